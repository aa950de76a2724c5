"""Workbook sheets written by hand and read in ranges of rows."""

import zipfile
from datetime import date
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import types as T

from vetrail.sources import readers, schemas, workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINKS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def name(column):
    return chr(65 + column) if column < 26 else chr(64 + column // 26) + chr(65 + column % 26)


def write_book(path, sheets, dimension=True, late=False):
    """Sheets are lists of rows of cells: text (shared), ("i", text), ("n", number), ("d", number), ("b", 0 or 1), ("e", text), None."""
    strings: dict[str, int] = {}
    parts = {}
    for k, rows in enumerate(sheets.values(), 1):
        lines = []
        for r, row in enumerate(rows, 1):
            cells = []
            for c, cell in enumerate(row):
                at = f'r="{name(c)}{r}"'
                if isinstance(cell, str):
                    cells.append(f'<c {at} t="s"><v>{strings.setdefault(cell, len(strings))}</v></c>')
                elif cell is not None:
                    kind, v = cell
                    body = {"i": f'<c {at} t="inlineStr"><is><t>{escape(str(v))}</t></is></c>', "n": f"<c {at}><v>{v}</v></c>",
                            "d": f'<c {at} s="1"><v>{v}</v></c>', "b": f'<c {at} t="b"><v>{v}</v></c>', "e": f'<c {at} t="e"><v>{v}</v></c>'}
                    cells.append(body[kind])
            lines.append(f'<row r="{r}">{"".join(cells)}</row>' if cells else f'<row r="{r}"/>')
        told = f'<dimension ref="A1:{name(max(map(len, rows), default=1) - 1)}{len(rows)}"/>' if dimension and rows else ""
        parts[f"xl/worksheets/sheet{k}.xml"] = f"<worksheet {MAIN}>{told}<sheetData>{''.join(lines)}</sheetData></worksheet>"
    listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
    day = '<workbookPr date1904="1"/>' if late else ""
    parts["xl/workbook.xml"] = f"<workbook {MAIN} {LINKS}>{day}<sheets>{listed}</sheets></workbook>"
    links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships>{links}</Relationships>"
    items = "".join(f"<si><r><t>{escape(s[:2])}</t></r><r><t>{escape(s[2:])}</t></r></si>" for s in strings)
    parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>{items}</sst>"
    parts["xl/styles.xml"] = (
        f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>'
    )
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for part, text in parts.items():
            out.writestr(part, text)


SCHEMA = T.StructType([T.StructField(*f) for f in [("no", T.LongType()), ("firm", T.StringType()), ("day", T.DateType()), ("gone", T.StringType())]])


def rows_of(n, first=0):
    return [[("n", i), f"Firm <{i % 7}> & Co", ("d", 44000 + i)] for i in range(first, first + n)]


def expected(n, first=0, shift=0):
    start = date(2020, 6, 18).toordinal() + shift
    return sorted((i, f"Firm <{i % 7}> & Co", date.fromordinal(start + i), None) for i in range(first, first + n))


@pytest.mark.parametrize("dimension", [True, False])
def test_two_sheets_in_ranges(spark, tmp_path, dimension):
    head = ["no", "firm", "day"]
    path = str(tmp_path / "book.xlsx")
    write_book(path, {"One": [head, *rows_of(5000)], "Other sheet": [head[::-1], *[r[::-1] for r in rows_of(40, 9)]]}, dimension)
    found = workbooks.read_workbook(spark, path, SCHEMA, rows=700)
    assert sorted(map(tuple, found.collect())) == expected(5000)
    assert found.rdd.getNumPartitions() == (8 if dimension else 1)
    other = workbooks.read_workbook(spark, path, SCHEMA, "Other sheet")
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, workbooks.read_workbook(spark, path, SCHEMA, "2").collect())) == expected(40, 9)
    with pytest.raises(Exception, match="no sheet Third; there are One, Other sheet"):
        workbooks.read_workbook(spark, path, SCHEMA, "Third").count()


def test_cells_of_all_kinds(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    rows = [
        ["a", "b", "", "c"], [("i", " x<y "), ("n", "1.5"), None, ("b", 1)], [], [None, ("e", "#N/A"), "z", ("d", 1.5)],
        ["é\n\"", ("n", "1E3")], [("n", "-0.25"), ("d", "0.25")],
    ]
    write_book(path, {"S": rows}, late=True)
    texts = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    got = [tuple(r) for r in workbooks.read_workbook(spark, path, texts, rows=2).collect()]
    assert sorted(got, key=repr) == sorted(
        [(" x<y ", "1.5", "true"), (None, None, "1904-01-02 12:00:00"), ("é\n\"", "1000", None), ("-0.25", "1904-01-01 06:00:00", None)], key=repr
    )


def test_folders_and_empty_sheets(spark, tmp_path):
    for k in range(3):
        write_book(tmp_path / f"{k}.xlsx", {"S": [["no", "firm", "day"], *rows_of(10 * k, 100 * k)] if k else []})
    found = workbooks.read_workbook(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, found.collect())) == sorted([*expected(10, 100), *expected(20, 200)])
    assert workbooks.read_workbook(spark, f"{tmp_path}/2*.xlsx", SCHEMA).count() == 20
    assert workbooks.read_workbook(spark, f"{tmp_path}/none*.xlsx", SCHEMA).count() == 0


def test_inspections_from_a_workbook(spark, tmp_path):
    fields = schemas.INSPECTIONS.fields
    cells = {"Inspection End Date": ("d", 44000)}
    row = [cells.get(f.name, ("n", 7) if f.dataType != T.StringType() else f"v {f.name}") for f in fields]
    path = str(tmp_path / "inspections.xlsx")
    write_book(path, {"Sheet1": [[f.name for f in fields], row]})
    found = readers.read_inspections(spark, path, "workbook").first()
    assert found["Inspection End Date"] == date(2020, 6, 18)
    assert all(found[f.name] == f"v {f.name}" for f in fields if f.dataType == T.StringType())
