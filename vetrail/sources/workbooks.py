"""Workbook sheets (.xlsx) as a Spark data source: ``spark.read.format("workbook")``.

The plan cuts a sheet into ranges of rows, told by the sheet's own dimension. A task streams the sheet's XML from its
start, skips rows ahead of its range unparsed, parses the rows of its range, and then streams the shared strings once for
those that its rows name. So a task holds its rows, not the sheet. Every value comes as text: dates (by the cell's number
format) as ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``, whole numbers without a point.

Options: ``path`` (a file, a folder or a glob; Arrow opens it), ``sheet`` (name or number from 1; 1 by default), ``rows``
of a range (50,000 by default). The first row of a sheet names its columns; the schema picks columns by these
names, and columns that a sheet lacks are null.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from fnmatch import fnmatch
from xml.etree import ElementTree

import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vetrail.session import with_package

RANGE_ROWS = 50_000
_CHUNK = 1 << 16
_ROW = re.compile(rb"<(?:\w+:)?row\b([^>]*?)(/>|>)")
_NUMBER = re.compile(rb'\br="(\d+)"')
_LETTERS = re.compile(r"[A-Z]+")
# Numbers of the built-in date formats.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), 45, 46, 47, *range(50, 59)])


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _attribute(element, name: str) -> str | None:
    return next((v for k, v in element.attrib.items() if k.rpartition("}")[2] == name), None)


def _place(reference: str) -> int:
    """Column number from 0 of a cell reference such as ``AB12``."""
    n = 0
    for c in _LETTERS.match(reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(element) -> str:
    """All text of a string item, without phonetic hints."""
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts += [t.text or "" for t in child if _tag(t) == "t"]
    return "".join(parts)


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def _files(path: str) -> list[str]:
    """The workbooks that a path names, in order."""
    folder, _, pattern = path.rpartition("/")
    if "*" in pattern:
        store, root = _resolve(folder)
    else:
        store, root = _resolve(path)
        if store.get_file_info([root])[0].type == fs.FileType.File:
            return [path]
        folder, pattern = path.rstrip("/"), "*.xlsx"
    names = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File)
    return [f"{folder}/{n}" for n in names if fnmatch(n, pattern)]


class Workbook:
    """An open workbook: its sheets, date styles and shared strings."""

    def __init__(self, path: str):
        store, root = _resolve(path)
        self._file = store.open_input_file(root)
        self._zip = zipfile.ZipFile(self._file)

    def __enter__(self) -> "Workbook":
        return self

    def __exit__(self, *_) -> None:
        self._zip.close()
        self._file.close()

    def _part(self, name: str):
        return ElementTree.fromstring(self._zip.read(name))

    def sheet(self, wanted: str) -> str:
        """The part of a sheet by its name, or its number from 1."""
        book = self._part("xl/workbook.xml")
        sheets = [e for e in book.iter() if _tag(e) == "sheet"]
        found = next((e for e in sheets if _attribute(e, "name") == wanted), None)
        if found is None and wanted.isdigit() and 0 < int(wanted) <= len(sheets):
            found = sheets[int(wanted) - 1]
        if found is None:
            raise ValueError(f"no sheet {wanted}; there are {', '.join(str(_attribute(e, 'name')) for e in sheets)}")
        links = {_attribute(e, "Id"): _attribute(e, "Target") for e in self._part("xl/_rels/workbook.xml.rels")}
        target = links[next(v for k, v in found.attrib.items() if k.endswith("}id"))]
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def first_day(self) -> datetime:
        """The day that number 0 stands for."""
        settings = [e for e in self._part("xl/workbook.xml").iter() if _tag(e) == "workbookPr"]
        late = bool(settings) and _attribute(settings[0], "date1904") in ("1", "true")
        return datetime(1904, 1, 1) if late else datetime(1899, 12, 30)

    def date_styles(self) -> frozenset[int]:
        """Numbers of the cell styles that show dates."""
        if "xl/styles.xml" not in self._zip.namelist():
            return frozenset()
        styles = self._part("xl/styles.xml")
        dates = set(_DATE_FORMATS)
        for e in styles.iter():
            if _tag(e) == "numFmt":
                plain = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", _attribute(e, "formatCode") or "")
                if re.search("[ymdhs]", plain, re.I) and "General" not in plain:
                    dates.add(int(_attribute(e, "numFmtId")))
        formats = next((e for e in styles if _tag(e) == "cellXfs"), [])
        return frozenset(i for i, e in enumerate(formats) if int(_attribute(e, "numFmtId") or 0) in dates)

    def strings(self, wanted: set[int]) -> dict[int, str]:
        """Shared strings by number, streamed."""
        found: dict[int, str] = {}
        if not wanted:
            return found
        last, number = max(wanted), -1
        with self._zip.open("xl/sharedStrings.xml") as part:
            for _, element in ElementTree.iterparse(part):
                if _tag(element) == "si":
                    number += 1
                    if number in wanted:
                        found[number] = _text(element)
                    element.clear()
                    if number >= last:
                        break
        return found

    def last_row(self, part: str) -> int | None:
        """The last row by the sheet's dimension; None where the sheet does not tell."""
        with self._zip.open(part) as stream:
            told = re.search(rb'<(?:\w+:)?dimension[^>]*\bref="[^":]*(?::[A-Z]+(\d+))?"', stream.read(_CHUNK))
        return int(told[1]) if told and told[1] else None

    def rows(self, part: str, first: int, last: float) -> Iterator[tuple[int, list[tuple]]]:
        """(row, cells) of a range of rows; a cell is (column, kind, style, text)."""
        with self._zip.open(part) as stream:
            held, row, ended = b"", 0, False
            while not ended or held:
                start = _ROW.search(held)
                if start is None:
                    data = stream.read(_CHUNK)
                    ended = not data
                    if ended:
                        return
                    held = held[-256:] + data
                    continue
                told = _NUMBER.search(start[1])
                if start[2] == b"/>":
                    row, held = int(told[1]) if told else row + 1, held[start.end() :]
                    continue
                end = re.compile(rb"</(?:\w+:)?row\s*>").search(held, start.end())
                while end is None:
                    data = stream.read(_CHUNK)
                    if not data:
                        raise ValueError(f"{part} ends inside a row")
                    held += data
                    end = re.compile(rb"</(?:\w+:)?row\s*>").search(held, start.end())
                row = int(told[1]) if told else row + 1
                if row > last:
                    return
                body, held = held[start.end() : end.start()], held[end.end() :]
                if row >= first:
                    yield row, _cells(body)


def _cells(body: bytes) -> list[tuple]:
    # Prefixes are bound by the sheet's own root; here any will do.
    names = set(re.findall(rb"</?(\w+):", body)) | set(re.findall(rb"\s(\w+):\w+=", body))
    bound = b"".join(b' xmlns:%s="x"' % n for n in names if n != b"xml")
    out, column = [], -1
    for cell in ElementTree.fromstring(b"<row" + bound + b">" + body + b"</row>"):
        reference = _attribute(cell, "r")
        column = _place(reference) if reference else column + 1
        kind = _attribute(cell, "t") or "n"
        value = next((e for e in cell if _tag(e) == ("is" if kind == "inlineStr" else "v")), None)
        if value is not None:
            text = _text(value) if kind == "inlineStr" else value.text or ""
            out.append((column, kind, int(_attribute(cell, "s") or 0), text))
    return out


def _shown(kind: str, style: int, text: str, strings: dict[int, str], dates: frozenset[int], day: datetime) -> str | None:
    if kind == "s":
        return strings.get(int(text))
    if kind == "b":
        return "true" if text == "1" else "false"
    if kind == "e":
        return None
    if kind == "n" and text:
        number = float(text)
        if style in dates:
            at = day + timedelta(seconds=round(number * 86400))
            return at.strftime("%Y-%m-%d") if at.time() == datetime.min.time() else at.strftime("%Y-%m-%d %H:%M:%S")
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
    return text


@dataclass
class RowRange(InputPartition):
    path: str
    part: str
    first: int
    last: float


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self._names = [f.name for f in schema.fields]
        self._path, self._sheet = options["path"], options.get("sheet", "1")
        self._rows = int(options.get("rows", RANGE_ROWS))

    def partitions(self) -> list[RowRange]:
        out = []
        for path in _files(self._path):
            with Workbook(path) as book:
                part = book.sheet(self._sheet)
                last = book.last_row(part)
            starts = range(1, (last or 1) + 1, self._rows)
            out += [RowRange(path, part, s, s + self._rows - 1) for s in starts]
            out[-1].last = float("inf")  # a dimension may be out of date
        return out or [RowRange("", "", 1, 0)]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        if not partition.path:
            return
        with Workbook(partition.path) as book:
            day, dates = book.first_day(), book.date_styles()
            head = next(book.rows(partition.part, 1, float("inf")), None)
            if head is None:
                return
            rows = [r for r in book.rows(partition.part, max(partition.first, head[0] + 1), partition.last)]
            wanted = {int(t) for _, cells in [head, *rows] for _, kind, _, t in cells if kind == "s"}
            strings = book.strings(wanted)
            named = {}
            for column, *cell in head[1]:
                named.setdefault(_shown(*cell, strings, dates, day), column)
            for _, cells in rows:
                values = {column: _shown(*cell, strings, dates, day) for column, *cell in cells}
                yield tuple(values.get(named.get(n)) for n in self._names)


class WorkbookSource(DataSource):
    """``workbook``: a sheet of .xlsx files as text columns."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        raise ValueError("name the columns to read by a schema")

    def reader(self, schema: T.StructType) -> _Reader:
        if any(f.dataType != T.StringType() for f in schema.fields):
            raise ValueError("a workbook gives text columns; cast them afterwards")
        return _Reader(schema, self.options)


def read_workbook(spark: SparkSession, path: str, schema: T.StructType, sheet: str = "1", rows: int = RANGE_ROWS) -> DataFrame:
    """The columns of a schema from a sheet, cast to their types; a value that does not fit its type is null."""
    with_package(spark).dataSource.register(WorkbookSource)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    found = spark.read.format("workbook").schema(texts).options(sheet=sheet, rows=str(rows)).load(path)
    return found.select(*[found[f"`{f.name}`"].try_cast(f.dataType).alias(f.name) for f in schema.fields])
