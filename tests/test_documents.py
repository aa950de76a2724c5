"""Documents read in byte ranges against a JSON parser."""

import json
import random
from collections import Counter

import pytest

from vetrail.sources import documents, readers

STRINGS = ["", "}", "{", "[", "]", '"', "\\", '\\"', "a}{b", '"results": [', "\\\\", "é} ", "line\nbreak}", '"}', "{}{}", ",", '\\"results\\": [{']


def value(rng, depth=0):
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind <= 2:
        return "".join(rng.choice(STRINGS) for _ in range(rng.randint(0, 3)))
    if kind == 3:
        return rng.choice([None, True, 1.5, -3])
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["a", "results", "}", "x y"]) + str(i): value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def record(rng, i):
    return {"id": str(i), "results": [{"id": "inner"}], "more": value(rng), "deep": {"results": [value(rng)]}}


def canonical(x):
    return json.dumps(x, sort_keys=True)


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "211", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "24"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("indent,ascii_only", [(None, False), (1, True)])
def test_records_of_documents(spark, tmp_path, small_ranges, indent, ascii_only):
    rng = random.Random(5)
    want = Counter()
    for f in range(4):
        records = [record(rng, i) for i in range(rng.choice([0, 1, 12]) if f else 20)]
        document = {"meta": {"results": [{"no": 1}], "x": value(rng)}, "others": [{"no": 2}], "note": STRINGS[f], "results": records}
        if f % 2:
            document |= {"tail": [{"no": 3}], "last": {"a": [{"no": 4}]}}
        text = json.dumps(document, indent=indent, ensure_ascii=ascii_only)
        (tmp_path / f"{f}.json").write_text(text, encoding="utf-8")
        want.update(canonical(r) for r in records)
    fragments = documents._fragments(spark, str(tmp_path))
    assert fragments.select("file", "block").distinct().count() > 20
    found = documents.document_records(spark, str(tmp_path)).collect()
    assert Counter(canonical(json.loads(r["record"])) for r in found) == want


def test_documents_that_are_arrays(spark, tmp_path, small_ranges):
    rng = random.Random(6)
    records = [record(rng, i) for i in range(25)]
    (tmp_path / "a.json").write_text(json.dumps([1, "x", *records[:10], None, *records[10:]], indent=2))
    (tmp_path / "b.json").write_text("[]\n")
    (tmp_path / "c.json").write_text("")
    found = documents.document_records(spark, str(tmp_path), None).collect()
    assert Counter(canonical(json.loads(r["record"])) for r in found) == Counter(map(canonical, records))


def test_documents_without_the_field(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"meta": {"results": [{"a": 1}]}, "text": "\\"results\\": [{}]"}')
    (tmp_path / "b.json").write_text('{"results": []}')
    assert documents.document_records(spark, str(tmp_path)).count() == 0


def test_lines_of_a_document(spark, tmp_path, small_ranges):
    records = [{"recalling_firm": f"F}}{i}\n", "classification": "Class I", "other": {"a": [i]}} for i in range(50)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"meta": 1, "results": records}, indent=3))
    readers.document_to_lines(spark, str(tmp_path / "in"), str(tmp_path / "lines"))
    rows = readers.read_recalls(spark, {"drug": str(tmp_path / "lines")}, ["recalling_firm"], lines=True)
    assert Counter(r["recalling_firm"] for r in rows.collect()) == Counter(r["recalling_firm"] for r in records)


def test_only_the_text_goes_through_the_shuffle(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text('{"results": [{"a": "x } \\" {"}, {"b": [1, {"c": 2}]}]}')
    passed, before = [], documents._before
    monkeypatch.setattr(documents, "_before", lambda rows, *sums: (passed.append(rows.columns), before(rows, *sums))[1])
    found = documents.document_records(spark, str(tmp_path)).collect()
    assert sorted(r["record"] for r in found) == ['{"a": "x } \\" {"}', '{"b": [1, {"c": 2}]}']
    assert passed and not any("_pieces" in columns for columns in passed)
