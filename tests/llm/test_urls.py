"""URL filters against a plain loop over all rules."""

import random
import re

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from vetrail.llm.queries import QUERIES, URL_RULES
from vetrail.llm.urls import DigestArray, DigestReader, Part, _write_part, build_digest_array, filter_urls, rules_table

SCHEMA = "page_id long, url string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def judge(url, rules, default="allow"):
    host, path = parts_of(url)
    fits = [(h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


ODD = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "http://COM/x", "http://a.com?x=/", "http://notcom/",
    "http://a.notcom/", "http://example.com/en", "http://example.com/en/", "https://WWW.Example.com/en/x#y://z",
    "https://m.www.example.com/en/x", "http://x.net/es/a", "http://net/fr/", "http://x.net/ES/a", "http://x.net/de/",
    "http://x.net:80/es/", "http://user@x.net/es/", "http://a..com/", "http://.com/", "http://com./", "http://é.com/ß?É",
    "a://b://c.com/", "http://x.com/line\nbreak", "HTTP://ÄX.COM/Ä", "http://x.net#/es/", "http://" + "a." * 3000 + "com/" + "p" * 50000,
]


def test_odd_urls(spark):
    rows = [(i, u) for i, u in enumerate(ODD)] + [(None, "http://a.com/"), (0, None), (0, None)]
    found = filter_urls(spark.createDataFrame(rows, SCHEMA), build_digest_array(rules_table(spark, URL_RULES)))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((i, *judge(u, URL_RULES)) for i, u in rows), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want


def test_many_rules_in_many_parts(spark):
    rng = random.Random(7)
    words = ["a", "b", "cc", "d.e", "éé"]

    def host():
        return ".".join(rng.choice(words) for _ in range(rng.randint(1, 4)))

    def path():
        return "".join("/" + rng.choice(words) for _ in range(rng.randint(0, 4)))

    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(400)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    stated = [*rules, *rules[:30], (None, "/", "block"), ("A.b", None, "block")]
    rules = [r for r in rules if r[:2] != ("a.b", "")] + [("a.b", "", "block")]
    array = build_digest_array(rules_table(spark, stated), part_entries=40)
    assert len(array.parts) > 5
    urls = [f"http://{host()}{path()}{rng.choice(['', '?q', '#f', '/'])}" for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(urls)), SCHEMA).repartition(5)
    found = {r["page_id"]: tuple(r)[1:] for r in filter_urls(rows, array, default="block").collect()}
    assert found == {i: judge(u, rules, "block") for i, u in enumerate(urls)}


def test_collisions_are_told_apart_by_the_strings(tmp_path):
    texts, same = ["one", "two", "six"], 77
    rows = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([b"1", b"2", b"6"], pa.binary()), pa.array([same, same, 99])],
        names=["text", "value", "digest"],
    )
    (told,) = _write_part(str(tmp_path))(iter([rows]))
    reader = DigestReader(DigestArray(str(tmp_path), (Part(*told.to_pylist()[0].values()),)))
    asked = [(same, b"two"), (same, b"other"), (99, b"six"), (99, b"one"), (5, b"one"), (same, b"one")]
    import numpy as np

    found = reader.find(np.array([d for d, _ in asked]), [t for _, t in asked])
    assert found == {0: b"2", 2: b"6", 5: b"1"}


def test_digests_are_those_of_spark(spark):
    text = "пример.com//en/"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_no_rows_no_rules_other_columns(spark):
    some = build_digest_array(rules_table(spark, URL_RULES))
    assert filter_urls(spark.createDataFrame([], SCHEMA), some).count() == 0
    none = build_digest_array(rules_table(spark, []))
    pages = spark.createDataFrame([(1, "http://a.net/es/", "h", "v")], f"{SCHEMA}, host string, verdict string")
    assert filter_urls(pages, none).first()["verdict"] == "allow"
    assert filter_urls(pages, some).first().asDict() == {
        "page_id": 1, "host": "a.net", "path": "/es/", "rule": "net/es/", "verdict": "block"
    }
    assert filter_urls(pages, some, keep=["url"]).columns[:2] == ["page_id", "url"]
    with pytest.raises(ValueError, match="host"):
        filter_urls(pages, some, keep=["host"])
    with pytest.raises(ValueError, match="verdicts"):
        build_digest_array(rules_table(spark, [("a", "/", "maybe")]))


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    found = {r["page_id"]: tuple(r)[1:] for r in QUERIES["op11_url_filters"](spark, sf_dir).collect()}
    assert found == {i: judge(u, URL_RULES) for i, u in pages}
