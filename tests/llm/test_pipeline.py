"""The pipeline: every stage against brute force on what the stage before it kept."""

import corpus_pipeline
from llm import brute
from pyspark.sql import functions as F

from vetrail.llm.mixing import mix_sources
from vetrail.session import materialized


def _stages(spark, docs, sf_dir):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialized(stage(spark, out[-1], sf_dir)))
    return out


def _check(docs):
    start, known, near, cut, mixed, packed = docs
    rows = brute.texts_by_id(start)
    assert {r["doc_id"] for r in start.subtract(known).collect()} <= {
        i for i, t in rows if not any(c.isalpha() for c in t or "") or len(t) < 30
    }
    assert all(any(c.isalpha() for c in t) for _, t in brute.texts_by_id(known))
    rows = brute.texts_by_id(known)
    component = brute.jaccard_components(rows)
    assert sorted(i for i, _ in brute.texts_by_id(near)) == sorted(set(component.values()))
    rows = brute.texts_by_id(near)
    removed = brute.cut_repeats(rows)
    after = dict(brute.texts_by_id(cut))
    assert set(after) == set(removed)
    for i, text in rows:
        total, gone, _, _ = removed[i]
        assert total - gone - 6 * removed[i][2] <= len(after[i].encode()) <= total - gone
        if not gone:
            assert after[i] == text
    copies = {}
    for r in mixed.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
        assert r["text"] == after[r["doc_id"]]
    assert set(copies) <= set(after) and max(copies.values()) <= 2
    given = mix_sources(cut).collect()
    assert copies == {r["doc_id"]: r["copies"] for r in given if r["copies"]}
    for table in (known, near, cut, mixed):
        assert table.columns == start.columns
    rows = packed.toPandas()
    assert len(rows[rows["piece"] == 0]) == sum(copies.values())
    once = rows.drop_duplicates(["doc_id", "piece"])
    assert once["doc_id"].nunique() == len(copies)
    for _, bin_ in rows.groupby("sequence_id"):
        bin_ = bin_.sort_values("offset")
        assert (bin_["offset"] == bin_["length"].cumsum() - bin_["length"]).all() and bin_["length"].sum() <= 4096


def test_stages_on_documents(spark, sf_dir):
    _check(_stages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir))


def test_stages_on_awkward_documents(spark, sf_dir):
    # Labels that follow no rule would make every text ambiguous.
    docs = brute.awkward_documents(spark).withColumn("lang", F.lit("en"))
    _check(_stages(spark, materialized(docs.union(docs.limit(3))), sf_dir))


def test_rows_without_an_id_of_their_own(spark, sf_dir):
    """Null ids and different texts under one id stay through near-duplicate removal, cuts and mixing."""
    def prose(tag):
        return " ".join(f"{tag}word{k}" for k in range(40))

    shared = prose("shared")
    ids = [(None, "a"), (None, "b"), (None, "a"), (1, "c"), (1, "d"), (1, "c"), (2, "e"), (None, "e")]
    rows = [(i, prose(t), "en", "s", 0) for i, t in ids]
    rows += [(3, f"{prose('f')} {shared}", "en", "s", 0), (3, f"{prose('g')} {shared}", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = materialized(corpus_pipeline.jaccard_join(spark, docs, sf_dir))
    key = lambda r: (r["doc_id"] or 0, r["text"])
    wanted = {(0, prose("a")), (0, prose("b")), (1, prose("c")), (1, prose("d")), (2, prose("e"))}
    wanted |= {(3, rows[-1][1]), (3, rows[-2][1])}
    assert sorted(map(key, near.collect())) == sorted(wanted)
    cut = materialized(corpus_pipeline.suffix_array_dedup(spark, near, sf_dir))
    texts = sorted(map(key, cut.collect()))
    assert [t for t in texts if t[0] < 3] == sorted(t for t in wanted if t[0] < 3)
    assert sorted(len(t) < 600 for i, t in texts if i == 3) == [False, True]
    mixed = list(map(key, corpus_pipeline.mixing(spark, cut, sf_dir).collect()))
    assert set(mixed) == set(texts) and max(mixed.count(t) for t in texts) <= 2


def test_columns_with_clashing_names(spark, sf_dir):
    """Extra columns keep their values, whatever the stages call their own."""
    names = ["kept_text", "_kept_text", "_copies", "_copy", "copies", "_row", "n_removed", "lang_pred", "score", "_letters", "component_id"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = materialized(docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in names}))
    for table in _stages(spark, docs, sf_dir)[1:-1]:
        assert table.columns == docs.columns
        for r in table.collect():
            assert [r[c] for c in names] == [f"{c}-{r['doc_id']}" for c in names]


def test_too_long_texts_are_refused():
    import numpy as np
    import pytest

    from vetrail.llm import suffix

    raw = np.broadcast_to(np.uint8(97), (1 << 28) + 1)
    with pytest.raises(ValueError, match="at most 268435456"):
        suffix.elected(raw, np.array([0, len(raw)]))


def test_run_is_the_stages(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    docs = _stages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)[-1]
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(keys).collect())) == sorted(map(tuple, docs.select(keys).collect()))


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert all(d.count() == 0 for d in _stages(spark, docs, sf_dir))


def test_stages_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "suffix-array dedup", "mixing", "best-fit packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
