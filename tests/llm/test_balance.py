"""Mixing to several margins."""

import numpy as np
import pandas as pd
import pytest
from llm import brute
from pyspark.sql import functions as F

from vetrail.llm import balance

SHARES = {"lang": {"en": 0.4, "de": 0.3, "fr": 0.2, None: 0.1}, "band": {0: 1, 1: 1}}


def _documents(spark, n=6000):
    rng = np.random.default_rng(2)
    langs, sources = np.array(["en", "de", "fr", None], object), np.array(["a", "b", "c", None], object)
    rows = []
    for k in range(n):
        words = int(rng.integers(1, 60))
        source = sources[min(3, int(rng.exponential()))]
        lang = langs[int(rng.choice(4, p=[0.6, 0.2, 0.1, 0.1]))] if source != "b" else "en" if k % 3 else "de"
        rows.append((k, "w " * words, source, lang, int(words > 30), "clash"))
    schema = "doc_id long, text string, source string, lang string, band int, _size string"
    return spark.createDataFrame(rows, schema)


def _raked(cells, targets, goals):
    """The same optimum by iterative proportional fitting over (source, lang, band) cells."""
    rate = {c: 1.0 for c in cells}
    for _ in range(3000):
        for axis, goal in enumerate((targets, *goals)):
            got = dict.fromkeys(goal, 0.0)
            for c, words in cells.items():
                got[c[axis]] += words * rate[c]
            for c in cells:
                rate[c] *= goal[c[axis]] / got[c[axis]]
    return rate


def test_margins_are_met(spark, monkeypatch):
    monkeypatch.setattr(balance, "BUCKET_CELLS", 6)
    documents = _documents(spark)
    found = balance.balanced_mix(documents, SHARES, block_rows=500)
    assert found.columns == ["doc_id", "source", "lang", "band", "size", "source_size", "target", "rate", "copies", "taken"]
    rows = found.toPandas()
    assert sorted(rows["doc_id"]) == list(range(6000))
    some = rows.fillna({"source": "-", "lang": "-"})
    targets = some.groupby("source")["target"].first().to_dict()
    total = sum(targets.values())
    goals = [{k or "-": share * total for k, share in SHARES["lang"].items()}, {0: total / 2, 1: total / 2}]
    for column, goal in (("source", targets), ("lang", goals[0]), ("band", goals[1])):
        exact = (some["rate"] * some["size"]).groupby(some[column]).sum()
        taken = some.groupby(column)["taken"].sum()
        for value, words in goal.items():
            assert exact[value] == pytest.approx(words, rel=1e-5)
            assert taken[value] == pytest.approx(words, rel=0.01)
    assert (some.groupby("source")["rate"].nunique() > 1).all()  # rates differ inside a source
    cells = some.groupby(["source", "lang", "band"])["size"].sum().to_dict()
    raked = _raked(cells, targets, goals)
    for cell, rate in some.groupby(["source", "lang", "band"])["rate"].first().items():
        assert rate == pytest.approx(raked[cell], rel=1e-4)
    again = balance.balanced_mix(documents.repartition(7), SHARES, block_rows=500).toPandas()
    pd.testing.assert_frame_equal(rows.sort_values("doc_id", ignore_index=True), again.sort_values("doc_id", ignore_index=True))


def test_targets_that_cannot_be_met(spark):
    documents = _documents(spark, 400)
    # Source b has no French: all words in French cannot hold b's target.
    with pytest.raises(ValueError, match="cannot be met"):
        balance.balanced_mix(documents, {"lang": {"fr": 0.999, "en": 0.001}})
    with pytest.raises(ValueError, match="no document"):
        balance.balanced_mix(documents, {"lang": {"en": 1, "xx": 1}})
    with pytest.raises(ValueError, match="below 0"):
        balance.balanced_mix(documents, {"lang": {"en": 1, "de": -1}})


def test_balance_awkward(spark):
    documents = brute.awkward_documents(spark).withColumn("_rows", F.lit("x"))
    assert balance.balanced_mix(documents.limit(0), {}).count() == 0
    rows = balance.balanced_mix(documents, {}).toPandas()
    assert len(rows) == documents.count()
    assert (rows.loc[rows["size"] == 0, "copies"] == 0).all()
    once = spark.range(5000).selectExpr("1L as doc_id", "'a b c' as text", "'s' as source", "'en' as lang")
    repeated = balance.balanced_mix(once, {"lang": {"en": 1}}).toPandas()
    assert len(repeated) == 5000 and set(repeated["copies"]) == {1, 2} and repeated["taken"].sum() == 22500
