"""Suffix-array dedup and n-gram Jaccard join against brute force."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from llm import brute
from pyspark.sql import functions as F

from vetrail.llm import jaccard, suffix
from vetrail.llm.common import buffers
from vetrail.llm.components import connected_components
from vetrail.llm.queries import QUERIES


def _cut(rows):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}


@pytest.fixture(scope="module")
def awkward(spark):
    documents = brute.awkward_documents(spark).repartition(4).cache()
    documents.count()
    return documents


def test_cut_repeats_query(spark, sf_dir):
    rows = brute.texts_by_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert _cut(QUERIES["op1_suffix_array_dedup"](spark, sf_dir).collect()) == brute.cut_repeats(rows)


@pytest.mark.parametrize(("heavy", "giant"), [(suffix.HEAVY, suffix.GIANT), (3, suffix.GIANT), (3, 2), (suffix.HEAVY, 1)])
def test_cut_repeats_awkward(awkward, heavy, giant, monkeypatch):
    """Also with nearly all shared grams split, as the commonest ones are, and with buckets not sorted."""
    monkeypatch.setattr(suffix, "GIANT", giant)
    monkeypatch.setattr(suffix.heavy_grams, "__defaults__", (heavy, suffix.MAX_HEAVY))
    assert _cut(suffix.cut_repeats(awkward).collect()) == brute.cut_repeats(brute.texts_by_id(awkward))


def test_cut_repeats_keeps_columns_and_text(awkward):
    rows = suffix.cut_repeats(awkward, keep=["bucket", "n", "lang"])
    assert rows.count() == awkward.count()
    texts = dict(brute.texts_by_id(awkward))
    for r in rows.collect():
        if not r["n_removed"]:
            assert r["kept_text"] == (texts[r["doc_id"]] or "")


def test_cut_repeats_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    removed = sorted((r["doc_id"], r["n_removed"]) for r in suffix.cut_repeats(rows).collect())
    assert removed == [(1, 0), (1, 0), (2, len(text))]


def test_redo_on_bytes_agrees(monkeypatch):
    """A bucket with a false claim gives the same spans from plain bytes."""
    rng = np.random.default_rng(5)
    gram = bytes(rng.integers(97, 123, suffix.GRAM, dtype=np.uint8))
    sides = [bytes(rng.integers(97, 123, suffix.SIDE, dtype=np.uint8)) for _ in range(4)]
    around, left = [], []
    for k in range(40):
        before = sides[k % 4][k % 7 * 9 :] if k % 3 else sides[k % 2]
        after = sides[(k * 3) % 4][: 68 - k % 5 * 11]
        around.append(before + gram + after)
        left.append(len(before))
    n = len(around)
    columns = (
        np.zeros(n, np.int64), np.full(n, -1), np.arange(n) % 13, np.arange(n) * 500 + 100, np.array(left), around,
    )
    plain = suffix.repeated_windows(*columns)
    monkeypatch.setattr(suffix, "_false_claims", lambda *a: np.arange(n))
    redone = suffix.repeated_windows(*columns)
    assert all((a == b).all() for a, b in zip(plain, redone))
    assert len(plain[0])


def test_suffix_order_sorts():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 3000, dtype=np.uint8)
    start = np.sort(rng.integers(0, 2900, 500))
    stop = np.minimum(start + rng.integers(0, 90, 500), 3000)
    group = np.sort(rng.integers(0, 20, 500))
    order = suffix.suffix_order(raw, suffix.PrefixHashes(raw), start, stop, group)
    data = raw.tobytes()
    keys = [(int(group[i]), data[start[i] : stop[i]]) for i in order]
    assert keys == sorted(keys)
    assert sorted(order.tolist()) == list(range(500))


def test_jaccard_query(spark, sf_dir):
    rows = brute.texts_by_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = QUERIES["op2_ngram_jaccard_join"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute.jaccard_components(rows)
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(brute.shingles(t)) for i, t in rows}


@pytest.mark.parametrize("frequent", [jaccard.FREQUENT, 2])
def test_jaccard_awkward(awkward, frequent):
    """Also with every token of two documents a frequent one, so that combinations are indexed."""
    rows = brute.texts_by_id(awkward)
    found = jaccard.jaccard_components(awkward, frequent=frequent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute.jaccard_components(rows)


@pytest.mark.parametrize("turns", [0, 6])
def test_jaccard_hot_groups(awkward, turns, monkeypatch):
    """Nearly every signature counts as hot: clusters are compared in blocks, with and without random partners."""
    for name, value in {"HOT": 1, "BLOCK_DOCS": 4, "FEW_PAIRS": 0, "MAX_TURNS": turns}.items():
        monkeypatch.setattr(jaccard, name, value)
    found = jaccard.jaccard_components(awkward, frequent=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute.jaccard_components(brute.texts_by_id(awkward))


def test_blocks_keep_pairs_without_a_map():
    tokens = np.arange(1, 200, dtype=np.uint64)
    bits = [None, jaccard.bit_map(tokens).tobytes(), None]
    rows = pd.DataFrame({"_i": 0, "_j": 0, "_own": 0, "doc": [1, 2, 3], "component": [1, 2, 3], "n": 199, "bits": bits})
    found = jaccard._compare_blocks(80)(rows)
    assert sorted(zip(found["a"], found["b"])) == [(1, 2), (1, 3), (2, 3)]


def test_hot_documents_of_rare_tokens(spark):
    """A hot token that counts as rare: an all-rare document meets a mixed one, and one far from both."""
    words = [f"w{k}" for k in range(200)]
    texts = [words, [*words[:199], "x"], words[:20] + [f"y{k}" for k in range(180)]]
    lists = [list(jaccard.shingle_lists(*buffers(pa.array([" ".join(t)]))))[0] for t in texts]
    facts = [(k, len(t), None if k != 1 else jaccard.bit_map(t).tobytes()) for k, t in enumerate(lists)]
    hot = spark.createDataFrame([(7, k, k) for k in range(3)], "sig long, doc long, component long")
    found = jaccard._hot_pairs(
        hot,
        spark.createDataFrame(facts, "doc long, n long, bits binary"),
        spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc long, text string"),
        80,
    )
    assert [tuple(r) for r in found.collect()] == [(0, 1)]


def test_signatures_always_meet():
    """Any two sets that link share a signature, whatever the classes are."""
    rng = np.random.default_rng(11)
    for trial in range(400):
        n = int(rng.integers(1, 300))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        other = np.unique(
            np.concatenate([
                base[rng.random(len(base)) < rng.choice([0.85, 0.92, 1.0])],
                rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 8) + 1)), dtype=np.uint64),
            ])
        )
        both = len(np.intersect1d(base, other))
        if 100 * both < 80 * (len(base) + len(other) - both):
            continue
        common = rng.permutation(base)[: int(len(base) * rng.choice([0, 0.5, 0.9, 1.0]))]
        frequent = jaccard.Frequent(np.sort(common), 0)
        a, _ = jaccard.signatures(base, frequent)
        b, _ = jaccard.signatures(other, frequent)
        assert len(np.intersect1d(a, b)), (trial, n)


@pytest.mark.parametrize(("frequent", "hot"), [(jaccard.FREQUENT, jaccard.HOT), (2, 2), (1_000, 2)])
def test_jaccard_ids_of_several_texts(spark, monkeypatch, frequent, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "MAX_TURNS", 0)
    rows = []
    for k in range(12):
        short = [f"s{k}x{i}" for i in range(16)]
        long = [f"l{k}x{i}" for i in range(60 + 7 * k)]
        # One id with both texts, in either order, and four others that are near copies of one of them.
        rows += [(k, " ".join(t)) for t in ([short, long] if k % 2 else [long, short])]
        for c in range(2):
            rows.append((100 + 10 * k + c, " ".join([*short[:-1], f"end{c}"])))
            rows.append((105 + 10 * k + c, " ".join([f"start{c}", *long[1:]])))
        # Two ids with alike texts under the threshold: that both have an empty row too is no link.
        near = [f"n{k}x{i}" for i in range(20)]
        rows += [(300 + k, " ".join(near)), (300 + k, None), (400 + k, " ".join([*near[:10], "x", *near[11:]])), (400 + k, "")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(documents, frequent=frequent).collect()}
    assert found == brute.jaccard_components(rows) and set(found.values()) == {*range(12), *range(300, 312), *range(400, 412)}


@pytest.mark.parametrize("run", [suffix.cut_repeats, jaccard.jaccard_components])
def test_empty_table(awkward, run):
    assert run(awkward.limit(0)).collect() == []


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 105), (105, 103), (7, 7), (200, 100), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    at = {r["node"]: r["component"] for r in found.collect()}
    assert {at[k] for k in range(61)} == {0}
    assert {at[k] for k in (100, 103, 105, 200)} == {100}
    assert found.count() == len(at)
    assert connected_components(spark.createDataFrame([], "a long, b long")).filter(F.lit(True)).collect() == []
