"""Language identification, quality, fingerprints, license scans, embeddings."""

import hashlib
import string
import zlib

import numpy as np
import pandas as pd
import pytest
from llm import brute
from pyspark.sql import functions as F

from vetrail.llm import fingerprint, hnsw, langid, licenses, quality, vectors
from vetrail.llm.queries import QUERIES

CURLY = "\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f"


@pytest.fixture(scope="module")
def awkward(spark):
    documents = brute.awkward_documents(spark).repartition(3).cache()
    documents.count()
    return documents


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def larger_dir():
    return "/root/testdata/sf0.01"


def test_language_accuracy(spark, larger_dir, documents):
    found = QUERIES["op7_language_id"](spark, larger_dir).toPandas().merge(documents, on="doc_id")
    assert len(found) == len(documents)
    fold = found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert (found["held_out"] == fold).all()
    held = found[found["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98
    assert found["score"].between(0, 1).all()


def test_language_awkward(awkward):
    model = langid.fit_languages(awkward)
    assert model.languages == ["en", "fr"]
    found = langid.identify_languages(awkward, model)
    assert found.count() == awkward.count()
    for r in found.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and (letters or r["score"] == 0)
    assert langid.identify_languages(awkward.limit(0), model).count() == 0
    unknown = langid.fit_languages(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.identify_languages(awkward, unknown).collect()} == {"und"}
    one = langid.fit_languages(awkward.withColumn("lang", F.lit("xx")))
    assert {r["lang_pred"] for r in langid.identify_languages(awkward, one).collect()} == {"und", "xx"}


@pytest.mark.parametrize("classes", [2, 3, 4, 7, 20])
def test_codewords_differ(classes):
    code = langid.codewords(classes)
    assert code.shape[0] == classes and set(np.unique(code)) == {-1, 1}
    assert len({row.tobytes() for row in code}) == classes
    assert all(abs(int(bit.sum())) < classes for bit in code.T)


def test_quality_held_out(spark, larger_dir):
    labels = pd.read_parquet(f"{larger_dir}/labels.parquet")
    found = QUERIES["op10_quality"](spark, larger_dir).toPandas()
    fold = found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    assert (found["held_out"] == fold).all()
    assert (found["predicted"] == (found["score"] >= 0.7)).all()
    held = found[found["held_out"]].merge(labels, on="doc_id")
    good = held["quality"] == 1
    rank = held["score"].rank()
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.9 and (held["predicted"] == held["quality"]).mean() > 0.9


def test_quality_awkward(spark, awkward):
    labels = awkward.select("doc_id", F.when(F.col("n") % 2 == 0, 1).otherwise(0).alias("quality"), "score")
    labels = labels.union(labels.limit(3)).union(labels.limit(2).withColumn("quality", F.lit(None).cast("int")))
    model = quality.fit_quality(awkward, labels)
    found = quality.score_quality(awkward, model)
    assert found.count() == awkward.count() and found.columns.count("score") == 1
    assert found.filter(~F.col("score").between(0, 1)).count() == 0
    none = quality.fit_quality(awkward, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(awkward, none).collect()} == {0.5}
    assert quality.score_quality(awkward.limit(0), model).count() == 0


def test_ngram_features_are_distinct_and_whole():
    text = b"one two two THREE,, 12 one two"
    (idx, values), (none, _) = quality.ngram_features(
        np.frombuffer(text, np.uint8), np.array([0, len(text), len(text)])
    )
    assert len(set(idx.tolist())) == len(idx) and (np.diff(idx) > 0).all() and not len(none)
    words = idx < 1 << quality.BITS
    assert np.isclose(values[words].sum(), 16.0) and np.isclose(values[~words].sum(), 1.0)


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _check_fingerprints(found, rows):
    rows = sorted(rows, key=lambda r: r[0])
    texts = {i: t or "" for i, t in rows}
    ids = [i for i, _ in rows]
    following = dict(zip(ids, ids[1:] + ids[:1]))
    by_text, errors = {}, []
    assert len(found) == len(rows)
    for r in found:
        text, nxt = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        quarter = len(text) // 4
        new = text[: len(text) - quarter] + nxt[:quarter]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if new == text:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
        errors.append(r["near_edited"] - _jaccard(brute.shingles(text), brute.shingles(new)))
        errors.append(r["near_next"] - _jaccard(brute.shingles(text), brute.shingles(nxt)))
    assert np.abs(errors).max() < 0.2 and np.std(errors) < 0.04


def test_fingerprint_query(spark, sf_dir):
    rows = brute.texts_by_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    _check_fingerprints(QUERIES["op5_fingerprints"](spark, sf_dir).collect(), rows)


def test_fingerprint_awkward(awkward):
    _check_fingerprints(fingerprint.fingerprints(awkward).collect(), brute.texts_by_id(awkward))
    assert fingerprint.fingerprints(awkward.limit(0)).count() == 0
    single = awkward.filter("n = 11")
    row = fingerprint.fingerprints(single).first()
    assert row["near_next"] == 1
    twice = fingerprint.fingerprints(single.union(single)).collect()
    assert len(twice) == 2 and {r["near_next"] for r in twice} == {1.0}


def test_fingerprint_ranges_follow_bytes(spark):
    # A third of the bytes in one id, a third in a few neighbouring ids, the rest even; every document keeps its follower.
    sizes = [4_000 if i == 70 else 400 if 200 <= i < 210 else 4 for i in range(1_000)]
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate(sizes)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    blocks = fingerprint.with_next_in_blocks(documents, "doc_id", "text", range_bytes=4_000)
    own = blocks.filter("_extra = 0").groupBy("_block").agg(
        F.sum(F.octet_length("_text")).alias("bytes"), F.count("*").alias("n"), F.max("_key") - F.min("_key") + 1
    )
    found = sorted(tuple(r) for r in own.collect())
    assert all(n == width for _, _, n, width in found) and sum(n for _, _, n, _ in found) == 1_000
    assert len(found) > 10 and max(b for _, b, n, _ in found if n > 1) < 12_000
    assert blocks.filter("_extra = 1").count() == len(found)
    assert blocks.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.countDistinct("_block").alias("b")).filter(
        "b > 1"
    ).count() == 0
    _check_fingerprints(fingerprint.fingerprints(documents).collect(), rows)


def test_likeness_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        for size in (3, 40, 400, 4000):

            def draw(n):
                return rng.integers(0, 2**64, n, dtype=np.uint64, endpoint=False)

            both = draw(int(size * share))
            a, b = (np.unique(np.concatenate([both, draw(size - len(both))])) for _ in range(2))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(fingerprint.likeness(fingerprint.codes(a), fingerprint.codes(b)) - true)
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.12


def _bare_grams(text):
    """Five-word shingles in order, of words without punctuation at their edges."""
    words = [w.strip(string.punctuation + CURLY) for w in brute.WORD.findall((text or "").translate(brute.LOWER))]
    words = [w for w in words if w]
    return [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []


def _scan_brute(rows, templates, least=0.8):
    """Templates whose shingles lie to ``least`` in some window of the same grid."""
    out = set()
    known = [(name, own, licenses._class_size(len(own))) for name, t in templates if (own := set(_bare_grams(t)))]
    for i, text in rows:
        grams = _bare_grams(text)
        every = set(grams)
        for name, own, size in known:
            if len(own & every) < least * len(own):
                continue
            for k in range(0, max(1, len(grams)), size):
                if len(own & set(grams[k : k + 2 * size])) >= least * len(own):
                    out.add((i, name))
    return out


def test_license_query(spark, sf_dir):
    rows = brute.texts_by_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    passages = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    templates = [tuple(r) for r in licenses.license_templates(spark).collect()]
    templates += [(f"passage-{i}", t) for i, t in zip(passages.item_id, passages.text)]
    found = QUERIES["op3_license_scans"](spark, sf_dir).collect()
    assert {r["license"] for r in found} >= {None, "apache-2.0", "cc-by-nc-4.0", "mit"}
    assert all((r["license"] is None) == r["template_id"].startswith("passage-") for r in found)
    assert {(r["doc_id"], r["template_id"]) for r in found} == _scan_brute(rows, templates)
    assert len(found) == len({(r["doc_id"], r["template_id"]) for r in found})


def test_license_awkward(spark, awkward, monkeypatch):
    texts = [t for t in brute.awkward_texts() if t]
    templates = [("a", texts[-4]), ("line", "this line stands in very many documents of the corpus"), ("none", None),
                 ("empty", ""), ("short", "one two three"), ("words", " ".join(texts[13].split()[100:400]))]
    table = spark.createDataFrame(templates, "template_id string, template string")
    expected = _scan_brute(brute.texts_by_id(awkward), templates)
    found = licenses.scan_templates(awkward, table).collect()
    assert {(r["doc_id"], r["template_id"]) for r in found} == expected and expected
    monkeypatch.setattr(licenses, "TEMPLATE_BYTES", 5000)  # scanned for in turns
    assert len(licenses._turns(table.toDF("id", "text"))) >= 3
    found = licenses.scan_templates(awkward, table).collect()
    assert {(r["doc_id"], r["template_id"]) for r in found} == expected
    assert licenses.scan_templates(awkward.limit(0), table).count() == 0
    assert licenses.scan_templates(awkward, table.limit(0)).count() == 0


def test_license_bodies(spark):
    """Bodies under another name, as comments, rewrapped, with curly quotes and small edits; halves are not found."""
    bodies = {r["template_id"]: r["template"] for r in licenses.license_templates(spark).collect()}
    filler = " ".join(f"word{k % 97} other{k % 89}" for k in range(2000))
    texts, expected = [], []

    def add(text, *names):
        texts.append((len(texts), text))
        expected.append(set(names))

    for name in ("mit/text", "bsd-3-clause/text", "gpl-3.0/text", "isc/text", "zlib/text", "mpl-2.0/text"):
        words = f"Copyright (c) 2031 Some Holder {bodies[name]}".split()
        lines = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        add(filler + "\n" + "\n".join(f" * {line}" for line in lines) + " */ " + filler, name)
        add("\n".join(f"# {line}" for line in lines).replace('"AS IS"', "\u201cas is\u201d"), name)
        add(" ".join(words[: len(words) // 2]))
    add(bodies["mit/text"].replace("THE AUTHORS OR COPYRIGHT HOLDERS", "SOME COMPANY", 1), "mit/text")
    add("(Released under the MIT License, see there)", "mit/released")
    add("released under the mit licence")
    add("code is licensed under the Apache License, Version 2.0)", "apache-2.0/licensed")
    add(". , ; !!! \u201c\u201d")
    found = licenses.scan_templates(
        spark.createDataFrame(texts, "doc_id long, text string"), licenses.license_templates(spark)
    ).collect()
    for (i, _), names in zip(texts, expected):
        # Relatives of a license that share 80 % of its text are found too, with a lower containment.
        got = {r["template_id"]: r["containment"] for r in found if r["doc_id"] == i}
        assert names == {t for t, share in got.items() if share == max(got.values())}
    assert {(r["doc_id"], r["template_id"]) for r in found} == _scan_brute(texts, list(bodies.items()))


def _links(rows):
    """Counts and components by brute force of (id, vector, label)."""
    groups, count = brute.Groups({i for i, _, _ in rows}), [0] * len(rows)
    sound = [
        label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    for a, (i, v, label) in enumerate(rows):
        for b, (j, w, other) in enumerate(rows[:a]):
            if sound[a] and sound[b] and label == other and len(v) == len(w):
                v64, w64 = np.array(v, float), np.array(w, float)
                if v64 @ w64 / (np.linalg.norm(v64) * np.linalg.norm(w64)) >= 0.98:
                    groups.join(i, j)
                    count[a] += 1
                    count[b] += 1
    return sorted((rows[k][0], count[k], groups.find(rows[k][0])) for k in range(len(rows)))


def _result(frame):
    rows = frame.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in rows)


def test_embedding_query(spark, sf_dir):
    table = pd.read_parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(int(i), list(v), int(k)) for i, v, k in zip(table["vec_id"], table["embedding"], table["label"])]
    assert _result(QUERIES["op6_embedding_near_dedup"](spark, sf_dir)) == _links(rows)


def test_embedding_awkward(spark, monkeypatch):
    """Dense groups, copies, unusable vectors; shards and counting blocks small, so that there are many."""
    monkeypatch.setattr(vectors, "COUNT_ROWS", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for k in range(260):
        v = centres[k % 6] + rng.normal(size=8) * (0.02 if k % 4 else 0.6)
        rows.append([1000 - k, [float(np.float32(x)) for x in v], k % 2 if k % 11 else None])
    rows += [[2000 + k, rows[0][1], rows[1][2]] for k in range(20)]
    rows += [[3000, None, 0], [3001, [0.0] * 8, 0], [3002, [None] + [1.0] * 7, 0], [3003, [float("nan")] * 8, 0],
             [3004, [float("inf")] * 8, 0], [3005, [], 0], [3006, [1.0, 2.0], 0], [3007, [1.0, 2.0], 0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table = table.withColumns({"component": F.lit(1), "rep": F.lit("x"), "shard": F.lit(2), "dim": F.lit(3)})
    assert _result(vectors.near_duplicate_vectors(table, shard_rows=60)) == _links([tuple(r) for r in rows])
    assert vectors.near_duplicate_vectors(table.limit(0)).count() == 0


def _searched(exact, **kwargs):
    ids = np.arange(len(exact))
    return vectors._search(ids, exact, None, ids, exact, 0.98, **kwargs)


def test_audit_sees_sparse_links(monkeypatch):
    """A graph that finds nothing but the asked vector itself: three links among 600 vectors are still found."""
    exact = vectors._units(np.random.default_rng(4).normal(size=(600, 24)))
    exact[[100, 300, 501]] = exact[[101, 302, 7]]
    own = lambda graph, exact, queries, beam, threshold: (np.arange(len(queries)),) * 2
    monkeypatch.setattr(vectors, "_links", own)
    a, b, beam, recall = _searched(exact)
    assert (beam, recall) == (0, 1.0)  # worked out by brute force in the end
    assert sorted(zip(b.tolist(), a.tolist())) == [(7, 501), (100, 101), (300, 302)]


def test_audit_counts_queries_not_pairs(monkeypatch):
    """A hot group does not outvote small ones: the beam is widened until these are found."""
    rng = np.random.default_rng(6)
    exact = vectors._units(rng.normal(size=(1600, 24)))
    exact[:800] = exact[0]
    exact[800::2] = exact[801::2]
    beams = []

    def links(graph, exact, queries, beam, threshold):
        beams.append(beam)
        rows, nodes = np.nonzero(queries @ exact.T >= threshold)
        kept = (rows < 800) | (beam > vectors.FIRST_BEAM)
        return rows[kept], nodes[kept]

    monkeypatch.setattr(vectors, "_links", links)
    a, _, beam, recall = _searched(exact)
    assert beams == [32, 64] and beam == 64 and recall == 1.0 and len(a) == 799 + 400
    assert len(_searched(exact, audit_rows=None)[0]) == 799 + 400 and beams == [32, 64]


def test_audit_asks_made_queries(monkeypatch):
    """A block without any link still measures the graph: one that finds nothing does not pass."""
    exact = vectors._units(np.random.default_rng(4).normal(size=(900, 24)))
    made = vectors._made_queries(exact, 0.98)
    near = (made @ exact.T).max(axis=1)
    assert len(made) == vectors.AUDIT_MADE and (near >= 0.98).all() and near.max() < 1 and np.ptp(near) > 0.01
    beams = []

    def links(graph, exact, queries, beam, threshold):
        beams.append(beam)
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    monkeypatch.setattr(vectors, "_links", links)
    a, _, beam, recall = _searched(exact)
    assert beams == [32, 64] and beam == 0 and recall == 1.0 and len(a) == 0


def test_embedding_large_label(spark, tmp_path):
    """Some thousand distinct vectors of one label over several shards, duplicates in few of them."""
    rng = np.random.default_rng(12)
    exact = rng.normal(size=(3000, 24))
    twins = rng.permutation(3000)[:120].reshape(-1, 2)
    exact[twins[:, 1]] = exact[twins[:, 0]] + rng.normal(size=(60, 24)) * 0.02
    rows = [(k, v.tolist(), "a") for k, v in enumerate(exact)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    folder = str(tmp_path / "audits")
    found = vectors.near_duplicate_vectors(frame, shard_rows=1000, audit_folder=folder).collect()
    audits = spark.read.parquet(folder).collect()
    # The graphs are asked, by beams of part of a shard, and their recall is known.
    assert sorted((r["shard"], r["block"]) for r in audits) == [(i, j) for i in range(3) for j in range(3)]
    assert all(0 < r["beam"] <= 128 and r["recall"] >= 0.99 and r["audited"] == vectors.AUDIT_ROWS for r in audits)
    unit = vectors._units(exact)
    a, b = np.nonzero(np.triu(unit @ unit.T >= vectors.THRESHOLD, 1))
    groups = brute.Groups(range(3000))
    for i, j in zip(a.tolist(), b.tolist()):
        groups.join(i, j)
    assert len(a) >= 60
    assert {r["vec_id"]: r["component_id"] for r in found} == {k: groups.find(k) for k in range(3000)}


def test_graph_recall():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(3000, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = hnsw.Hnsw.build(v)
    assert [len(n) for n, _ in graph.layers] == [187, 3000]
    ids, _ = graph.search(v[:300], 64)
    true = np.argsort(-(v[:300] @ v.T), axis=1)[:, :10]
    recall = np.mean([len(np.intersect1d(a, b)) / 10 for a, b in zip(ids, true)])
    assert recall > 0.9
