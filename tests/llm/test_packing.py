"""Packing, training order and mixing."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from llm import brute
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vetrail.llm import materialise, mixing, packing
from vetrail.llm.queries import QUERIES, TOKENIZER

FILE = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def awkward(spark):
    documents = brute.awkward_documents(spark).repartition(3).cache()
    documents.count()
    return documents


def _ids(texts):
    reader = Tokenizer.from_file(FILE)
    return [reader.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def _check_packed(rows: pd.DataFrame, documents: list[tuple[int, str | None]], capacity=4096):
    expected = {}
    for (i, _), ids in zip(documents, _ids([t for _, t in documents])):
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            expected[i, p] = (s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows.itertuples()}
    assert got == expected and len(rows) == len(expected)
    for _, bin_ in rows.groupby("sequence_id"):
        bin_ = bin_.sort_values("offset")
        assert (bin_["offset"] == bin_["length"].cumsum() - bin_["length"]).all()
        assert bin_["length"].sum() <= capacity
    least = -(-int(rows["length"].sum()) // capacity)
    assert rows["sequence_id"].nunique() <= least * 1.05 + 1


def test_packing_query(spark, sf_dir):
    rows = QUERIES["op4_best_fit_packing"](spark, sf_dir).toPandas()
    _check_packed(rows, brute.texts_by_id(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def test_packing_awkward(awkward):
    _check_packed(packing.pack_documents(awkward, FILE).toPandas(), brute.texts_by_id(awkward))


def test_odd_words_are_encoded_alike():
    texts = ["a\x01b \x01 \x01\x01", "<|endoftext|> x<|startoftext|>y", "it's we'll I'M", "x" * 200, "日本語 テスト",
             "é ́e", "tab\tnew line\x85nel nbsp", "🙂🙂 a🙂b", "'" * 90 + " 's", "ΑΣ ΣΑΣ"]
    from vetrail.llm.common import buffers
    from vetrail.llm.tokens import WordTokenizer
    import pyarrow as pa

    words = WordTokenizer(FILE)
    for _ in range(2):  # the second time from memory
        flat, counts = words.encode(*buffers(pa.array(texts)))
        at = np.concatenate([[0], np.cumsum(counts)])
        got = [flat[a:b].tolist() + [1] for a, b in zip(at[:-1], at[1:])]
        assert got == _ids(texts)
    small = WordTokenizer(FILE, remembered=5)
    for t in texts:
        flat, _ = small.encode(*buffers(pa.array([t])))
        assert flat.tolist() + [1] == _ids([t])[0]


def test_designs_use_every_piece():
    r = random.Random(2)
    counts = {r.randint(1, 100): r.randint(1, 50) for _ in range(40)}
    used: dict[int, int] = {}
    for design, times in packing.bin_designs(counts, 100):
        assert sum(design) <= 100
        for length in design:
            used[length] = used.get(length, 0) + times
    assert used == counts


def test_best_two_replaces_the_smallest():
    # Greedy: 60 + 30 leaves 10; instead of 30 the two pieces 22 and 18 fill the bin.
    designs = packing.bin_designs({60: 1, 30: 1, 22: 1, 18: 1}, 100)
    assert sorted(designs[0][0]) == [18, 22, 60]


def test_repeated_rows_are_packed_each(spark):
    rows = spark.createDataFrame([(1, "a b c")] * 3, "doc_id long, text string")
    packed = packing.pack_documents(rows, FILE).toPandas()
    assert len(packed) == 3 and packed[["sequence_id", "offset"]].drop_duplicates().shape[0] == 3


@pytest.mark.parametrize("total", [1, 2, 3, 10, 1000, 4097])
def test_feistel_is_a_permutation(total):
    numbers = np.arange(total)
    slots = materialise.feistel_slots(numbers, total, key=9)
    assert sorted(slots.tolist()) == list(range(total))
    assert (materialise.feistel_slots(slots, total, key=9, inverse=True) == numbers).all()
    if total > 100:
        assert (slots != materialise.feistel_slots(numbers, total, key=10)).any()


def _documents_of(rows, records):
    """Ids per document (in a list, as ids may repeat), put together from records in the order of the stream."""
    got: dict = {}
    for r in rows:
        ids = np.frombuffer(records[r["slot"]], "<u2")[: r["n_tokens"]].tolist()
        edges = [*r["starts"], r["n_tokens"]]
        for doc, a, b in zip(r["doc_ids"], edges[:-1], edges[1:]):
            got.setdefault(doc, []).append((r["slot"], ids[a:b]))
    return got


def _check_order(spark, documents, folder, rows, tokens, shard_rows, key=42):
    n = len(rows)
    assert sorted(r["slot"] for r in rows) == list(range(n))
    assert all(r["shard"] == r["slot"] // shard_rows for r in rows)
    records = list(materialise.read_records(folder, 0, n, 2 * tokens, shard_rows))
    assert {len(p) for p in records} == {2 * tokens}
    number = materialise.feistel_slots(np.arange(n), n, key, inverse=True)
    stream = sorted(rows, key=lambda r: number[r["slot"]])
    got = _documents_of(stream, records)
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    want: dict = {}
    for (doc, _), ids in zip(texts, _ids([t for _, t in texts])):
        want.setdefault(doc, []).append(ids)
    assert set(got) == set(want)
    for doc, lists in want.items():
        joined = [i for _, ids in got[doc] for i in ids]
        if len(lists) == 1:
            assert joined == lists[0]
        assert sorted(joined) == sorted(i for ids in lists for i in ids)
    short = [r for r in rows if r["n_tokens"] < tokens]
    assert len(short) <= documents.rdd.getNumPartitions()
    return records


def test_training_order_round_trip(spark, sf_dir):
    from vetrail.session import fresh_folder

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert QUERIES["op9_token_output"](spark, sf_dir).count() > 0
    folder = fresh_folder(spark)
    ordered = materialise.training_order(documents, FILE, folder, key=5)
    rows = materialise.written_shards(ordered, folder).collect()
    _check_order(spark, documents, folder, rows, materialise.SEQUENCE_TOKENS, materialise.SHARD_ROWS, 5)


def test_binary_shards(awkward, spark, tmp_path):
    """One file of fixed-stride records per shard, read by offset; a second run writes only what is not whole."""
    folder, shards = str(tmp_path), tmp_path / "shards"
    ordered = materialise.training_order(awkward, FILE, folder, tokens=64, shard_rows=16)
    rows = materialise.written_shards(ordered, folder, tokens=64).collect()
    records = _check_order(spark, awkward, folder, rows, 64, 16)
    names = sorted(p.name for p in shards.iterdir() if not p.name.startswith("."))
    count = -(-len(rows) // 16)
    assert names == sorted(f"shard-{k:08d}.{e}" for k in range(count) for e in ("bin", "json")) and count > 3
    data = [(shards / f"shard-{k:08d}.bin").read_bytes() for k in range(count)]
    assert b"".join(data) == b"".join(records)
    found = sorted(map(tuple, materialise.shard_manifest(spark, f"{folder}/shards").collect()))
    assert found == [(k, len(d) // 128, 128, zlib.crc32(d)) for k, d in enumerate(data)]
    assert list(materialise.read_records(folder, 13, 37, 128, 16)) == records[13:37]
    # Cut short, and never told of: both are written anew, from other partitions of the same table; the rest stays.
    (shards / "shard-00000001.bin").write_bytes(b"cut")
    (shards / "shard-00000003.json").unlink()
    kept = (shards / "shard-00000000.bin").stat().st_mtime_ns
    again = materialise.training_order(awkward.repartition(5), FILE, folder, tokens=64, shard_rows=16)
    rewritten = materialise.written_shards(again, folder, tokens=64).collect()
    assert {r["shard"] for r in rewritten} == {1, 3}
    assert [(shards / f"shard-{k:08d}.bin").read_bytes() for k in range(count)] == data
    assert (shards / "shard-00000000.bin").stat().st_mtime_ns == kept
    assert materialise.written_shards(again, folder, tokens=64).count() == 0


def test_training_order_empty_and_too_large_vocabulary(awkward, tmp_path, monkeypatch):
    ordered = materialise.training_order(awkward.limit(0), FILE, str(tmp_path))
    assert materialise.written_shards(ordered, str(tmp_path)).count() == 0
    from vetrail.llm import tokens

    class Large:
        def get_vocab_size(self):
            return 1 << 17

    import tokenizers

    class Reader:
        from_file = staticmethod(lambda file: Large())

    monkeypatch.setattr(tokenizers, "Tokenizer", Reader)
    with pytest.raises(ValueError, match="16 bits"):
        tokens.WordTokenizer(FILE)


def _targets(sizes: dict) -> dict:
    """Shares by weight; what stops at its limit gives its excess to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        price = left / sum(weight[s] for s in open_)
        stop = {s for s in open_ if price * weight[s] > 2 * sizes[s]}
        if not stop:
            return out | {s: price * weight[s] for s in open_}
        for s in stop:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= stop
    return out


def _check_mix(rows: pd.DataFrame, loose: float):
    sizes = {None if pd.isna(s) else s: int(g["size"].sum()) for s, g in rows.groupby("source", dropna=False)}
    targets = _targets(sizes)
    for s, g in rows.groupby("source", dropna=False):
        s = None if pd.isna(s) else s
        assert (g["source_size"] == sizes[s]).all()
        assert np.allclose(g["target"], targets[s])
        # Copies are whole: a source that is mostly one document can miss by half of it.
        assert abs(g["taken"].sum() - targets[s]) <= max(loose * targets[s], g["size"].max() / 2)
    assert (rows["taken"] <= 2 * rows["size"]).all()


def test_mixing_query(spark, sf_dir):
    rows = QUERIES["op8_mixing"](spark, sf_dir).toPandas()
    texts = brute.texts_by_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert dict(zip(rows["doc_id"], rows["size"])) == {i: len(brute.WORD.findall(t or "")) for i, t in texts}
    _check_mix(rows, 0.01)


def test_mixing_awkward_and_reruns(awkward):
    rows = mixing.mix_sources(awkward).toPandas()
    _check_mix(rows, 0.05)
    again = mixing.mix_sources(awkward.repartition(7)).toPandas()
    keys = ["doc_id", "taken"]
    assert rows[keys].sort_values(keys).values.tolist() == again[keys].sort_values(keys).values.tolist()
    assert len(rows) == awkward.count()
    assert mixing.mix_sources(awkward.limit(0)).count() == 0


def test_mixing_repeated_rows_and_empty_sources(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "", "t"), (3, None, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(documents)
    assert found.count() == 4
    assert found.filter(F.col("source") == "s").agg(F.sum("taken")).first()[0] == 9
    assert found.filter(F.col("size") == 0).agg(F.sum("taken")).first()[0] == 0
