"""Token sequences in training order, as fixed-stride shards.

The ids of all documents, each with the end id behind it, are one stream per task, cut into sequences of equal
length; only a task's last one is shorter. Sequences are written once without padding and numbered without gaps, and a
keyed Feistel permutation gives each number its global slot: a few rounds on the halves of the number, over the
smallest even number of bits that holds all numbers; results outside the range walk the cycle until they are inside. So
the training order is known without a sort of the corpus, and any slot's sequence can be told by the inverse.

Sequences are dealt by ranges of shards, ``slot // shard_rows``, and sorted by slot. A task streams its shards, one
after another, to files of nothing but records, under a temporary name until they are whole, with a line of
manifest beside each. A record has ``stride`` bytes: token ids as 16-bit little-endian numbers, padded with the end
id. Record r of a shard starts at ``r * stride``, so a reader resumes anywhere by arithmetic. A run into the
same folder goes on where an earlier one ended: it takes the sequences that are written, and shuffles and writes only
those of shards that are not whole.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetrail.llm.common import bounded_batches, mix, shared_store, text_blocks
from vetrail.llm.packing import END_ID
from vetrail.llm.tokens import tokenizer
from vetrail.session import materialized

SEQUENCE_TOKENS = 1024
#: Records of a shard: files of 64 MB.
SHARD_ROWS = 32_768
ROUNDS = 6


def feistel_slots(numbers: np.ndarray, total: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 to total-1 (or its inverse) at the given numbers."""
    half = max(1, ((max(total - 1, 1)).bit_length() + 1) // 2)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    rounds = [mix(np.array([key % (1 << 64)], np.uint64) + np.uint64(r + 1))[0] for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        for r in reversed(rounds) if inverse else rounds:
            if inverse:
                left, right = right ^ (mix(left + r) & mask), left
            else:
                left, right = right, left ^ (mix(right + r) & mask)
        return left << bits | right

    out = once(np.asarray(numbers).astype(np.uint64))
    while (outside := out >= np.uint64(total)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def token_sequences(
    documents: DataFrame, file: str, id_column: str, text: str, tokens: int, end_id: int
) -> DataFrame:
    """(doc_ids, starts, n_tokens, payload, _part, _row): the stream of all ids, cut into sequences of ``tokens``.

    ``doc_ids`` are the documents with ids in the sequence, ``starts`` the places where they begin there: 0 for the first.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"doc_ids array<{kind}>, starts array<int>, n_tokens int, payload binary, _part int, _row long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(file)
        part_id, row = TaskContext.get().partitionId(), 0
        # What is left of the stream: its ids, its documents and where each of them begins (before 0: it goes on).
        stream, keys, begin = np.zeros(0, "<u2"), [], np.zeros(0, np.int64)

        def records(end: int) -> pa.RecordBatch:
            nonlocal row
            edges = np.append(np.arange(0, end, tokens), end)
            first = np.searchsorted(begin, edges[:-1], "right") - 1
            last = np.searchsorted(begin, edges[1:] - 1, "right") - 1
            which = [range(a, b + 1) for a, b in zip(first.tolist(), last.tolist())]
            n = len(which)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([[keys[d] for d in ds] for ds in which], pa.list_(key_kind)),
                    pa.array([np.maximum(begin[ds.start : ds.stop] - e, 0) for ds, e in zip(which, edges)], pa.list_(pa.int32())),
                    pa.array(np.diff(edges), pa.int32()),
                    pa.array([stream[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
                    pa.array(np.full(n, part_id, np.int32)),
                    pa.array(np.arange(row, row + n, dtype=np.int64)),
                ],
                names=["doc_ids", "starts", "n_tokens", "payload", "_part", "_row"],
            )
            row += n
            return out

        key_kind = pa.null()
        for rows, raw, at in text_blocks(batches, text):
            ids, counts = words.encode(raw, at)
            key_column = rows.column(rows.schema.get_field_index(id_column))
            key_kind = key_column.type
            ends = np.cumsum(counts + 1)
            new = np.full(int(ends[-1]), end_id, "<u2")
            inside = np.ones(len(new), bool)
            inside[ends - 1] = False
            new[inside] = ids
            begin = np.concatenate([begin, ends - counts - 1 + len(stream)])
            keys += key_column.to_pylist()
            stream = np.concatenate([stream, new])
            whole = len(stream) // tokens * tokens
            if whole:
                yield records(whole)
                held = max(0, int(np.searchsorted(begin, whole, "right")) - 1) if whole < len(stream) else len(keys)
                stream, keys, begin = stream[whole:], keys[held:], begin[held:] - whole
        if len(stream):
            yield records(len(stream))

    return documents.select(id_column, text).mapInArrow(cut, schema)


def _exists(spark: SparkSession, folder: str) -> bool:
    """Whether a whole Parquet table lies in a folder."""
    store, root = shared_store(folder)
    return store.get_file_info([f"{root}/_SUCCESS"])[0].type == fs.FileType.File


def training_order(
    documents: DataFrame,
    file: str,
    folder: str,
    key: int = 42,
    id_column: str = "doc_id",
    text: str = "text",
    tokens: int = SEQUENCE_TOKENS,
    shard_rows: int = SHARD_ROWS,
    end_id: int = END_ID,
) -> DataFrame:
    """All sequences with their place in training order: slot, shard, doc_ids, starts, n_tokens, payload (unpadded).

    The slots are 0 to the number of sequences less one. Null and empty texts are an end id in the stream. Repeated rows
    are documents of their own; null ids stay null. Other columns are not read. An empty table gives an empty result.
    Sequences are written once into ``folder``, which all executors reach; if it holds them already they are
    taken from there, so every later read and run gives the same slots. Vocabularies beyond 16 bits raise ``ValueError``.
    """
    spark = bounded_batches(documents)
    tokenizer(file)
    place = f"{folder}/sequences"
    cut = token_sequences(documents, file, id_column, text, tokens, end_id)
    if not _exists(spark, place):
        cut.write.mode("overwrite").option("compression", "zstd").parquet(place)
    sequences = spark.read.schema(cut.schema).parquet(place)
    parts = sequences.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per written partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialized(
        parts.select("_part", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    total = starts.agg(F.sum("_rows")).first()[0] or 0

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(feistel_slots(number.to_numpy(np.int64), total, key))

    placed = sequences.join(F.broadcast(starts.drop("_rows")), "_part")
    placed = placed.withColumn("slot", slot(F.col("_start") + F.col("_row")))
    return placed.select(
        "slot", F.floor(F.col("slot") / shard_rows).alias("shard"), "doc_ids", "starts", "n_tokens", "payload"
    )


def _shard_name(shard: int) -> str:
    return f"shard-{shard:08d}"


class _Shard:
    """A file that is written record by record, and renamed with its line of manifest when it is whole."""

    def __init__(self, store: fs.FileSystem, root: str, shard: int, stride: int, end_id: int):
        self._store, self._path, self._under = store, f"{root}/{_shard_name(shard)}", uuid.uuid4().hex
        self._stride, self._pad = stride, np.array([end_id], "<u2").tobytes()
        self._entry = {"shard": shard, "n_rows": 0, "stride": stride, "crc32": 0}
        self._out = store.open_output_stream(f"{self._path}.{self._under}.tmp")

    def add(self, payload: bytes) -> None:
        record = payload + self._pad * ((self._stride - len(payload)) // 2)
        self._out.write(record)
        self._entry["n_rows"] += 1
        self._entry["crc32"] = zlib.crc32(record, self._entry["crc32"])

    def close(self) -> None:
        self._out.close()
        self._store.move(f"{self._path}.{self._under}.tmp", f"{self._path}.bin")
        under = f"{self._path}.{self._under}.json.tmp"
        with self._store.open_output_stream(under) as out:
            out.write(json.dumps(self._entry).encode())
        self._store.move(under, f"{self._path}.json")


def _whole_shards(spark: SparkSession, folder: str, stride: int) -> list[tuple[int, int]]:
    """Ranges of shards that are whole: manifest line and a file of its size. As many lines as there are shards."""
    store, root = shared_store(folder)
    sizes = {i.base_name: i.size for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True))}
    if not any(name.endswith(".json") for name in sizes):
        return []
    lines = shard_manifest(spark, folder).filter(F.col("stride") == stride).collect()
    whole = sorted(r["shard"] for r in lines if sizes.get(f"{_shard_name(r['shard'])}.bin") == r["n_rows"] * stride)
    cuts = np.flatnonzero(np.diff(whole) != 1) + 1 if whole else []
    return [(int(part[0]), int(part[-1])) for part in np.split(np.array(whole), cuts)] if whole else []


def written_shards(
    ordered: DataFrame, folder: str, tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """Write the shards of ``training_order`` into ``folder``/shards; (slot, shard, doc_ids, starts, n_tokens) of what was written.

    ``folder`` is one that all executors reach; Arrow opens it. Files are there when all rows have been read. Shards of
    an earlier run that are whole are left out before the shuffle. A task holds one record at a time.
    """
    spark = bounded_batches(ordered)
    place, stride = f"{folder}/shards", 2 * tokens
    store, root = shared_store(place)
    store.create_dir(root, recursive=True)
    if whole := _whole_shards(spark, place, stride):
        ordered = ordered.filter(~reduce(or_, [F.col("shard").between(a, b) for a, b in whole]))
    told = ordered.drop("payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = shared_store(place)
        open_, now = None, None
        for batch in batches:
            shards = batch.column(batch.schema.get_field_index("shard")).to_pylist()
            for shard, payload in zip(shards, batch.column(batch.schema.get_field_index("payload")).to_pylist()):
                if shard != now:
                    if open_:
                        open_.close()
                    open_, now = _Shard(store, root, shard, stride, end_id), shard
                open_.add(payload)
            yield batch.drop_columns(["payload"])
        if open_:
            open_.close()

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ordered.repartitionByRange(ranges, "shard").sortWithinPartitions("slot").mapInArrow(run, told.schema)


def shard_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, n_rows, stride, crc32) of the shards that are whole."""
    files = spark.read.schema("shard long, n_rows long, stride long, crc32 long")
    return files.option("pathGlobFilter", "shard-*.json").json(folder)


def read_records(folder: str, start: int, stop: int, stride: int, shard_rows: int = SHARD_ROWS) -> Iterator[bytes]:
    """Records of slots start to stop-1 of a run's folder by offset; nothing before them is read."""
    store, root = shared_store(f"{folder}/shards")
    while start < stop:
        shard, row = divmod(start, shard_rows)
        n = min(stop - start, shard_rows - row)
        with store.open_input_file(f"{root}/{_shard_name(shard)}.bin") as file:
            data = file.read_at(n * stride, row * stride)
        if len(data) != n * stride:
            raise ValueError(f"shard {shard} ends before slot {start + n - 1}")
        yield from (data[k : k + stride] for k in range(0, len(data), stride))
        start += n
