"""Helpers shared by the operators: raw text buffers, words, shingles, hashes, run folders.

Texts are handled as Arrow buffers inside tasks: a block of texts is one byte array with offsets, and
words and shingles of all its texts are found by array operations. Blocks are cut by bytes, so memory
follows the block size or the longest single text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.operators.ordered import broadcast_if_small
from vetrail.session import fresh_folder, with_package

BLOCK_BYTES = 1 << 19
BATCH_BYTES = 8 << 20
SHINGLE_WORDS = 5
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(frame: DataFrame) -> SparkSession:
    """Hand rows to Python in batches of a bounded number of bytes, whatever the length of the texts."""
    spark = with_package(frame.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def written(rows: DataFrame, compression: str = "zstd") -> DataFrame:
    """Like ``materialized``, compressed harder: for tables as large as their input."""
    path = fresh_folder(rows.sparkSession)
    rows.write.option("compression", compression).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def shared_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a shared folder and the folder's path in it, for files that tasks write themselves."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


#: Ids (with a number) that may be broadcast: 16 bytes each. More are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def broadcast_ids(rows: DataFrame) -> DataFrame:
    """Hint a broadcast for a written table of ids that is counted to be small enough."""
    return broadcast_if_small(rows, BROADCAST_IDS)


def word_count(text: str | Column) -> Column:
    """Number of words of a text; null counts 0."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs keep equal outputs, near ones are spread."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers 0 to n-1 of the hash base modulo 2^64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 4096), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def text_blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", block_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into blocks of about ``block_bytes`` of text: rows, bytes, offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, at = buffers(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + block_bytes, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start), raw[at[start] : at[end]], at[start : end + 1] - at[start]
            start = end


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of a block, and per text the index of its first word (n+1)."""
    solid = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    begin, stop = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return begin, stop, np.searchsorted(begin, at)


def span_hashes(raw: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span; spans are disjoint, ascending and not empty."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = stop - begin
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    values = raw[within + np.repeat(begin, length)].astype(np.uint64) + np.uint64(1)
    values *= powers(int(length.max()) + 1)[within]
    return mix(np.add.reduceat(values, first) + mix(length.astype(np.uint64)))


def word_hashes(raw: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block, and per text the index of its first word."""
    begin, stop, first = word_spans(raw, at)
    return span_hashes(_LOWER[raw] if lower else raw, begin, stop), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; position i is the run that starts at word i."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + words[k : len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def shingle_lists(
    raw: np.ndarray, at: np.ndarray, n: int = SHINGLE_WORDS
) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingle hashes; fewer than n words are one shingle, none is empty."""
    words, first = word_hashes(raw, at)
    grams = gram_hashes(words, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield gram_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return x.view(np.int64)
