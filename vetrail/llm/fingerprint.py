"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

A text's shingle hashes are put into bins once, and the smallest hash of each bin stays. An empty bin
takes the value of another one, found by trying a fixed random sequence of bins until one is filled, so
equal sets fill alike and the estimate stays unbiased. Only the low bits of each bin are stored. Two
fingerprints agree in a bin by chance with probability 2**-BITS; the likeness corrects for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import BLOCK_BYTES, bounded_batches, buffers, mix, shingle_lists

BINS = 512
BITS = 4
_LOG_BINS = BINS.bit_length() - 1
_TRIES = 64
_BIN_SALT = mix(np.arange(1, BINS + 1, dtype=np.uint64))


def _donors(block: int) -> np.ndarray:
    """Tries block*_TRIES and following: which bin each bin asks (tries x bins)."""
    tries = np.arange(block * _TRIES, (block + 1) * _TRIES, dtype=np.uint64)
    asked = mix((tries[:, None] << np.uint64(20)) + np.arange(BINS, dtype=np.uint64)[None] + np.uint64(1))
    return (asked >> np.uint64(64 - _LOG_BINS)).astype(np.int64)


_known_donors: list[np.ndarray] = []


def codes(shingles: np.ndarray) -> np.ndarray:
    """The low bits of every bin for a set of ascending shingle hashes; no codes for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.uint8)
    bins = (shingles >> np.uint64(64 - _LOG_BINS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    smallest = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    # Hashes ascend, so the first of a bin is its smallest.
    smallest[bins[first]] = shingles[first]
    filled[bins[first]] = True
    empty, block = np.flatnonzero(~filled), 0
    out = smallest.copy()
    while len(empty):
        if block == len(_known_donors):
            _known_donors.append(_donors(block))
        asked = _known_donors[block][:, empty]
        hit = filled[asked]
        which = hit.argmax(axis=0)
        found = hit[which, np.arange(len(empty))]
        out[empty[found]] = smallest[asked[which, np.arange(len(empty))][found]]
        empty, block = empty[~found], block + 1
    # The bin number goes into the bits: one hash in many bins agrees by chance in each bin anew.
    return (mix(out + _BIN_SALT) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(code: np.ndarray) -> str:
    """Two bins a byte, as hexadecimal text."""
    return (code[0::2] << 4 | code[1::2]).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness of two sets from their codes; two empty sets are alike."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def _block_codes(texts: list[str]) -> list[np.ndarray]:
    raw, at = buffers(pa.array(texts, pa.large_string()))
    return [codes(s) for s in shingle_lists(raw, at)]


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many first ones of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_LOWEST = -(1 << 63)
#: Bytes of text that a range should hold, and the finest cuts of the ids that ranges are put together from.
RANGE_BYTES, FINE_CUTS = 16 << 20, 100_000


def _range_starts(rows: DataFrame, least: int, range_bytes: int) -> np.ndarray:
    """First keys of consecutive ranges of ids that hold about equally many bytes of text.

    Fine ranges between quantiles of the ids are weighed, and neighbours put together. The driver holds their first
    keys and weights: ``FINE_CUTS`` rows at most. A fine range, and so one id, stays whole.
    """
    size = F.octet_length("_text") + 64
    total = int(rows.agg(F.sum(size)).first()[0] or 0)
    ranges = max(least, -(-total // range_bytes))
    cuts = min(32 * ranges, FINE_CUTS)
    quantiles = [i / cuts for i in range(1, cuts)]
    limits = rows.agg(F.percentile_approx("_key", quantiles, max(10_000, 4 * cuts))).first()[0]
    limits = np.unique(np.array(limits or [], np.int64))

    @F.pandas_udf("int")
    def fine_range(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, keys.to_numpy(np.int64), "left").astype(np.int32))

    sized = rows.select("_key", size.alias("_size")).groupBy(fine_range("_key"))
    fine = sorted((r[1], r[2]) for r in sized.agg(F.min("_key"), F.sum("_size")).collect())
    weights = np.array([w for _, w in fine], np.float64)
    middle = np.cumsum(weights) - weights / 2
    own = (middle * ranges / max(total, 1)).astype(np.int64)
    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
    return np.array([k for k, _ in fine], np.int64)[first]


def with_next_in_blocks(
    documents: DataFrame, id_column: str, text: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Rows (_block, _extra, _key, id, text): id ranges, each closed by the next range's first row.

    Ranges follow the bytes of the texts, one partition each. The last range is closed by the first row of all.
    Null ids come first.
    """
    spark = documents.sparkSession
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(_LOWEST))
    rows = documents.select(key.alias("_key"), id_column, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    starts = _range_starts(rows, int(spark.conf.get("spark.sql.shuffle.partitions")), range_bytes)

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        keys = keys.to_numpy(np.int64)
        own = np.searchsorted(starts, keys, "right") - 1
        opens = starts[own] == keys
        # The range before the first one is the last.
        return pd.Series([[b, (b or len(starts)) - 1] if o else [b] for b, o in zip(own.tolist(), opens.tolist())])

    placed = rows.select("*", F.posexplode(places("_key")).alias("_extra", "_block"))
    dealt = placed.repartitionById(max(1, len(starts)), "_block")
    return dealt.sortWithinPartitions("_block", "_extra", "_key", "_text")


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text is empty; the fingerprint of a text without words is the empty string, alike (1) to
    another of its kind and unlike (0) to any other. The document that follows the last one is the first; a
    single document follows itself. Rows of equal ids follow one another in the order of their texts. An
    empty table gives an empty result. Other columns are not read.
    """
    bounded_batches(documents)
    kind = documents.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    ordered = with_next_in_blocks(documents, id_column, text).select("_block", "_extra", id_column, "_text")

    def compare(held: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        """Rows of all but the last of consecutive (block, extra, id, text)."""
        own = _block_codes([r[3] for r in held])
        pairs = [i for i in range(len(held) - 1) if not held[i][1] and held[i + 1][0] == held[i][0]]
        new = [edited(held[i][3], held[i + 1][3]) for i in pairs]
        new_codes = _block_codes(new)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[i][2] for i in pairs], key_type),
                pa.array([len(held[i][3]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                pa.array([packed(own[i]) for i in pairs], pa.string()),
                pa.array([packed(c) for c in new_codes], pa.string()),
                pa.array([likeness(own[i], c) for i, c in zip(pairs, new_codes)], pa.float64()),
                pa.array([likeness(own[i], own[i + 1]) for i in pairs], pa.float64()),
            ],
            names=[id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key_type = 0, pa.int64()
        for batch in batches:
            key_type = batch.schema.field(2).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[3])
                if size > BLOCK_BYTES and len(held) > 1:
                    yield compare(held, key_type)
                    held = held[-1:]
                    size = len(held[0][3])
        if len(held) > 1:
            yield compare(held, key_type)

    return ordered.mapInArrow(run, schema)
