"""Vector code compression: product codebooks by Lloyd's rounds on members that stay where they are.

A vector of whole numbers is cut into equal consecutive parts, and every part position has a codebook. The
parts of all vectors are the members. They are dealt once by (position, entry, salt) and written: the partition
of that key owns them. The salt, a hash of the members' block, splits entries that hold a large share of all rows.

1. Owners sum their resident members; one row per owner, component and task is added up to the new entries.
2. Each resident member is assigned anew against the codebook of its position. Members that keep their entry
   are written where they are, without a shuffle; only those that change it are dealt to their new owners.

Codebooks (entries x dimension numbers) are told to every task; members never leave the executors. The codes of
all vectors are one pass over them with the final codebooks. All arithmetic is on whole numbers, so the
result is the same however rows are dealt, and a lost task repeats its part exactly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrail.llm.common import bounded_batches, written
from vetrail.llm.integers import integer_rows, is_sound, nearest, packed, smallest_rows, unpacked
from vetrail.operators.ordered import broadcast_if_small
from vetrail.session import fresh_folder

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Bytes of vectors that a task assigns at a time, of members in one block, and of members in one partition.
_CHUNK_BYTES, BLOCK_BYTES, PARTITION_BYTES = 8 << 20, 1 << 20, 32 << 20
_BLOCKS = "position int, entry int, salt int, width int, members binary"
_OWNER = ["position", "entry", "salt"]


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part position: whole numbers, (positions, entries, components)."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        """Digest of all components, by position, entry and place, in decimal and joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers (rows, positions) and squared error of whole-number vectors."""
        positions, _, width = self.entries.shape
        codes = np.zeros((len(vectors), positions), np.uint8)
        error = np.zeros(len(vectors), np.int64)
        for p in range(positions):
            codes[:, p], apart = nearest(vectors[:, p * width : (p + 1) * width], self.entries[p])
            error += apart
        return codes, error

    def decode(self, code: str) -> np.ndarray:
        """The whole-number vector a code stands for."""
        return np.concatenate([self.entries[p, e] for p, e in enumerate(bytes.fromhex(code))])


def common_length(rows: DataFrame, vector: str, parts: int) -> tuple[int, int]:
    """The length of most sound vectors that can be cut into parts (ties: the longer), and how many have it."""
    sizes = rows.filter(is_sound(vector)).groupBy(F.size(vector).alias("n")).count()
    found = sizes.filter((F.col("n") > 0) & (F.col("n") % parts == 0)).orderBy(F.desc("count"), F.desc("n")).first()
    return (found["n"], found["count"]) if found else (0, 0)


def _chunks(batches: Iterator[pa.RecordBatch], vector: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(vector))
        step = max(1, _CHUNK_BYTES // max(8, 8 * len(column[0]) if len(column) else 8))
        for start in range(0, batch.num_rows, step):
            part = column.slice(start, step)
            yield batch.slice(start, step), integer_rows(part)


def _rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*found)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_NAMES = ["position", "entry", "salt", "width", "members"]


def _blocks_of(position: int, entries: np.ndarray, members: np.ndarray, salts: int) -> Iterator[tuple]:
    """A block per entry that occurs; its salt is a hash of its members, so a repeated task gives the same."""
    order = np.argsort(entries, kind="stable")
    cuts = np.flatnonzero(np.diff(entries[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        data, width = packed(members[rows])
        yield position, int(entries[rows[0]]), zlib.crc32(data) % salts, width, data


def _dealt(blocks: DataFrame, partitions: int, length: int) -> DataFrame:
    """Blocks shuffled to the partitions of their owners, the small ones of an owner put together, and written."""

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, held, size = None, [], 0

        def full() -> pa.RecordBatch:
            data, width = packed(np.concatenate(held))
            return _rows([(*owner, width, data)], _NAMES)

        for batch in batches:
            for *key, width, data in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (key != owner or size >= BLOCK_BYTES):
                    yield full()
                    held, size = [], 0
                owner, size = key, size + len(data)
                held.append(unpacked(data, width, length))
        if held:
            yield full()

    dealt = blocks.repartition(partitions, *_OWNER).sortWithinPartitions(*_OWNER)
    return written(dealt.mapInArrow(together, _BLOCKS))


def _first_members(rows: DataFrame, vector: str, books: Codebooks, salts: int) -> DataFrame:
    width = books.entries.shape[2]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, vectors in _chunks(batches, vector):
            codes, _ = books.encode(vectors)
            for p in range(codes.shape[1]):
                own = vectors[:, p * width : (p + 1) * width]
                yield _rows(list(_blocks_of(p, codes[:, p], own, salts)), _NAMES)

    return rows.select(vector).mapInArrow(place, _BLOCKS)


def _updated(residents: DataFrame, books: Codebooks) -> Codebooks:
    """Entries replaced by the floored means of their residents; entries without any stay."""
    length = books.entries.shape[2]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for position, entry, _, width, data in zip(*[c.to_pylist() for c in batch.columns]):
                members = unpacked(data, width, length)
                total = np.append(members.sum(0), len(members))
                sums[position, entry] = sums.get((position, entry), 0) + total
        if sums:
            keys = np.repeat(np.array(list(sums)), length, axis=0)
            totals = np.array(list(sums.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[:, 0], pa.int32()),
                    pa.array(keys[:, 1], pa.int32()),
                    pa.array(np.tile(np.arange(length), len(sums)), pa.int32()),
                    pa.array(totals[:, :-1].ravel(), pa.int64()),
                    pa.array(np.repeat(totals[:, -1], length), pa.int64()),
                ],
                names=["position", "entry", "component", "total", "n"],
            )

    partial = residents.mapInArrow(add, "position int, entry int, component int, total long, n long")
    means = partial.groupBy("position", "entry", "component").agg(F.sum("total"), F.sum("n"))
    entries = books.entries.copy()
    for position, entry, component, total, n in means.collect():  # as many rows as the codebooks have numbers
        entries[position, entry, component] = total // n
    return Codebooks(entries)


def _reassigned(residents: DataFrame, books: Codebooks, salts: int, partitions: int) -> DataFrame:
    """Residents under new codebooks: those that keep their entry stay where they lie, the others are dealt."""
    length = books.entries.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, moved = [], []
            for position, entry, salt, width, data in zip(*[c.to_pylist() for c in batch.columns]):
                members = unpacked(data, width, length)
                best, _ = nearest(members, books.entries[position])
                stay = best == entry
                if stay.any():
                    kept, width = packed(members[stay])
                    found.append((position, entry, salt, width, kept))
                    moved.append(False)
                gone = list(_blocks_of(position, best[~stay], members[~stay], salts))
                found += gone
                moved += [True] * len(gone)
            rows = _rows(found, _NAMES)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(moved, pa.bool_())], names=[*_NAMES, "moved"])

    spark = residents.sparkSession
    folder = fresh_folder(spark)
    assigned = residents.mapInArrow(assign, f"{_BLOCKS}, moved boolean")
    assigned.write.partitionBy("moved").option("compression", "zstd").parquet(folder)
    after = spark.read.schema(f"{_BLOCKS}, moved boolean").parquet(folder)
    stayed, left = (after.filter(F.col("moved") == m).drop("moved") for m in (False, True))
    return stayed.union(_dealt(left, partitions, length))


def train_codebooks(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks | None:
    """Codebooks after some rounds, begun with the parts of the vectors of the smallest ids; None without vectors.

    Reads the vectors that ``encode_vectors`` encodes. With fewer vectors than ``entries`` the codebooks are that small.
    """
    spark = bounded_batches(rows)
    length, n = common_length(rows, vector, parts)
    if not n:
        return None
    if entries > 256:
        raise ValueError("entry numbers have two hexadecimal digits: at most 256 entries")
    sound = rows.filter(is_sound(vector, length)).select(id_column, vector)
    first = smallest_rows(sound, entries, vector, F.col(id_column).asc_nulls_last())
    books = Codebooks(first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy())
    partitions = max(spark.sparkContext.defaultParallelism, -(-n * length * 2 // PARTITION_BYTES))
    # An entry that holds all members of its position is split into pieces of at most about a partition's size.
    salts = max(1, -(-n * length * 2 // (parts * PARTITION_BYTES)))
    residents = None
    for _ in range(rounds):
        if residents is None:
            residents = _dealt(_first_members(sound, vector, books, salts), partitions, length // parts)
        else:
            residents = _reassigned(residents, books, salts, partitions)
        books = _updated(residents, books)
    return books


def encode_vectors(
    rows: DataFrame, books: Codebooks, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(id, label, code, error) of every sound vector of the codebooks' length: one pass, no shuffle."""
    length = books.entries.shape[0] * books.entries.shape[2]
    sound = rows.filter(is_sound(vector, length)).select(
        F.col(id_column).alias("_id"), F.col(label).alias("_label"), F.col(vector).alias("_vector")
    )
    kinds = [rows.schema[c].dataType for c in (id_column, label)]
    fields = [("_id", kinds[0]), ("_label", kinds[1]), ("code", T.StringType()), ("error", T.LongType())]
    bounded_batches(rows)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, vectors in _chunks(batches, "_vector"):
            codes, error = books.encode(vectors)
            text = codes.tobytes().hex()
            step = 2 * codes.shape[1]
            texts = [text[i : i + step] for i in range(0, len(text), step)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(error)],
                names=["_id", "_label", "code", "error"],
            )

    return sound.mapInArrow(encode, T.StructType([T.StructField(n, k) for n, k in fields]))


def vector_codes(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per vector: id, label, code, error, label_error (over equal labels, nulls together), codebooks_sha256.

    Left out are vectors that are null, hold a null or non-finite component, or differ in length from
    most of those that can be cut into ``parts``. Repeated rows are members each; where ids repeat or are null, the
    first entries are told apart by the vectors, null ids last. Vectors whose components, times 256, are beyond 2^26
    raise ``ValueError``. Other columns are not read. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    books = train_codebooks(rows, id_column, vector, parts, entries, rounds)
    id_kind, label_kind = (rows.schema[c].dataType for c in (id_column, label))
    results = {"code": T.StringType(), "error": T.LongType(), "label_error": T.LongType(), "codebooks_sha256": T.StringType()}
    if clash := set(results) & {id_column, label}:
        raise ValueError(f"rename {', '.join(sorted(clash))}: these are columns of the result")
    if books is None:
        fields = {id_column: id_kind, label: label_kind} | results
        return spark.createDataFrame([], T.StructType([T.StructField(n, k) for n, k in fields.items()]))
    encoded = written(encode_vectors(rows, books, id_column, vector, label))
    totals = encoded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    joined = encoded.join(broadcast_if_small(totals), F.col("_label").eqNullSafe(F.col("_of")))
    return joined.select(
        F.col("_id").alias(id_column), F.col("_label").alias(label), "code", "error", "label_error",
        F.lit(books.sha256).alias("codebooks_sha256"),
    )
