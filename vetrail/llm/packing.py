"""Best-fit packing of token pieces into sequences of a fixed capacity.

A piece's place depends only on its length, so packing is decided on the table of lengths, which has
at most ``capacity`` rows for any corpus. Best-two-fit: a bin is filled greedily with the largest piece
that fits; then its smallest piece is replaced by two unpacked ones that fit the widened gap more
tightly. The bin is made as often as the counts allow before the next one is designed; each design uses
up at least one length, so there are at most ``capacity`` designs.

The pieces of a length are then numbered across the table (in blocks, so that no length has to be
numbered in one task), and a number tells the bin and the offset in it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetrail.llm.common import bounded_batches, text_blocks
from vetrail.llm.tokens import tokenizer
from vetrail.session import materialized

CAPACITY = 4096
END_ID = 1
BLOCK_ROWS = 5_000


class _Lengths:
    """Counts per length with the lengths still in stock in ascending order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {k: v for k, v in counts.items() if v > 0}
        self.stock = sorted(self.left)

    def largest(self, most: int) -> int:
        at = bisect_right(self.stock, most)
        return self.stock[at - 1] if at else 0

    def take(self, length: int, number: int = 1) -> None:
        self.left[length] -= number
        if not self.left[length]:
            self.stock.remove(length)

    def put(self, length: int) -> None:
        if not self.left.get(length):
            self.left[length] = 0
            self.stock.insert(bisect_right(self.stock, length), length)
        self.left[length] += 1

    def best_two(self, room: int) -> tuple[int, int]:
        """The two lengths in stock with the largest sum up to ``room``; (0, 0) if there is none."""
        best, i, j = (0, 0), 0, len(self.stock) - 1
        while i <= j:
            a, b = self.stock[i], self.stock[j]
            if a + b > room:
                j -= 1
            else:
                if a + b > sum(best) and (i < j or self.left[a] > 1):
                    best = (b, a)
                if a + b == room and sum(best) == room:
                    break
                i += 1
        return best


def bin_designs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins) that pack all counted lengths."""
    stock, designs = _Lengths(counts), []
    while stock.stock:
        design, gap = [], capacity
        while (length := stock.largest(gap)) > 0:
            stock.take(length)
            design.append(length)
            gap -= length
        if gap and len(design) > 1:
            smallest = min(design)
            two = stock.best_two(gap + smallest)
            if sum(two) > smallest:
                design.remove(smallest)
                stock.put(smallest)
                for length in two:
                    stock.take(length)
                    design.append(length)
        need = {k: design.count(k) for k in design}
        more = min(stock.left.get(k, 0) // n for k, n in need.items())
        if more:
            for k, n in need.items():
                stock.take(k, n * more)
        designs.append((design, more + 1))
    return designs


def _slots(designs: list[tuple[list[int], int]]) -> pd.DataFrame:
    """Per run of equal numbers of a length: the bins and offsets they get."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for design, times in designs:
        offset = 0
        for length in sorted(set(design), reverse=True):
            per_bin = design.count(length)
            rows.append((length, used.get(length, 0), per_bin, sequence, offset))
            used[length] = used.get(length, 0) + per_bin * times
            offset += per_bin * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "from", "per_bin", "sequence", "offset"]).astype("int64")


def pack_lengths(
    pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    ``pieces`` must read the same at every reading (a written table). Equal pieces get places of their
    own. An empty table stays empty. Columns named ``_block`` or ``_number`` are not allowed.
    """
    # Counts per length: at most ``capacity`` rows on the driver.
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    slots = _slots(bin_designs(counts, capacity))
    blocks = max(1, -(-sum(counts.values()) // block_rows))
    keys = [c for c in pieces.columns if c != length]
    blocked = pieces.withColumn("_block", F.pmod(F.xxhash64(*keys), F.lit(blocks)))
    sizes = blocked.groupBy(length, "_block").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(length).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(length, "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    order = Window.partitionBy(length, "_block").orderBy(*keys)
    numbered = (
        blocked.withColumn("_number", F.row_number().over(order) - 1)
        .join(starts, [length, "_block"])
        .withColumn("_number", F.col("_number") + F.col("_start"))
    )
    shared = pieces.sparkSession.sparkContext.broadcast(slots)  # designs x distinct lengths in a bin

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        table = _by_length(shared.value)
        key = lengths.to_numpy(np.int64) << 44 | numbers.to_numpy(np.int64)
        row = np.searchsorted(table["key"], key, "right") - 1
        within = numbers.to_numpy(np.int64) - table["from"][row]
        per_bin = table["per_bin"][row]
        return pd.DataFrame(
            {
                "sequence_id": table["sequence"][row] + within // per_bin,
                "offset": table["offset"][row] + within % per_bin * lengths.to_numpy(np.int64),
            }
        )

    return (
        numbered.withColumn("_place", place(length, "_number"))
        .withColumns({"sequence_id": F.col("_place.sequence_id"), "offset": F.col("_place.offset")})
        .drop("_place", "_block", "_number", "_start")
    )


def _by_length(slots: pd.DataFrame) -> dict[str, np.ndarray]:
    slots = slots.assign(key=slots["length"].to_numpy() << 44 | slots["from"].to_numpy())
    slots = slots.sort_values("key")
    return {c: slots[c].to_numpy(np.int64) for c in slots.columns}


def token_pieces(
    documents: DataFrame,
    file: str,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Cut each document's ids and its end id into pieces: id, piece, start, length, ids_crc32."""
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(file)
        for rows, raw, at in text_blocks(batches, text):
            ids, counts = words.encode(raw, at)
            which, piece, start, length, crc = [], [], [], [], []
            begin = 0
            for k, n in enumerate(counts.tolist()):
                own = np.append(ids[begin : begin + n].astype("<u4"), np.uint32(end_id))
                begin += n
                for p, s in enumerate(range(0, n + 1, capacity)):
                    part = own[s : s + capacity]
                    which.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            key = rows.column(rows.schema.get_field_index(id_column)).take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    key,
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=[id_column, "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(id_column, text).mapInArrow(cut, schema)


def pack_documents(
    documents: DataFrame,
    file: str,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Null and empty texts are one piece of the end id. A text longer than ``capacity`` less one is cut
    into full pieces and a rest. Repeated rows are packed each. Other columns are not read. An empty
    table gives an empty result.
    """
    bounded_batches(documents)
    pieces = materialized(token_pieces(documents, file, id_column, text, capacity, end_id))
    return pack_lengths(pieces, "length", capacity)
