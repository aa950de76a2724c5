"""Vectors as whole numbers: exact squared distances and floored means, alike on every run and partitioning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Components beyond this are refused: their squared distances would leave 64 bits.
LARGEST = 1 << 26
#: Whole numbers up to here are exact in double precision.
_EXACT = 1 << 53


def is_sound(vector: str | Column, length: int | None = None) -> Column:
    """Not null, no null or non-finite component, and of a given length."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    found = vector.isNotNull() & finite
    return F.coalesce(found if length is None else found & (F.size(vector) == length), F.lit(False))


def integer_rows(column: pa.Array, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of an Arrow list column whose lists have one length; int64, one row per list."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(values * scale)
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST / scale:g} can't be compared exactly in 64 bits")
    return out.astype(np.int64).reshape(len(column), -1)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of whole-number rows, as int64 (rows, centres)."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < _EXACT:
        a, b = x.astype(np.float64), centres.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(centres)), np.int64)
    for j in range(x.shape[1]):  # a component at a time: memory follows the result
        apart = x[:, j, None] - centres[None, :, j]
        out += apart * apart
    return out


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre (ties: the smaller number) and its squared distance."""
    apart = squared_distances(x, centres)
    best = apart.argmin(1)
    return best, apart[np.arange(len(x)), best]


def packed(x: np.ndarray) -> tuple[bytes, int]:
    """Whole numbers in the fewest of 2 or 4 bytes each, and that width."""
    width = 2 if np.abs(x).max(initial=0) < 1 << 15 else 4
    return x.astype(f"<i{width}").tobytes(), width


def unpacked(data: bytes, width: int, length: int) -> np.ndarray:
    """The rows of ``packed`` numbers."""
    return np.frombuffer(data, f"<i{width}").astype(np.int64).reshape(-1, length)


def smallest_rows(rows: DataFrame, n: int, vector: str, *order: Column) -> np.ndarray:
    """The whole-number vectors of the first n rows in an order, ties by the vector; n rows reach the driver."""
    first = rows.orderBy(*order, F.col(vector)).limit(n).select(vector).toArrow().column(0)
    return integer_rows(first.combine_chunks())
