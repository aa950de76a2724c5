"""Centroid clustering with an n-simplex projection as a filter ahead of exact comparisons.

A few pivots span a simplex. A vector's distances to the pivots, taken once, place it as an apex over that
simplex: its coordinates along the base, and its height over it. For two apexes a and b the distance of the
vectors lies between |a - b| and the same with the height of b turned to the other side. Apexes are written beside the
vectors, so a round places only the centroids anew: bounds in a few dimensions rule out all centroids whose
lower bound exceeds the least upper bound, and the rest are compared exactly on whole numbers. The bounds carry a
slack for rounding that follows the base's condition, so a filter never drops the nearest centroid.

Tasks add up their members per centroid, and the driver gets clusters x length sums a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrail.llm.common import bounded_batches, written
from vetrail.llm.integers import integer_rows, is_sound, smallest_rows, squared_distances

LENGTH, CLUSTERS, ROUNDS, PIVOTS = 64, 40, 5, 16
SEED = "2:"
#: A pivot is taken while its height over the base exceeds this share of the widest distance.
_LEAST_HEIGHT = 0.05
#: Rows compared at a time.
_CHUNK = 4096


@dataclass(frozen=True)
class Simplex:
    """Pivots and the coordinates of their simplex: row i of ``base`` places pivot i+1 against pivot 0."""

    pivots: np.ndarray
    base: np.ndarray
    inverse: np.ndarray

    @classmethod
    def over(cls, vectors: np.ndarray, most: int = PIVOTS) -> "Simplex":
        """Pivots among some vectors, each the one highest over the simplex of those before it."""
        chosen, widest = [0], float(np.sqrt(squared_distances(vectors[:1], vectors).max()))
        base = np.zeros((0, 0))
        while len(chosen) < min(most, len(vectors)):
            simplex = cls._of(vectors[chosen], base)
            places = simplex.apexes(vectors)
            high = int(places[:, -1].argmax())
            if places[high, -1] <= _LEAST_HEIGHT * widest or high in chosen:
                break
            grown = np.zeros((len(chosen), len(chosen)))
            grown[:-1, :-1], grown[-1] = base, places[high]
            base = grown
            chosen.append(high)
        return cls._of(vectors[chosen], base)

    @classmethod
    def _of(cls, pivots: np.ndarray, base: np.ndarray) -> "Simplex":
        return cls(pivots, base, np.linalg.inv(base) if len(base) else base)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the simplex from distances to the pivots; the last one is the height."""
        apart = squared_distances(vectors, self.pivots).astype(np.float64)
        norms = (self.base * self.base).sum(1)
        along = (apart[:, :1] + norms - apart[:, 1:]) / 2 @ self.inverse.T
        height = np.sqrt(np.maximum(apart[:, 0] - (along * along).sum(1), 0))
        return np.column_stack([along, height])

    def slack(self, widest: float) -> float:
        """More than rounding can change a squared bound between apexes whose squared distances reach ``widest``."""
        spread = 1.0
        if len(self.base):
            spread += float(np.abs(self.inverse).sum(1).max()) * widest**0.5
        return 4 * widest * (len(self.pivots) * spread * 2.0**-45) ** 0.5

    def candidates(self, apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """Which centroids may be the nearest to each vector, as (vectors, centres) booleans."""
        squares = (apexes * apexes).sum(1)[:, None] + (centres * centres).sum(1)[None]
        lower = squares - 2 * apexes @ centres.T
        upper = lower + 4 * apexes[:, -1:] * centres[:, -1]
        slack = self.slack(float(squares.max(initial=0)) * 2)
        return lower <= upper.min(1, keepdims=True) + slack


def nearest_by_bounds(
    simplex: Simplex, vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number), its squared distance, and how many exact comparisons it took."""
    best, distance = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
    places, compared = simplex.apexes(centroids), 0
    for s in range(0, len(vectors), _CHUNK):
        part = vectors[s : s + _CHUNK]
        row, centre = np.nonzero(simplex.candidates(apexes[s : s + _CHUNK], places))
        apart = np.zeros(len(row), np.int64)
        for a in range(0, len(row), _CHUNK):
            difference = part[row[a : a + _CHUNK]] - centroids[centre[a : a + _CHUNK]]
            apart[a : a + _CHUNK] = (difference * difference).sum(1)
        table = np.full((len(part), len(centroids)), np.iinfo(np.int64).max)
        table[row, centre] = apart
        best[s : s + _CHUNK] = table.argmin(1)
        distance[s : s + _CHUNK] = table.min(1)
        compared += len(row)
    return best, distance, compared


def _numbers(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Equal-sized binary values as one array of numbers, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _cached(sound: DataFrame, id_column: str, vector: str, simplex: Simplex) -> DataFrame:
    """(_id, _whole, _apex) of every vector, written once."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = integer_rows(batch.column(1))
                apex = simplex.apexes(whole)
                columns = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (whole.astype("<i4"), apex)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_id", "_whole", "_apex"])

    fields = [("_id", sound.schema[id_column].dataType), ("_whole", T.BinaryType()), ("_apex", T.BinaryType())]
    schema = T.StructType([T.StructField(n, k) for n, k in fields])
    return written(sound.select(F.col(id_column).alias("_id"), vector).mapInArrow(place, schema))


def _unpack(batch: pa.RecordBatch, simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    whole, apex = (batch.column(batch.schema.get_field_index(c)) for c in ("_whole", "_apex"))
    length = simplex.pivots.shape[1]
    return _numbers(whole, "<i4", length).astype(np.int64), _numbers(apex, "<f8", len(simplex.pivots))


def _updated(cached: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Centroids replaced by the floored means of their vectors; those without any stay."""
    k, length = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, length), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                whole, apexes = _unpack(batch, simplex)
                best, _, _ = nearest_by_bounds(simplex, whole, apexes, centroids)
                np.add.at(sums, best, whole)
                counts += np.bincount(best, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, length), pa.int32()),
                pa.array(np.tile(np.arange(length), len(used)), pa.int32()),
                pa.array(sums[used].ravel()),
                pa.array(np.repeat(counts[used], length)),
            ],
            names=["cluster", "component", "total", "n"],
        )

    partial = cached.select("_whole", "_apex").mapInArrow(add, "cluster int, component int, total long, n long")
    out = centroids.copy()
    means = partial.groupBy("cluster", "component").agg(F.sum("total"), F.sum("n"))
    for cluster, component, total, n in means.collect():  # clusters x length rows
        out[cluster, component] = total // n
    return out


def _assigned(cached: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best, distance, _ = nearest_by_bounds(simplex, *_unpack(batch, simplex), centroids)
                columns = [batch.column(0), pa.array(best, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "cluster", "distance"])

    fields = [("_id", cached.schema["_id"].dataType), ("cluster", T.IntegerType()), ("distance", T.LongType())]
    return written(cached.mapInArrow(assign, T.StructType([T.StructField(n, k) for n, k in fields])))


def centroid_clusters(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    length: int = LENGTH,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    seed: str = SEED,
) -> DataFrame:
    """Per vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``length`` components, none null or non-finite. The first centroids are the vectors of
    the smallest hashes of seed and id; null ids come last, equal ids are told apart by their vectors. Fewer vectors
    than ``clusters`` are that many centroids. Repeated rows are members each. Vectors whose components, times 256, are
    beyond 2^26 raise ``ValueError``. Other columns are not read. An empty table gives an empty result.
    """
    results = {"cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"}
    if id_column in results:
        raise ValueError(f"rename {id_column}: it is a column of the result")
    spark = bounded_batches(rows)
    sound = rows.filter(is_sound(vector, length)).select(id_column, vector)
    hashed = F.sha2(F.concat(F.lit(seed), F.col(id_column).cast("string")), 256)
    centroids = smallest_rows(sound, clusters, vector, hashed.asc_nulls_last(), F.col(id_column).asc_nulls_last())
    if not len(centroids):
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        kind = T.StructType([T.StructField(id_column, rows.schema[id_column].dataType)])
        return spark.createDataFrame([], T.StructType([*kind.fields, *T._parse_datatype_string(empty).fields]))
    simplex = Simplex.over(centroids, pivots)
    cached = _cached(sound, id_column, vector, simplex)
    for _ in range(rounds):
        centroids = _updated(cached, simplex, centroids)
    assigned = _assigned(cached, simplex, centroids)
    # One row per cluster from here to the broadcast.
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, n, sum(inertia.values()), digests[c]) for c, n in inertia.items()],
        "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("_cluster")).select(
        F.col("_id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
