"""Vector codes and centroid clusters against plain loops over whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vetrail.llm.clusters import Simplex, centroid_clusters, nearest_by_bounds
from vetrail.llm.codes import Codebooks, _blocks_of, _BLOCKS, _dealt, _first_members, _reassigned, _rows, _NAMES, train_codebooks, vector_codes
from vetrail.llm.integers import squared_distances, unpacked
from vetrail.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def sound(vector, length=None):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector) and len(vector) == (length or len(vector))


def whole(vector):
    return [math.floor(256 * float(x)) for x in vector]


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def best(member, entries):
    return min((apart(member, e), i) for i, e in enumerate(entries))


def floored_means(members, entries):
    groups = [[] for _ in entries]
    for m in members:
        groups[best(m, entries)[1]].append(m)
    return [[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(groups, entries)]


def last(x):
    return (x is None, x)


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted((r for r in rows if sound(r[1])), key=lambda r: (last(r[0]), r[1]))
    vectors = [whole(r[1]) for r in kept]
    width = len(vectors[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for v in vectors] for p in range(parts)]
    books = [members[:entries] for members in cut]
    for _ in range(rounds):
        books = [floored_means(members, book) for members, book in zip(cut, books)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    out = []
    for i, (vec_id, _, label) in enumerate(kept):
        found = [best(members[i], book) for members, book in zip(cut, books)]
        out.append((vec_id, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    sums = {label: sum(r[3] for r in out if r[1] == label) for label in {r[1] for r in out}}
    return [(*r, sums[r[1]], hashlib.sha256(text.encode()).hexdigest()) for r in out]


def brute_clusters(rows, length=64, clusters=40, rounds=5):
    def key(r):
        return last(r[0] if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()), last(r[0]), r[1]

    kept = sorted((r for r in rows if sound(r[1], length)), key=key)
    vectors = [whole(r[1]) for r in kept]
    centroids = vectors[:clusters]
    for _ in range(rounds):
        centroids = floored_means(vectors, centroids)
    found = [best(v, centroids) for v in vectors]
    inertia = [sum(d for d, c in found if c == k) for k in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(r[0], c, d, inertia[c], sum(inertia), digests[c]) for r, (d, c) in zip(kept, found)]


def same(frame, rows):
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted(rows, key=repr)


def mixed_rows(seed, n=260, length=64, spread=1.0):
    """Vectors with hot copies, ties, repeated and null ids, and all kinds of unsound ones."""
    rng = random.Random(seed)
    hot = [np.float32(rng.gauss(0, spread)).item() for _ in range(length)]
    rows = []
    for i in range(n):
        vector = hot if i % 3 == 0 else [np.float32(rng.gauss(0, spread)).item() for _ in range(length)]
        rows.append((i, vector, rng.choice([None, 0, 1])))
    grid = [[float((i * k) % 3 - 1) for k in range(length)] for i in range(40)]  # many equal distances
    rows += [(1000 + i, v, 2) for i, v in enumerate(grid)]
    rows += [rows[5], rows[5], (7, grid[3], None), (None, grid[5], 1), (None, hot, 1), (3000, [0.0] * length, None)]
    bad = [None, [], [None] * length, [math.nan] + [0.0] * (length - 1), [math.inf] + [0.0] * (length - 1), [1.0] * (length - 1) + [None]]
    return rows + [(-1 - i, v, 1) for i, v in enumerate(bad)]


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.02), (3, 3000.0)])
def test_codes(spark, seed, spread):
    rows = [r for r in mixed_rows(seed, spread=spread) if r[1] != []]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("code", F.lit("x")).withColumn("_id", F.lit(1))
    same(vector_codes(frame), brute_codes(rows))


def test_codes_of_few_vectors_and_other_sizes(spark):
    rows = [(i, [float(i * k % 5) for k in range(8)], None) for i in range(9)]
    same(vector_codes(spark.createDataFrame(rows, SCHEMA), parts=4, entries=4, rounds=4), brute_codes(rows, 4, 4, 4))
    same(vector_codes(spark.createDataFrame(rows, SCHEMA), parts=2), brute_codes(rows, 2))


def test_codes_leave_out_lengths_of_the_few(spark):
    rows = [(i, [float(i + k) for k in range(16)], 1) for i in range(5)]
    odd = [(90, [1.0] * 32, 1), (91, [1.0] * 15, 1), (92, [], 1)]
    same(vector_codes(spark.createDataFrame(rows + odd, SCHEMA)), brute_codes(rows))


@pytest.mark.parametrize("operator", [vector_codes, centroid_clusters])
def test_empty_tables(spark, operator):
    none = spark.createDataFrame([], SCHEMA)
    bad = spark.createDataFrame([(1, None, 1), (2, [], None), (3, [math.nan] * 64, 1)], SCHEMA)
    assert operator(none).count() == operator(bad).count() == 0
    assert operator(none).columns == operator(spark.createDataFrame(mixed_rows(4, 5), SCHEMA)).columns


@pytest.mark.parametrize("operator", [vector_codes, centroid_clusters])
def test_too_large_components_are_refused(spark, operator):
    with pytest.raises(Exception, match="64 bits"):
        operator(spark.createDataFrame([(1, [1e9] * 64, 1)], SCHEMA)).count()


def test_only_members_that_change_their_entry_are_dealt(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=32).tolist(), 0) for i in range(500)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    before, after = train_codebooks(frame, rounds=0, entries=8), train_codebooks(frame, rounds=1, entries=8)

    def members(blocks):
        return sorted(
            (b["position"], b["entry"], tuple(m))
            for b in blocks.collect()
            for m in unpacked(b["members"], b["width"], 2).tolist()
        )

    residents = _dealt(_first_members(frame, "embedding", before, 3), 5, 2)
    moved = _reassigned(residents, after, 3, 5)
    want = []
    for _, v, _ in rows:
        v = whole(np.float32(v).tolist())
        want += [(p, best(v[2 * p : 2 * p + 2], after.entries[p].tolist())[1], tuple(v[2 * p : 2 * p + 2])) for p in range(16)]
    assert members(moved) == sorted(want)
    # Stayers lie in files of their own that no shuffle wrote; the rest are fewer than all.
    kept = members(moved.filter(F.input_file_name().contains("moved=false")))
    assert set(kept) <= set(members(residents)) and 0 < len(kept) < len(want)
    # All blocks of an owner lie in one partition, and large owners are salted.
    filed = residents.withColumn("file", F.input_file_name())
    owners = filed.groupBy("position", "entry", "salt").agg(F.countDistinct("file").alias("n"))
    assert owners.filter("n > 1").count() == 0
    assert residents.groupBy("position", "entry").agg(F.countDistinct("salt").alias("n")).filter("n > 1").count() > 0


def test_blocks_and_decoding():
    found = list(_blocks_of(3, np.array([2, 0, 2]), np.array([[1, 2], [-3, 4], [70000, 6]]), 4))
    assert [(b[0], b[1], b[3]) for b in found] == [(3, 0, 2), (3, 2, 4)]
    assert unpacked(found[1][4], 4, 2).tolist() == [[1, 2], [70000, 6]]
    assert _rows([], _NAMES).num_rows == 0 and _BLOCKS.count(",") == 4
    books = Codebooks(np.array([[[1, 2], [3, 4]], [[5, 6], [7, 8]]]))
    assert books.decode("0100").tolist() == [3, 4, 5, 6]


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.02), (3, 3000.0)])
def test_clusters(spark, seed, spread):
    rows = mixed_rows(seed, spread=spread) + [(5000, [1.0] * 63, 1), (5001, [1.0] * 65, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("cluster", F.lit(1)).withColumn("_id", F.lit(1))
    same(centroid_clusters(frame), brute_clusters(rows))


def test_clusters_of_few_and_equal_vectors(spark):
    rows = [(i, [float(i % 2)] * 4, None) for i in range(9)]
    same(centroid_clusters(spark.createDataFrame(rows, SCHEMA), length=4), brute_clusters(rows, 4))
    same(centroid_clusters(spark.createDataFrame(rows[::2], SCHEMA), length=4, clusters=3), brute_clusters(rows[::2], 4, 3))
    same(centroid_clusters(spark.createDataFrame(rows[:1], SCHEMA), length=4), brute_clusters(rows[:1], 4))


@pytest.mark.parametrize("scale", [3, 300, 1 << 26])
def test_bounds_hold_and_rule_out(scale):
    rng = np.random.default_rng(scale)
    centres = rng.integers(-scale, scale, (40, 64))
    vectors = np.concatenate([centres[rng.integers(0, 40, 500)] + rng.integers(-scale // 3, scale // 3 + 1, (500, 64)), centres])
    vectors = np.clip(vectors, -(1 << 26), 1 << 26)
    simplex = Simplex.over(centres)
    apexes, places = simplex.apexes(vectors), simplex.apexes(centres)
    exact = squared_distances(vectors, centres)
    lower = ((apexes[:, None] - places[None]) ** 2).sum(2)
    upper = lower + 4 * apexes[:, None, -1] * places[None, :, -1]
    slack = simplex.slack(float(exact.max()))
    assert (lower <= exact + slack).all() and (exact <= upper + slack).all()
    best_, distance, compared = nearest_by_bounds(simplex, vectors, apexes, centres)
    assert (best_ == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert compared < 0.5 * exact.size


@pytest.mark.parametrize("name,brute", [("op12_vector_codes", brute_codes), ("op13_centroid_clusters", brute_clusters)])
def test_queries(spark, sf_dir, name, brute):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(QUERIES[name](spark, sf_dir), brute(rows))
