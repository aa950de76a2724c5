"""Boosted trees and Shapley values against plain loops."""

import itertools
import math
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vetrail.operators import boost, explain, shapley, train

NAMES = ["a", "b", "c", "d"]
START = date(2020, 1, 1)


def table(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 6, n), rng.normal(size=n).round(1), rng.integers(0, 2, n), rng.exponential(size=n).round(2)])
    chance = 1 / (1 + np.exp(-(x[:, 0] - 3 + x[:, 1] * (1 + x[:, 2]))))
    y = (rng.random(n) < chance).astype(int)
    return x.astype(float), y


def frame(spark, x, y, partitions=3):
    rows = [(*map(float, r), int(t), START + timedelta(days=i)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y int, day date").repartition(partitions)


def sigmoid(m):
    return 1 / (1 + np.exp(-m))


def brute_fit(x, y, edges, spec):
    """Every split of every node tried by itself."""
    weight = np.where(y > 0, spec.positive_weight, 1.0)
    base = math.log(weight[y > 0].sum() / weight[y == 0].sum())
    margin, trees = np.full(len(y), base), []
    for t in range(spec.trees):
        p = sigmoid(margin)
        g = np.rint(weight * (p - y) * spec.unit) / spec.unit
        h = np.rint(weight * p * (1 - p) * spec.unit) / spec.unit
        columns, nodes = spec.columns(x.shape[1], t), {}

        def value(rows):
            return -spec.rate * g[rows].sum() / (h[rows].sum() + spec.l2)

        def grow(node, rows, depth):
            nodes[node] = (-1, None, value(rows), h[rows].sum())
            best = None
            for f in columns if depth < spec.depth else ():
                for cut in edges[f]:
                    left, right = rows[x[rows, f] < cut], rows[x[rows, f] >= cut]
                    if not len(left) or not len(right) or min(h[left].sum(), h[right].sum()) < spec.min_weight:
                        continue
                    gain = sum(s * g[part].sum() ** 2 / (h[part].sum() + spec.l2) for s, part in ((1, left), (1, right), (-1, rows)))
                    if gain > max(spec.min_gain, 1e-6) and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, cut, left, right
            if best:
                nodes[node] = (int(best[1]), best[2], value(rows), h[rows].sum())
                grow(2 * node + 1, best[3], depth + 1)
                grow(2 * node + 2, best[4], depth + 1)

        grow(0, np.arange(len(y)), 0)
        trees.append(nodes)
        for i in range(len(y)):
            node = 0
            while nodes[node][0] >= 0:
                node = 2 * node + 1 + (x[i, nodes[node][0]] >= nodes[node][1])
            margin[i] += nodes[node][2]
    return base, trees, margin


def check(model, brute):
    base, trees, _ = brute
    assert model.base == pytest.approx(base, abs=1e-9) and len(model.trees) == len(trees)
    found = {(t, node): (f, cut, v, c) for t, node, f, cut, v, c, _ in model.nodes()}
    assert set(found) == {(t, n) for t, nodes in enumerate(trees) for n in nodes}
    for (t, node), (f, cut, v, c) in found.items():
        assert (f, cut) == trees[t][node][:2]
        assert (v, c) == pytest.approx(trees[t][node][2:], abs=1e-7)


SPECS = [
    boost.Spec(trees=4, depth=3),
    boost.Spec(trees=3, depth=4, positive_weight=7.0, min_weight=4.0, l2=2.5, rate=0.3),
    boost.Spec(trees=4, depth=3, feature_share=0.6, min_gain=3.0, seed=7),
]


def test_every_split_against_brute_force(spark):
    x, y = table()
    binned = boost.binned(frame(spark, x, y), NAMES, "y")
    for spec, model in zip(SPECS, boost.fit_many(binned, SPECS)):
        brute = brute_fit(x, y, binned.edges, spec)
        check(model, brute)
        assert model.margins(x) == pytest.approx(brute[2], abs=1e-7)


def test_splits_by_shuffle_are_the_same(spark, monkeypatch):
    x, y = table(300, 2)
    binned = boost.binned(frame(spark, x, y), NAMES, "y")
    by_driver = boost.fit_many(binned, SPECS[:2])
    monkeypatch.setattr(boost, "DRIVER_BYTES", 0)
    monkeypatch.setattr(boost, "TASK_BYTES", 1)  # one model a scan
    monkeypatch.setattr(boost, "_GROUP", 2)
    for a, b in zip(by_driver, boost.fit_many(binned, SPECS[:2])):
        assert list(a.nodes()) == list(b.nodes())


def test_sums_reach_the_driver_once_per_node(spark, monkeypatch):
    x, y = table(300, 2)
    binned = boost.binned(frame(spark, x, y, 6), NAMES, "y", partition_rows=20)
    wanted = boost.fit_many(binned, SPECS[:1])[0]
    monkeypatch.setattr(boost, "DIRECT_BYTES", 0)
    sent, added = [], boost._added
    monkeypatch.setattr(boost, "_added", lambda parts, *rest: (sent.append(len(parts)), added(parts, *rest))[1])
    assert list(boost.fit_many(binned, SPECS[:1])[0].nodes()) == list(wanted.nodes())
    assert sent and max(sent) == 1


def test_lanes_of_many_models_are_the_same(spark, monkeypatch):
    x, y = table(300, 5)
    specs = [boost.Spec(trees=4, depth=1 + k % 4, seed=k, feature_share=0.7, subsample=0.8) for k in range(10)]
    binned = boost.binned(frame(spark, x, y, 4), NAMES, "y", partition_rows=20)
    together = boost.fit_many(binned, specs)
    dealt = boost._Scans(cores=8, partitions=4, rows=300, left=0)
    assert dealt.ranges(10) == 2 and len(dealt.lanes([(k, 1) for k in range(10)], 2)) == 10
    assert dealt.ranges(2) == 4 and len(dealt.lanes([(k, 1) for k in range(2)], 4)) == 1
    for k in (2, 9):
        assert list(boost.fit_many(binned, [specs[k]])[0].nodes()) == list(together[k].nodes())


def test_bin_edges_are_the_values_at_ranks(spark):
    rng = np.random.default_rng(4)
    x = np.stack([rng.integers(0, 5, 999), rng.integers(-300, 300, 999), np.full(999, 2), rng.normal(size=999)], 1).astype(float)
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double").repartition(5)
    for bins in (2, 64, 255):
        for f, edges in enumerate(boost.bin_edges(rows, list("abcd"), bins)):
            values = np.sort(x[:, f])
            wanted = np.unique([values[int(np.ceil(i / bins * 999)) - 1] for i in range(1, bins)])
            assert list(edges) == list(wanted[wanted > values[0]])
    assert boost.bin_edges(rows.limit(0), ["a"])[0].size == 0


def test_models_side_by_side_equal_those_fitted_alone(spark):
    x, y = table(350, 3)
    drawn = [
        boost.Spec(trees=12, depth=2, subsample=0.7, seed=3), boost.Spec(trees=7, depth=3, rate=0.5),
        boost.Spec(trees=30, depth=2, patience=3, fit=(0, 18500), watch=(18500, 1 << 30), rate=0.8),
    ]
    binned = boost.binned(frame(spark, x, y), NAMES, "y", "day")
    other = boost.binned(frame(spark, x, y, 7), NAMES, "y", "day", edges=binned.edges)
    for together, spec in zip(boost.fit_many(binned, drawn), drawn):
        alone = boost.fit_many(other, [spec])[0]
        assert list(together.nodes()) == list(alone.nodes()) and together.history == alone.history


def average_precision(y, score):
    total, before = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        flagged = score >= t
        recall = y[flagged].sum() / y.sum()
        total += (recall - before) * y[flagged].mean()
        before = recall
    return total


def test_stops_on_average_precision(spark):
    x, y = table(500, 4)
    fit, watch = frame(spark, x[:300], y[:300]), frame(spark, x[300:], y[300:])
    model = train.fit_boosted_trees(fit, NAMES, "y", valid=watch, depth=2, rate=0.7, patience=4, trees=60)
    margins, want = np.full(200, model.base), []
    everything = train.fit_boosted_trees(fit, NAMES, "y", depth=2, rate=0.7, trees=len(model.history))
    for t, tree in enumerate(everything.trees):
        margins = margins + tree.value[everything.leaves(t, x[300:])]
        want.append(average_precision(y[300:], margins.round(9)))
    assert model.history == pytest.approx(want)
    best = 0
    for r, value in enumerate(want):
        if value > want[best]:
            best = r
        if r - best >= 4:
            break
    else:
        pytest.fail("patience must end the fit")
    assert len(model.trees) == best + 1 < len(want) < 60
    assert boost.best_round([0.1, 0.3, 0.3, 0.2], 2) == (1, True)
    assert boost.best_round([None, 0.3], 2) == (1, False) and boost.best_round([], 2) == (0, False)


def brute_shapley(model, row):
    """All feature subsets; an unknown feature follows both branches by their covers."""

    def expect(tree, cuts, known, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        left, right = 2 * node + 1, 2 * node + 2
        if f in known:
            return expect(tree, cuts, known, left if row[f] < cuts[node] else right)
        return sum(tree.cover[c] / tree.cover[node] * expect(tree, cuts, known, c) for c in (left, right))

    n = len(row)
    out = np.zeros(n)
    for tree, cuts in zip(model.trees, model.thresholds):
        for i in range(n):
            others = [j for j in range(n) if j != i]
            for k in range(n):
                weight = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
                for known in itertools.combinations(others, k):
                    out[i] += weight * (expect(tree, cuts, {*known, i}) - expect(tree, cuts, set(known)))
    return out


@pytest.mark.parametrize("spec", SPECS[:2])
def test_shapley_values_against_all_subsets(spark, spec, monkeypatch):
    x, y = table()
    rows = frame(spark, x, y).withColumn("id", F.monotonically_increasing_id())
    model = boost.fit_many(boost.binned(rows, NAMES, "y"), [spec])[0]
    found = shapley.shapley_values(model, x[:60])
    assert found == pytest.approx(np.array([brute_shapley(model, r) for r in x[:60]]), abs=1e-9)
    assert model.expected + found.sum(1) == pytest.approx(model.margins(x[:60]), abs=1e-9)
    monkeypatch.setattr(shapley, "_VALUES", 64)
    monkeypatch.setattr(shapley, "_ROWS", 7)
    assert shapley.shapley_values(model, x[:60]) == pytest.approx(found, abs=1e-12)
    explained = explain.tree_contributions(model, rows, NAMES, "id").collect()
    for r in explained[:40]:
        assert r["contributions"] == pytest.approx(brute_shapley(model, np.array(r["values"])), abs=1e-9)


def test_nulls_absent_features_and_storage(spark, tmp_path):
    x, y = table(200, 5)
    rows = frame(spark, x, y).withColumn("b", F.when(F.col("c") == 0, F.col("b")))
    more = rows.unionByName(rows.limit(5).withColumn("y", F.lit(None).cast("int")))
    names = ["a", "b", "absent"]
    model = train.fit_boosted_trees(more, names, "y", trees=3, depth=2)
    filled = train.fit_boosted_trees(rows.na.fill(0.0, ["b"]).withColumn("absent", F.lit(0)), names, "y", trees=3, depth=2)
    assert list(model.nodes()) == list(filled.nodes())
    train.save_model(spark, model, str(tmp_path / "m"))
    again = train.load_model(spark, str(tmp_path / "m"))
    assert list(again.nodes()) == list(model.nodes()) and again.spec == model.spec
    scores = [r[0] for r in train.score_rows(again, rows.orderBy("day"), names).select("risk_score").collect()]
    values = np.column_stack([x[:, 0], np.where(x[:, 2] == 0, x[:, 1], 0), np.zeros(len(x))])
    assert scores == pytest.approx(sigmoid(model.margins(values)))
    assert sum(again.importance()) == pytest.approx(1) and again.importance()[2] == 0


def test_one_class_and_no_rows(spark):
    x, y = table(50, 6)
    model = train.fit_boosted_trees(frame(spark, x, y * 0), NAMES, "y", trees=2, depth=2)
    assert len(model.trees) == 2 and (model.margins(x) < -5).all()
    none = train.fit_boosted_trees(frame(spark, x, y).limit(0), NAMES, "y", trees=2, depth=2)
    assert len(none.trees) == 2 and none.importance().sum() == 0


def test_search_equals_models_fitted_alone(spark):
    x, y = table(600, 8)
    rows = frame(spark, x, y).withColumnRenamed("day", "inspection_date")
    draws = [d | {"trees": 6, "depth": 2} for d in train.random_draws(3)]
    trials = train.random_search(rows, NAMES, "y", draws=draws, folds=2)
    edges = boost.binned(rows, NAMES, "y").edges
    for trial in trials:
        draw = {k: trial[k] for k in draws[0]}
        found = []
        for a, b in train.expanding_folds(rows, "inspection_date", 2):
            fit, valid = train.fold_parts(rows, "inspection_date", a, b)
            part = boost.binned(fit, NAMES, "y", "inspection_date", edges=edges)
            model = boost.fit_many(part, [boost.Spec(**draw)])[0]
            scored = train.score_rows(model, valid, NAMES)
            found.append(train.evaluate(scored, "y", "risk_score").first()["pr_auc"])
        assert trial["pr_auc"] == pytest.approx(np.mean(found), abs=1e-9)
    assert [t["pr_auc"] for t in trials] == sorted((t["pr_auc"] for t in trials), reverse=True)


def test_partner_of_a_dependence(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 4, (300, 3)).astype(float)
    rows = [(i, [*r], [r[0] * (r[2] - 1), 0.0, 0.5 * r[2]]) for i, r in enumerate(x.tolist())]
    explained = spark.createDataFrame(rows, "id long, values array<double>, contributions array<double>")
    found = explain.dependence(explained, ["p", "q", "r"], ["p"]).collect()
    assert {r["partner"] for r in found} == {"r"} and sum(r["n"] for r in found) == 300
    mean = x[:, 2].mean()
    for r in found:
        mine = (x[:, 0] == r["value"]) & ((x[:, 2] > mean) == bool(r["partner_high"]))
        assert r["n"] == mine.sum()
        assert r["mean_contribution"] == pytest.approx((x[mine, 0] * (x[mine, 2] - 1)).mean())
    strengths = {r["partner"]: r["strength"] for r in explain.interaction_strengths(explained, ["p", "q", "r"], ["p"]).collect()}
    assert strengths["r"] > 3 * strengths["q"]


def test_columns_of_few_bins_are_counted_together():
    widths = [2, 64, 5, 1, 200, 3, 3, 256, 40]
    columns, rng = np.array([0, 1, 2, 3, 4, 6, 7, 8]), np.random.default_rng(5)
    counted = boost.Histogram(columns, widths, 3)
    assert len(counted.packs) == 5 and sorted(sum(counted.packs, [])) == list(range(8))
    wanted = np.zeros((2, 3, 8, 256), np.int64)
    for _ in range(2):
        bins = np.stack([rng.integers(0, w, 500) for w in widths]).astype(np.uint8)
        rows, slot = np.sort(rng.permutation(500)[:300]), rng.integers(0, 3, 300)
        g, h = rng.integers(-(1 << 24), 1 << 24, 300).astype(float), rng.integers(0, 1 << 22, 300).astype(float)
        counted.add(bins, rows, slot, g, h)
        for i, c in enumerate(columns):
            for sums, x in zip(wanted, (g, h)):
                np.add.at(sums, (slot, i, bins[c][rows]), x.astype(np.int64))
    assert (counted.sums(256) == wanted).all()


def test_hashes_are_read_only_where_rows_are_drawn(spark):
    x, y = table(300, 2)
    binned = boost.binned(frame(spark, x, y), NAMES, "y")
    for share, hashed in ((1.0, False), (0.7, True)):
        models = [boost._Growing(boost.Spec(trees=1, depth=1, subsample=share), 0.0)]
        assert ("draw" in boost._read(binned.blocks, models).columns) is hashed


def test_small_tables_are_fitted_without_scans(spark, monkeypatch):
    x, y = table(400, 11)
    specs = [
        boost.Spec(trees=1 + 3 * k, depth=1 + k % 4, seed=k, feature_share=0.7, subsample=0.8 if k % 2 else 1.0, rate=0.6,
                   positive_weight=1.0 + k, min_gain=0.5 * (k % 3), patience=2, fit=(0, 18500 + 10 * k),
                   watch=(18500 + 10 * k, 1 << 30) if k % 3 else None, without=(k,) if k < 2 else ())
        for k in range(10)
    ]
    binned = boost.binned(frame(spark, x, y, 4), NAMES, "y", "day", partition_rows=50)
    monkeypatch.setattr(boost, "_HELD_ROWS", 64)
    scan = boost._grow_level
    monkeypatch.setattr(boost, "_grow_level", lambda *_: pytest.fail("a scan"))
    whole = boost.fit_many(binned, specs)
    monkeypatch.setattr(boost, "_grow_level", scan)
    monkeypatch.setattr(boost, "DIRECT_BYTES", 0)
    monkeypatch.setattr(boost, "RANGE_ROWS", 200)
    for a, b in zip(whole, boost.fit_many(binned, specs)):
        assert list(a.nodes()) == list(b.nodes()) and a.base == b.base
        assert a.history == pytest.approx(b.history, abs=1e-12)


def test_average_precision_of_arrays():
    rng = np.random.default_rng(3)
    for n in (1, 7, 300):
        y, score = rng.integers(0, 2, n), rng.integers(0, 9, n) / 4 - 1
        y[0] = 1
        assert boost.average_precision(y, score) == pytest.approx(average_precision(y, score), abs=1e-12)
    assert boost.average_precision(np.zeros(4, int), np.arange(4.0)) is None
    assert boost.average_precision(np.zeros(0, int), np.zeros(0)) is None


def test_sums_stay_exact_beyond_the_rows_of_a_float(monkeypatch):
    monkeypatch.setattr(boost, "_EXACT_ROWS", 5)
    counted, bins = boost.Histogram(np.array([0, 1]), [3, 300], 1), np.array([[0, 1, 2], [5, 5, 255]], np.uint8)
    for _ in range(4):
        counted.add(bins, np.arange(3), np.zeros(3, int), np.array([3.0, -4.0, 5.0]), np.array([1.0, 2.0, 3.0]))
    sums = counted.sums(300)
    assert sums[0, 0, 0, :3].tolist() == [12, -16, 20] and sums[1, 0, 1, [5, 255]].tolist() == [12, 12]


def test_rounds_are_measured_without_a_sort_of_all_rows(spark, monkeypatch):
    x, y = table(700, 12)
    half = START + timedelta(days=350)
    day = (half - date(1970, 1, 1)).days
    specs = [boost.Spec(trees=13, depth=2 + k, rate=0.7, patience=9, fit=(0, day), watch=(day, 1 << 30)) for k in range(2)]
    specs.append(boost.Spec(trees=2, depth=1, fit=(0, day), watch=(1 << 29, 1 << 30)))  # nothing to watch
    binned = boost.binned(frame(spark, x, y, 4), NAMES, "y", "day", partition_rows=50)
    monkeypatch.setattr(boost, "DIRECT_BYTES", 0)
    monkeypatch.setattr(boost, "_ADVANCE", 3)
    whole = boost.fit_many(binned, specs)
    monkeypatch.setattr(boost, "LOOK_ROWS", 60)
    sizes, limits = [], boost._limits
    monkeypatch.setattr(boost, "_limits", lambda *a: (found := limits(*a), sizes.extend(map(len, found)))[0])
    for a, b in zip(whole, boost.fit_many(binned, specs)):
        assert a.history == b.history and list(a.nodes()) == list(b.nodes())
    assert max(sizes) == 5 and whole[2].history == [None, None]
    for model in whole[:2]:
        margins = np.full(350, model.base)
        for t, tree in enumerate(model.trees):
            margins = margins + tree.value[model.leaves(t, x[350:])]
            assert model.history[t] == pytest.approx(average_precision(y[350:], margins.round(9)), abs=1e-12)


def test_scans_read_only_blocks_of_their_part(spark):
    x, y = table(500, 13)
    rows = frame(spark, x, y, 2).withColumn("part", (F.col("a") > 4).cast("int"))
    binned = boost.binned(rows, NAMES, "y", "day", part="part")
    for part in (0, 1):
        read = boost._read(binned.blocks, [boost._Growing(boost.Spec(part=part), 0.0)])
        n = rows.filter(F.col("part") == part).count()
        assert read.agg(F.sum(F.octet_length("y"))).first()[0] == n and 0 < n < 500
    assert binned.blocks.filter(F.octet_length("part") != 4).count() == 0
