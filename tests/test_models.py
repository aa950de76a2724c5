"""Metrics, gates, splits, models and explanations by their own arithmetic."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from vetrail.operators import (
    categories, explain, metrics, monitor, ordered, profile, quality, score, split, train,
)
from vetrail.plans import retrain, scoring
from vetrail.sources import commits


def scored(spark, rows):
    return spark.createDataFrame(rows, "y int, s double")


def test_equal_scores(spark):
    r = metrics.evaluate(scored(spark, [(1, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)]), "y", "s").first()
    assert (r["roc_auc"], r["pr_auc"]) == (0.5, 0.5)


def test_metrics_against_loops(spark):
    """Crowded scores: most rows in a tiny range, so blocks of fixed width would be useless."""
    rng = np.random.default_rng(3)
    s = np.where(rng.random(400) < 0.8, rng.integers(0, 50, 400) * 1e-9, rng.random(400)).round(12)
    y = (rng.random(400) < 0.3).astype(int)
    r = metrics.evaluate(scored(spark, [(int(a), float(b)) for a, b in zip(y, s)]), "y", "s").first()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))
    ap, before = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        flagged = s >= t
        recall = y[flagged].sum() / y.sum()
        ap += (recall - before) * y[flagged].mean()
        before = recall
    assert r["roc_auc"] == pytest.approx(auc) and r["pr_auc"] == pytest.approx(ap)


def test_one_class_only_is_undefined(spark):
    r = metrics.evaluate(scored(spark, [(0, 0.1), (0, 0.7)]), "y", "s").first()
    assert r["roc_auc"] is None and r["f1"] == 0.0


def test_threshold_ties_take_the_smallest(spark):
    rows = scored(spark, [(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6)])
    r = metrics.threshold_at_recall(rows, "y", "s", 0.5).first()
    assert (r["threshold"], r["recall"]) == (0.7, 0.5)


def test_curves_have_their_end_points(spark):
    rows = scored(spark, [(1, 0.9), (0, 0.8)])
    roc = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(rows, "y", "s").collect())
    assert roc == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    pr = metrics.pr_curve(rows, "y", "s").filter("threshold is null").first()
    assert (pr["precision"], pr["recall"]) == (1.0, 0.0)


def test_text_codes(spark):
    words = ["b", "a", "abc", "abcd", "abce", "ab", "Z", "", "é"]
    got = {r["value"]: r["code"] for r in ordered.text_codes(spark.createDataFrame([(w,) for w in words * 2], "v string"), "v").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}


def test_expanding_folds(spark):
    rows = spark.range(400).select(F.expr("date_add(date'2020-01-01', cast(id as int))").alias("d"))
    folds = split.expanding_folds(rows, "d", 3)
    sizes = [tuple(p.count() for p in split.fold_parts(rows, "d", *f)) for f in folds]
    assert [b for _, b in sizes] == pytest.approx([100] * 3, abs=2)
    assert [a for a, _ in sizes] == pytest.approx([100, 200, 300], abs=2)


def test_expanding_folds_of_few_days(spark):
    rows = spark.createDataFrame([(date(2020, 1, 1 + k % 2),) for k in range(10)], "d date")
    with pytest.raises(ValueError, match="different days"):
        split.expanding_folds(rows, "d", 3)
    # One day holds nearly all rows: the folds are still there, and no part is empty.
    crowded = spark.createDataFrame([(date(2020, 1, 1 + min(k, 4)),) for k in range(40)], "d date")
    folds = split.expanding_folds(crowded, "d", 3)
    assert len(folds) == 3
    assert all(p.count() for f in folds for p in split.fold_parts(crowded, "d", *f))


def test_codes_of_unseen_texts(spark):
    old = spark.createDataFrame([("DE", "x"), ("US", None)], "a string, b string")
    new = spark.createDataFrame([("AT", None), ("US", "y"), (None, "x")], "a string, b string")
    codes = split.fit_codes(old, ["a", "b"])
    got = sorted(tuple(r) for r in split.apply_codes(new, codes, ["a", "b"]).select("a_encoded", "b_encoded").collect())
    assert got == [(-1, 0), (-1, 1), (1, -1)]


def test_crosstab_counts_unlisted_values(spark):
    rows = spark.createDataFrame([("g", v) for v in "abcc"] + [("g", None)], "g string, v string")
    r = profile.crosstab_rate(rows, "g", "v", ["a", "b"], "a").first()
    assert (r["a"], r["b"], r["other"], r["rate"]) == (1, 1, 2, 0.25)


def test_repeated_keys_do_not_multiply(spark):
    scores = spark.createDataFrame([(1, 0.2), (1, 0.4), (2, 0.5)], "k int, s double")
    outcomes = spark.createDataFrame([(1, date(2020, 1, 5), 1), (1, date(2020, 1, 9), 0), (2, date(2020, 1, 7), 0)], "k int, d date, y int")
    r = monitor.predicted_vs_actual(scores, outcomes, "k", "d", "s", "y").first()
    assert r["n"] == 3 and r["predicted"] == pytest.approx((0.3 + 0.3 + 0.5) / 3) and r["actual"] == pytest.approx(1 / 3)


def test_gates(spark):
    rows = spark.createDataFrame(
        [(1, date(2020, 1, 1), 0, 0, 0), (1, date(2025, 1, 1), 1, 1, 0)],
        "fei_number int, inspection_date date, target_oai int, n_prior_inspections int, n_prior_oai int",
    ).withColumns({"n_prior_vai": F.lit(0), "n_prior_nai": F.lit(0)})
    got = {r["gate"]: r["passed"] for r in quality.feature_gates(rows, 2025, 1).collect()}
    assert got["rows"] == got["target_not_binary"] == got["history_of_first_rows"] == 1
    assert got["missing_columns"] == 0 and got["target_rate"] == 0
    with pytest.raises(quality.GateFailed, match="target_rate"):
        quality.require(quality.feature_gates(rows, 2025, 1))
    leaky = rows.withColumn("n_prior_vai", F.lit(1))
    bad = {r["gate"]: r["passed"] for r in quality.feature_gates(leaky, 2025, 1).collect()}
    assert bad["history_of_first_rows"] == 0
    floor = spark.createDataFrame([(0.8, 0.1)], "roc_auc double, pr_auc double")
    got = {r["gate"]: r["passed"] for r in quality.model_gates(floor, 12).collect()}
    assert got == {"roc_auc": 1, "pr_auc": 0, "n_features": 1}
    assert quality.row_gate(rows, "letters", 2).first()["passed"] == 0


def test_severity_and_absent_features(spark):
    codes = spark.createDataFrame([("21 CFR 211.113(b)",), ("820.22",), ("211.1135",), ("x",), (None,)], "c string")
    got = {r["c"]: r["severity"] for r in categories.with_severity(codes, "c").collect()}
    assert got == {"21 CFR 211.113(b)": "sterility", "820.22": "quality_system", "211.1135": "other", "x": "other", None: None}
    own = spark.createDataFrame(
        [("211", "drugs"), ("211.113", "sterility"), ("211.113(b)", "validated"), ("820.22", "b"), ("820.22", "a")], "prefix string, category string"
    )
    more = spark.createDataFrame([("21 CFR 211.113(b)(1)",), ("211.113 (a)",), ("211.5",), ("820.22",), ("2110.5",)], "c string")
    got = {r["c"]: r["s"] for r in categories.with_severity(more.union(more), "c", own, "s").collect()}
    assert got == {"21 CFR 211.113(b)(1)": "validated", "211.113 (a)": "sterility", "211.5": "drugs", "820.22": "a", "2110.5": "other"}
    filled = score.with_absent_as_zero(spark.createDataFrame([(None,)], "a int"), ["a", "b"]).first()
    assert (filled["a"], filled["b"]) == (0, 0)


def test_latest_values_take_the_last_known_per_column(spark):
    rows = spark.createDataFrame(
        [(1, date(2020, 1, 1), 0, "DE", 5), (1, date(2021, 1, 1), 1, None, None), (1, None, 2, None, 9)],
        "fei_number int, inspection_date date, n_prior_inspections int, country string, x int",
    )
    r = score.latest_values(rows, ["inspection_date", "country", "x"]).first()
    assert (r["inspection_date"], r["country"], r["x"]) == (date(2021, 1, 1), "DE", 9)


def test_drift_alert(spark):
    base = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "s double")
    runs = spark.createDataFrame([("a", 0.25), ("b", 0.9)], "run string, s double")
    got = {r["run"]: r["alert"] for r in monitor.score_drift(runs, base, "s", "run").collect()}
    assert got == {"a": 0, "b": 1}


NAMES = ["n_prior_inspections", "n_prior_oai", "x", "noise"]


@pytest.fixture(scope="module")
def rows(spark):
    """Two informative columns, one noise column; dates over four years."""
    frame = spark.range(1200).select(
        F.col("id").alias("inspection_id"), (F.col("id") % 200).alias("fei_number"),
        F.expr("date_add(date'2020-01-01', cast(id % 1400 as int))").alias("inspection_date"),
        (F.expr("pmod(hash(id, 1), 10)")).alias("n_prior_inspections"),
        (F.expr("pmod(hash(id, 2), 5)")).alias("n_prior_oai"),
        (F.expr("pmod(hash(id, 3), 100)") / 10).alias("x"),
        (F.expr("pmod(hash(id, 4), 7)")).alias("noise"),
    )
    chance = F.col("n_prior_oai") * 2 + F.col("x") - F.col("n_prior_inspections") / 3
    return frame.withColumn("target_oai", (chance > 9).cast("int"))


@pytest.fixture(scope="module")
def trees(rows):
    return train.fit_boosted_trees(rows, NAMES, positive_weight=None, trees=5, depth=3)


def test_tree_contributions_add_up(spark, rows, trees):
    found = explain.tree_contributions(trees, rows, NAMES, "inspection_id", ("target_oai",))
    base = explain.base_margin(trees)
    total = F.aggregate("contributions", F.lit(base), lambda a, x: a + x)
    off = found.select(
        F.max(F.abs(total - F.col("margin"))),
        F.max(F.abs(1 / (1 + F.exp(-total)) - F.col("risk_score"))),
        F.count("*"),
    ).first()
    assert off[0] < 1e-9 and off[1] < 1e-9 and off[2] == 1200
    drivers = explain.top_drivers(found, NAMES, "inspection_id", 2)
    assert drivers.count() == 2400
    ordered_ok = drivers.groupBy("inspection_id").agg(
        F.max_by(F.abs("contribution"), -F.col("place")).alias("a"),
        F.max(F.abs("contribution")).alias("b"),
    )
    assert ordered_ok.filter("a < b").count() == 0
    importance = {r["feature"]: r["importance"] for r in explain.global_importance(found, NAMES).collect()}
    assert importance["noise"] < min(importance["n_prior_oai"], importance["x"])
    direction = {r["feature"]: r["correlation"] for r in explain.direction_summary(found, NAMES).collect()}
    assert direction["n_prior_oai"] > 0.5
    report = explain.risk_report(found, NAMES, "inspection_id", (), "target_oai", 5, 2)
    assert report.count() == 10 and report.filter("rank = 1").count() == 2
    cases = explain.waterfall(found, NAMES, "target_oai", "inspection_id", base)
    assert {r["case"] for r in cases.collect()} >= {"true_positive"}


def test_contributions_of_repeated_ids_stay_in_their_rows(spark, rows, trees):
    twice = rows.unionByName(rows.withColumn("x", F.col("x") + 3))
    found = explain.tree_contributions(trees, twice, NAMES, "inspection_id")
    total = F.aggregate("contributions", F.lit(explain.base_margin(trees)), lambda a, x: a + x)
    off = found.select(F.max(F.abs(total - F.col("margin"))), F.count("*")).first()
    assert off[0] < 1e-9 and off[1] == 2400
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_single_leaf_trees_keep_their_rows(spark, rows):
    flat = rows.withColumns({c: F.lit(1.0) for c in NAMES})
    model = train.fit_boosted_trees(flat, NAMES, trees=2, depth=2)
    found = explain.tree_contributions(model, flat, NAMES, "inspection_id")
    assert found.count() == 1200
    assert found.filter(F.exists("contributions", lambda x: x != 0)).count() == 0


def test_linear_model(spark, rows):
    model = train.fit_logistic(rows, NAMES)
    found = explain.linear_contributions(model, rows, NAMES, "inspection_id")
    total = F.aggregate("contributions", F.lit(float(model.stages[-1].intercept)), lambda a, x: a + x)
    assert found.select(F.max(F.abs(total - F.col("margin")))).first()[0] < 1e-9
    # Population scaling: every scaled feature has variance 1 with divisor n.
    z = model.transform(train._prepared(rows, NAMES, "target_oai")).select(vector_to_array("_x").alias("z"))
    spread = z.select(*[F.stddev_pop(F.col("z")[i]) for i in range(len(NAMES))]).first()
    assert list(spread) == pytest.approx([1.0] * len(NAMES))
    # At the optimum, the gradient of c * summed loss plus half the squared weights vanishes.
    pdf = model.transform(train._prepared(rows, NAMES, "target_oai")).select(
        vector_to_array("_x").alias("z"), vector_to_array("probability")[1].alias("p"), "target_oai"
    ).toPandas()
    x = np.array(pdf["z"].tolist())
    gradient = x.T @ (pdf["p"] - pdf["target_oai"]).to_numpy() + model.stages[-1].coefficients.toArray()
    assert np.abs(gradient).max() < 0.05


def test_scoring_keeps_columns_and_sums_to_one(spark, rows, trees):
    out = train.score_rows(trees, rows.drop("noise"), NAMES)
    assert out.columns == [*[c for c in rows.columns if c != "noise"], "risk_score"]
    assert out.schema["n_prior_oai"].dataType == rows.schema["n_prior_oai"].dataType
    both = train.score_rows(trees, rows, NAMES).select(F.col("risk_score").alias("b"), (1 - F.col("risk_score")).alias("a"))
    assert quality.score_gates(both, "a", "b").filter("passed = 0").count() == 0


def test_search_is_repeatable_and_sorted(spark, rows):
    ranges = train.SEARCH_RANGES | {"trees": (2, 3), "depth": (2, 3)}
    draws = train.random_draws(2, ranges=ranges)
    assert draws == train.random_draws(2, ranges=ranges)
    trials = train.random_search(rows, NAMES, draws=draws, folds=2)
    assert len(trials) == 2 and trials[0]["pr_auc"] >= trials[1]["pr_auc"]
    assert len(train.random_draws()) == 30 and set(train.random_draws()[0]) == set(train.SEARCH_RANGES)


def test_champion_is_replaced_only_by_a_better_one(spark, rows, tmp_path):
    registry = str(tmp_path / "registry")
    metric = {"roc_auc": 0.8, "pr_auc": 0.4}
    args = (date(2024, 1, 1), metric, NAMES, ["c"], "codes")
    assert train.champion(spark, registry) is None
    assert train.register_challenger(spark, registry, "v1", "p1", *args)
    assert not train.register_challenger(spark, registry, "v2", "p2", *args)  # not better
    better = (date(2024, 2, 1), metric | {"pr_auc": 0.5}, NAMES)
    assert train.register_challenger(spark, registry, "v3", "p3", *better)
    assert train.champion(spark, registry)["version"] == "v3"
    # On one date the order of registration counts, not the text of the version.
    for version, value in (("v9", 0.6), ("v10", 0.7)):
        assert train.register_challenger(spark, registry, version, "p", date(2024, 2, 1), metric | {"pr_auc": value}, NAMES)
    assert train.champion(spark, registry)["version"] == "v10"
    assert not train.register_challenger(spark, registry, "v11", "p", date(2024, 2, 1), metric | {"pr_auc": 0.65}, NAMES)
    with pytest.raises(ValueError, match="v9"):
        train.register_challenger(spark, registry, "v9", "p", date(2024, 3, 1), metric, NAMES)
    unknown = {"roc_auc": None, "pr_auc": None}
    assert not train.register_challenger(spark, registry, "v12", "p", date(2024, 3, 1), unknown, NAMES)
    assert train.champion(spark, registry)["version"] == "v10"


def test_retrain_stores_codes_and_scores_from_the_registry(spark, rows, tmp_path):
    coded = rows.withColumns({"country": F.when(F.col("x") > 5, "DE").otherwise("US"), "product_type": F.lit("p")})
    options = {"categories": ["country"], "trees": 3, "depth": 2}
    assert retrain.retrain(coded, NAMES, str(tmp_path), "v1", date(2024, 1, 1), **options)
    with pytest.raises(ValueError, match="v1"):
        retrain.retrain(coded, NAMES, str(tmp_path), "v1", date(2024, 2, 1), **options)
    with pytest.raises(quality.GateFailed, match="n_features"):
        retrain.retrain(coded, NAMES, str(tmp_path), "v2", date(2024, 2, 1), floor={"roc_auc": 0.1}, **options)
    assert train.registry_table(spark, f"{tmp_path}/registry").count() == 1
    # A country that was not fitted sorts before the others; theirs keep their codes.
    more = coded.withColumn("country", F.when(F.col("fei_number") < 20, "AT").otherwise(F.col("country")))
    out = scoring.score_champion(more, str(tmp_path), audit={"threshold": 0.5})
    assert out.count() == 200
    assert {"model_version", "trained_on", "n_features", "threshold"} <= set(out.columns)
    codes = spark.read.parquet(f"{tmp_path}/v1-codes").collect()
    assert {(r["column"], r["text"]): r["code"] for r in codes} == {("country", "DE"): 0, ("country", "US"): 1}
    with pytest.raises(ValueError, match="no champion"):
        scoring.score_champion(more, str(tmp_path / "none"))


def test_one_class_in_the_newest_year_never_promotes(spark, rows, tmp_path):
    newest = F.year("inspection_date") == 2023
    flat = rows.withColumn("target_oai", F.when(newest, 0).otherwise(F.col("target_oai")))
    assert not retrain.retrain(flat, NAMES, str(tmp_path), "v1", date(2024, 1, 1), trees=2, depth=2)


def test_default_draws_split_and_refit(spark, rows):
    trials = train.random_search(rows, NAMES, draws=[d | {"trees": 2} for d in train.random_draws(3)], folds=2, stop_early=True)
    best = train.fit_best(rows, NAMES, trials)
    assert all(t.feature[0] >= 0 for t in best.trees)


def test_retrain_writes_a_loadable_model(spark, rows, tmp_path):
    assert retrain.retrain(rows, NAMES, str(tmp_path), "v1", date(2024, 1, 1), trees=3, depth=2, stop_early=True)
    entry = train.champion(spark, f"{tmp_path}/registry")
    again = train.load_model(spark, entry["path"])
    assert entry["features"] == NAMES and entry["roc_auc"] > 0.7
    assert train.score_rows(again, rows, NAMES).count() == 1200
    wide = rows.withColumns({c: F.lit("x") for c in ("product_type", "country")})
    out = scoring.score_facilities(again, wide, NAMES, audit={"model_version": "v1"})
    assert out.count() == 200 and "model_version" in out.columns


def test_profiles_handle_nulls(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "g string, v int")
    assert [tuple(r) for r in profile.value_counts(rows, "g").collect()] == [("a", 2)]
    r = profile.rate_by_group(rows, "g", F.col("v") == 1).first()
    assert (r["g"], r["n"], r["rate"]) == ("a", 2, 0.5)
    assert profile.distinct_values(rows, "g").first()[0] == 1
    assert profile.distinct_values(rows, "g", approximate=True).first()[0] == 1


def test_registrations_at_once_leave_one_champion(spark, tmp_path):
    """Each of eight writers gets a number of its own, and each promotion is right for the entries before it."""
    registry = str(tmp_path / "registry")
    values = [0.3, 0.5, 0.4, 0.9, 0.2, 0.8, 0.7, 0.6]

    def one(k):
        return train.register_challenger(spark, registry, f"v{k}", "p", date(2024, 1, 1), {"roc_auc": 0.7, "pr_auc": values[k]}, NAMES)

    with ThreadPoolExecutor(8) as pool:
        promoted = list(pool.map(one, range(8)))
    entries = sorted(train.registry_table(spark, registry).collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in entries] == list(range(1, 9))
    best = 0.0
    for r in entries:
        assert r["promoted"] == (r["pr_auc"] > best) == promoted[int(r["version"][1:])]
        best = max(best, r["pr_auc"])
    assert train.champion(spark, registry)["version"] == "v3"
    assert not [f for f in (tmp_path / "registry").iterdir() if f.name.endswith(".tmp")]
    assert not commits.create_if_absent(spark, registry, "000000000003.json", "{}")


def test_drift_of_distributions(spark):
    rng = np.random.default_rng(2)
    base, same, wide = rng.normal(size=4000), rng.normal(size=3000), rng.normal(scale=2.0, size=3000)
    runs = [("same", float(x)) for x in same] + [("wide", float(x)) for x in wide] + [("same", None)]
    scores = spark.createDataFrame(runs, "run string, s double").repartition(5)
    baseline = spark.createDataFrame([("b", float(x)) for x in base], "run string, s double")
    edges = np.quantile(base, np.arange(1, 10) / 10)
    exact = {r["run"]: r for r in monitor.distribution_drift(scores, baseline, "s", "run", edges.tolist()).collect()}
    for run, x in (("same", same), ("wide", wide)):
        p = np.diff([0, *[(x <= e).mean() for e in edges], 1])
        q = np.diff([0, *[(base <= e).mean() for e in edges], 1])
        assert exact[run]["n"] == 3000 and exact[run]["psi"] == pytest.approx(((p - q) * np.log(p / q)).sum())
        assert exact[run]["ks"] == pytest.approx(np.abs(np.cumsum(p - q)).max())
    assert (exact["same"]["alert"], exact["wide"]["alert"]) == (0, 1)
    # Means are alike: only the distribution tells the runs apart.
    assert {r["alert"] for r in monitor.score_drift(scores, baseline, "s", "run").collect()} == {0}
    halves = monitor.score_sketches(baseline.withColumn("run", F.pmod(F.hash("s"), F.lit(6))), "s", "run")
    merged = monitor.merged_sketches(halves)
    assert merged.first()["n"] == 4000
    rough = {r["run"]: r for r in monitor.sketch_drift(monitor.score_sketches(scores, "s", "run"), merged, "run").collect()}
    for run in ("same", "wide"):
        assert rough[run]["n"] == 3000 and rough[run]["ks"] == pytest.approx(exact[run]["ks"], abs=0.02)
        assert rough[run]["psi"] == pytest.approx(exact[run]["psi"], abs=0.05)
    with pytest.raises(ValueError, match="no scores"):
        monitor.sketch_drift(halves, merged.limit(0), "run")


def test_sketched_years(spark):
    rows = spark.range(6000).select(
        F.expr("date_add(date'2019-01-01', cast(id % 1400 as int))").alias("day"), F.col("id").alias("code"),
        F.expr("cast(sqrt(id % 400) as int)").alias("kind"),
    )
    kinds, codes = (profile.yearly_sketches(rows, "day", c) for c in ("kind", "code"))
    chosen = rows.filter(F.year("day").between(2020, 2021))
    want = chosen.groupBy("kind").count().orderBy(F.desc("count"), "kind").limit(3).collect()
    found = profile.counts_of_years(kinds, 2020, 2021, 3).collect()
    assert [(r["item"], r["count"]) for r in found] == [tuple(r) for r in want]
    assert {r["n"] for r in found} == {chosen.count()} and {r["n_distinct"] for r in found} == {20}
    exact = profile.distinct_values(chosen, "code").first()[0]
    assert profile.counts_of_years(codes, 2020, 2021, 1).first()["n_distinct"] == pytest.approx(exact, rel=0.03)


def test_subjects_of_letters(spark):
    table = {
        "CGMP/Finished Pharmaceuticals/Adulterated": {"wl_cgmp", "wl_adulterated"},
        "Unapproved New Drugs/Misbranded": {"wl_unapproved_drug", "wl_misbranded"},
        "Current  Good Manufacturing\nPractice (CGMP)": {"wl_cgmp"},
        "CGMP/QSR/Medical Devices/Adulterated": {"wl_cgmp", "wl_medical_device", "wl_adulterated"},
        "Foreign Supplier Verification Program (FSVP)": {"wl_fsvp"},
        "Compounding Pharmacy/Adulterated Drug Products": {"wl_compounding", "wl_adulterated"},
        "Seafood HACCP/CGMP for Foods": {"wl_cgmp"}, "Tobacco; unadulterated": set(), None: set(),
    }
    rows = spark.createDataFrame([(1, date(2020, 1, 1), s) for s in table], "e int, d date, subject string")
    flags = categories.letter_subjects(rows, "e", "d").measures
    found = {r["subject"]: {n for n in flags if r[n]} for r in rows.select("subject", *[c.alias(n) for n, c in flags.items()]).collect()}
    assert found == table
    own = categories.letter_subjects(rows, "e", "d", phrases={"food": ["seafood", "tobacco"], "none": []}).measures
    assert [tuple(r) for r in rows.select(F.sum(own["food"]), F.sum(own["none"])).collect()] == [(2, 0)]
