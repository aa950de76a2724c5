"""Classifiers: fitting, search, importances, champion and challenger."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date as Date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.operators import boost
from vetrail.operators.boost import BoostedTrees, Spec
from vetrail.operators.metrics import evaluate
from vetrail.operators.score import with_absent_as_zero
from vetrail.operators.split import expanding_folds, fold_parts
from vetrail.sources import commits

Model = PipelineModel | BoostedTrees

# Boosting defaults and the ranges of the random search.
TREES, DEPTH, RATE, PATIENCE = 300, 6, 0.1, 20
SEARCH_DRAWS, SEARCH_FOLDS = 30, 3
#: Rounds without improvement that end a fit of a search that may stop early.
SEARCH_PATIENCE = 10
SEARCH_RANGES = {
    "trees": (100, 499),
    "depth": (3, 9),
    "rate": (0.01, 0.21),
    "min_weight": (1, 9),
    "subsample": (0.6, 1.0),
    "feature_share": (0.6, 1.0),
    "min_gain": (0.0, 5.0),
    "positive_weight": (10.0, 35.0),
}


@dataclass(frozen=True)
class ClassCounts:
    """Numbers of negative and positive rows (one aggregate job)."""

    neg: int
    pos: int

    @classmethod
    def of(cls, rows: DataFrame, target: str) -> "ClassCounts":
        hit = F.col(target) == 1
        return cls(*rows.agg(F.count_if(~hit), F.count_if(hit)).first())

    @property
    def ratio(self) -> float:
        """Weight that gives the positives the mass of the negatives."""
        return self.neg / max(self.pos, 1)

    def balanced(self) -> tuple[float, float]:
        """Weights n / (2 n_c) of a negative and a positive row."""
        n = self.neg + self.pos
        return n / (2 * max(self.neg, 1)), n / (2 * max(self.pos, 1))


def _weighted(rows: DataFrame, target: str, neg: float, pos: float) -> DataFrame:
    return rows.withColumn("_weight", F.when(F.col(target) == 1, float(pos)).otherwise(float(neg)))


def _prepared(rows: DataFrame, features: Sequence[str], target: str, *more: str) -> DataFrame:
    """Only what fitting reads, absent values 0."""
    columns = [F.col(c).cast("double") for c in features]
    return with_absent_as_zero(rows, features).select(
        *columns, F.col(target).cast("double").alias(target), *more
    )


def fit_logistic(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target_oai",
    balanced: bool = False,
    c: float = 1.0,
    max_iter: int = 1000,
) -> PipelineModel:
    """L2-regularised logistic regression on standardised features.

    Features are scaled with the population deviation, and the penalty 1/(c n) on the mean loss is
    the same as a penalty 1 against c times the summed loss.
    """
    counts = ClassCounts.of(train, target)
    n = counts.neg + counts.pos
    rows = _weighted(
        _prepared(train, features, target), target, *(counts.balanced() if balanced else (1.0, 1.0))
    )
    to_population = (n / max(n - 1, 1)) ** 0.5
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            scalingVec=[to_population] * len(features), inputCol="_sample_scaled", outputCol="_x"
        ),
        LogisticRegression(
            featuresCol="_x", labelCol=target, weightCol="_weight", regParam=1.0 / (c * n),
            elasticNetParam=0.0, standardization=False, maxIter=max_iter,
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target_oai",
    valid: DataFrame | None = None,
    positive_weight: float | None = 1.0,
    **options,
) -> BoostedTrees:
    """Gradient-boosted trees. ``positive_weight=None`` weighs the positives by the class ratio.

    ``options`` are settings of :class:`boost.Spec`. With ``valid`` fitting stops once the average precision on it has
    not improved for ``patience`` rounds (20 by default), and the trees up to the best round are kept.
    """
    return fit_boosted_models(train, features, [{"positive_weight": positive_weight} | options], target, valid)[0]


def fit_boosted_models(
    train: DataFrame,
    features: Sequence[str],
    settings: Sequence[Mapping[str, object]],
    target: str = "target_oai",
    valid: DataFrame | None = None,
) -> list[BoostedTrees]:
    """Several boosted models of the same rows, fitted in the same scans."""
    if any(s.get("positive_weight", 1.0) is None for s in settings):
        ratio = ClassCounts.of(train, target).ratio
        settings = [dict(s) | ({"positive_weight": ratio} if s.get("positive_weight", 1.0) is None else {}) for s in settings]
    rows = _prepared(train, features, target, F.lit(0).alias("_part"))
    watch = {}
    if valid is not None:
        rows = rows.unionByName(_prepared(valid, features, target, F.lit(1).alias("_part")))
        watch = {"watch": Spec().fit, "watch_part": 1}
    defaults = {"trees": TREES, "depth": DEPTH, "rate": RATE, "patience": PATIENCE} | watch
    specs = [Spec(**(defaults | dict(s))) for s in settings]
    edges = boost.bin_edges(rows.filter("_part = 0"), features)
    return boost.fit_many(boost.binned(rows, features, target, part="_part", edges=edges), specs)


def score_rows(
    model: Model, rows: DataFrame, features: Sequence[str], score: str = "risk_score"
) -> DataFrame:
    """Add the probability of the positive class; the other columns stay as they are."""
    if isinstance(model, BoostedTrees):
        values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0) for c in features]
        return rows.select(*rows.columns, (1 / (1 + F.exp(-boost.margin_column(model, values)))).alias(score))
    inputs = {f"_in_{c}": F.col(c) for c in features if c in rows.columns}
    kept = rows.withColumns(inputs) if inputs else rows
    numeric = with_absent_as_zero(kept, features).withColumns(
        {c: F.col(c).cast("double") for c in features}
    )
    # with_absent_as_zero adds missing features; they exist only while the model reads them.
    scored = model.transform(numeric).withColumn(score, vector_to_array("probability")[1])
    return scored.select(
        *[F.col(f"_in_{c}").alias(c) if c in features else F.col(c) for c in rows.columns], score
    )


def scaled(model: PipelineModel, rows: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The columns of a logistic model as it reads them, as ``<feature>_scaled``."""
    prepared = _prepared(rows, features, target)
    for stage in model.stages[:-1]:
        prepared = stage.transform(prepared)
    values = vector_to_array("_x")
    return prepared.select(*[values[i].alias(f"{c}_scaled") for i, c in enumerate(features)])


def random_draws(
    n: int = SEARCH_DRAWS, seed: int = 42, ranges: Mapping[str, tuple] = SEARCH_RANGES
) -> list[dict]:
    """Parameter draws: whole numbers for whole-number ranges, else uniform."""
    rng = random.Random(seed)
    return [
        {
            k: rng.randint(a, b) if isinstance(a, int) else rng.uniform(a, b)
            for k, (a, b) in ranges.items()
        }
        for _ in range(n)
    ]


_EPOCH = Date(1970, 1, 1)


def random_search(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target_oai",
    date: str = "inspection_date",
    draws: Sequence[dict] | None = None,
    folds: int = SEARCH_FOLDS,
    stop_early: bool = False,
    bins: int = boost.BINS,
) -> list[dict]:
    """Mean average precision of each draw over expanding time folds, best first.

    Rows are binned once; the models of all draws and folds grow side by side in the same scans, and are
    measured in one. With ``stop_early`` a fit stops once the average precision on the last fifth of its days
    no longer improves.
    """
    draws = list(draws or random_draws())
    # Every scan works for many models: smaller partitions than for a single one.
    table = boost.binned(train, features, target, date, bins=bins, partition_rows=boost.PARTITION_ROWS // 4)
    first, last = Spec().fit
    specs, spans = [], []
    for a, b in expanding_folds(train, date, folds):
        start, end = (a - _EPOCH).days, (b - _EPOCH).days if b else last
        fit, watch = (first, start), None
        if stop_early:
            early, _ = fold_parts(train, date, a, b)
            cut = (expanding_folds(early, date, 4)[-1][0] - _EPOCH).days
            fit, watch = (first, cut), (cut, start)
        specs += [Spec(**draw, fit=fit, watch=watch, patience=SEARCH_PATIENCE) for draw in draws]
        spans += [(start, end)] * len(draws)
    models = boost.fit_many(table, specs)
    found = evaluate(boost.score_blocks(table, models, spans), "y", "risk_score", by=["model"])
    measured = {r["model"]: r["pr_auc"] for r in found.collect()}
    trials = []
    for i, draw in enumerate(draws):
        known = [x for x in (measured.get(k) for k in range(i, len(models), len(draws))) if x is not None]
        kept = [len(models[k].trees) for k in range(i, len(models), len(draws))]
        trials.append(draw | {"pr_auc": sum(known) / len(known) if known else 0.0, "rounds": sum(kept) / len(kept)})
    return sorted(trials, key=lambda t: -t["pr_auc"])


def fit_best(
    train: DataFrame,
    features: Sequence[str],
    trials: Sequence[dict],
    target: str = "target_oai",
    valid: DataFrame | None = None,
) -> BoostedTrees:
    """Fit the best trial of a search on all training rows: the tuned model of a comparison."""
    best = {k: v for k, v in trials[0].items() if k in SEARCH_RANGES}
    return fit_boosted_trees(train, features, target, valid=valid, **best)


def feature_importances(
    spark: SparkSession, model: BoostedTrees, features: Sequence[str]
) -> DataFrame:
    """Gain importance per feature, highest first (one row per feature)."""
    rows = [(f, float(g)) for f, g in zip(features, model.importance())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def model_metrics(
    named: Mapping[str, tuple[Model, Sequence[str]]], rows: DataFrame, target: str
) -> DataFrame:
    """Metrics of several fitted models on the same rows, one row per model."""
    scored = None
    for name, (model, features) in named.items():
        one = score_rows(model, rows, features).select(
            F.lit(name).alias("model"), F.col(target).cast("int").alias("y"), "risk_score"
        )
        scored = one if scored is None else scored.unionByName(one)
    return evaluate(scored, "y", "risk_score", by=["model"])


def ablation(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    without: Sequence[str],
    target: str = "target_oai",
    valid: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Metrics of boosted trees with all features and without some of them, both fitted in the same scans."""
    left_out = tuple(i for i, f in enumerate(features) if f in set(without))
    settings = [dict(options), options | {"without": left_out}]
    every, fewer = fit_boosted_models(train, features, settings, target, valid)
    named = {"all features": (every, features), "without " + ", ".join(without): (fewer, features)}
    return model_metrics(named, test, target)


# --- persistence and promotion ------------------------------------------------------------------

REGISTRY = (
    "sequence bigint, version string, path string, trained_on date, roc_auc double, pr_auc double, "
    "features array<string>, categories array<string>, codes_path string, promoted boolean"
)


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    """Write a fitted model, replacing what is there."""
    if isinstance(model, BoostedTrees):
        boost.save_boosted(spark, model, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """Read a fitted model back."""
    try:
        return boost.load_boosted(spark, path)
    except Exception as e:  # a linear model has no table of nodes
        if "PATH_NOT_FOUND" in str(e):
            return PipelineModel.load(path)
        raise


def registry_table(spark: SparkSession, registry: str) -> DataFrame | None:
    """All entries of a registry, or None before the first one."""
    return commits.entries(spark, registry, REGISTRY)


def champion(spark: SparkSession, registry: str) -> dict | None:
    """The promoted entry that was registered last, or None (one row)."""
    table = registry_table(spark, registry)
    last = table.filter("promoted").orderBy(F.desc("sequence")).first() if table else None
    return last.asDict() if last else None


def refuse_known(spark: SparkSession, registry: str, version: str) -> None:
    """Raise if a version is registered already: its model must not be replaced."""
    table = registry_table(spark, registry)
    if table and table.filter(F.col("version") == version).limit(1).count():
        raise ValueError(f"version {version} is registered already")


def register_challenger(
    spark: SparkSession,
    registry: str,
    version: str,
    path: str,
    trained_on: Date,
    metrics: Mapping[str, float | None],
    features: Sequence[str],
    categories: Sequence[str] = (),
    codes_path: str | None = None,
) -> bool:
    """Append a challenger; it is promoted if there is no champion or its PR-AUC is higher.

    Entries are numbered in the order of registration. A version is registered once. Unknown
    metrics (measured on one class only) never promote. Of several retrainings that register at once each is compared
    with the champion of all entries before its own (see :mod:`vetrail.sources.commits`).
    """
    roc_auc, pr_auc = (None if metrics[m] is None else float(metrics[m]) for m in ("roc_auc", "pr_auc"))

    def decide(known: list[dict], number: int) -> dict:
        if any(e["version"] == version for e in known):
            raise ValueError(f"version {version} is registered already")
        now = next((e for e in reversed(known) if e["promoted"]), None)
        promoted = roc_auc is not None and pr_auc is not None and (now is None or pr_auc > now["pr_auc"])
        return {
            "sequence": number, "version": version, "path": path, "trained_on": trained_on, "roc_auc": roc_auc, "pr_auc": pr_auc,
            "features": list(features), "categories": list(categories), "codes_path": codes_path, "promoted": promoted,
        }

    return commits.append(spark, registry, REGISTRY, decide)["promoted"]
