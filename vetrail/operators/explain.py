"""Additive contributions of features to each row's score, and reports made of them.

Contributions of a row stay together in one array next to it, so per-row rankings need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrail.functions.scores import driver_text, percent_text
from vetrail.operators.boost import BoostedTrees
from vetrail.operators.profile import ranked
from vetrail.operators.score import with_absent_as_zero
from vetrail.operators.shapley import shapley_values
from vetrail.session import with_package


def _inputs(rows: DataFrame, key: str, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    present = with_absent_as_zero(rows, features)
    return present.select(
        key, *keep, *[F.col(c).cast("double").alias(c) for c in features if c not in keep],
        values.alias("_values"),
    )


def base_margin(model: BoostedTrees) -> float:
    """Margin of a row of which nothing is known."""
    return model.expected


def tree_contributions(
    model: BoostedTrees, rows: DataFrame, features: Sequence[str], key: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Exact Shapley values of boosted trees in margin space: ``contributions`` sum to margin - base.

    Adds ``margin``, ``risk_score`` and the arrays ``contributions`` and ``values`` in feature order. Rows are
    explained where they are, in Arrow batches: none is multiplied or shuffled, and ``key`` may repeat. The model goes
    to the tasks; patterns of its leaves are worked out tree by tree, so memory does not grow with the trees.
    """
    with_package(rows.sparkSession)
    inputs = _inputs(rows, key, features, keep).select(key, *keep, "_values")
    numbers = T.ArrayType(T.DoubleType())
    added = [("margin", T.DoubleType()), ("risk_score", T.DoubleType()), ("values", numbers), ("contributions", numbers)]
    schema = T.StructType([*inputs.schema.fields[:-1], *[T.StructField(n, k) for n, k in added]])
    n = len(features)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.columns[-1].flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            margin = model.margins(x)
            offsets = pa.array(np.arange(0, len(x) * n + 1, n, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(m.ravel())) for m in (x, shapley_values(model, x))]
            columns = [*batch.columns[:-1], pa.array(margin), pa.array(1 / (1 + np.exp(-margin))), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return inputs.mapInArrow(explain, schema)


def linear_contributions(
    model: PipelineModel, rows: DataFrame, features: Sequence[str], key: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Contributions of a linear model on standardised features: weight times scaled value.

    Scaling centres on the training mean, so the sum is the margin less the intercept.
    """
    final = model.stages[-1]
    prepared = _inputs(rows, key, features, keep)
    for stage in model.stages:
        prepared = stage.transform(prepared)
    weights = F.array(*[F.lit(float(w)) for w in final.coefficients])
    return prepared.select(
        key,
        *keep,
        vector_to_array("rawPrediction")[1].alias("margin"),
        vector_to_array("probability")[1].alias("risk_score"),
        F.col("_values").alias("values"),
        F.zip_with(vector_to_array("_x"), weights, lambda x, w: x * w).alias("contributions"),
    )


def rule_contributions(
    rows: DataFrame,
    weights: Mapping[str, float],
    base: float,
    key: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Contributions of a given linear rule: weight times the distance from the column's mean."""
    features = list(weights)
    prepared = _inputs(rows, key, features, keep)
    means = prepared.agg(F.array(*[F.avg(c) for c in features]).alias("means")).scalar()
    given = F.array(*[F.lit(float(weights[c])) for c in features])
    apart = F.zip_with("_values", "_means", lambda x, m: x - m)
    parts = prepared.withColumn("_means", means).withColumn(
        "contributions", F.zip_with(apart, given, lambda x, w: x * w)
    )
    margin = F.aggregate("contributions", F.lit(float(base)), lambda total, x: total + x)
    return parts.select(
        key, *keep, margin.alias("margin"), F.col("_values").alias("values"), "contributions"
    ).withColumn("risk_score", 1 / (1 + F.exp(-F.col("margin"))))


def _long(explained: DataFrame, features: Sequence[str], *keep: str | Column) -> DataFrame:
    names = F.array(*[F.lit(f) for f in features])
    return explained.select(
        *keep,
        F.inline(
            F.arrays_zip(
                names.alias("feature"), F.col("values").alias("value"),
                F.col("contributions").alias("contribution"),
            )
        ),
    )


def global_importance(explained: DataFrame, features: Sequence[str], top: int = 20) -> DataFrame:
    """Mean absolute contribution per feature, highest first."""
    long = _long(explained, features)
    means = long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    return means.orderBy(F.desc("importance"), "feature").limit(top)


def direction_summary(explained: DataFrame, features: Sequence[str]) -> DataFrame:
    """How contribution moves with the feature's value: correlation and signed mean."""
    long = _long(explained, features)
    return long.groupBy("feature").agg(
        F.try_divide(
            F.covar_pop("value", "contribution"),
            F.stddev_pop("value") * F.stddev_pop("contribution"),
        ).alias("correlation"),  # null for a constant
        F.avg("contribution").alias("mean_contribution"),
        F.min("contribution").alias("lowest"),
        F.max("contribution").alias("highest"),
    )


def interaction_strengths(
    explained: DataFrame, features: Sequence[str], chosen: Sequence[str], width: float = 1.0
) -> DataFrame:
    """(feature, partner, strength): how the contribution of a chosen feature moves with each other one.

    Inside bins of the chosen feature's value its contribution is correlated with the other features' values; the
    strength is the mean absolute correlation, weighed by the rows of the bins. One aggregate for all pairs.
    """
    long = _long(explained, features, F.col("values").alias("_all")).filter(F.col("feature").isin(list(chosen)))
    spread = F.stddev_pop("contribution")
    bins = long.groupBy("feature", F.floor(F.col("value") / width).alias("_bin")).agg(
        F.count("*").alias("_n"),
        *[
            F.try_divide(F.covar_pop("contribution", F.col("_all")[j]), spread * F.stddev_pop(F.col("_all")[j])).alias(f"_r{j}")
            for j in range(len(features))
        ],
    )
    pairs = F.array(*[F.struct(F.lit(f).alias("partner"), F.col(f"_r{j}").alias("r")) for j, f in enumerate(features)])
    each = bins.select("feature", "_n", F.inline(pairs)).filter(F.col("feature") != F.col("partner"))
    return each.groupBy("feature", "partner").agg(
        (F.sum(F.col("_n") * F.abs(F.coalesce("r", F.lit(0.0)))) / F.sum("_n")).alias("strength")
    )


def dependence(
    explained: DataFrame, features: Sequence[str], chosen: Sequence[str], width: float = 1.0
) -> DataFrame:
    """Mean contribution by value, in bins of a width, for chosen features, told apart by their strongest partner.

    The partner is the feature with the largest interaction strength (rounded to six places; ties: the first name).
    ``partner_high`` is 1 where its value is above its mean over all rows.
    """
    strengths = interaction_strengths(explained, features, chosen, width)
    # One row per chosen feature.
    partners = strengths.groupBy("feature").agg(
        F.min_by("partner", F.struct((-F.round("strength", 6)).alias("s"), F.col("partner").alias("p"))).alias("partner")
    )
    names = F.array(*[F.lit(f) for f in features])
    long = _long(explained, features, F.col("values").alias("_all")).filter(F.col("feature").isin(list(chosen)))
    paired = long.join(F.broadcast(partners), "feature")
    means = explained.agg(F.array(*[F.avg(F.col("values")[j]) for j in range(len(features))]).alias("means")).scalar()
    place = (F.array_position(names, F.col("partner")) - 1).cast("int")
    value = (F.floor(F.col("value") / width) * width).cast("double").alias("value")
    beside = (F.get("_all", place) > F.get("_means", place)).cast("bigint").alias("partner_high")
    return paired.withColumn("_means", means).groupBy("feature", value, "partner", beside).agg(
        F.count("*").alias("n"), F.avg("contribution").alias("mean_contribution")
    )


def _by_impact(features: Sequence[str], k: int) -> Column:
    """The k features with the largest absolute contribution, as an array of structs."""
    names = F.array(*[F.lit(f) for f in features])
    joined = F.arrays_zip(
        names.alias("feature"), F.col("values").alias("value"),
        F.col("contributions").alias("contribution"),
    )
    order = F.transform(
        joined, lambda x: F.struct((-F.abs(x["contribution"])).alias("size"), x["feature"].alias("f"), x.alias("d"))
    )
    return F.transform(F.slice(F.array_sort(order), 1, k), lambda x: x["d"])


def top_drivers(
    explained: DataFrame, features: Sequence[str], key: str, k: int = 8, keep: Sequence[str] = ()
) -> DataFrame:
    """Per row, the ``k`` features with the largest absolute contribution and their text."""
    found = explained.select(key, *keep, F.posexplode(_by_impact(features, k)).alias("place", "d"))
    return found.select(
        key, *keep, (F.col("place") + 1).alias("place"), "d.*",
        driver_text(F.col("d.feature"), F.col("d.value"), F.col("d.contribution")).alias("driver"),
    )


def first_case(scored: DataFrame, target: str, score: str, key: str, kind: str) -> DataFrame:
    """The first true positive (score above .5) or false negative (below .2), by row id."""
    sure = {"true_positive": F.col(score) > 0.5, "false_negative": F.col(score) < 0.2}[kind]
    return scored.filter((F.col(target) == 1) & sure).orderBy(key).limit(1)


def waterfall(
    explained: DataFrame, features: Sequence[str], target: str, key: str, base: float
) -> DataFrame:
    """All contributions of the first true positive and the first false negative, largest first."""
    cases = None
    for kind in ("true_positive", "false_negative"):
        one = first_case(explained, target, "risk_score", key, kind).withColumn("case", F.lit(kind))
        cases = one if cases is None else cases.unionByName(one)
    return top_drivers(
        cases, features, key, len(features), ("case", "risk_score", "margin")
    ).withColumn("base", F.lit(base))


def risk_report(
    explained: DataFrame, features: Sequence[str], key: str, keep: Sequence[str], target: str,
    k: int = 5, drivers: int = 5,
) -> DataFrame:
    """The riskiest rows with rank, score text, outcome and their strongest drivers."""
    head = ranked(explained, F.desc("risk_score"), F.col(key), k=k)
    shown = head.withColumns(
        {
            "score_text": percent_text(F.col("risk_score")),
            "actual": F.when(F.col(target) == 1, "OAI").otherwise("Non-OAI"),
        }
    )
    return top_drivers(
        shown, features, key, drivers, ("rank", "score_text", "actual", "risk_score", *keep)
    )
