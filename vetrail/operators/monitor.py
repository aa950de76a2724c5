"""Watching scores after deployment: drift against a baseline, predicted against actual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Population stability beyond which a distribution counts as shifted, and the least share of a bin.
PSI_ALERT, LEAST_SHARE = 0.2, 1e-4
#: Size of a score sketch: ranks are off by about 0.4 %.
SKETCH_SIZE = 800


def score_drift(
    scores: DataFrame, baseline: DataFrame, score: str, run: str, sigmas: float = 2.0
) -> DataFrame:
    """Mean score per run, and whether it lies beyond so many deviations of the baseline."""
    base = baseline.agg(
        F.struct(F.avg(score).alias("mean"), F.stddev_samp(score).alias("sd")).alias("b")
    ).scalar()
    per_run = scores.groupBy(run).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"))
    off = F.abs(F.col("mean_score") - base["mean"])
    return per_run.withColumns(
        {
            "baseline_mean": base["mean"],
            "deviations": F.try_divide(off, base["sd"]),
            "alert": (off > sigmas * base["sd"]).cast("int"),
        }
    )


def _distances(own: Column, base: Column) -> dict[str, Column]:
    """Population stability index and Kolmogorov distance of two arrays of cumulative shares that end in 1."""

    def shares(ranks: Column) -> Column:
        return F.transform(ranks, lambda x, i: F.greatest(F.lit(LEAST_SHARE), x - F.when(i > 0, F.get(ranks, i - 1)).otherwise(0.0)))

    total = F.aggregate(
        F.zip_with(shares(own), shares(base), lambda p, q: (p - q) * F.log(p / q)), F.lit(0.0), lambda a, x: a + x
    )
    apart = F.array_max(F.zip_with(own, base, lambda p, q: F.abs(p - q)))
    return {"psi": total, "ks": apart, "alert": (total > PSI_ALERT).cast("int")}


def distribution_drift(
    scores: DataFrame, baseline: DataFrame, score: str, run: str, edges: Sequence[float]
) -> DataFrame:
    """Per run the shift of its distribution against the baseline, over bins below, between and above ascending edges.

    ``psi`` is the population stability index (empty bins count as a share of ``LEAST_SHARE``), ``ks`` the largest distance of
    the cumulative shares at the edges; ``alert`` tells a ``psi`` above ``PSI_ALERT``. Exact; null scores are left out.
    """

    def ranks(rows: DataFrame) -> Column:
        return F.array(*[F.avg((F.col(score) <= e).cast("double")) for e in edges], F.lit(1.0))

    base = baseline.agg(ranks(baseline).alias("ranks")).scalar()
    per_run = scores.groupBy(run).agg(F.count(score).alias("n"), ranks(scores).alias("_own"))
    per_run = per_run.withColumn("_base", base)
    return per_run.withColumns(_distances(F.col("_own"), F.col("_base"))).drop("_own", "_base")


def score_sketches(scores: DataFrame, score: str, run: str) -> DataFrame:
    """(run, n, sketch): the distribution of each run's scores in a few kilobytes, to be stored beside them."""
    known = scores.filter(F.col(score).isNotNull())
    return known.groupBy(run).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(score).cast("double"), SKETCH_SIZE).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Sketches of runs put together, all or by groups of runs: no score is read again."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_drift(sketches: DataFrame, baseline: DataFrame, run: str, bins: int = 10) -> DataFrame:
    """``distribution_drift`` from stored sketches, over bins of equal share of the baseline (one row with its sketch)."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    # As many numbers as there are bins.
    found = baseline.select(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", shares)).alias("edges")).first()
    if found is None or not found["edges"]:
        raise ValueError("the baseline holds no scores")
    edges = F.array(*[F.lit(float(e)) for e in found["edges"]])
    ranks = F.concat(F.kll_sketch_get_rank_double("sketch", edges), F.array(F.lit(1.0)))
    own = sketches.withColumns({"_own": ranks, "_base": baseline.select(ranks.alias("r")).scalar()})
    return own.withColumns(_distances(F.col("_own"), F.col("_base"))).select(run, "n", "psi", "ks", "alert")


def predicted_vs_actual(
    scores: DataFrame, outcomes: DataFrame, key: str, date: str, score: str, target: str
) -> DataFrame:
    """Mean predicted score and actual rate per month, for outcomes that have a score.

    Outcomes whose key repeats are rows of their own; a key scored several times has its mean score.
    """
    one = scores.groupBy(key).agg(F.avg(score).alias(score))
    known = one.join(outcomes.select(key, date, target), key)
    return (
        known.groupBy(F.date_trunc("month", date).cast("date").alias("month"))
        .agg(
            F.count("*").alias("n"),
            F.avg(score).alias("predicted"),
            F.avg(F.col(target).cast("double")).alias("actual"),
        )
        .withColumn("gap", F.col("predicted") - F.col("actual"))
    )
