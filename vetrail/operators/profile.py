"""Descriptive profiles: counts, shares, cross tables, rates, repeat offenders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(rows: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; null is not counted. ``top`` keeps the head only."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ordered = counts.orderBy(F.desc("n"), column)
    return ordered if top is None else ordered.limit(top)


def value_shares(rows: DataFrame, column: str) -> DataFrame:
    """Share of each value among the rows that have one."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    # The total of the counts, not of the rows: the exchange is used again.
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def crosstab(
    rows: DataFrame, group: str, column: str, values: Sequence[str], other: str = "other"
) -> DataFrame:
    """Rows per group and value, one column per value, 0 where there are none.

    Values that are not listed are counted in the column ``other``.
    """
    present = rows.filter(F.col(group).isNotNull() & F.col(column).isNotNull())
    return present.groupBy(group).agg(
        *[F.count_if(F.col(column) == v).alias(v) for v in values],
        F.count_if(~F.col(column).isin(list(values))).alias(other),
    )


def crosstab_rate(
    rows: DataFrame,
    group: str,
    column: str,
    values: Sequence[str],
    rated: str,
    other: str = "other",
) -> DataFrame:
    """Cross table with the rated value's part of all rows of the group, highest first."""
    total = sum((F.col(v) for v in values), F.col(other))
    table = crosstab(rows, group, column, values, other)
    return table.withColumn(
        "rate", F.coalesce(F.try_divide(F.col(rated), total), F.lit(0.0))
    ).orderBy(F.desc("rate"), group)


def rate_by_group(rows: DataFrame, group: str, hit: Column) -> DataFrame:
    """Share of rows that meet a condition, per group (an unknown condition counts as not met)."""
    met = F.coalesce(hit, F.lit(False)).cast("double")
    return (
        rows.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count("*").alias("n"), F.avg(met).alias("rate"))
    )


def mean_of_rates(rows: DataFrame, group: str, hit: Column) -> DataFrame:
    """Unweighted mean of the per-group rates."""
    return rate_by_group(rows, group, hit).agg(F.avg("rate").alias("mean_rate"))


def top_groups_rate(rows: DataFrame, group: str, hit: Column, k: int = 15) -> DataFrame:
    """Rates of the ``k`` largest groups, highest rate first. One aggregation serves both."""
    largest = rate_by_group(rows, group, hit).orderBy(F.desc("n"), group).limit(k)
    return largest.orderBy(F.desc("rate"), group)


def detail_by_class(rows: DataFrame, outcome: str, count: str = "n_citations") -> DataFrame:
    """Mean detail count, and share of events with any detail, per outcome."""
    return (
        rows.filter(F.col(outcome).isNotNull())
        .groupBy(outcome)
        .agg(
            F.avg(count).alias("mean_details"),
            F.avg((F.col(count) > 0).cast("double")).alias("share_with_detail"),
        )
    )


def repeat_offenders(
    rows: DataFrame,
    entity: str,
    outcome: str,
    bad: str,
    date: str,
    firsts: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    """Per entity: number and last date of bad events, and first known value of some columns.

    ``firsts`` maps output names to columns; "first" follows the ``order`` columns and skips nulls
    column by column.
    """
    place = F.struct(*order)
    hits = rows.filter((F.col(outcome) == bad) & F.col(entity).isNotNull())
    known = [
        F.min(F.when(F.col(c).isNotNull(), F.struct(place.alias("at"), F.col(c).alias("v"))))["v"]
        .alias(name)
        for name, c in firsts.items()
    ]
    return (
        hits.groupBy(entity)
        .agg(F.count("*").alias("n_oai"), F.max(date).alias("last_oai"), *known)
        .orderBy(F.desc("n_oai"), entity)
    )


def offenders_over(offenders: DataFrame, least: int = 3) -> DataFrame:
    """Number of entities, and how many of them reach a number of bad events."""
    return offenders.agg(
        F.count("*").alias("n_entities"), F.count_if(F.col("n_oai") >= least).alias("n_repeat")
    )


def count_of_counts(offenders: DataFrame, count: str = "n_oai") -> DataFrame:
    """How many entities have each count, by count."""
    return offenders.groupBy(count).agg(F.count("*").alias("n_entities")).orderBy(count)


def distinct_values(rows: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of distinct values; exact unless an approximation is asked for."""
    if approximate:
        return rows.agg(F.approx_count_distinct(column).alias("n_distinct"))
    return rows.filter(F.col(column).isNotNull()).select(column).distinct().agg(
        F.count("*").alias("n_distinct")
    )


def yearly_sketches(rows: DataFrame, date: str, column: str, items: int = 1000) -> DataFrame:
    """(year, n, distinct, frequent): what is needed to count distinct and frequent values of any range of years."""
    known = rows.filter(F.col(date).isNotNull() & F.col(column).isNotNull()).select(
        F.year(date).alias("year"), F.col(column).alias("_value")
    )
    return known.groupBy("year").agg(
        F.count("*").alias("n"), F.hll_sketch_agg("_value", 14).alias("distinct"),
        F.expr(f"approx_top_k_accumulate(_value, {int(items)})").alias("frequent"),
    )


def counts_of_years(sketches: DataFrame, first: int, last: int, k: int = 10) -> DataFrame:
    """(n, n_distinct, item, count) of the k most frequent values of some years, from stored sketches alone.

    Distinct counts are off by about 1 %; counts of values are exact while the years hold no more values than
    three quarters of the sketches' items, and never below the truth.
    """
    chosen = sketches.filter(F.col("year").between(first, last))
    merged = chosen.agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.expr("approx_top_k_estimate(approx_top_k_combine(frequent), 500)").alias("found"),
    )
    every = merged.select("n", "n_distinct", F.inline_outer("found"))
    return every.orderBy(F.desc("count"), "item").limit(k)


def yearly_counts(rows: DataFrame, date: str) -> DataFrame:
    """Rows per calendar year."""
    return (
        rows.filter(F.col(date).isNotNull())
        .groupBy(F.year(date).alias("year"))
        .agg(F.count("*").alias("n"))
        .orderBy("year")
    )


def target_profile(rows: DataFrame, target: str, part: Column) -> DataFrame:
    """Rows, positives and rate of a 0/1 target for every part of a split."""
    return rows.groupBy(part.alias("part")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(target).cast("bigint")).alias("n_pos"),
        F.avg(F.col(target).cast("double")).alias("rate"),
    )


def class_ratio(rows: DataFrame, target: str) -> DataFrame:
    """Negatives per positive of a 0/1 target: the weight that balances the positive class."""
    hit = F.col(target).cast("bigint")
    return rows.agg(
        F.sum(1 - hit).alias("n_neg"),
        F.sum(hit).alias("n_pos"),
        F.try_divide(F.sum(1 - hit), F.sum(hit)).alias("ratio"),
    )


def ranked(rows: DataFrame, *order: Column, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of an order, numbered from 1. The number is given to ``k`` rows only."""
    head = rows.orderBy(*order).limit(k)
    return head.withColumn(name, F.row_number().over(Window.orderBy(*order)))
