"""Detail rows (citations) counted per event and joined to the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detail_counts(details: DataFrame, key: str, code: str) -> DataFrame:
    """Per event: ``n_citations`` (codes present) and ``n_unique_cfr`` (distinct codes).

    Counting per (event, code) first lets the shuffle spread an event that holds very many rows,
    and leaves one row per distinct code for the second step.
    """
    per_code = details.filter(F.col(key).isNotNull()).groupBy(key, code).agg(
        F.count(code).alias("n")
    )
    return per_code.groupBy(key).agg(
        F.sum("n").alias("n_citations"), F.count(code).alias("n_unique_cfr")
    )


def with_detail_counts(events: DataFrame, counts: DataFrame, event_key: str) -> DataFrame:
    """Left join of the counts, 0 where an event has no detail row."""
    key = counts.columns[0]
    joined = events.join(
        counts.withColumnRenamed(key, event_key) if key != event_key else counts,
        event_key,
        "left",
    )
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_citations", "n_unique_cfr")}
    )


def details_in_scope(details: DataFrame, key: str, events: DataFrame, event_key: str) -> DataFrame:
    """Detail rows whose event is in scope (semi-join)."""
    ids = events.select(F.col(event_key).alias("_scope_id"))
    return details.join(ids, F.col(key) == F.col("_scope_id"), "left_semi")
