"""State of every facility now: latest values, roll-forward, scores, tiers, alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrail.columns import EventColumns
from vetrail.functions.scores import (
    ALERT_TIERS, batch_tier, lookup_tier, outcome_label, percent_text, tier_rank,
)
from vetrail.operators.history import SideEvents, feature_table

# The columns of the score output.
SCORE_COLUMNS = [
    "fei_number", "product_type", "country", "risk_score", "risk_tier", "inspection_date",
]
_FUTURE_ID = 2**63 - 1


def _newest_order() -> Column:
    return F.struct("inspection_date", "n_prior_inspections")


def latest_values(features: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per facility, the last non-null value of each column by date (not one whole row)."""
    wanted = [c for c in columns or features.columns if c != "fei_number"]
    # Undated rows sort last, as the newest.
    place = F.struct(
        F.col("inspection_date").isNull().alias("undated"), "inspection_date", "n_prior_inspections"
    )
    rows = features.filter("fei_number is not null").withColumn("_place", place)
    known = [
        F.max(F.when(F.col(c).isNotNull(), F.struct("_place", F.col(c).alias("v"))))["v"].alias(c)
        for c in wanted
    ]
    return rows.groupBy("fei_number").agg(*known)


def newest_rows(features: DataFrame) -> DataFrame:
    """Per facility, the whole newest row. Partial maxima are taken before the shuffle."""
    whole = F.struct(_newest_order().alias("_at"), *features.columns)
    return features.groupBy("fei_number").agg(F.max(whole).alias("_row")).select(
        *[F.col(f"_row.{c}").alias(c) for c in features.columns]
    )


def next_event_features(features: DataFrame, as_of: Date) -> DataFrame:
    """Features of each facility's next event: its newest row with that row's outcome added.

    An outcome other than serious counts as clean, and citations and side events stay as they
    were; :func:`next_event_exact` recomputes everything instead.
    """
    bad = F.coalesce(F.col("target_oai"), F.lit(0))
    n = F.col("n_prior_inspections") + 1
    n_oai = F.col("n_prior_oai") + bad
    had_previous = F.col("n_prior_inspections") >= 1
    previous = F.col("last_classification_oai")
    updated = {
        "n_prior_inspections": n,
        "n_prior_oai": n_oai,
        "n_prior_nai": F.col("n_prior_nai") + 1 - bad,
        "pct_oai": n_oai / n,
        "pct_vai": F.col("n_prior_vai") / n,
        "days_since_last_inspection": F.date_diff(F.lit(as_of), "inspection_date"),
        "last_classification_oai": bad.cast("int"),
        "last_classification_vai": F.lit(0),
        "trend_worsening": (had_previous & (bad > previous)).cast("int"),
        "recent_oai_rate": F.when(had_previous, (bad + previous) / 2).otherwise(
            bad.cast("double")
        ),
    }
    return newest_rows(features).select(
        *[updated[c].alias(c) if c in updated else F.col(c) for c in features.columns]
    )


def next_event_exact(
    events: DataFrame,
    side: Sequence[SideEvents],
    as_of: Date,
    cols: EventColumns = EventColumns(),
    **options,
) -> DataFrame:
    """Features of each facility's next event, recomputed from all it did up to a date.

    One row per facility dated ``as_of`` is added to the events, and only its features are kept.
    """
    past = events.filter(F.col(cols.date) <= F.lit(as_of))
    newest = F.max(F.struct(cols.date, cols.event_id, cols.kind, cols.country, cols.area)).alias("_n")
    future = (
        past.filter(F.col(cols.entity).isNotNull())
        .groupBy(cols.entity)
        .agg(newest)
        .select(
            cols.entity,
            F.lit(_FUTURE_ID).alias(cols.event_id),
            F.lit(as_of).alias(cols.date),
            *[F.col(f"_n.{c}").alias(c) for c in (cols.kind, cols.country, cols.area)],
            *[F.lit(0).alias(c) for c in ("is_oai", "is_vai", "is_nai", "n_citations", "n_unique_cfr")],
        )
    )
    rows = past.select(*future.columns).unionByName(future)
    return feature_table(rows, side, cols, **options).filter(F.col("inspection_id") == _FUTURE_ID)


def with_absent_as_zero(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Every listed feature present and not null, 0 where it is missing."""
    have = set(rows.columns)
    return rows.withColumns(
        {c: F.coalesce(c, F.lit(0)) if c in have else F.lit(0) for c in features}
    )


def batch_scores(scored: DataFrame, score: str = "risk_score") -> DataFrame:
    """The score table with tiers, highest score first."""
    tiered = scored.withColumn("risk_score", F.col(score)).withColumn(
        "risk_tier", batch_tier(F.col("risk_score"))
    )
    return tiered.select(*SCORE_COLUMNS, tier_rank(F.col("risk_tier")).alias("tier_rank")).orderBy(
        F.desc("risk_score"), "fei_number"
    )


def alerts(scores: DataFrame, tiers: Sequence[str] = ALERT_TIERS) -> DataFrame:
    """Scored facilities in the named tiers."""
    return scores.filter(F.col("risk_tier").isin(list(tiers)))


def profile_cards(rows: DataFrame, score: str = "risk_score") -> DataFrame:
    """Per facility: identity, history counts, score text and lookup tier."""
    return rows.select(
        "fei_number", "product_type", "country", "project_area",
        F.date_format("inspection_date", "yyyy-MM-dd").alias("last_inspection"),
        F.col("n_prior_inspections").alias("total_inspections"),
        F.col("n_prior_oai").alias("oai_inspections"),
        F.col("n_prior_vai").alias("vai_inspections"),
        F.col("n_prior_nai").alias("nai_inspections"),
        F.col("n_warning_letters").alias("warning_letters"),
        F.col("n_recalls").alias("recalls"),
        F.col("n_published_483s").alias("published_483s"),
        "days_since_last_inspection",
        percent_text(F.col(score)).alias("risk_score"),
        lookup_tier(F.col(score)).alias("risk_tier"),
    )


def entity_history(features: DataFrame, entity=None) -> DataFrame:
    """Events with readable outcome, newest first; of one facility, or of all."""
    rows = features if entity is None else features.filter(F.col("fei_number") == entity)
    return rows.select(
        "fei_number", "inspection_date", "product_type", "project_area",
        outcome_label(F.col("target_oai")).alias("classification"),
    ).orderBy("fei_number", F.desc_nulls_last("inspection_date"))


def with_audit(scores: DataFrame, audit: Mapping[str, object]) -> DataFrame:
    """Constant audit columns on every score row (model version, threshold, date, features)."""
    return scores.withColumns({name: F.lit(value) for name, value in audit.items()})
