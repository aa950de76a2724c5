"""Batch scoring: one row per facility with score, tier and audit columns, and its alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as Date

from pyspark.sql import DataFrame

from vetrail.operators import score, split, train
from vetrail.sources import sinks


def score_facilities(
    model: train.Model,
    features: DataFrame,
    names: Sequence[str],
    as_of: Date | None = None,
    audit: Mapping[str, object] | None = None,
) -> DataFrame:
    """Score the newest state of every facility, highest first.

    With ``as_of`` the newest event's outcome is rolled into the history first; without it the
    features from before that event are scored, column by column the last known value.
    """
    if as_of is None:
        wanted = [*names, *score.SCORE_COLUMNS[1:3], "inspection_date"]
        state = score.latest_values(features, list(dict.fromkeys(wanted)))
    else:
        state = score.next_event_features(features, as_of)
    scored = score.batch_scores(train.score_rows(model, state, names))
    return score.with_audit(scored, audit or {})


def score_champion(
    features: DataFrame, folder: str, as_of: Date | None = None, audit: Mapping[str, object] | None = None
) -> DataFrame:
    """Score every facility with the champion of ``folder``: its model, features and category codes.

    The version, its training date and the number of its features are added as audit columns.
    """
    spark = features.sparkSession
    entry = train.champion(spark, f"{folder}/registry")
    if entry is None:
        raise ValueError(f"no champion in {folder}")
    model = train.load_model(spark, entry["path"])
    if entry["codes_path"]:
        codes = spark.read.parquet(entry["codes_path"])
        features = split.apply_codes(features, codes, entry["categories"])
    own = {
        "model_version": entry["version"],
        "trained_on": entry["trained_on"],
        "n_features": len(entry["features"]),
    }
    return score_facilities(model, features, entry["features"], as_of, own | dict(audit or {}))


def write_scores(scores: DataFrame, folder: str, run_date: Date) -> DataFrame:
    """Write the scores as Parquet and CSV and the alerts as CSV, each under the run's date.

    Alerts are taken from the written scores, so the model runs once.
    """
    sinks.write_dated(scores, f"{folder}/facility_scores", run_date)
    written = scores.sparkSession.read.parquet(f"{folder}/facility_scores").filter(
        sinks.on_run_date(run_date)
    )
    sinks.write_dated(written.drop(sinks.RUN_DATE), f"{folder}/facility_scores_csv", run_date, "csv")
    alerts = score.alerts(written)
    sinks.write_dated(alerts.drop(sinks.RUN_DATE), f"{folder}/high_risk_alerts", run_date, "csv")
    return alerts
