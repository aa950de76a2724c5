"""Data and model gates. Each gives rows (gate, value, passed), from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The limits of the gates.
MIN_FEATURE_ROWS = 100_000
MIN_LETTERS = 3_000
MIN_RECALLS = 1_000
RATE_LIMITS = (0.01, 0.20)
MODEL_FLOOR = {"roc_auc": 0.7, "pr_auc": 0.2}
MIN_FEATURES = 10
REQUIRED_COLUMNS = [
    "fei_number", "inspection_date", "target_oai", "n_prior_inspections", "n_prior_oai",
    "n_prior_vai", "n_prior_nai", "days_since_last_inspection", "n_warning_letters", "n_recalls",
    "product_type", "country",
]


class GateFailed(ValueError):
    """A gate did not pass."""


def _gates(rows: DataFrame, gates: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One aggregate per gate value, then one output row per gate."""
    values = rows.agg(*[v.cast("double").alias(f"v{i}") for i, (v, _) in enumerate(gates.values())],
                      *[F.coalesce(p, F.lit(False)).alias(f"p{i}") for i, (_, p) in enumerate(gates.values())])
    return values.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("gate"), F.col(f"v{i}").alias("value"),
                        F.col(f"p{i}").cast("int").alias("passed"),
                    )
                    for i, name in enumerate(gates)
                ]
            )
        )
    )


def row_gate(rows: DataFrame, name: str, more_than: int) -> DataFrame:
    """The table has more than so many rows."""
    n = F.count("*")
    return _gates(rows, {f"{name}_rows": (n, n > more_than)})


def missing_columns(rows: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns that the table lacks."""
    return [c for c in required if c not in rows.columns]


def feature_gates(
    features: DataFrame,
    cut_year: int,
    min_rows: int = MIN_FEATURE_ROWS,
    rate_limits: tuple[float, float] = RATE_LIMITS,
    required: Sequence[str] = REQUIRED_COLUMNS,
    target: str = "target_oai",
) -> DataFrame:
    """Gates of the feature table: size, columns, target, rate, leakage, temporal split."""
    n, rate = F.count("*"), F.avg(target)
    bad_target = F.count_if(F.col(target).isNull() | ~F.col(target).isin(0, 1))
    first = F.col("n_prior_inspections") == 0
    leaked = F.sum(
        F.when(first, F.col("n_prior_oai") + F.col("n_prior_vai") + F.col("n_prior_nai"))
    )
    early = F.col("inspection_date") < F.lit(Date(cut_year, 1, 1))
    newest_train = F.max(F.when(early, F.col("inspection_date")))
    oldest_test = F.min(F.when(~early, F.col("inspection_date")))
    missing = F.lit(len(missing_columns(features, required)))
    return _gates(
        features,
        {
            "rows": (n, n > min_rows),
            "missing_columns": (missing, missing == 0),
            "target_not_binary": (bad_target, bad_target == 0),
            "target_rate": (rate, (rate > rate_limits[0]) & (rate < rate_limits[1])),
            "first_rows": (F.count_if(first), F.count_if(first) > 0),
            "history_of_first_rows": (leaked, leaked == 0),
            "train_rows": (F.count_if(early), F.count_if(early) > 0),
            "test_rows": (F.count_if(~early), F.count_if(~early) > 0),
            "days_between_parts": (F.date_diff(oldest_test, newest_train), newest_train < oldest_test),
        },
    )


def score_gates(scored: DataFrame, p0: str, p1: str, tolerance: float = 1e-6) -> DataFrame:
    """Probabilities lie in [0, 1] and sum to 1."""
    outside = F.count_if(F.col(p1).isNull() | ~F.col(p1).between(0.0, 1.0))
    off = F.count_if(F.abs(F.col(p0) + F.col(p1) - 1.0) > tolerance)
    return _gates(
        scored,
        {"outside_unit_range": (outside, outside == 0), "sum_not_one": (off, off == 0)},
    )


def model_gates(
    metrics: DataFrame,
    n_features: int,
    floor: Mapping[str, float] = MODEL_FLOOR,
    min_features: int = MIN_FEATURES,
) -> DataFrame:
    """The model's metrics are above the floor, and it uses enough features."""
    count = F.lit(n_features)
    gates = {name: (F.min(name), F.min(name) > least) for name, least in floor.items()}
    return _gates(metrics, gates | {"n_features": (count, count > min_features)})


def require(gates: DataFrame) -> None:
    """Raise :class:`GateFailed` with the gates that did not pass."""
    failed = gates.filter("passed = 0").collect()  # one row per gate
    if failed:
        raise GateFailed(", ".join(f"{r['gate']}={r['value']}" for r in failed))
