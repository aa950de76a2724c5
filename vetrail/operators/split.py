"""Feature lists, temporal splits and category codes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrail.functions.coerce import text_or_nan
from vetrail.operators.ordered import broadcast_if_small, running_totals
from vetrail.session import materialized

# Identity columns, categories, and features that trees do not need.
NOT_FEATURES = ["inspection_id", "fei_number", "inspection_date", "target_oai", "year"]
CATEGORIES = ["product_type", "country", "project_area"]
REDUNDANT_FOR_TREES = [
    "has_warning_letter", "has_recall", "has_published_483", "pct_oai", "pct_vai",
]
DOMINANT_FEATURE = "last_classification_oai"


def numeric_features(
    columns: Iterable[str],
    dropped: Sequence[str] = NOT_FEATURES,
    categories: Sequence[str] = CATEGORIES,
    redundant: Sequence[str] = (),
) -> list[str]:
    """Column names less the dropped, categorical and redundant ones, in their order."""
    out = {*dropped, *categories, *redundant}
    return [c for c in columns if c not in out]


def before_year(rows: DataFrame, date: str, year: int) -> DataFrame:
    """Training part: dated before the year. A date comparison, so the scan can use it."""
    return rows.filter(F.col(date) < F.lit(Date(year, 1, 1)))


def since_year(rows: DataFrame, date: str, year: int) -> DataFrame:
    """Test part: dated in the year or later."""
    return rows.filter(F.col(date) >= F.lit(Date(year, 1, 1)))


def split_part(date: str, year: int) -> Column:
    """``train`` or ``test`` by date; null for rows without a date."""
    return F.when(F.col(date) < F.lit(Date(year, 1, 1)), "train").when(
        F.col(date).isNotNull(), "test"
    )


def last_year(rows: DataFrame, date: str) -> int:
    """The newest calendar year, the cut of a rolling validation (one aggregate job)."""
    return rows.agg(F.year(F.max(date))).first()[0]


def rolling_split(rows: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Everything before the newest year, and the newest year."""
    year = last_year(rows, date)
    return before_year(rows, date, year), since_year(rows, date, year)


def training_window(rows: DataFrame, date: str, until: Date, years: int = 3) -> DataFrame:
    """Rows of the last years before a date (a sliding training window)."""
    first = F.add_months(F.lit(until), -12 * years)
    return rows.filter((F.col(date) >= first) & (F.col(date) < F.lit(until)))


def expanding_folds(rows: DataFrame, date: str, folds: int = 3) -> list[tuple[Date, Date | None]]:
    """Cut dates of expanding time-series folds.

    Fold i trains on rows before its first date and validates from there up to its second date
    (open for the last fold). Whole days stay together: a cut is the first day with at least i/(folds + 1)
    of the rows before it, moved on where days are too few for that. Fewer days than ``folds + 1`` raise.
    """
    # One row per calendar day.
    counts = rows.filter(F.col(date).isNotNull()).groupBy(F.col(date).cast("date").alias("day")).count()
    days = sorted((r["day"], r["count"]) for r in counts.collect())
    if len(days) < folds + 1:
        raise ValueError(f"{folds} folds need {folds + 1} different days; there are {len(days)}")
    before = [0]
    for _, n in days:
        before.append(before[-1] + n)
    cuts, at = [], 0
    for i in range(1, folds + 1):
        wanted = next(k for k, n in enumerate(before) if n * (folds + 1) >= i * before[-1])
        at = min(max(wanted, at + 1), len(days) - 1 - (folds - i))
        cuts.append(days[at][0])
    return list(zip(cuts, [*cuts[1:], None]))


def fold_parts(
    rows: DataFrame, date: str, start: Date, end: Date | None
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of one expanding fold."""
    train = rows.filter(F.col(date) < F.lit(start))
    valid = rows.filter(F.col(date) >= F.lit(start))
    return train, valid if end is None else valid.filter(F.col(date) < F.lit(end))


#: Code of a category that the fitted codes do not know.
UNSEEN = -1


def fit_codes(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The codes of categories as a written table (column, text, code).

    A code is the 0-based rank of the text among all of its column, missing being ``nan``. One pass over the
    rows serves all columns.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text_or_nan(c).alias("text")) for c in columns])
    texts = rows.select(F.inline(pairs)).distinct().withColumn("_one", F.lit(1))
    ranked = running_totals(texts, F.col("text").asc(), {"_rank": "_one"}, by=["column"])
    return materialized(ranked.select("column", "text", (F.col("_rank") - 1).cast("bigint").alias("code")))


def apply_codes(
    rows: DataFrame,
    codes: DataFrame,
    columns: Sequence[str],
    suffix: str = "_encoded",
    max_broadcast: int = 100_000,
) -> DataFrame:
    """Add the fitted code of each category; texts that were not fitted get ``UNSEEN``."""
    for c in columns:
        own = codes.filter(F.col("column") == c).select(
            F.col("text").alias("_text"), F.col("code").alias(c + suffix)
        )
        rows = rows.withColumn("_text", text_or_nan(c)).join(
            broadcast_if_small(own, max_broadcast), "_text", "left"
        ).drop("_text")
    return rows.na.fill(UNSEEN, [c + suffix for c in columns])


def label_encode(rows: DataFrame, columns: Sequence[str], suffix: str = "_encoded") -> DataFrame:
    """Fit codes on the rows and apply them to the same rows."""
    return apply_codes(rows, fit_codes(rows, columns), columns, suffix)
