"""Scope, outcome flags and dates of the raw event tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.columns import EventColumns, Outcomes
from vetrail.functions.coerce import is_value, lacks_text, not_in_or_null

# The project areas of food inspections, which are out of scope.
FOOD_AREAS = [
    "Foodborne Biological Hazards",
    "Food Composition, Standards, Labeling and Econ",
    "Pesticides and Chemical Contaminants",
    "Food and Color Additives Petition Review",
    "Molecular Biology and Natural Toxins",
]


def in_scope(events: DataFrame, area: str, excluded: Iterable[str] = FOOD_AREAS) -> DataFrame:
    """Rows whose area is not excluded; rows without an area stay."""
    return events.filter(not_in_or_null(area, excluded))


def with_outcome_flags(
    events: DataFrame, outcome: str, outcomes: Outcomes = Outcomes()
) -> DataFrame:
    """Add ``is_oai``, ``is_vai`` and ``is_nai``; an unknown or missing outcome has all 0."""
    return events.withColumns(
        {
            "is_oai": is_value(outcome, outcomes.oai),
            "is_vai": is_value(outcome, outcomes.vai),
            "is_nai": is_value(outcome, outcomes.nai),
        }
    )


def prepare_inspections(
    raw: DataFrame,
    cols: EventColumns = EventColumns(),
    outcomes: Outcomes = Outcomes(),
    excluded: Iterable[str] = FOOD_AREAS,
) -> DataFrame:
    """Scope filter and outcome flags of the inspection table."""
    return with_outcome_flags(in_scope(raw, cols.area, excluded), cols.outcome, outcomes)


def without_text(rows: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column does not contain the text, in any case; null rows stay."""
    return rows.filter(lacks_text(column, text))


def with_year(rows: DataFrame, date: str, name: str = "year") -> DataFrame:
    """Add the calendar year of a date."""
    return rows.withColumn(name, F.year(date))


def from_year(rows: DataFrame, date: str, first_year: int) -> DataFrame:
    """Rows dated in or after a year. Compares dates, so the filter reaches the scan."""
    return rows.filter(F.col(date) >= F.make_date(F.lit(first_year), F.lit(1), F.lit(1)))


def complete(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null in the named columns."""
    return rows.dropna(subset=list(columns))
