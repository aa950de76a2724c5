"""Names of the columns that play a role, so that every operator runs on any event schema."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EventColumns:
    """Roles of the columns of an event table (one row per inspection of a facility)."""

    entity: str = "FEI Number"
    event_id: str = "Inspection ID"
    date: str = "Inspection End Date"
    outcome: str = "Classification"
    area: str = "Project Area"
    kind: str = "Product Type"
    country: str = "Country/Area"


# The three outcome labels of the inspection data.
OUTCOME_NAI = "No Action Indicated (NAI)"
OUTCOME_VAI = "Voluntary Action Indicated (VAI)"
OUTCOME_OAI = "Official Action Indicated (OAI)"


@dataclass(frozen=True)
class Outcomes:
    """Labels of the serious, minor and clean outcome."""

    oai: str = OUTCOME_OAI
    vai: str = OUTCOME_VAI
    nai: str = OUTCOME_NAI


# The feature table: identity and static columns, then the numeric history.
STATIC_FEATURES = [
    "inspection_id", "fei_number", "inspection_date", "product_type", "country", "project_area",
    "target_oai",
]
HISTORY_FEATURES = [
    "n_prior_inspections", "n_prior_oai", "n_prior_vai", "n_prior_nai", "pct_oai", "pct_vai",
    "days_since_last_inspection", "last_classification_oai", "last_classification_vai",
    "trend_worsening", "recent_oai_rate", "total_prior_citations",
    "avg_citations_per_inspection", "max_citations_single_inspection",
    "total_unique_cfr_violated",
]
SIDE_FEATURES = [
    "n_warning_letters", "has_warning_letter", "days_since_last_wl", "n_recalls", "has_recall",
    "n_class_I_recalls", "n_class_II_recalls", "n_published_483s", "has_published_483",
]
FEATURE_TABLE = STATIC_FEATURES + HISTORY_FEATURES + SIDE_FEATURES
