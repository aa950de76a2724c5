"""Tiers, rates and report texts of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier cut points (from below) and the tier names of the two reports.
TIER_CUTS = [0.1, 0.3, 0.6]
LOOKUP_TIERS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
BATCH_TIERS = ["Low", "Medium", "High", "Critical"]
ALERT_TIERS = ["High", "Critical"]
OUTCOME_LABELS = {1: "OAI", 0: "NAI/VAI"}
F1_EPSILON = 1e-8


def lookup_tier(score: Column) -> Column:
    """Tier of one looked-up facility: a cut point belongs to the tier above it."""
    low, medium, high, critical = LOOKUP_TIERS
    a, b, c = TIER_CUTS
    return (
        F.when(score >= c, critical).when(score >= b, high).when(score >= a, medium).otherwise(low)
    )


def batch_tier(score: Column) -> Column:
    """Tier in the batch output: a cut point belongs to the tier below it; 0 has no tier."""
    low, medium, high, critical = BATCH_TIERS
    a, b, c = TIER_CUTS
    return (
        F.when((score <= 0) | (score > 1) | F.isnan(score), F.lit(None).cast("string"))
        .when(score <= a, low)
        .when(score <= b, medium)
        .when(score <= c, high)
        .when(score <= 1, critical)
    )


def tier_rank(tier: Column) -> Column:
    """Order of a tier name of either report, 0 the lowest; null stays null."""
    rank = None
    for i, name in enumerate(LOOKUP_TIERS):
        matches = F.upper(tier) == name
        rank = F.when(matches, i) if rank is None else rank.when(matches, i)
    return rank


def f1_with_epsilon(precision: Column, recall: Column) -> Column:
    """Harmonic mean that is 0 rather than undefined where both are 0."""
    return 2 * precision * recall / (precision + recall + F.lit(F1_EPSILON))


def outcome_label(target: Column) -> Column:
    """Readable outcome of a 0/1 target."""
    return F.when(target == 1, OUTCOME_LABELS[1]).when(target == 0, OUTCOME_LABELS[0])


def percent_text(value: Column, digits: int = 1) -> Column:
    """A share as a percent text, like ``12.3%``."""
    return F.format_string(f"%.{digits}f%%", value * 100)


def driver_text(feature: Column, value: Column, impact: Column) -> Column:
    """One risk driver as text: arrow, feature, value, signed impact (halves away from 0)."""
    impact = F.round(impact, 9)
    arrow = F.when(impact > 0, "↑").otherwise("↓")
    return F.format_string("%s %s = %.0f (impact: %+.3f)", arrow, feature, value, impact)
