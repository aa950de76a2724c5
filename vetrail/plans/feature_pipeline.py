"""From raw files to the feature table: scope, matching, history, gates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vetrail.columns import EventColumns
from vetrail.operators import clean, detail, history, quality, resolve
from vetrail.session import materialized
from vetrail.sources import readers, sinks


def build_mapping(
    letters: DataFrame, recalls: DataFrame, facilities: DataFrame, recall_order: str
) -> DataFrame:
    """Match letters and recalls to facilities and keep the names that were matched."""
    by_letter = resolve.match_letters(letters, facilities)
    by_recall = resolve.match_recalls(recalls, facilities, recall_order)
    return resolve.match_mapping(by_letter, "warning_letters", "company_name").unionByName(
        resolve.match_mapping(by_recall, "enforcement", "recalling_firm")
    )


def build_features(
    inspections: DataFrame,
    citations: DataFrame,
    letters: DataFrame,
    recalls: DataFrame,
    forms: DataFrame,
    mapping: DataFrame,
    cols: EventColumns = EventColumns(),
    **options,
) -> DataFrame:
    """The feature table of all in-scope inspections that have a facility key."""
    scoped = clean.prepare_inspections(inspections, cols)
    counts = detail.detail_counts(citations, "Inspection ID", "Act/CFR Number")
    events = detail.with_detail_counts(scoped, counts, cols.event_id)
    side = history.side_sources(
        resolve.with_entity(letters, mapping, "warning_letters", "company_name"),
        resolve.with_entity(recalls, mapping, "enforcement", "recalling_firm"),
        forms,
    )
    return history.feature_table(events, side, cols, keys=scoped, **options)


@dataclass(frozen=True)
class Gates:
    """Limits of the pipeline's gates; ``cut_year`` is the first year of the test part."""

    cut_year: int
    letters: int = quality.MIN_LETTERS
    recalls: int = quality.MIN_RECALLS
    rows: int = quality.MIN_FEATURE_ROWS
    rate_limits: tuple[float, float] = quality.RATE_LIMITS
    required: tuple[str, ...] = tuple(quality.REQUIRED_COLUMNS)


def run(
    spark: SparkSession,
    inspections: str,
    citations: str,
    letters: str,
    recalls: Mapping[str, str],
    forms: str,
    mapping: str,
    output: str,
    kind: str = "csv",
    gates: Gates | None = None,
    match: bool = False,
) -> DataFrame:
    """Read the raw files, write the feature table as Parquet, and return it as written.

    With ``match`` the mapping is built from the names first and written to ``mapping``, where it is
    otherwise read. With ``gates`` too few letters or recalls, or a feature table that fails a gate, raise
    :class:`quality.GateFailed`; the table is then not written.
    """
    events = readers.read_inspections(spark, inspections, kind)
    notes = readers.read_letters(spark, letters)
    recalled = readers.with_recall_date(readers.read_recalls(spark, recalls))
    if gates:
        quality.require(quality.row_gate(notes, "letters", gates.letters))
        quality.require(quality.row_gate(recalled, "recalls", gates.recalls))
    if match:
        found = build_mapping(notes, recalled, events.filter("`FEI Number` is not null"), "recall_initiation_date")
        sinks.write_parquet(found, mapping)
    features = build_features(
        events,
        readers.read_citations(spark, citations, kind),
        notes,
        recalled,
        readers.read_forms(spark, forms, kind),
        readers.read_mapping(spark, mapping),
    )
    if gates:
        features = materialized(features)
        quality.require(
            quality.feature_gates(features, gates.cut_year, gates.rows, gates.rate_limits, gates.required)
        )
    sinks.write_parquet(features, output)
    return readers.read_features(spark, output)
