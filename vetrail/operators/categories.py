"""Citation severity and letter subject categories, as counts over the earlier history.

These are described for the original pipeline but were found not to improve its model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.operators.history import SideEvents

# Example codes of each severity category, and the names of the subjects told apart in letters.
SEVERITY_CODES = {
    "sterility": ["211.113", "211.42", "211.46"],
    "process_validation": ["211.100", "211.110", "820.75"],
    "quality_system": ["211.22", "211.192", "820.22"],
    "records_documentation": ["211.180", "211.186", "820.184"],
    "testing_lab": ["211.160", "211.165"],
}
OTHER_SEVERITY = "other"
#: Phrases that tell a subject, in lower case; letters name their subjects in many ways, so tables of a user's own may be passed.
SUBJECT_PHRASES = {
    "wl_cgmp": ["cgmp", "current good manufacturing practice", "finished pharmaceuticals", "active pharmaceutical ingredient"],
    "wl_unapproved_drug": ["unapproved"],
    "wl_adulterated": ["adulterated"],
    "wl_misbranded": ["misbranded", "false & misleading", "false and misleading"],
    "wl_medical_device": ["medical device", "quality system regulation"],
    "wl_compounding": ["compounding", "compounded", "outsourcing facilit"],
    "wl_fsvp": ["fsvp", "foreign supplier verification"],
}

_PART, _SECTION = r"(\d+)", r"\d+\.\d+"


def code_prefixes(code: Column) -> Column:
    """What a table may name of a regulation code, shortest first: ``21 CFR 211.113(b)(1)`` gives ``211``, ``211.113``,
    ``211.113(b)``, ``211.113(b)(1)``. Empty for a text without a section."""
    section = F.regexp_extract(code, _SECTION, 0)
    marks = F.regexp_extract_all(F.regexp_extract(code, _SECTION + r"((?:\s*\([0-9A-Za-z]+\))*)", 1), F.lit(r"\([0-9A-Za-z]+\)"), 0)
    below = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(marks), F.lit(1))),
        lambda n: F.concat(section, F.array_join(F.slice(marks, F.lit(1), n), "")),
    )
    every = F.concat(F.array(F.regexp_extract(section, _PART, 1), section), F.when(F.size(marks) > 0, below).otherwise(F.array().cast("array<string>")))
    return F.when(section != "", every).otherwise(F.array().cast("array<string>"))


def severity_table(spark: SparkSession, codes: Mapping[str, Sequence[str]] = SEVERITY_CODES) -> DataFrame:
    """(prefix, category) of a few stated codes; large tables are read from files."""
    rows = [(prefix, name) for name, prefixes in codes.items() for prefix in prefixes]
    return spark.createDataFrame(rows, "prefix string, category string")


def with_severity(details: DataFrame, code: str, table: DataFrame | None = None, category: str = "severity") -> DataFrame:
    """Add the category of a code's longest prefix in a table (prefix, category); ``other`` without one, null without a code.

    Of equal prefixes the first category by name counts. Codes are looked up once each, however many rows carry them.
    """
    if table is None:
        table = severity_table(details.sparkSession)
    single = table.groupBy("prefix").agg(F.min("category").alias("category"))
    codes = details.select(F.col(code).alias("_code")).filter("_code is not null").distinct()
    known = codes.select("_code", F.posexplode(code_prefixes(F.col("_code"))).alias("_long", "prefix")).join(single, "prefix")
    best = known.groupBy("_code").agg(F.max_by("category", "_long").alias("_category"))
    joined = details.join(best, F.col(code) == F.col("_code"), "left")
    found = F.when(F.col(code).isNotNull(), F.coalesce("_category", F.lit(OTHER_SEVERITY)))
    return joined.select(*[F.col(f"`{c}`") for c in details.columns], found.alias(category))


def severity_counts(
    details: DataFrame, key: str, code: str, table: DataFrame | None = None, names: Sequence[str] = tuple(SEVERITY_CODES)
) -> DataFrame:
    """Per event, the number of citations of each category (columns ``citations_<category>``)."""
    rows = details.filter(F.col(key).isNotNull()).select(key, F.col(code).alias("_of"))
    kinds = with_severity(rows, "_of", table, "_kind")
    return kinds.groupBy(key).agg(
        *[F.count_if(F.col("_kind") == n).alias(f"citations_{n}") for n in [*names, OTHER_SEVERITY]]
    )


def severity_totals(names: Sequence[str] = tuple(SEVERITY_CODES)) -> dict[str, str]:
    """The ``totals`` argument that sums these counts over earlier events."""
    return {f"prior_citations_{n}": f"citations_{n}" for n in [*names, OTHER_SEVERITY]}


def letter_subjects(
    letters: DataFrame, entity: str, date: str, subject: str = "subject",
    phrases: Mapping[str, Sequence[str]] = SUBJECT_PHRASES,
) -> SideEvents:
    """Letters as side events that count each subject: a letter has one if its subject line holds one of its phrases.

    Phrases are matched at the beginnings of words, whatever the case and the blanks between words.
    """
    text = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(subject, F.lit(""))), r"[\s/,;:()\[\]-]+", " "))
    return SideEvents(
        letters,
        entity,
        date,
        {
            name: reduce(or_, [F.contains(text, F.lit(f" {p}")) for p in ps], F.lit(False)).cast("int")
            for name, ps in phrases.items()
        },
    )
