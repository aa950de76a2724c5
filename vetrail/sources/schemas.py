"""Declared schemas of the raw inputs and of the score tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_LONG, _INT, _TEXT, _DATE, _DOUBLE = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.DoubleType(),
)

INSPECTIONS = _struct(
    ("Inspection ID", _LONG), ("FEI Number", _LONG), ("Legal Name", _TEXT), ("City", _TEXT),
    ("State", _TEXT), ("Country/Area", _TEXT), ("Inspection End Date", _DATE),
    ("Classification", _TEXT), ("Project Area", _TEXT), ("Product Type", _TEXT),
    ("Fiscal Year", _INT),
)
CITATIONS = _struct(
    ("Inspection ID", _LONG), ("FEI Number", _LONG), ("Act/CFR Number", _TEXT),
    ("Short Description", _TEXT), ("Long Description", _TEXT), ("Program Area", _TEXT),
)
# Date and facility key come as text and are coerced by the reader.
FORMS_483 = _struct(
    ("FEI Number", _TEXT), ("Record Date", _TEXT), ("Download", _TEXT), ("Publish Date", _TEXT)
)
LETTERS = _struct(
    ("posted_date", _TEXT), ("issue_date", _TEXT), ("company_name", _TEXT), ("letter_url", _TEXT),
    ("issuing_office", _TEXT), ("subject", _TEXT),
)
RECALL_FIELDS = [
    "recalling_firm", "classification", "city", "state", "country", "product_type",
    "recall_initiation_date", "reason_for_recall", "voluntary_mandated", "status",
]
RECALL = _struct(*[(name, _TEXT) for name in RECALL_FIELDS])
MATCH_DOCUMENT = T.MapType(
    _TEXT, T.MapType(_TEXT, _struct(("fei", _LONG), ("score", _DOUBLE)))
)
MATCHES = _struct(("source", _TEXT), ("name", _TEXT), ("fei", _LONG), ("score", _DOUBLE))
SCORES = _struct(
    ("fei_number", _LONG), ("product_type", _TEXT), ("country", _TEXT), ("risk_score", _DOUBLE),
    ("risk_tier", _TEXT), ("inspection_date", _DATE),
)
