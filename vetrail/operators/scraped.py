"""Named columns out of scraped table rows (an array of HTML cells per row)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.functions.html import (
    absolute_url, anchor_href, anchor_text, cell_at, cell_date, cell_text,
)

# The order of the cells in a scraped inspection row.
INSPECTION_CELLS = [
    "firm_name", "city", "state", "country", "zip_code", "inspection_end_date", "classification",
    "project_area", "posted_date", "fei_number",
]


def letter_rows(rows: DataFrame, cells: str, host: str, *keep: str) -> DataFrame:
    """Letter rows: two dates, the linked company with its address, office and subject."""
    c = F.col(cells)
    return rows.select(
        *keep,
        cell_date(cell_at(c, 0)).alias("posted_date"),
        cell_date(cell_at(c, 1)).alias("issue_date"),
        anchor_text(cell_at(c, 2)).alias("company_name"),
        absolute_url(anchor_href(cell_at(c, 2)), host).alias("letter_url"),
        cell_text(cell_at(c, 3)).alias("issuing_office"),
        cell_text(cell_at(c, 4)).alias("subject"),
    )


def inspection_rows(
    rows: DataFrame, cells: str, *keep: str, fields: list[str] = INSPECTION_CELLS
) -> DataFrame:
    """Inspection rows by position, missing cells empty; date cells prefer their date attribute."""
    out = []
    for i, field in enumerate(fields):
        cell = cell_at(F.col(cells), i)
        text = cell_text(cell)
        if field.endswith("_date"):
            text = F.coalesce(F.nullif(cell_date(cell), F.lit("")), text)
        out.append(text.alias(field))
    return rows.select(*keep, *out)
