"""Writers: Parquet, CSV and JSON, replaced as a whole or per run date."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN_DATE = "run_date"


def write_parquet(rows: DataFrame, path: str) -> None:
    """Replace a Parquet table."""
    rows.write.mode("overwrite").parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Replace a CSV table with header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """Replace a table of JSON records, one per line."""
    rows.write.mode("overwrite").json(path)


def write_dated(rows: DataFrame, path: str, run_date: Date, kind: str = "parquet") -> None:
    """Replace the partition of one run date; other dates stay."""
    writer = (
        rows.withColumn(RUN_DATE, F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_DATE)
        .format(kind)
    )
    if kind == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def on_run_date(run_date: Date) -> Column:
    """Filter on the partition of one run date."""
    return F.col(RUN_DATE) == F.lit(run_date)
