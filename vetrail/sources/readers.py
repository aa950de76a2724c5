"""Readers of the raw inputs. Schemas are declared, so nothing is inferred from the data.

Workbooks are read sheet by sheet in ranges of rows (``kind="workbook"``), or from their tabular export.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrail.functions.coerce import coerced_date, coerced_long, strict_date
from vetrail.operators.clean import complete
from vetrail.sources import schemas
from vetrail.sources.documents import document_records
from vetrail.sources.workbooks import read_workbook


def read_table(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, kind: str = "parquet"
) -> DataFrame:
    """A tabular file set: ``parquet``, ``orc``, ``csv`` with header, ``json`` lines, or the first sheet of a ``workbook``."""
    if kind == "workbook":
        return read_workbook(spark, path, schema)
    reader = spark.read.schema(schema).format(kind)
    if kind == "csv":
        reader = reader.options(header=True, mode="PERMISSIVE", escape='"', multiLine=False)
    return reader.load(path if isinstance(path, str) else list(path))


def read_inspections(spark: SparkSession, path, kind: str = "csv") -> DataFrame:
    """The inspection table. Dates are parsed strictly in text formats."""
    if kind == "parquet":
        return read_table(spark, path, schemas.INSPECTIONS, kind)
    date = "Inspection End Date"
    texts = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == date else f.dataType) for f in schemas.INSPECTIONS]
    )
    return read_table(spark, path, texts, kind).withColumn(date, strict_date(f"`{date}`"))


def read_citations(spark: SparkSession, path, kind: str = "csv") -> DataFrame:
    """The citation table."""
    return read_table(spark, path, schemas.CITATIONS, kind)


def read_forms(spark: SparkSession, path, kind: str = "csv") -> DataFrame:
    """Published forms with coerced date and facility key; rows that lack either are dropped."""
    rows = read_table(spark, path, schemas.FORMS_483, kind)
    typed = rows.withColumns(
        {"Record Date": coerced_date("Record Date"), "FEI Number": coerced_long("FEI Number")}
    )
    return complete(typed, "Record Date", "FEI Number")


def read_letters(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """Letters from JSON arrays, or from JSON lines, which large inputs should use.

    A file that is one JSON array is parsed by one task; JSON lines are split, and ``read_letter_document`` splits an array.
    """
    rows = spark.read.schema(schemas.LETTERS).option("multiLine", not lines).json(path)
    return rows.withColumn("issue_date", strict_date("issue_date"))


def read_letter_document(spark: SparkSession, path) -> DataFrame:
    """Letters of files that are one large JSON array each, read in byte ranges by many tasks."""
    parsed = document_records(spark, path, None).select(F.from_json("record", schemas.LETTERS).alias("r"))
    return parsed.select("r.*").withColumn("issue_date", strict_date("issue_date"))


def read_recalls(
    spark: SparkSession,
    paths: Mapping[str, str | Sequence[str]],
    fields: Sequence[str] = schemas.RECALL_FIELDS,
    lines: bool = False,
) -> DataFrame:
    """Recalls of several sources, tagged ``_source``, absent fields as empty text.

    By default each file is one object with a ``results`` array; with ``lines`` each line is a
    record. Only the wanted fields are parsed.
    """
    record = T.StructType([f for f in schemas.RECALL if f.name in set(fields)])
    every = None
    for source, path in paths.items():
        path = path if isinstance(path, str) else list(path)
        if lines:
            rows = spark.read.schema(record).json(path)
        else:
            document = T.StructType([T.StructField("results", T.ArrayType(record))])
            found = spark.read.schema(document).option("multiLine", True).json(path)
            rows = found.select(F.inline("results"))
        tagged = rows.select(
            *[F.coalesce(f, F.lit("")).alias(f) for f in fields], F.lit(source).alias("_source")
        )
        every = tagged if every is None else every.unionByName(tagged)
    return every


def document_to_lines(spark: SparkSession, path, output: str, field: str | None = "results") -> None:
    """Turn documents, one object with an array of records each or one array, into JSON lines.

    A document is read in byte ranges by many tasks; line breaks inside a record become blanks.
    """
    records = document_records(spark, path, field)
    # Raw line breaks can only stand between tokens.
    lines = records.select(F.regexp_replace("record", r"[\r\n]+", " ").alias("value"))
    lines.write.mode("overwrite").text(output)


def with_recall_date(recalls: DataFrame, text: str = "recall_initiation_date") -> DataFrame:
    """Add ``recall_date``; an unreadable date is null."""
    return recalls.withColumn("recall_date", coerced_date(text, "yyyyMMdd"))


def read_mapping(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """The name-to-facility mapping as rows (source, name, fei, score).

    ``kind="document"`` reads the nested JSON form {source: {name: {fei}}}, which is one object.
    """
    if kind != "document":
        return read_table(spark, path, schemas.MATCHES, kind)
    parsed = spark.read.text(path, wholetext=True).select(
        F.from_json("value", schemas.MATCH_DOCUMENT).alias("m")
    )
    return (
        parsed.select(F.explode("m").alias("source", "names"))
        .select("source", F.explode("names").alias("name", "m"))
        .select("source", "name", "m.fei", "m.score")
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table."""
    return spark.read.parquet(path)
