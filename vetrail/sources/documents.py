"""Large JSON documents as rows, read by many tasks: one object with an array of records, or one array.

Spark reads a document in byte ranges and cuts it at every closing brace, whether or not it ends an object. What a
fragment does to the state of a parser depends only on whether it starts inside a string: so each is summed up for both
cases (quotes, braces and brackets opened and closed). Running sums over the fragments, by byte range and then
inside each range, tell where strings are open and how deep a fragment lies. Records end where the depth
returns to that of their array; the fragments of a record are put together by their place in the document.

No task sees more than a byte range and single records. A backslash never stands before a closing brace in valid
JSON, so no escape spans two fragments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetrail.session import materialized

_PLACE = ["file", "block", "n"]


def _fragments(spark: SparkSession, path) -> DataFrame:
    """(file, block, n, value): text between closing braces, with its byte range and place in it; written once."""
    rows = spark.read.option("lineSep", "}").text(path)
    placed = rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), "value",
    )
    return materialized(placed)


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _outside(text: Column) -> Column:
    """What lies outside strings, of a text that starts outside of one."""
    return F.array_join(F.filter(F.split(F.regexp_replace(text, r"(?s)\\.", ""), '"'), lambda _, i: i % 2 == 0), "")


def _dip(plain: Column) -> Column:
    """How far below its start the number of open brackets falls (0 or less)."""
    steps = F.split(F.regexp_replace(plain, r"[^\[\]]+", ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("least"))

    def step(found: Column, sign: Column) -> Column:
        now = found["now"] + (sign == "[").cast("int") - (sign == "]").cast("int")
        return F.struct(now.alias("now"), F.least(found["least"], now).alias("least"))

    return F.aggregate(steps, start, step)["least"]


def _before(rows: DataFrame, *sums: str) -> DataFrame:
    """Add ``<name>_before``: the sum over all earlier fragments of the file."""
    # One row per byte range of a file.
    blocks = rows.groupBy("file", "block").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "file", "block", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in sums]
    )
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(carried, ["file", "block"]).withColumns(
        {f"{c}_before": F.col(f"_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums}
    ).drop(*[f"_{c}" for c in sums])


def _with_depths(fragments: DataFrame) -> DataFrame:
    """Add ``braces`` and ``brackets``: open ones ahead of a fragment; ``*_after`` behind it; ``lowest``: fewest brackets
    open in it; ``string``: it ends in a string."""
    pieces = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    # Only the number of quotes goes through the shuffle beside the text: the pieces are several times as large.
    rows = _before(fragments.withColumn("quotes", F.size(pieces) - 1), "quotes").withColumn("_pieces", pieces)
    # Pieces between quotes are in turn outside and inside strings.
    even = F.array_join(F.filter("_pieces", lambda _, i: i % 2 == 0), "")
    odd = F.array_join(F.filter("_pieces", lambda _, i: i % 2 == 1), "")
    plain = F.when(F.col("quotes_before") % 2 == 0, even).otherwise(odd)
    string = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    rows = rows.select(*_PLACE, "value", plain.alias("_plain"), string.alias("string"))
    rows = rows.withColumns(
        {
            "brace": _count(F.col("_plain"), "{") - F.when(F.col("string"), 0).otherwise(1),
            "bracket": _count(F.col("_plain"), "[") - _count(F.col("_plain"), "]"),
            "dip": _dip(F.col("_plain")),
        }
    )
    rows = _before(rows, "brace", "bracket")
    return rows.select(
        *_PLACE, "value", "string",
        F.col("brace_before").alias("braces"), F.col("bracket_before").alias("brackets"),
        (F.col("brace_before") + F.col("brace")).alias("braces_after"),
        (F.col("bracket_before") + F.col("bracket")).alias("brackets_after"),
        (F.col("bracket_before") + F.col("dip")).alias("lowest"),
    )


def document_records(spark: SparkSession, path, field: str | None = "results") -> DataFrame:
    """(file, record): the text of every object in the array ``field`` of each document, or of a document that is an array.

    Files are documents of their own. Elements that are no objects are left out, as are documents without the field.
    Byte ranges follow ``spark.sql.files.maxPartitionBytes``.
    """
    deep = _with_depths(_fragments(spark, path))
    outer = 0 if field is None else 1
    if field is None:
        opening = r"(?s)^\s*\[(.*)$"
    else:
        opening = rf'(?s)(?<!\\)"\Q{field}\E"\s*:\s*\[(.*)$'
    head = F.regexp_extract("value", opening, 1)
    own = _outside(F.substring("value", F.lit(1), F.length("value") - F.length(head)))
    # The array opens at the top of its document: no brace but the outer one is open there, and only its own bracket.
    top = F.col("value").rlike(opening) & (F.col("braces") + _count(own, "{") == outer)
    top &= F.col("brackets") + _count(own, "[") - _count(own, "]") == 1
    marked = deep.withColumns({"head": F.when(top, head), "place": F.struct("block", "n")})
    # One row per document: where its array opens, and the first fragment in which it is closed.
    opened = marked.filter(F.col("head").isNotNull()).groupBy("file").agg(F.min("place").alias("first"))
    inside = marked.join(opened, "file").filter(F.col("place") >= F.col("first"))
    lowest = F.when(F.col("place") == F.col("first"), 1 + _dip(_outside(F.col("head")))).otherwise(F.col("lowest"))
    closed = inside.filter(lowest <= 0).groupBy("file").agg(F.min("place").alias("last"))
    inside = inside.join(closed, "file", "left").filter(F.col("last").isNull() | (F.col("place") < F.col("last")))
    ends = ~F.col("string") & (F.col("braces_after") == outer) & (F.col("brackets_after") == 1)
    inside = inside.withColumn("end", ends.cast("int"))
    numbered = _before(inside, "end")
    text = F.when(F.col("place") == F.col("first"), F.col("head")).otherwise(F.col("value"))
    records = numbered.groupBy("file", "end_before").agg(
        F.max("end").alias("whole"),
        F.array_sort(F.collect_list(F.struct("place", text.alias("text")))).alias("parts"),
    ).filter("whole = 1")
    joined = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    return records.select("file", joined.alias("text")).select(
        "file", F.substring("text", F.instr("text", "{"), F.length("text")).alias("record")
    )
