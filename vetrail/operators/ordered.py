"""Running totals and ranks over a whole table without gathering it in one task.

A window without a partition key runs in a single task. Here the rows are range-partitioned on the
order columns, each partition is a block, block totals (one row per partition) are accumulated and
broadcast, and the rest is a window inside each block. Range limits are sampled from the data, so a
crowded part of the range gets as many blocks as it needs. They differ from run to run, so the rows
are written with their block number before it is used twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetrail.session import materialized


def in_blocks(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``_block``, the number of their range partition; blocks follow the order."""
    return materialized(
        rows.repartitionByRange(*order).withColumn("_block", F.spark_partition_id())
    )


def running_totals(
    rows: DataFrame, order: Column, sums: dict[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Add inclusive running sums in an order, and each group's grand total.

    ``sums`` maps an output name to the summed column; ``<name>_all`` is its total. ``by`` names
    grouping columns with few values; inside a group the order must tell the rows apart.
    """
    placed = in_blocks(rows, order, *[F.col(c).asc() for c in by])
    blocks = placed.groupBy(*by, "_block").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    # At most (partitions x groups) rows from here to the broadcast.
    before = (
        Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*by)
    carried = blocks.select(
        *by,
        "_block",
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in sums],
        *[F.sum(f"_{n}").over(whole).alias(f"{n}_all") for n in sums],
    )
    inside = (
        Window.partitionBy(*by, "_block")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(F.broadcast(carried), [*by, "_block"])
        .withColumns({n: F.col(f"_{n}_before") + F.sum(c).over(inside) for n, c in sums.items()})
        .drop("_block", *[f"_{n}_before" for n in sums])
    )


def text_codes(rows: DataFrame, column: str, value: str = "value", code: str = "code") -> DataFrame:
    """Distinct texts of a column with their 0-based rank in text order."""
    distinct = rows.select(F.col(column).alias(value)).distinct().withColumn("_one", F.lit(1))
    ranked = running_totals(distinct, F.col(value).asc(), {"_rank": "_one"})
    return ranked.select(value, (F.col("_rank") - 1).cast("bigint").alias(code))


def broadcast_if_small(table: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only if the table is counted to be small; else leave it to the planner."""
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table
