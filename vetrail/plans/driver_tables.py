"""The star-schema test tables in the roles of the inspection data.

Customers are facilities, orders inspections, line items citations and side events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.columns import EventColumns, Outcomes
from vetrail.operators.clean import with_outcome_flags
from vetrail.operators.detail import detail_counts, with_detail_counts
from vetrail.operators.history import SideEvents, feature_table, side_sources

ORDERS = EventColumns(
    entity="o_custkey",
    event_id="o_orderkey",
    date="o_date",
    outcome="o_orderstatus",
    area="o_orderpriority",
    kind="c_mktsegment",
    country="n_name",
)
STATUSES = Outcomes(oai="F", vai="P", nai="O")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with flags, market segment and nation of the customer."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("o_date"),
        "o_orderstatus",
        "o_orderpriority",
    )
    return with_outcome_flags(orders.join(customer, "o_custkey", "left"), "o_orderstatus", STATUSES)


def counted_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line-item counts."""
    counts = detail_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    return with_detail_counts(inspections(spark, sf_dir), counts, "o_orderkey")


def shipped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey",
            "l_returnflag",
            "l_linestatus",
            F.col("l_shipdate").cast("date").alias("l_date"),
        )
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def _kinds() -> tuple[Column, Column, Column]:
    """Which items play letters, recalls and forms."""
    flag = F.col("l_returnflag")
    return flag == "R", flag == "A", (flag == "N") & (F.col("o_orderstatus") == "O")


def side_tables(spark: SparkSession, sf_dir: str) -> list[SideEvents]:
    """Returned items as letters, accepted ones as recalls, new ones of open orders as forms."""
    items = shipped_items(spark, sf_dir)
    letter, recall, form = _kinds()
    return side_sources(
        letters=items.filter(letter),
        recalls=items.filter(recall),
        forms=items.filter(form),
        entity="o_custkey",
        letter_date="l_date",
        recall_date="l_date",
        recall_class="l_linestatus",
        form_entity="o_custkey",
        form_date="l_date",
        classes=("F", "O"),
    )


def side_events(spark: SparkSession, sf_dir: str) -> list[SideEvents]:
    """The same three kinds out of one scan of the line items."""
    letter, recall, form = _kinds()
    return [
        SideEvents(
            shipped_items(spark, sf_dir).filter(letter | recall | form),
            "o_custkey",
            "l_date",
            {
                "n_warning_letters": letter.cast("int"),
                "n_recalls": recall.cast("int"),
                "n_class_I_recalls": (recall & (F.col("l_linestatus") == "F")).cast("int"),
                "n_class_II_recalls": (recall & (F.col("l_linestatus") == "O")).cast("int"),
                "n_published_483s": form.cast("int"),
            },
            {"days_since_last_wl": letter},
        )
    ]


def features(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The full feature table of the orders."""
    return feature_table(
        counted_inspections(spark, sf_dir),
        side_events(spark, sf_dir),
        ORDERS,
        keys=table(spark, sf_dir, "orders"),
        **options,
    )
