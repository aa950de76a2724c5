"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates that give each source
its target number of words, those closest in relative entropy (weighted by words) to one copy each are
exponentially tilted: ``rate = exp(dual * feature)`` with one dual variable per source. Newton's
method on the convex dual needs two sums per source and step. They are taken over the table of
(source, size, number of documents), which holds all that the dual depends on.

Rates become whole copies source by source, in blocks of a bounded number of documents, the largest
first: what rounding leaves over is carried on to the next document, so a block misses its words by
about half of its smallest document.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetrail.llm.common import word_count
from vetrail.session import materialized

#: Weights given to the sources in code point order, repeating.
CYCLE = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
BLOCK_ROWS = 2000


def capped_targets(
    sources: DataFrame,
    total: Column,
    weight: Column,
    cap: float = CAP,
    share: float = SHARE,
) -> DataFrame:
    """Add ``target`` to one row per source: shares by weight, none above ``cap`` times its size.

    In the order of ``cap * size / weight`` the sources that stop at their cap come first. A source
    stops if what is left for it and all later ones, shared by weight, is above its cap. Sources of
    size 0 get 0. ``sources`` has a row per source, ``total`` its size.
    """
    rows = sources.withColumns({"_limit": F.lit(cap) * total, "_weight": weight})
    # One row per source: few rows, whatever the number of documents.
    order = Window.orderBy((F.col("_limit") / F.col("_weight")).asc(), F.col("_rank").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_left": F.sum(total).over(Window.partitionBy()) * share
            - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)),
            "_weights": F.sum("_weight").over(Window.partitionBy())
            - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)),
        }
    ).withColumn("_price", F.col("_left") / F.col("_weights"))
    rows = rows.withColumn("_stops", F.col("_price") * F.col("_weight") > F.col("_limit"))
    price = F.min(F.when(~F.col("_stops"), F.struct("_place", "_price"))).over(Window.partitionBy())
    rows = rows.withColumn("_place", F.row_number().over(order)).withColumn("_at", price)
    return rows.withColumn(
        "target",
        F.when(
            F.col("_at").isNull() | (F.col("_place") < F.col("_at._place")), F.col("_limit")
        ).otherwise(F.least(F.col("_at._price") * F.col("_weight"), F.col("_limit"))),
    ).drop("_limit", "_weight", "_left", "_weights", "_price", "_stops", "_place", "_at")


def source_targets(documents: DataFrame, source: str, size: str) -> DataFrame:
    """(source, source_size, target): weights 5, 2, 1 repeating in code point order, null last."""
    totals = documents.groupBy(source).agg(F.sum(size).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    ranked = totals.withColumn("_rank", rank)
    weights = F.array(*[F.lit(w) for w in CYCLE])
    weight = F.element_at(weights, (F.col("_rank") % len(CYCLE) + 1).cast("int"))
    return capped_targets(ranked, F.col("source_size").cast("double"), weight).drop("_rank")


def tilted_rates(
    sizes: DataFrame, source: str, size: str, count: str, tolerance: float = 1e-10, steps: int = 50
) -> DataFrame:
    """Newton iterations on the dual; returns one row per source with its ``rate``.

    ``sizes`` has (source, size, count, target). The dual of source s is
    ``sum(words * exp(dual)) - dual * target``; its gradient and second derivative are sums over the
    source's sizes. A step that would raise the dual is avoided by starting above the optimum, where
    the function is convex and Newton's steps fall monotonically. A target of 0 gives rate 0.
    """
    key = F.coalesce(F.col(source), F.lit(""))
    state = (
        sizes.groupBy(source)
        .agg(F.first("target").alias("target"), F.sum(F.col(size) * F.col(count)).alias("_words"))
        .withColumn("dual", F.lit(math.log(CAP) + 0.1))
        .withColumn("_key", key)
        .select(source, "_key", F.col(source).isNull().alias("_none"), "target", "dual")
    )
    state = materialized(state)
    keyed = sizes.withColumns({"_key": key, "_none": F.col(source).isNull()})
    for _ in range(steps):
        sums = (
            keyed.join(state.select("_key", "_none", "dual"), ["_key", "_none"])
            .groupBy("_key", "_none")
            .agg(F.sum(F.col(size) * F.col(count) * F.exp("dual")).alias("_mass"))
        )
        state = materialized(
            state.join(sums, ["_key", "_none"]).select(
                source,
                "_key",
                "_none",
                "target",
                F.when(
                    (F.col("target") > 0) & (F.col("_mass") > 0),
                    F.col("dual") - (F.col("_mass") - F.col("target")) / F.col("_mass"),
                )
                .otherwise(F.col("dual"))
                .alias("dual"),
                F.when(
                    (F.col("target") > 0) & (F.col("_mass") > 0),
                    F.abs(F.col("_mass") / F.col("target") - 1),
                )
                .otherwise(0.0)
                .alias("_off"),
            )
        )
        if (state.agg(F.max("_off")).first()[0] or 0.0) < tolerance:
            break
    # Nine places: the order of summation must not decide how a rate is rounded to copies.
    rate = F.when(F.col("target") > 0, F.least(F.round(F.exp("dual"), 9), F.lit(CAP))).otherwise(0.0)
    return state.select("_key", "_none", rate.alias("rate"))


def mix_sources(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: id, size, source_size, target, rate, copies, taken.

    Size is the number of words; null text has size 0 and gets no copies. A null source is a source
    of its own. Repeated ids are documents of their own. An empty table gives an empty result. Other
    columns are not read. The result depends on the rows only, not on their order or partitions.
    """
    sized = documents.select(
        F.col(id_column).alias("_id"),
        F.col(source).alias("_source"),
        word_count(text).alias("_size"),
        F.xxhash64(text).alias("_tie"),
    )
    sized = materialized(
        sized.groupBy("_id", "_source", "_size", "_tie").agg(F.count("*").alias("_repeat"))
    )
    rows = sized.select("_source", (F.col("_size")).alias("_size"), "_repeat")
    histogram = rows.groupBy("_source", "_size").agg(F.sum("_repeat").alias("_count"))
    words = histogram.select("_source", (F.col("_size") * F.col("_count")).alias("_words"), "_count")
    targets = materialized(
        source_targets(words, "_source", "_words")
        .join(
            words.groupBy(F.col("_source").alias("_other")).agg(F.sum("_count").alias("_rows")),
            F.col("_source").eqNullSafe(F.col("_other")),
        )
        .drop("_other")
    )
    with_targets = histogram.join(
        targets.select(F.col("_source").alias("_other"), "target"),
        F.col("_source").eqNullSafe(F.col("_other")),
    ).drop("_other")
    rates = tilted_rates(with_targets, "_source", "_size", "_count")
    plan = materialized(
        targets.withColumns(
            {
                "_key": F.coalesce(F.col("_source"), F.lit("")),
                "_none": F.col("_source").isNull(),
            }
        )
        .join(rates, ["_key", "_none"])
        .drop("_source")
    )
    rated = sized.withColumns(
        {"_key": F.coalesce(F.col("_source"), F.lit("")), "_none": F.col("_source").isNull()}
    ).join(plan, ["_key", "_none"])
    # Blocks of about block_rows documents: a hot source is many blocks.
    blocks = F.ceil(F.col("_rows") / F.lit(block_rows))
    rated = rated.withColumn(
        "_block", F.pmod(F.xxhash64("_id", "_tie"), F.greatest(blocks, F.lit(1)))
    )
    # A repeated row counts once in the scan, with all its repeats.
    scan = rated.groupBy("_key", "_none", "_block").applyInPandas(
        _scan_block,
        "_id long, _source string, _size long, _repeat long, source_size long, target double, "
        "rate double, copies array<int>",
    )
    return scan.select(
        F.col("_id").alias(id_column),
        F.col("_source").alias(source),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "rate",
        F.explode("copies").alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col("size"))


def _scan_block(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["_size", "_id", "_tie"], ascending=[False, True, True], kind="stable")
    carried, all_copies = 0.0, []
    for n, rate, repeat in zip(block["_size"].tolist(), block["rate"].tolist(), block["_repeat"].tolist()):
        own = []
        for _ in range(repeat):
            carried += rate * n
            taken = min(int(CAP), max(0, math.floor(carried / n + 0.5))) if n else 0
            carried -= taken * n
            own.append(taken)
        all_copies.append(own)
    block["copies"] = all_copies
    return block[["_id", "_source", "_size", "_repeat", "source_size", "target", "rate", "copies"]]
