"""Mixing to several margins at once: sources and shares of words by language, length band or any other column.

Among all rates that meet the targets, those closest in relative entropy (weighted by words) to one copy each are
``exp(a[source] + sum of b[margin value])``: documents of a source differ in rate by what their margins need. Given the
duals ``b`` those of the sources are ``a = log(target / sum of words * exp(b))``, so there may be any number of
sources, and Newton's method runs on ``b`` alone. Its convex function, gradient and full Hessian are sums over
sources, taken from the table of cells (source and margin values, with their words) in buckets of whole
sources; the driver adds a row per bucket. Steps are halved until the function falls far enough. Targets
that cannot be met together have no optimum; they raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import word_count
from vetrail.llm.mixing import BLOCK_ROWS, source_targets
from vetrail.session import materialized, with_package

#: Margin values in all, so that the Hessian is small.
MOST_VALUES = 256
#: Cells that a task holds at a time.
BUCKET_CELLS = 100_000
TOLERANCE = 1e-8
STEPS = 50


def balanced_mix(
    documents: DataFrame,
    shares: dict[str, dict],
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: id, source, the margins, size, source_size, target, rate, copies, taken.

    ``shares`` tells per column the share of the mix's words that each of its values gets (None for null); shares of a column are
    scaled to 1, and values it does not name get none. Sources get the targets of ``mix_sources``; one that has no
    words under the named values gets none, and the shares are of the others' targets. Size is
    the number of words; documents of size 0 get no copies. Repeated ids are documents of their own.
    An empty table gives an empty result. Values that no document has, more than ``MOST_VALUES`` of
    them, shares below 0 and targets that cannot be met together raise a ``ValueError``. Other columns are not read. The result
    depends on the rows only, not on their order or partitions.
    """
    spark = with_package(documents.sparkSession)
    margins = list(shares)
    slots = [(m, value) for m in margins for value, share in shares[m].items() if share]
    if len(slots) > MOST_VALUES:
        raise ValueError(f"{len(slots)} margin values are more than {MOST_VALUES}")
    if any(not share >= 0 or math.isinf(share) for m in margins for share in shares[m].values()):
        raise ValueError("shares are finite and not below 0")
    places = [f"_m{k}" for k in range(len(margins))]

    def place(margin: str):
        """Number of the row's value among the slots; -1 for values without a share."""
        out = F.lit(-1)
        for k, (m, value) in enumerate(slots):
            if m == margin:
                out = F.when(F.col(margin).eqNullSafe(F.lit(value)), k).otherwise(out)
        return out

    rows = documents.select(
        F.col(id_column).alias("_id"),
        F.col(source).alias("_source"),
        word_count(text).alias("_size"),
        F.xxhash64(text).alias("_tie"),
        *[place(m).alias(p) for m, p in zip(margins, places)],
        *[F.col(m).alias(f"_v{k}") for k, m in enumerate(margins)],
    )
    rows = materialized(rows)
    cells = rows.groupBy("_source", *places).agg(F.sum("_size").alias("_words"), F.count("*").alias("_rows"))
    cells = materialized(cells)
    targets = materialized(source_targets(cells, "_source", "_words"))
    joined = cells.join(targets.withColumnRenamed("_source", "_other"), F.col("_source").eqNullSafe(F.col("_other")))
    joined = materialized(joined.drop("_other"))
    open_ = joined.filter((F.col("_words") > 0) & (F.col("target") > 0))
    for p in places:
        open_ = open_.filter(F.col(p) >= 0)
    open_ = materialized(open_.select("_source", "_words", "target", *places))

    least = open_.agg(F.count("*"), F.array(*[F.collect_set(p) for p in places]) if places else F.lit(None)).first()
    if least[0] and set(range(len(slots))) - {k for seen in least[1] or [] for k in seen}:
        raise ValueError("no document has a margin value that a share is given for")
    duals = _newton(open_, slots, shares, places) if least[0] else np.zeros(len(slots))
    lookup = F.array(*[F.lit(float(b)) for b in duals]) if slots else None
    tilt = F.lit(0.0)
    for p in places:
        tilt = tilt + F.element_at(lookup, F.greatest(F.col(p), F.lit(0)) + 1)
    sums = open_.groupBy("_source").agg(F.sum(F.col("_words") * F.exp(tilt)).alias("_mass"))
    excluded = F.lit(False)
    for p in places:
        excluded |= F.col(p) < 0
    rated = joined.join(sums.withColumnRenamed("_source", "_other"), F.col("_source").eqNullSafe(F.col("_other")), "left")
    # Nine places: the order of summation must not decide how a rate is rounded to copies.
    rate = F.round(F.col("target") / F.col("_mass") * F.exp(tilt), 9)
    rated = rated.withColumn("rate", F.when(excluded | (F.col("_words") == 0), 0.0).otherwise(F.coalesce(rate, F.lit(0.0))))
    plan = materialized(rated.select("_source", *places, "_rows", "source_size", "target", "rate"))

    same = F.col("_source").eqNullSafe(F.col("_other"))
    plan = plan.withColumnRenamed("_source", "_other")
    for p in places:
        plan = plan.withColumnRenamed(p, f"{p}_of_plan")
        same &= F.col(p) == F.col(f"{p}_of_plan")
    blocks = F.greatest(F.ceil(F.col("_rows") / F.lit(block_rows)), F.lit(1))
    dealt = rows.join(plan, same).withColumn("_block", F.pmod(F.xxhash64("_id", "_tie"), blocks))
    values = [f"_v{k}" for k in range(len(margins))]
    kept = ["_id", "_source", *values, "_size", "source_size", "target", "rate"]
    types = {f.name: f.dataType.simpleString() for f in dealt.schema}
    # A row that is repeated is one row with a count, so that its repeats do not make a large group.
    counted = dealt.groupBy(*kept, "_tie", "_block", *places).agg(F.count("*").alias("_repeat"))
    copies = counted.groupBy("_source", *places, "_block").applyInPandas(
        _round_block(kept), ", ".join(f"`{c}` {types[c]}" for c in kept) + ", copies long, _repeat long"
    )
    copies = copies.withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("_repeat"))))
    return copies.select(
        F.col("_id").alias(id_column),
        F.col("_source").alias(source),
        *[F.col(v).alias(m) for v, m in zip(values, margins)],
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("_size")).alias("taken"),
    )


def _newton(cells: DataFrame, slots: list, shares: dict[str, dict], places: list[str]) -> np.ndarray:
    """Duals of the margin values."""
    n = len(slots)
    if not n:
        return np.zeros(0)
    buckets = -(-cells.count() // BUCKET_CELLS)
    cells = materialized(cells.withColumn("_bucket", F.pmod(F.xxhash64("_source"), F.lit(buckets)).cast("int")))
    total = cells.select("_source", "target").distinct().agg(F.sum("target")).first()[0]
    goal = np.array([total * shares[m][v] / sum(shares[m].values()) for m, v in slots])

    def sums(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        rows = cells.groupBy("_bucket").applyInPandas(
            _bucket_sums(b, places), "_bucket int, value double, gradient array<double>, hessian array<double>"
        )
        parts = rows.orderBy("_bucket").collect()  # a row of at most 256 * 257 sums for 100,000 cells
        value = math.fsum(r["value"] for r in parts) - float(goal @ b)
        gradient = np.sum([r["gradient"] for r in parts], axis=0) - goal
        return value, gradient, np.sum([r["hessian"] for r in parts], axis=0).reshape(n, n)

    b = np.zeros(n)
    value, gradient, hessian = sums(b)
    for _ in range(STEPS):
        if np.abs(gradient).max() <= TOLERANCE * total:
            return b
        # Values of a margin may all be raised alike without any effect: the shortest step is taken.
        step = -np.linalg.lstsq(hessian, gradient, rcond=1e-10)[0]
        slope, length = float(gradient @ step), 1.0
        while length > 1e-6:
            trial = sums(b + length * step)
            if trial[0] <= value + 1e-4 * length * slope + 1e-13 * abs(value):
                break
            length /= 2
        else:
            break
        b, (value, gradient, hessian) = b + length * step, trial
    if np.abs(gradient).max() <= TOLERANCE * total:
        return b
    off = max(range(n), key=lambda k: abs(gradient[k]))
    raise ValueError(f"the targets cannot be met together: {slots[off]} is off by {gradient[off]:.6g} words of {goal[off]:.6g}")


def _bucket_sums(b: np.ndarray, places: list[str]):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        # Null sources are one source; an order of the cells makes reruns add up alike.
        cells = cells.sort_values(["_source", *places], kind="stable")
        at = cells[places].to_numpy(np.int64)
        key = cells["_source"].isna().to_numpy().astype(np.int64) * -1
        key[key == 0] = pd.factorize(cells["_source"])[0][key == 0]
        _, which = np.unique(key, return_inverse=True)
        target = np.zeros(which.max() + 1)
        target[which] = cells["target"].to_numpy(float)
        tilt = b[at].sum(axis=1)
        top = np.full(len(target), -np.inf)
        np.maximum.at(top, which, tilt)
        mass = cells["_words"].to_numpy(float) * np.exp(tilt - top[which])
        whole = np.bincount(which, mass)
        weight = target[which] * mass / whole[which]
        value = float(target @ (top + np.log(whole)))
        hessian = np.zeros((len(b), len(b)))
        for k in range(at.shape[1]):
            for j in range(at.shape[1]):
                np.add.at(hessian, (at[:, k], at[:, j]), weight)
        gradient = np.diag(hessian).copy()
        # Less the product of the source's own sums, source by source.
        own = np.zeros((min(len(target), 1024), len(b)))
        for s in range(0, len(target), len(own)):
            own[:] = 0
            inside = (which >= s) & (which < s + len(own))
            for k in range(at.shape[1]):
                np.add.at(own, (which[inside] - s, at[inside, k]), weight[inside])
            part = target[s : s + len(own)]
            hessian -= own[: len(part)].T @ (own[: len(part)] / part[:, None])
        return pd.DataFrame(
            {
                "_bucket": [int(cells["_bucket"].iloc[0])],
                "value": [value],
                "gradient": [gradient.tolist()],
                "hessian": [hessian.ravel().tolist()],
            }
        )

    return run


def _round_block(kept: list[str]):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        """Whole copies, the largest documents first; what rounding leaves over goes to the next one."""
        block = block.sort_values(["_size", "_id", "_tie"], ascending=[False, True, True], kind="stable")
        carried, at, copies, repeats = 0.0, [], [], []
        for row, (n, rate, repeat) in enumerate(zip(*(block[c].tolist() for c in ("_size", "rate", "_repeat")))):
            # Of a row's repeats some get one copy more than the others: two counts, however many repeats there are.
            wanted = max(0, math.floor((carried + rate * n * repeat) / n + 0.5)) if n else 0
            carried += rate * n * repeat - wanted * n
            low, more = divmod(wanted, repeat)
            for count, times in ((low + 1, more), (low, repeat - more)):
                if times:
                    at.append(row)
                    copies.append(count)
                    repeats.append(times)
        out = block[kept].iloc[at].reset_index(drop=True)
        return out.assign(copies=copies, _repeat=repeats)

    return run
