"""Gradient-boosted trees of second order on binned features, many models in the same scans.

Rows are binned once by quantiles and kept in blocks: bins feature by feature, the label, the day, a hash for
drawing, and a margin per model. A scan brings, for every open model, the sums of gradient and hessian per (node,
feature, bin). Of two sibling nodes only the one with the smaller hessian is counted; the other is the parent
less that one. A split's gain is GL²/(HL+l2) + GR²/(HR+l2) - G²/(H+l2); it must exceed ``min_gain``, and both
sides need a hessian of ``min_weight``. Rows and features are drawn per tree.

Gradients are whole multiples of a small unit, so sums are exact: the trees do not depend on how
rows are dealt, and a lost task repeats its part exactly. Partial sums of tasks are added by a shuffle over (model, node),
and the driver gets one sum per node; partial sums of few bytes are added on the driver. A fit sends it at most
``DRIVER_BYTES`` of sums; beyond, and for many models, the splits are chosen where the sums are added.

A table of few bytes goes to the tasks whole, and each task fits one model; no step of it needs a job. Larger tables are scanned:
a scan of many models is dealt over (lane of models, range of rows): each range of rows costs one partial sum per node.

Margins of few models move forward with every tree and are cached; every few trees a new table of blocks is written, which
cuts the lineage. Models stop once
the average precision on watched rows has not improved for ``patience`` rounds; the scores of all
rounds since the last look come from one pass, as arrays in ranges of scores, and a task sums a round range by range.
"""

from __future__ import annotations

import json
import math
import pickle
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.operators.ordered import running_totals
from vetrail.operators.score import with_absent_as_zero
from vetrail.session import materialized, with_package

BINS = 64
BLOCK_ROWS = 8192
#: Rows that are worth a partition of their own; beyond ``spark.sql.shuffle.partitions`` partitions grow instead.
PARTITION_ROWS = 4096
#: Trees between two written tables of margins (of few and of many models), and between two looks at the watched rows.
_ADVANCE, _ADVANCE_MANY, _MANY, _LOOK = 10, 2, 8, 10
#: Sums that a fit sends to the driver in all, and those of one scan; partial sums are sent without a shuffle while few.
DRIVER_BYTES, SUM_BYTES, DIRECT_BYTES = 512 << 20, 4 << 20, 16 << 20
#: Sums that one task holds at a time, in bytes; further models are counted by other tasks.
TASK_BYTES = 128 << 20
#: Rows of a range, where many models are counted: more ranges leave less for lanes of models.
RANGE_ROWS = 1 << 20
_UNIT_BITS = 24
#: Nodes whose sums travel together.
_GROUP = 16
#: Cells of columns that are counted together; they are numbered in a byte.
_CELLS = 256
#: Rows whose sums of units are whole numbers below 2^53.
_EXACT_ROWS = 1 << 28
#: Rows of a block where a task holds all rows, and tables of how many times ``DIRECT_BYTES`` are told to the tasks whole.
_HELD_ROWS, _WHOLE = 32768, 4
#: Watched rows whose scores a task sorts at a time.
LOOK_ROWS = 1 << 22
_DAYS = (-(1 << 30), 1 << 30)


@dataclass(frozen=True)
class Spec:
    """How one model is fitted: on rows of a part and a range of days since 1970 (end excluded), watching others."""

    trees: int = 300
    depth: int = 6
    rate: float = 0.1
    min_weight: float = 1.0
    l2: float = 1.0
    min_gain: float = 0.0
    subsample: float = 1.0
    feature_share: float = 1.0
    positive_weight: float = 1.0
    seed: int = 42
    patience: int = 20
    fit: tuple[int, int] = _DAYS
    watch: tuple[int, int] | None = None
    part: int = 0
    watch_part: int = 0
    without: tuple[int, ...] = ()  # features that are not used

    @property
    def unit(self) -> float:
        return 2.0 ** (_UNIT_BITS - max(0, math.ceil(math.log2(max(1.0, self.positive_weight)))))

    def columns(self, n: int, tree: int) -> np.ndarray:
        """The features a tree may use."""
        usable = np.setdiff1d(np.arange(n), self.without)
        k = max(1, int(self.feature_share * len(usable)))
        return np.sort(np.random.default_rng([self.seed, tree]).permutation(usable)[:k])

    def drawn(self, draw: np.ndarray, tree: int) -> np.ndarray:
        """Which rows a tree is fitted on, by their hash; equal rows share their fate."""
        if self.subsample >= 1:
            return np.ones(len(draw), bool)
        salt = np.uint64((self.seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = draw.view(np.uint64) ^ salt
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x >> np.uint64(11)) * 2.0**-53 < self.subsample


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2i+1 and 2i+2. A node without a feature (-1) is a leaf."""

    feature: np.ndarray
    cut: np.ndarray  # the last bin that goes left
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.zeros(n))

    def places(self, goes_right: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], n: int) -> np.ndarray:
        """The node that each of n rows ends in."""
        at, rows = np.zeros(n, np.int32), np.arange(n)
        while len(rows):
            node = at[rows]
            inner = self.feature[node] >= 0
            rows, node = rows[inner], node[inner]
            at[rows] = 2 * node + 1 + goes_right(self.feature[node], node, rows)
        return at


@dataclass
class BoostedTrees:
    """A fitted model: ``thresholds`` are on the features' own scale; a row goes left where its value is below."""

    features: list[str]
    base: float
    trees: list[Tree]
    thresholds: list[np.ndarray]
    spec: Spec
    #: Average precision on the watched rows after each round, where there were any.
    history: list[float | None] = field(default_factory=list)

    @property
    def expected(self) -> float:
        """Margin expected over the fitted rows, by the covers of the leaves."""
        return self.base + sum(expected_value(t) for t in self.trees)

    def leaves(self, t: int, x: np.ndarray) -> np.ndarray:
        tree, cuts = self.trees[t], self.thresholds[t]
        return tree.places(lambda f, node, rows: x[rows, f] >= cuts[node], len(x))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margins of rows of feature values (rows, features)."""
        out = np.full(len(x), self.base)
        for t, tree in enumerate(self.trees):
            out += tree.value[self.leaves(t, x)]
        return out

    def importance(self) -> np.ndarray:
        """Share of each feature in the mean gain of its splits, as the original ranks features; sums to 1."""
        gains, n = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(gains, tree.feature[inner], tree.gain[inner])
            np.add.at(n, tree.feature[inner], 1)
        mean = gains / np.maximum(n, 1)
        return mean / mean.sum() if mean.sum() else mean

    def nodes(self) -> Iterator[tuple]:
        """(tree, node, feature, threshold, value, cover, gain) of the nodes that rows can reach."""
        for t, (tree, cuts) in enumerate(zip(self.trees, self.thresholds)):
            reached = [0]
            for node in reached:
                f = int(tree.feature[node])
                cut = float(cuts[node]) if f >= 0 else None
                yield t, node, f, cut, float(tree.value[node]), float(tree.cover[node]), float(tree.gain[node])
                if f >= 0:
                    reached += [2 * node + 1, 2 * node + 2]


def expected_value(tree: Tree) -> float:
    """The leaves' values weighed by their share of the root's cover."""
    total, open_ = 0.0, [(0, 1.0)]
    while open_:
        node, share = open_.pop()
        if tree.feature[node] < 0:
            total += share * tree.value[node]
            continue
        for child in (2 * node + 1, 2 * node + 2):
            open_.append((child, share * tree.cover[child] / tree.cover[node]))
    return total


# --- binned rows --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Binned:
    """Rows in blocks, and per feature the ascending values at which bins begin (bin 0 lies below the first)."""

    blocks: DataFrame
    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    target: str

    @property
    def widths(self) -> list[int]:
        """Bins of each feature."""
        return [1 + len(e) for e in self.edges]


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> tuple[np.ndarray, ...]:
    """Values at the quantiles of each feature, without the smallest value; the driver gets bins x features numbers.

    The i-th one is the value at rank ceil(i / bins x rows). Ranks come from running counts over the distinct values of
    all features; no task merges the values of a feature.
    """
    if not features:
        return ()
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value")) for i, c in enumerate(features)])
    counts = rows.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias("n"))
    steps = running_totals(counts, F.col("value").asc(), {"upto": "n"}, ["feature"])
    upto, every = F.col("upto"), F.col("upto_all")
    before = upto - F.col("n")
    # Few values pass the cheap test, which lets through a little too much.
    near = F.floor(upto * bins / every + 1e-6) > F.floor(before * bins / every - 1e-6)
    ranks = F.transform(F.array(*[F.lit(i / bins) for i in range(1, bins)]), lambda p: F.ceil(p * every))
    found = steps.filter((before > 0) & near).filter(F.exists(ranks, lambda r: (r > before) & (r <= upto)))
    values: list[list[float]] = [[] for _ in features]
    for r in found.select("feature", "value").collect():
        if not math.isnan(r["value"]):
            values[r["feature"]].append(r["value"])
    return tuple(np.array(sorted(v), np.float64) for v in values)


def binned(
    rows: DataFrame, features: Sequence[str], target: str, date: str | None = None, part: str | Column | None = None,
    bins: int = BINS, edges: tuple[np.ndarray, ...] | None = None, partition_rows: int = PARTITION_ROWS,
) -> Binned:
    """Bin rows once for any number of fits: features as doubles, absent values 0, rows without a target left out.

    ``part`` numbers groups of rows that are kept apart (fitted, watched); days come from ``date``, and rows without one
    are in no range of days.
    """
    spark = with_package(rows.sparkSession)
    numeric = [F.col(c).cast("double").alias(c) for c in features]
    part = F.lit(0) if part is None else F.col(part) if isinstance(part, str) else part
    day = F.unix_date(F.col(date).cast("date")) if date else F.lit(0)
    table = with_absent_as_zero(rows, features).filter(F.col(target).isNotNull()).select(
        *numeric, F.col(target).cast("int").alias("_y"), F.coalesce(day, F.lit(_DAYS[0] - 1)).alias("_day"),
        part.cast("int").alias("_part"),
    )
    table = table.withColumn("_draw", F.xxhash64(*features, "_y", "_day")).select(
        F.array(*features).alias("_x"), "_y", "_day", "_part", "_draw", *features
    )
    if edges is None:
        edges = bin_edges(table, features, bins)
    if max((len(e) for e in edges), default=0) > 255:
        raise ValueError("at most 256 bins")
    n_features = len(features)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
            bins = np.stack([np.searchsorted(e, x[:, f], "right").astype(np.uint8) for f, e in enumerate(edges)])
            y, day, parts, draw = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            for part in np.unique(parts):
                own = np.flatnonzero(parts == part)
                for at in np.array_split(own, -(-len(own) // BLOCK_ROWS)):
                    packed = [
                        bins[:, at], y[at].astype(np.uint8), _short(day[at].astype(np.int32)), np.array([part], np.int32),
                        draw[at].astype(np.int64), np.zeros(0),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p.tobytes()], pa.binary()) for p in packed], names=["bins", "y", "day", "part", "draw", "margin"]
                    )

    # Few large partitions would leave cores idle in every scan, many small ones cost each scan their start.
    wanted = max(1, -(-table.count() // partition_rows))
    dealt = table.drop(*features).repartition(min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocks = dealt.mapInArrow(
        cut, "bins binary, y binary, day binary, part binary, draw binary, margin binary"
    )
    return Binned(materialized(blocks), tuple(features), edges, target)


def _short(x: np.ndarray) -> np.ndarray:
    """A column of equal values as one value."""
    return x[:1] if (x == x[0]).all() else x


@dataclass
class _Block:
    """The columns of a block as arrays; part has one value, as has the day where all are equal."""

    bins: np.ndarray
    y: np.ndarray
    day: np.ndarray
    part: np.ndarray
    margin: np.ndarray | None
    draw: np.ndarray | None = None

    @classmethod
    def each(cls, batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator["_Block"]:
        kinds = {"bins": np.uint8, "y": np.uint8, "day": np.int32, "part": np.int32, "draw": np.int64, "margin": np.float64}
        for batch in batches:
            for i in range(batch.num_rows):
                parts = {c: np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in kinds.items() if c in batch.schema.names}
                n = len(parts["y"])
                bins, margin = parts.pop("bins").reshape(n_features, n), parts.pop("margin")
                margin = margin.reshape(-1, n) if margin.size else None
                yield cls(bins, margin=margin, **parts)

    def places(self, tree: Tree, rows: np.ndarray | None = None) -> np.ndarray:
        """The nodes that rows end in. A leaf is its own left child, and no bin is above its cut."""
        rows = np.arange(len(self.y)) if rows is None else rows
        levels = int(np.flatnonzero(tree.feature >= 0).max(initial=-1) + 1).bit_length()
        return self.moved(tree, np.zeros(len(rows), np.int64), rows, levels)

    def moved(self, tree: Tree, at: np.ndarray, rows: np.ndarray, levels: int = 1) -> np.ndarray:
        """The nodes that rows reach from others, some levels on."""
        inner = tree.feature >= 0
        own = np.arange(len(inner))
        left, offset = np.where(inner, 2 * own + 1, own), np.where(inner, tree.feature, 0).astype(np.int64) * len(self.y)
        cut = np.where(inner, tree.cut, 255).astype(np.uint8)
        flat = self.bins.reshape(-1)
        for _ in range(levels):
            right = flat.take(offset.take(at) + rows) > cut.take(at)
            at = left.take(at)
            at += right
        return at

    def only(self, rows: np.ndarray) -> "_Block":
        """Some rows, without margins."""
        day = self.day if len(self.day) < len(self.y) else self.day[rows]
        return _Block(np.ascontiguousarray(self.bins[:, rows]), self.y[rows], day, self.part, None, self.draw[rows])

    def margin_of(self, base: float, slot: int | None, pending: Sequence[Tree], rows: np.ndarray | None = None) -> np.ndarray:
        n = len(self.y) if rows is None else len(rows)
        if slot is None or self.margin is None:
            out = np.full(n, base)
        else:
            out = self.margin[slot].copy() if rows is None else self.margin[slot][rows]
        for tree in pending:
            out += tree.value[self.places(tree, rows)]
        return out

    def of(self, part: int, days: tuple[int, int]) -> np.ndarray:
        fits = (self.part == part) & (self.day >= days[0]) & (self.day < days[1])
        return np.flatnonzero(np.broadcast_to(fits, len(self.y)))


# --- sums and splits ----------------------------------------------------------------------------


def gradients(margin: np.ndarray, y: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the weighted logistic loss, in whole units."""
    p = np.negative(margin)
    np.exp(p, out=p)
    p += 1
    np.divide(1, p, out=p)
    g, h = p - y, 1 - p
    if spec.positive_weight != 1:
        weight = np.where(y > 0, spec.positive_weight, 1.0)
        g *= weight
        p *= weight
    h *= p
    np.maximum(h, 1e-16, out=h)
    for x in (g, h):
        x *= spec.unit
        np.rint(x, out=x)
    return g, h


def packs(columns: np.ndarray, widths: Sequence[int]) -> list[list[int]]:
    """Places among columns that are counted as one, the product of their numbers of bins at most ``_CELLS``."""
    out: list[list[int]] = []
    cells: list[int] = []
    for i in sorted(range(len(columns)), key=lambda i: -widths[columns[i]]):
        own = widths[columns[i]]
        k = next((k for k, c in enumerate(cells) if c * own <= _CELLS), len(out))
        if k == len(out):
            out.append([])
            cells.append(1)
        out[k].append(i)
        cells[k] *= own
    return out


class Histogram:
    """Sums of g and h per (column, slot, bin), exact in 64 bits: columns of few bins are counted together.

    Column by column: what a column needs stays in the cache. g and h are the parts of a complex number, so that a row is
    added once a column; these sums are exact up to ``_EXACT_ROWS`` rows and then carried over to whole numbers.
    """

    def __init__(self, columns: np.ndarray, widths: Sequence[int], slots: int):
        self.columns, self.widths, self.slots = columns, widths, slots
        self.packs = packs(columns, widths)
        self.totals = [np.zeros(slots * math.prod(widths[columns[i]] for i in p), np.complex128) for p in self.packs]
        self.carried = [0] * len(self.packs)
        self.rows = 0

    def add(self, bins: np.ndarray, rows: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        self.rows += len(rows)
        if self.rows > _EXACT_ROWS:
            self.carried = [self._whole(k) for k in range(len(self.packs))]
            for total in self.totals:
                total[:] = 0
            self.rows = len(rows)
        both = np.empty(len(rows), np.complex128)
        both.real, both.imag = g, h
        for pack, total in zip(self.packs, self.totals):
            cell = bins[self.columns[pack[0]]]
            for i in pack[1:]:
                cell = cell * np.uint8(self.widths[self.columns[i]]) + bins[self.columns[i]]  # below 256
            key = slot * (len(total) // self.slots)
            key += cell.take(rows)
            np.add.at(total, key, both)

    def _whole(self, k: int) -> np.ndarray:
        """The sums of a pack so far, (2, slots x cells)."""
        return np.stack([self.totals[k].real, self.totals[k].imag]).astype(np.int64) + self.carried[k]

    def sums(self, n_bins: int) -> np.ndarray:
        """(2, slots, columns, bins)"""
        out = np.zeros((2, self.slots, len(self.columns), n_bins), np.int64)
        for p, pack in enumerate(self.packs):
            cells = self._whole(p).reshape(2, self.slots, *[self.widths[self.columns[i]] for i in pack])
            for k, i in enumerate(pack):
                others = tuple(2 + j for j in range(len(pack)) if j != k)
                out[:, :, i, : self.widths[self.columns[i]]] = cells.sum(axis=others)
        return out


def best_splits(sums: np.ndarray, spec: Spec) -> list[tuple | None]:
    """Per slot (column, bin, gain, left g, left h), or None; of equal gains the first column and bin."""
    g, h = sums[0] / spec.unit, sums[1] / spec.unit
    left_g, left_h = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    all_g, all_h = g[:, :1].sum(2, keepdims=True), h[:, :1].sum(2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    l2 = spec.l2
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
    fits = (left_h >= spec.min_weight) & (right_h >= spec.min_weight) & (left_h > 0) & (right_h > 0)
    gain = np.where(fits & (gain > max(spec.min_gain, 1e-6)), gain, -np.inf).reshape(len(g), -1)
    out: list[tuple | None] = []
    for slot in range(len(g)):
        at = int(gain[slot].argmax()) if gain.shape[1] else 0
        if not gain.shape[1] or gain[slot, at] == -np.inf:
            out.append(None)
            continue
        column, cut = divmod(at, g.shape[2] - 1)
        out.append((column, cut, float(gain[slot, at]), float(left_g[slot, column, cut]), float(left_h[slot, column, cut])))
    return out


@dataclass
class _Growing:
    """A model while it is fitted: what the driver keeps of it."""

    spec: Spec
    base: float
    slot: int | None = None
    done: list[Tree] = field(default_factory=list)
    saved: int = 0  # trees that the margins of the blocks include
    looked: int = 0
    history: list[float | None] = field(default_factory=list)
    open: bool = True
    tree: Tree | None = None
    columns: np.ndarray | None = None
    level: list[int] = field(default_factory=list)
    sums: dict[int, np.ndarray] = field(default_factory=dict)

    def begin(self, n_features: int) -> None:
        self.tree = Tree.empty(self.spec.depth)
        self.columns = self.spec.columns(n_features, len(self.done))
        self.level, self.sums = [0], {}

    def counted(self) -> list[int]:
        """Nodes to count: of two siblings the one of the smaller hessian, if their parents' sums are known."""
        if not self.sums:
            return self.level
        pairs = zip(self.level[::2], self.level[1::2])
        return [a if self.tree.cover[a] <= self.tree.cover[b] else b for a, b in pairs]

    def settle(self, node: int, g: float, h: float) -> None:
        self.tree.cover[node] = h
        self.tree.value[node] = -self.spec.rate * g / (h + self.spec.l2)

    def split(self, node: int, found: tuple | None, g: float, h: float) -> list[int]:
        if node == 0:
            self.settle(0, g, h)
        if found is None:
            return []
        column, cut, gain, left_g, left_h = found
        self.tree.feature[node], self.tree.cut[node], self.tree.gain[node] = self.columns[column], cut, gain
        self.settle(2 * node + 1, left_g, left_h)
        self.settle(2 * node + 2, g - left_g, h - left_h)
        return [2 * node + 1, 2 * node + 2]

    def learn(self, nodes: list[int], counted: np.ndarray) -> dict[int, tuple]:
        """Per node of the level its best split, gradient and hessian; ``counted`` has the sums of the nodes asked."""
        now = {node: counted[:, i] for i, node in enumerate(nodes)}
        for node in nodes if self.sums else ():
            sibling = node + 1 if node % 2 else node - 1
            now[sibling] = self.sums[(node - 1) // 2] - now[node]
        every = np.stack([now[i] for i in self.level], axis=1)
        self.sums = now
        return {n: (b, *t) for n, b, t in zip(self.level, best_splits(every, self.spec), _totals(every, self.spec).T)}

    def descend(self, found: dict[int, tuple]) -> None:
        """Split the nodes of the level as found; their children are the next one."""
        self.level = [c for node in self.level for c in self.split(node, *found[node])]

    @property
    def growing(self) -> bool:
        """Whether the level may be split: a node of the last one is a leaf, its sums known from its parent's split."""
        return bool(self.level) and self.level[0] < (1 << self.spec.depth) - 1

    def add(self) -> None:
        """Keep the tree that has grown."""
        self.done.append(self.tree)
        self.sums = {}
        self.open = len(self.done) < self.spec.trees


def _partial_sums(told: list[tuple], widths: Sequence[int]):
    """A task's sums of the nodes asked, one row per model and group of nodes."""
    n_features, n_bins = len(widths), max(widths, default=1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, Histogram] = {}
        for block in _Block.each(batches, n_features):
            fitted: dict[tuple, np.ndarray] = {}
            for m, spec, base, slot, pending, tree, number, columns, nodes in told:
                if (spec.part, spec.fit) not in fitted:
                    fitted[spec.part, spec.fit] = block.of(spec.part, spec.fit)
                rows = fitted[spec.part, spec.fit]
                if spec.subsample < 1:
                    rows = rows[spec.drawn(block.draw[rows], number)]
                slots = np.full(len(tree.feature), -1)
                slots[nodes] = np.arange(len(nodes))
                mine = slots[block.places(tree, rows)]
                rows, mine = rows[mine >= 0], mine[mine >= 0]
                g, h = gradients(block.margin_of(base, slot, pending, rows), block.y[rows], spec)
                if m not in totals:
                    totals[m] = Histogram(columns, widths, len(nodes))
                totals[m].add(block.bins, rows, mine, g, h)
        model, group, sums = [], [], []
        for m, counted in totals.items():
            total = counted.sums(n_bins)
            for k in range(0, total.shape[1], _GROUP):
                model.append(m)
                group.append(k // _GROUP)
                sums.append(np.ascontiguousarray(total[:, k : k + _GROUP]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(model, pa.int32()), pa.array(group, pa.int32()), pa.array(sums, pa.binary())],
            names=["model", "group", "sums"],
        )

    return count


def _added(parts: Sequence[bytes], columns: int, n_bins: int) -> np.ndarray:
    """Partial sums of a group of nodes added up: (2, nodes, columns, bins)."""
    out = np.frombuffer(parts[0], np.int64).copy()
    for p in parts[1:]:
        out += np.frombuffer(p, np.int64)
    return out.reshape(2, -1, columns, n_bins)


def _totals(sums: np.ndarray, spec: Spec) -> np.ndarray:
    """Gradient and hessian per node: (2, nodes)."""
    return sums[:, :, 0].sum(2) / spec.unit


@dataclass
class _Scans:
    """How a fit deals its scans."""

    cores: int
    partitions: int
    rows: int
    left: int  # bytes of sums that may still be sent to the driver

    def send(self, size: int, reserve: int = 0) -> bool:
        """Whether so many bytes may be sent."""
        fits = size <= self.left - reserve
        self.left -= size if fits else 0
        return fits

    def ranges(self, models: int) -> int:
        """Partitions that a lane reads: all of the blocks for few models."""
        if models <= _MANY:
            return self.partitions
        return min(self.partitions, max(2, -(-self.rows // RANGE_ROWS)))

    def lanes(self, models: list[tuple[int, int]], ranges: int) -> list[list[int]]:
        """Neighbours among (model, bytes) that tasks count together: enough lanes for all cores, bounded sums in each."""
        wanted = max(1, -(-3 * self.cores // ranges)) if ranges < self.partitions else 1
        most = -(-len(models) // wanted)
        out: list[list[int]] = []
        size = 0
        for k, own in models:
            if not out or len(out[-1]) >= most or size + own > TASK_BYTES:
                out.append([])
                size = 0
            out[-1].append(k)
            size += own
        return out


def _lane(blocks: DataFrame, slots: Sequence[int | None], ranges: int) -> tuple[DataFrame, int]:
    """Blocks with only the margins of a lane of models, and the first slot that they hold."""
    known = [s for s in slots if s is not None]
    first, n = (min(known), max(known) - min(known) + 1) if known else (0, 0)
    one = 8 * F.octet_length("y")
    out = blocks.withColumn("margin", F.substring("margin", first * one + 1, n * one))
    return out.coalesce(ranges), first


def _read(blocks: DataFrame, models: Sequence[_Growing]) -> DataFrame:
    """What a scan of some models reads: blocks of their parts, the hashes only where rows are drawn."""
    parts = [F.lit(bytearray(np.int32(p).tobytes())) for p in sorted({m.spec.part for m in models})]
    own = blocks.filter(F.col("part").isin(parts))
    return own if any(m.spec.subsample < 1 for m in models) else own.drop("draw")


def _grow_level(blocks: DataFrame, models: list[_Growing], widths: Sequence[int], scans: _Scans) -> None:
    """One more level of the trees of some models: their sums in one scan, then their splits."""
    n_bins = max(widths, default=1)
    size = sum(_bytes_of(len(m.counted()), m, n_bins) for m in models)
    ranges = scans.ranges(len(models))
    direct = size * ranges <= DIRECT_BYTES and scans.send(size * ranges, DRIVER_BYTES // 2)
    at_reduce = not direct and (size > SUM_BYTES or not scans.send(size))
    asked = [m.level if at_reduce else m.counted() for m in models]
    specs, n_columns = [m.spec for m in models], [len(m.columns) for m in models]
    partial, blocks = None, _read(blocks, models)
    lanes = scans.lanes([(k, _bytes_of(len(nodes), m, max(n_bins, _CELLS))) for k, (m, nodes) in enumerate(zip(models, asked))], ranges)
    for lane in lanes:
        read, first = _lane(blocks, [models[k].slot for k in lane], ranges) if len(lanes) > 1 else (blocks, 0)
        told = [
            (k, m.spec, m.base, None if m.slot is None else m.slot - first, m.done[m.saved :], m.tree, len(m.done), m.columns, asked[k])
            for k, m in ((k, models[k]) for k in lane)
        ]
        one = read.mapInArrow(_partial_sums(told, widths), "model int, group int, sums binary")
        partial = one if partial is None else partial.unionAll(one)
    found: list[dict[int, tuple]] = [{} for _ in models]
    if at_reduce:

        def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            model, group = int(key[0]), int(key[1])
            sums = _added(list(rows["sums"]), n_columns[model], n_bins)
            best = [b or (-1, 0, 0.0, 0.0, 0.0) for b in best_splits(sums, specs[model])]
            nodes = range(group * _GROUP, group * _GROUP + len(best))
            table = [(model, i, *b, *t) for i, b, t in zip(nodes, best, _totals(sums, specs[model]).T)]
            return pd.DataFrame(table, columns=["model", "place", "c", "cut", "gain", "lg", "lh", "g", "h"])

        schema = "model int, place int, c int, cut int, gain double, lg double, lh double, g double, h double"
        for r in partial.groupBy("model", "group").applyInPandas(choose, schema).collect():
            found[r["model"]][asked[r["model"]][r["place"]]] = (tuple(r[2:7]) if r["c"] >= 0 else None, r["g"], r["h"])
        for m in models:
            m.sums = {}
    else:
        if not direct:

            def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
                sums = _added(list(rows["sums"]), n_columns[int(key[0])], n_bins)
                return pd.DataFrame({"model": [key[0]], "group": [key[1]], "sums": [sums.tobytes()]})

            partial = partial.groupBy("model", "group").applyInPandas(add, partial.schema)
        parts: dict[int, dict[int, list[bytes]]] = {}
        for model, group, sums in zip(*[c.to_pylist() for c in partial.toArrow().columns]):
            parts.setdefault(model, {}).setdefault(group, []).append(sums)
        for k, (m, nodes) in enumerate(zip(models, asked)):
            groups = [_added(p, len(m.columns), n_bins) for _, p in sorted(parts.get(k, {}).items())]
            counted = np.concatenate(groups, axis=1) if groups else np.zeros((2, len(nodes), len(m.columns), n_bins), np.int64)
            found[k] = m.learn(nodes, counted)
    for m, own in zip(models, found):
        m.descend(own)


def _bytes_of(nodes: int, m: _Growing, n_bins: int) -> int:
    return 16 * nodes * len(m.columns) * n_bins


def _advanced(blocks: DataFrame, models: list[_Growing], n_features: int, written: bool) -> DataFrame:
    """Blocks whose margins include all trees of the open models, held by the caller or written too."""
    told = [(m.base, m.slot, m.done[m.saved :]) for m in models]

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(_Block.each(iter([batch]), n_features)):
                margin = np.stack([block.margin_of(*t) for t in told]).tobytes()
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*row.columns[:-1], pa.array([margin], pa.binary())], names=row.schema.names)

    out = blocks.mapInArrow(advance, blocks.schema)
    out = materialized(out) if written else out
    for slot, m in enumerate(models):
        m.slot, m.saved = slot, len(m.done)
    return out


def _look(blocks: DataFrame, models: list[_Growing], slots: list[tuple], n_features: int, watched: Sequence[tuple[int, int]]) -> None:
    """Average precision of every round since the last look: one pass, the scores of a round gathered range by range.

    ``watched`` has the negative and positive rows that each model watches. A range holds about ``LOOK_ROWS`` rows; a task sums
    the ranges of a round from the highest scores on, one at a time.
    """
    told = [(k, m.spec, m.base, *slots[k], m.done) for k, m in enumerate(models)]
    keys = [(k, r) for k, m in enumerate(models) for r in range(m.looked, len(m.done))]
    place = {key: i for i, key in enumerate(keys)}

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for block in _Block.each(batches, n_features):
            for k, spec, base, slot, saved, done in told:
                rows = block.of(spec.watch_part, spec.watch)
                if not len(rows):
                    continue
                y, margin = block.y[rows], block.margin_of(base, slot, (), rows)
                for r in range(saved, len(done)):
                    margin = margin + done[r].value[block.places(done[r], rows)]
                    # Ties must not depend on the last bits of a sum.
                    yield place[k, r], y, np.round(margin, 9)

    ranges = max((-(-(neg + pos) // LOOK_ROWS) for neg, pos in watched), default=1)
    limits = _limits(blocks, scores, len(keys), ranges) if ranges > 1 else [np.zeros(0)] * len(keys)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, y, score in scores(batches):
            part = len(limits[key]) - np.searchsorted(limits[key], score, "right")  # 0: the highest scores
            parts = [(int(p), part == p) for p in np.unique(part)] if len(limits[key]) else [(0, slice(None))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(parts), pa.int32()), pa.array([p for p, _ in parts], pa.int32()),
                    pa.array([score[at].tobytes() for _, at in parts], pa.binary()), pa.array([y[at].tobytes() for _, at in parts], pa.binary()),
                ],
                names=["key", "part", "score", "y"],
            )

    positives = [watched[k][1] for k, _ in keys]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own in groupby(_sorted_parts(batches), lambda r: r[0]):
            if positives[key]:
                found = math.fsum(_precision_terms((r[1:] for r in own), positives[key]))
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([found])], names=["key", "pr_auc"])

    dealt = blocks.mapInArrow(deal, "key int, part int, score binary, y binary").repartition(len(keys), "key")
    found = dealt.sortWithinPartitions("key", "part").mapInArrow(measure, "key int, pr_auc double").collect()
    rounds = {keys[r["key"]]: r["pr_auc"] for r in found}
    for k, m in enumerate(models):
        m.history += [rounds.get((k, r)) for r in range(m.looked, len(m.done))]
        m.looked = len(m.done)


def _limits(blocks: DataFrame, scores: Callable, n: int, ranges: int) -> list[np.ndarray]:
    """Per key the scores at which ranges of about as many rows begin: quantiles of the quantiles of blocks."""
    points = 16 * ranges

    def thin(x: np.ndarray, k: int) -> np.ndarray:
        return np.sort(x)[np.linspace(0, len(x) - 1, k).astype(int)]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[np.ndarray]] = {}
        for key, _, score in scores(batches):
            own = kept.setdefault(key, [])
            own.append(thin(score, points))
            if len(own) == 64:
                own[:] = [thin(np.concatenate(own), 32 * points)]
        every = [(key, thin(np.concatenate(own), points).tobytes()) for key, own in kept.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in every], pa.int32()), pa.array([x for _, x in every], pa.binary())], names=["key", "points"]
        )

    found: list[list[np.ndarray]] = [[] for _ in range(n)]
    for r in blocks.mapInArrow(sketch, "key int, points binary").collect():
        found[r["key"]].append(np.frombuffer(r["points"]))
    return [np.unique(thin(np.concatenate(x), ranges + 1)[1:-1]) if x else np.zeros(0) for x in found]


def _sorted_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            score, y = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in ((2, np.float64), (3, np.uint8)))
            yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), score, y


def _precision_terms(pieces: Iterator[tuple[int, np.ndarray, np.ndarray]], positives: int) -> Iterator[float]:
    """What each distinct score adds to the average precision; ranges of scores come from the highest on."""
    above = hits = 0
    for _, own in groupby(pieces, lambda r: r[0]):
        scores, labels = zip(*[r[1:] for r in own])
        score, y = np.concatenate(scores), np.concatenate(labels)
        order = np.argsort(-score, kind="stable")
        score, tp = score[order], hits + np.cumsum(y[order] > 0)
        ends = np.append(np.flatnonzero(score[1:] != score[:-1]), len(score) - 1)
        pos, tp, at = np.diff(tp[ends], prepend=hits), tp[ends], above + ends + 1
        some = pos > 0
        yield from (pos[some] / positives * (tp[some] / at[some])).tolist()
        above, hits = above + len(score), int(tp[-1])


def best_round(history: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """The round of the best average precision (ties: the first) when patience ended, and whether it ended."""
    best = 0
    for r, value in enumerate(history):
        if (value or 0.0) > (history[best] or 0.0):
            best = r
        if r - best >= patience:
            return best, True
    return best, False


def class_counts(blocks: DataFrame, spans: Sequence[tuple[int, tuple[int, int]]], n_features: int) -> list[tuple[int, int]]:
    """Negative and positive rows of each (part, range of days)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(spans), 2), np.int64)
        for block in _Block.each(batches, n_features):
            for k, span in enumerate(spans):
                n[k] += np.bincount(block.y[block.of(*span)] > 0, minlength=2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(spans)), pa.int32()), pa.array(n[:, 0]), pa.array(n[:, 1])], names=["span", "neg", "pos"]
        )

    counts = blocks.mapInArrow(count, "span int, neg long, pos long").groupBy("span").agg(F.sum("neg"), F.sum("pos"))
    found = {m: (neg, pos) for m, neg, pos in counts.collect()}
    return [found.get(k, (0, 0)) for k in range(len(spans))]


def base_margin(neg: int, pos: int, spec: Spec) -> float:
    """Log odds of weighted positives."""
    share = min(max(pos * spec.positive_weight / max(neg + pos * spec.positive_weight, 1e-9), 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


# --- a model a task -----------------------------------------------------------------------------


def average_precision(y: np.ndarray, score: np.ndarray) -> float | None:
    """The step sum over distinct scores as in :func:`metrics.evaluate`, correctly rounded; None without positives."""
    positives = int((y > 0).sum())
    return math.fsum(_precision_terms(iter([(0, score, y)]), positives)) if positives else None


def _fit_whole(blocks: Sequence[_Block], spec: Spec, widths: Sequence[int]) -> _Growing:
    """A model fitted where all rows are: the levels of a tree follow each other without a scan."""
    n_bins = max(widths, default=1)
    fitted = [b.only(b.of(spec.part, spec.fit)) for b in blocks]
    watched = [b.only(b.of(spec.watch_part, spec.watch)) for b in blocks] if spec.watch is not None else []
    neg, pos = sum((np.bincount(b.y > 0, minlength=2) for b in fitted), np.zeros(2, np.int64)).tolist()
    m = _Growing(spec, base_margin(neg, pos, spec))
    for b in (*fitted, *watched):
        b.margin = np.full(len(b.y), m.base)
    labels = np.concatenate([b.y for b in watched]) if watched else np.zeros(0, np.uint8)
    while m.open:
        m.begin(len(widths))
        drawn = []
        for b in fitted:
            rows = np.flatnonzero(spec.drawn(b.draw, len(m.done)))
            drawn.append((rows, *gradients(b.margin[rows], b.y[rows], spec)))
        at = [np.zeros(len(rows), np.int64) for rows, _, _ in drawn]
        while m.growing:
            nodes = m.counted()
            sums, slots = Histogram(m.columns, widths, len(nodes)), np.full(len(m.tree.feature), -1)
            slots[nodes] = np.arange(len(nodes))
            for b, (rows, g, h), node in zip(fitted, drawn, at):
                slot = slots.take(node)
                mine = np.flatnonzero(slot >= 0)
                sums.add(b.bins, rows[mine], slot[mine], g[mine], h[mine])
            m.descend(m.learn(nodes, sums.sums(n_bins)))
            at = [b.moved(m.tree, node, rows) for b, (rows, _, _), node in zip(fitted, drawn, at)]
        for k, b in enumerate(fitted):
            b.margin += m.tree.value[at[k] if spec.subsample >= 1 else b.places(m.tree)]
        for b in watched:
            b.margin += m.tree.value[b.places(m.tree)]
        m.add()
        if spec.watch is not None:
            # Ties must not depend on the last bits of a sum.
            m.history.append(average_precision(labels, np.concatenate([np.round(b.margin, 9) for b in watched] or [np.zeros(0)])))
            if len(m.done) % _LOOK == 0 and best_round(m.history, spec.patience)[1]:
                m.open = False
    return m


def _bytes_of_rows(table: Binned) -> int:
    rows = table.blocks.agg(F.sum(F.octet_length("y"))).first()[0] or 0
    return rows * (len(table.features) + 17)


def _fitted_whole(table: Binned, specs: Sequence[Spec]) -> list[_Growing]:
    """All rows are told to the tasks, each of which fits a model; those with most rows and levels begin first."""
    spark, widths = table.blocks.sparkSession, table.widths
    blocks = _rows_of(table)
    known: dict[tuple, int] = {}
    for s in specs:
        if (s.part, s.fit) not in known:
            known[s.part, s.fit] = sum(len(b.of(s.part, s.fit)) for b in blocks)
    order = sorted(range(len(specs)), key=lambda k: -known[specs[k].part, specs[k].fit] * specs[k].depth)
    told = spark.sparkContext.broadcast(blocks)
    specs = list(specs)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                m = _fit_whole(told.value, specs[order[place]], widths)
                kept = _kept(m)
                found = zlib.compress(pickle.dumps((m.base, m.done[:kept], m.history)), 1)
                yield pa.RecordBatch.from_arrays([pa.array([order[place]], pa.int32()), pa.array([found], pa.binary())], names=["model", "found"])

    try:
        fits = spark.range(0, len(specs), 1, max(1, len(specs))).mapInArrow(fit, "model int, found binary").collect()
    finally:
        told.destroy()
    out: list[_Growing | None] = [None] * len(specs)
    for r in fits:
        base, done, history = pickle.loads(zlib.decompress(r["found"]))
        out[r["model"]] = _Growing(specs[r["model"]], base, done=done, history=history)
    return out


def _rows_of(table: Binned) -> list[_Block]:
    """All rows in blocks of even size, part by part."""
    batches = table.blocks.toArrow().to_batches()
    by_part: dict[int, list[_Block]] = {}
    for b in _Block.each(iter(batches), len(table.features)):
        by_part.setdefault(int(b.part[0]), []).append(b)
    out = []
    for part, blocks in by_part.items():
        bins = np.concatenate([b.bins for b in blocks], axis=1)
        y, draw = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "draw"))
        day = np.concatenate([np.broadcast_to(b.day, len(b.y)) for b in blocks])
        for at in (slice(s, s + _HELD_ROWS) for s in range(0, len(y), _HELD_ROWS)):
            out.append(_Block(np.ascontiguousarray(bins[:, at]), y[at], day[at], np.array([part], np.int32), None, draw[at]))
    return out


# --- many models in scans -----------------------------------------------------------------------


def fit_many(table: Binned, specs: Sequence[Spec]) -> list[BoostedTrees]:
    """Fit models side by side; each equals the model fitted by itself.

    A table of few bytes is told to the tasks, which fit a model each; larger ones are scanned for all models level by level.

    A model ends with its number of trees, or when the average precision on its watched rows has not improved for
    ``patience`` rounds; then the trees up to the best round are kept. Scans follow the slowest model: as many
    as its trees have levels.
    """
    n_features, widths = len(table.features), table.widths
    if _bytes_of_rows(table) <= min(_WHOLE * DIRECT_BYTES, DRIVER_BYTES // _WHOLE):
        return [_finished(m, table) for m in _fitted_whole(table, specs)]
    first = table.blocks.persist(StorageLevel.MEMORY_AND_DISK)
    held = [first]
    blocks = first
    try:
        rows = blocks.agg(F.sum(F.octet_length("y"))).first()[0] or 0
        cores = blocks.sparkSession.sparkContext.defaultParallelism
        scans = _Scans(cores, blocks.rdd.getNumPartitions(), rows, DRIVER_BYTES)
        none = (0, (0, 0))
        spans = [(s.part, s.fit) for s in specs] + [none if s.watch is None else (s.watch_part, s.watch) for s in specs]
        counts = class_counts(blocks, spans, n_features)
        models = [_Growing(s, base_margin(*c, s)) for s, c in zip(specs, counts)]
        rows_watched = {id(m): c for m, c in zip(models, counts[len(specs) :])}
        anchor, slots = blocks, {id(m): (None, 0) for m in models}
        while open_ := [m for m in models if m.open]:
            for m in open_:
                m.begin(n_features)
            for _ in range(max(m.spec.depth for m in open_)):
                growing = [m for m in open_ if m.growing]
                if not growing:
                    break
                _grow_level(blocks, growing, widths, scans)
            for m in open_:
                m.add()
            ended = [m for m in open_ if not m.open]
            rounds = len(open_[0].done)  # all open models have as many trees
            watched = [m for m in open_ if m.spec.watch is not None]
            if watched and (rounds % _LOOK == 0 or ended):
                looking = watched if rounds % _LOOK == 0 else [m for m in ended if m.spec.watch is not None]
                if looking:
                    _look(anchor, looking, [slots[id(m)] for m in looking], n_features, [rows_watched[id(m)] for m in looking])
                    for m in looking:
                        m.open = m.open and not best_round(m.history, m.spec.patience)[1]
            still = [m for m in models if m.open]
            many = len(still) > _MANY
            if still and (not many or rounds % _ADVANCE_MANY == 0):
                # The scans of this tree have read the blocks, so all that came before them is of no use.
                for old in held:
                    if old is not anchor and old is not blocks:
                        old.unpersist()
                written = many or rounds % _ADVANCE == 0
                held = [b for b in held if b is anchor or b is blocks]
                blocks = _advanced(blocks, still, n_features, written).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(blocks)
                if rounds % _LOOK == 0:
                    anchor = blocks
                    slots = {id(m): (m.slot, m.saved) for m in still}
    finally:
        for old in held:
            old.unpersist()
    return [_finished(m, table) for m in models]


def _kept(m: _Growing) -> int:
    """Trees up to the best round."""
    return best_round(m.history, m.spec.patience)[0] + 1 if m.spec.watch is not None and m.history else len(m.done)


def _finished(m: _Growing, table: Binned) -> BoostedTrees:
    trees = m.done[: _kept(m)]
    cuts = [
        np.array([table.edges[f][c] if f >= 0 else np.nan for f, c in zip(t.feature, t.cut)]) for t in trees
    ]
    return BoostedTrees(list(table.features), m.base, trees, cuts, m.spec, m.history)


# --- scoring and storing ------------------------------------------------------------------------


def margin_column(model: BoostedTrees, values: Sequence[Column]) -> Column:
    """Margin of each row, in Arrow batches; the model goes to the tasks with the function."""

    @F.pandas_udf("double")
    def margin(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.margins(np.column_stack([c.to_numpy(np.float64) for c in columns])))

    return margin(*values)


NODES = "tree int, node int, feature int, threshold double, value double, cover double, gain double"


def save_boosted(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    """Write nodes and settings as Parquet, replacing what is there."""
    spark.createDataFrame(list(model.nodes()), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    about = {"features": model.features, "base": model.base, "spec": asdict(model.spec), "history": model.history}
    about = spark.createDataFrame([(json.dumps(about),)], "about string")
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_boosted(spark: SparkSession, path: str) -> BoostedTrees:
    """Read a model back; its nodes are as many as the model has."""
    about = json.loads(spark.read.schema("about string").parquet(f"{path}/model").first()["about"])
    about["spec"] = {k: tuple(v) if isinstance(v, list) else v for k, v in about["spec"].items()}
    spec = Spec(**about["spec"])
    trees: dict[int, Tree] = {}
    cuts: dict[int, np.ndarray] = {}
    for r in spark.read.schema(NODES).parquet(f"{path}/nodes").collect():
        tree = trees.setdefault(r["tree"], Tree.empty(spec.depth))
        at = cuts.setdefault(r["tree"], np.full(len(tree.feature), np.nan))
        tree.feature[r["node"]], tree.value[r["node"]] = r["feature"], r["value"]
        tree.cover[r["node"]], tree.gain[r["node"]] = r["cover"], r["gain"]
        if r["threshold"] is not None:
            at[r["node"]] = r["threshold"]
    order = sorted(trees)
    return BoostedTrees(about["features"], about["base"], [trees[t] for t in order], [cuts[t] for t in order], spec, about["history"])


def score_blocks(table: Binned, models: Sequence[BoostedTrees], days: Sequence[tuple[int, int]]) -> DataFrame:
    """(model, y, risk_score) of every model on the rows of its range of days: all models in one scan."""
    told = []
    for k, (m, span) in enumerate(zip(models, days)):
        at = [np.searchsorted(table.edges[f], c) if f >= 0 else 0 for t, cuts in zip(m.trees, m.thresholds) for f, c in zip(t.feature, cuts)]
        cuts = np.array(at, np.int32).reshape(len(m.trees), -1)
        told.append((k, m.spec.part, span, m.base, [replace(t, cut=c) for t, c in zip(m.trees, cuts)]))
    n_features = len(table.features)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _Block.each(batches, n_features):
            for k, part, span, base, trees in told:
                rows = block.of(part, span)
                margin = block.margin_of(base, None, trees, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), k, np.int32)), pa.array(block.y[rows].astype(np.int32)),
                        pa.array(1 / (1 + np.exp(-np.round(margin, 9)))),
                    ],
                    names=["model", "y", "risk_score"],
                )

    return table.blocks.mapInArrow(score, "model int, y int, risk_score double")
