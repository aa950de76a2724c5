"""Suffix-array dedup: bytes covered by a 100-byte string that starts earlier in the corpus.

All windows (strings of ``window`` bytes) are judged, without comparing or sorting all suffixes:

1. *Anchors.* Every window elects one of its ``GRAM``-byte grams, the first with the smallest hash. Equal windows
   elect the same gram at the same place, so equal windows are found among the occurrences of one
   elected gram. About one position in thirty is elected.
2. *Buckets.* Occurrences of a gram meet in hash ranges. Those with equal surroundings (the bytes any of their
   windows can hold) form a class; all but its first member are covered whole. What remains are the
   first members of buckets with several classes.
3. *Suffix sort.* In a bucket the suffixes that start at the anchors are sorted by mergesort. Two suffixes are
   compared by the length of their common prefix, found by binary search over prefix polynomial hashes. The
   common prefixes of neighbours in the sorted order tell which suffixes share how many bytes to the right;
   with the hash of the bytes to the left this gives, for every window around an anchor, its equals and the first
   of them. Claims are verified byte by byte; a bucket with a false claim is redone on plain bytes.
4. Spans meet their texts, and the remaining bytes are hashed.

A gram with very many occurrences (counted over all documents) is split: its windows fall into ``NODES`` ranges by
how far they reach to the right, and for each range the bytes common to all its windows take the gram's
place. Buckets of such longer strings are small unless the windows themselves are equal, and equal
surroundings collapse ahead of the shuffle. A bucket that keeps very many classes all the same is not
sorted in one task: its windows are hashed (128 bits) and their first places found by an aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import bounded_batches, mix, powers, text_blocks
from vetrail.session import materialized

WINDOW = 100
GRAM = 32
SIDE = WINDOW - GRAM
NODES = 8
#: Occurrences of a gram from which on it is split.
HEAVY = 8_000
MAX_HEAVY = 100_000
_FLUSH = 200_000
_SORT_ROWS = 10_000
_PLACE_BITS = np.uint64(28)

#: Classes of a bucket from which on it is not sorted in one task.
GIANT = 16_000
#: Marks a position whose windows all start earlier; added to the node of rows of giant buckets.
_WHOLE, _FROM_GIANT = -2, 100

_NODE_LOW = np.array([k * (SIDE + 1) // NODES for k in range(NODES)])
_NODE_HIGH = np.array([(k + 1) * (SIDE + 1) // NODES - 1 for k in range(NODES)])

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE_TOO = mix(np.arange(1001, 1257, dtype=np.uint64))

_inverse = np.ones(1, np.uint64)


def _inverses(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        grown = np.full(max(n, 4096), _INVERSE, np.uint64)
        grown[0] = 1
        _inverse = np.multiply.accumulate(grown)
    return _inverse[:n]


class PrefixHashes:
    """Hash of any span of a byte array from the prefix sums of ``byte value * base**position``."""

    def __init__(self, raw: np.ndarray, values: np.ndarray = _BYTE):
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[raw] * powers(n + 1)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * _inverses(len(self.sums))[start]


def elected(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, PrefixHashes]:
    """Positions elected by at least one window of a block of texts, and their gram hashes.

    A block, and so a single text, may have 256 MB; longer ones raise ``ValueError``.
    """
    n = len(raw)
    if n > 1 << _PLACE_BITS:
        raise ValueError(f"a text of {n} bytes; at most {1 << _PLACE_BITS} can be searched")
    hashes = PrefixHashes(raw)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none.astype(np.uint64), hashes
    starts = np.arange(n - GRAM + 1)
    gram = mix(hashes.of(starts, starts + GRAM))
    least = (gram >> _PLACE_BITS << _PLACE_BITS) | starts.astype(np.uint64)
    size, wanted = 1, SIDE + 1
    while size * 2 <= wanted:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wanted:
        least = np.minimum(least[: size - wanted], least[wanted - size :])
    end = np.repeat(at[1:], np.diff(at))
    inside = np.arange(len(least)) + WINDOW <= end[: len(least)]
    place = (least[inside] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    if not len(place):
        return none, none.astype(np.uint64), hashes
    # Elected places never go back as the window moves on.
    place = place[np.concatenate([[True], place[1:] != place[:-1]])]
    return place, gram[place], hashes


def _anchor_rows(rows, raw, at, heavy: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, surroundings, document, position, node) of a block's anchors; node -1: not split."""
    place, gram, hashes = elected(raw, at)
    text = np.searchsorted(at, place, "right") - 1
    start, stop = at[text], at[text + 1]
    left, right = np.maximum(place - SIDE, start), np.minimum(place + WINDOW, stop)
    around = PrefixHashes(raw, _BYTE_TOO).of(left, right)
    around = mix(around + mix(((place - left) << 8 | (right - place)).astype(np.uint64)))
    documents = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[text]
    node = np.full(len(place), -1, np.int8)
    if len(heavy) and len(place):
        spot = np.minimum(np.searchsorted(heavy, gram), len(heavy) - 1)
        split = heavy[spot] == gram
        if split.any():
            parts = [np.flatnonzero(~split)]
            nodes, buckets = [node[~split]], [gram[~split]]
            for k in range(NODES):
                low, high = place - (SIDE - _NODE_HIGH[k]), place + GRAM + _NODE_LOW[k]
                fits = np.flatnonzero(split & (low >= start) & (high <= stop))
                parts.append(fits)
                nodes.append(np.full(len(fits), k, np.int8))
                buckets.append(mix(hashes.of(low[fits], high[fits]) + np.uint64(k + 1)))
            which = np.concatenate(parts)
            return (
                np.concatenate(buckets), around[which], documents[which], (place - start)[which],
                np.concatenate(nodes),
            )
    return gram, around, documents, place - start, node


def _count_grams(ranges: int):
    """Grams that a batch of texts holds twice or more, with their counts, per hash range.

    A gram missed by every batch has at most one occurrence per batch, which bounds its bucket.
    """

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        grams, counts = np.unique(np.concatenate(held), return_counts=True)
        grams, counts = grams[counts > 1], counts[counts > 1]
        of = (grams % np.uint64(ranges)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(of), pa.array(grams.view(np.int64)), pa.array(counts)], names=["range", "gram", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, raw, at in text_blocks(batches):
            held.append(elected(raw, at)[1])
            size += len(held[-1])
            if size > _FLUSH:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    return run


def heavy_grams(texts: DataFrame, least: int = HEAVY, most: int = MAX_HEAVY) -> np.ndarray:
    """Ascending hashes of the grams elected at ``least`` places or more, the ``most`` commonest."""
    counted = texts.mapInArrow(_count_grams(1), "range int, gram long, n long")
    found = counted.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    top = found.orderBy(F.desc("n"), "gram").limit(most).select("gram").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


_PACKED = "range int, bucket binary, around binary, doc binary, pos binary, node binary, kept boolean"


def _deal(heavy, ranges: int):
    """Anchors packed per hash range; of equal surroundings in a batch only the first is dealt to its range."""

    def pack(of: np.ndarray, columns: list[np.ndarray], kept: bool) -> list[tuple]:
        order = np.argsort(of, kind="stable")
        of = of[order]
        heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
        columns = [c[order] for c in columns]
        ends = [*heads[1:], len(of)] if len(of) else []
        return [(int(of[a]), *(c[a:b].tobytes() for c in columns), kept) for a, b in zip(heads, ends)]

    def flush(held: list[tuple]) -> pa.RecordBatch:
        bucket, around, doc, pos, node = (np.concatenate(c) for c in zip(*held))
        pos = pos.astype(np.int32)
        order = np.lexsort((pos, doc, around, bucket))
        bucket, around, doc, pos, node = (c[order] for c in (bucket, around, doc, pos, node))
        first = np.concatenate(
            [[True], (bucket[1:] != bucket[:-1]) | (around[1:] != around[:-1])]
        )
        same = ~first & np.concatenate([[False], (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])])
        rest = ~first & ~same
        of = (bucket % np.uint64(ranges)).astype(np.int32)
        rows = pack(of[first], [c[first] for c in (bucket, around, doc, pos, node)], True)
        none = np.zeros(0, np.uint64)
        spread = (mix(doc[rest].view(np.uint64)) % np.uint64(ranges)).astype(np.int32)
        for r in pack(spread, [doc[rest], pos[rest]], False):
            rows.append((r[0], none.tobytes(), none.tobytes(), r[1], r[2], b"", False))
        kinds = [pa.int32(), *[pa.binary()] * 5, pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
            names=["range", "bucket", "around", "doc", "pos", "node", "kept"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, raw, at in text_blocks(batches):
            held.append(_anchor_rows(rows, raw, at, heavy.value))
            size += len(held[-1][0])
            if size > _FLUSH:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    return run


def _meet(giant: int):
    """Marks of one hash range: positions covered whole, and first members of classes to be sorted."""
    return lambda rows: _meet_range(rows, giant)


def _meet_range(rows: pd.DataFrame, giant: int) -> pd.DataFrame:
    def joined(part: pd.DataFrame, column: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in part[column]] or [np.zeros(0, kind)])

    kept, passed = rows[rows["kept"]], rows[~rows["kept"]]
    bucket, around = joined(kept, "bucket", np.uint64), joined(kept, "around", np.uint64)
    doc, pos, node = joined(kept, "doc", np.int64), joined(kept, "pos", np.int32), joined(kept, "node", np.int8)
    order = np.lexsort((pos, doc, around, bucket))
    bucket, around, doc, pos, node = (c[order] for c in (bucket, around, doc, pos, node))
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    first = new.copy()
    first[1:] |= around[1:] != around[:-1]
    same = np.zeros(len(bucket), bool)
    same[1:] = ~first[1:] & (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])
    group = np.cumsum(new) - 1
    classes = np.bincount(group, first) if len(group) else np.zeros(0)
    sort = first & (classes[group] > 1) if len(group) else first
    cover = ~first & ~same
    own_node = node[sort].astype(np.int32)
    own_node[classes[group[sort]] > giant] += _FROM_GIANT
    passed_doc, passed_pos = joined(passed, "doc", np.int64), joined(passed, "pos", np.int32)
    others = int(cover.sum()) + len(passed_doc)
    return pd.DataFrame(
        {
            "doc": np.concatenate([doc[sort], doc[cover], passed_doc]),
            "pos": np.concatenate([pos[sort], pos[cover], passed_pos]),
            "bucket": np.concatenate([bucket[sort].view(np.int64), np.zeros(others, np.int64)]),
            "node": np.concatenate([own_node, np.full(others, _WHOLE, np.int32)]),
        }
    )


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node, doc, pos, left, bytes) for the anchors of each text that are to be sorted."""
    for rows, raw, at in text_blocks(batches):
        marks = rows.column(rows.schema.get_field_index("marks"))
        counts = marks.value_lengths().to_numpy(zero_copy_only=False)
        flat = marks.flatten()
        pos = flat.field("pos").to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(rows.num_rows), counts)
        place = pos + at[text]
        low, high = np.maximum(place - SIDE, at[text]), np.minimum(place + WINDOW, at[text + 1])
        data = raw.tobytes()
        doc = rows.column(rows.schema.get_field_index("doc")).take(pa.array(text))
        yield pa.RecordBatch.from_arrays(
            [
                flat.field("bucket"),
                flat.field("node").cast(pa.int32()),
                doc,
                pa.array(pos),
                pa.array((place - low).astype(np.int32)),
                pa.array([data[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary()),
            ],
            names=["bucket", "node", "doc", "pos", "left", "bytes"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window around an anchor that its node stands for: two hashes and where it starts."""
    for batch in batches:
        node, pos, left = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 3, 4))
        node = node - _FROM_GIANT
        around = batch.column(5).to_pylist()
        size = np.array([len(x) for x in around], np.int64)
        raw = np.frombuffer(b"".join(around), np.uint8)
        base = np.cumsum(size) - size
        one, two = PrefixHashes(raw), PrefixHashes(raw, _BYTE_TOO)
        low = np.where(node < 0, 0, _NODE_LOW[node])
        high = np.where(node < 0, SIDE, _NODE_HIGH[node])
        found = []
        for r in range(SIDE + 1):
            begin = left - (SIDE - r)
            fits = np.flatnonzero((low <= r) & (r <= high) & (begin >= 0) & (begin + WINDOW <= size))
            a = base[fits] + begin[fits]
            found.append((mix(one.of(a, a + WINDOW)), mix(two.of(a, a + WINDOW)), fits, pos[fits] - (SIDE - r)))
        hashes, others, rows, start = (np.concatenate(c) for c in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes.view(np.int64)),
                pa.array(others.view(np.int64)),
                batch.column(2).take(pa.array(rows)),
                pa.array(start),
            ],
            names=["one", "two", "doc", "start"],
        )


def common_prefix(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the spans from a and b, at most ``most``: binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
    while (open_ := low < high).any():
        middle = np.where(open_, (low + high + 1) // 2, low)
        equal = hashes.of(a, a + middle) == hashes.of(b, b + middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return low


def suffix_order(
    raw: np.ndarray, hashes: PrefixHashes, start: np.ndarray, stop: np.ndarray, group: np.ndarray
) -> np.ndarray:
    """Order of the suffixes start..stop inside their groups (ascending, consecutive): a mergesort.

    All runs of all groups are merged at once: an element's new place is its place in its own run and
    the number of smaller elements in the run beside it, found by binary search.
    """

    def less(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        most = np.minimum(stop[x] - start[x], stop[y] - start[y])
        common = common_prefix(hashes, start[x], start[y], most)
        ended = common == most
        at_x, at_y = np.minimum(start[x] + common, len(raw) - 1), np.minimum(start[y] + common, len(raw) - 1)
        shorter = stop[x] - start[x] - (stop[y] - start[y])
        by_length = (shorter < 0) | ((shorter == 0) & or_equal)
        return np.where(ended, by_length, raw[at_x] < raw[at_y])

    n = len(start)
    order = np.arange(n)
    first = np.searchsorted(group, group, "left")
    last = np.searchsorted(group, group, "right")
    slot = np.arange(n)
    width, longest = 1, int((last - first).max(initial=0))
    while width < longest:
        run = (slot - first) // width
        pair = first + (run & ~1) * width
        other = first + (run ^ 1) * width
        low, high = np.minimum(other, last), np.minimum(other + width, last)
        begin = low.copy()
        right = (run & 1) == 1
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            # How many beside are smaller; from the right run also those that are equal: a stable merge.
            smaller = less(order[middle], order[active], right[active])
            low[active] = np.where(smaller, middle + 1, low[active])
            high[active] = np.where(smaller, high[active], middle)
            active = active[low[active] < high[active]]
        target = pair + (slot - first - run * width) + (low - begin)
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        width *= 2
    return order


def repeated_windows(
    group: np.ndarray, node: np.ndarray, doc: np.ndarray, pos: np.ndarray, left: np.ndarray, around: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, low, high): rows some of whose windows start earlier, and the bytes these windows cover.

    Rows come sorted by group. A row's windows all hold its gram, so what they cover is one span.
    """
    n = len(group)
    size = np.array([len(x) for x in around], np.int64)
    raw = np.frombuffer(b"".join(around), np.uint8)
    base = np.cumsum(size) - size
    anchor, stop = base + left, base + size
    hashes = PrefixHashes(raw)
    order = suffix_order(raw, hashes, anchor, stop, group)
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        common[1:] = common_prefix(hashes, anchor[a], anchor[b], np.minimum(stop[a] - anchor[a], stop[b] - anchor[b]))
        common[1:][group[a] != group[b]] = -1
    reach = stop - anchor - GRAM
    low_r = np.where(node < 0, 0, _NODE_LOW[node])
    high_r = np.where(node < 0, SIDE, _NODE_HIGH[node])
    earliest = np.full(n, SIDE + 1, np.int64)
    latest = np.full(n, -1, np.int64)
    source = {}
    # Smaller (document, position) first, so that the first of equal keys is the earliest.
    age = np.empty(n, np.int64)
    age[np.lexsort((pos, doc))] = np.arange(n)
    for r in range(SIDE + 1):
        back = SIDE - r
        # Neighbours that share gram and r bytes to the right are of one interval of the sorted order.
        interval = np.cumsum((common < GRAM + r) | (np.arange(n) == 0))
        of = np.empty(n, np.int64)
        of[order] = interval
        fits = np.flatnonzero((left >= back) & (reach >= r) & (low_r <= r) & (r <= high_r))
        if len(fits) < 2:
            continue
        before = hashes.of(anchor[fits] - back, anchor[fits])
        key = mix(before + mix(of[fits].astype(np.uint64)))
        sort = np.lexsort((age[fits], key))
        key, rows = key[sort], fits[sort]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = rows[np.flatnonzero(new)[np.cumsum(new) - 1]]
        hit = ~new & ((doc[rows] != doc[head]) | (pos[rows] != pos[head]))
        again, origin = rows[hit], head[hit]
        if len(again):
            earliest[again] = np.minimum(earliest[again], r)
            latest[again] = np.maximum(latest[again], r)
            source[r] = (again, origin)
    found = np.flatnonzero(latest >= 0)
    wrong = _false_claims(raw, anchor, source, earliest, latest)
    if len(wrong):
        _redo(np.unique(group[wrong]), group, doc, pos, left, around, low_r, high_r, earliest, latest)
        found = np.flatnonzero(latest >= 0)
    return found, pos[found] - SIDE + earliest[found], pos[found] + GRAM + latest[found]


def _false_claims(raw, anchor, source, earliest, latest) -> np.ndarray:
    """Rows whose first or last repeated window differs from its source in some byte."""
    wrong = []
    span = np.arange(WINDOW)
    for r, (again, origin) in source.items():
        ends = (earliest[again] == r) | (latest[again] == r)
        again, origin = again[ends], origin[ends]
        for s in range(0, len(again), 5_000):
            a, o = again[s : s + 5_000], origin[s : s + 5_000]
            one = raw[(anchor[a] - (SIDE - r))[:, None] + span]
            two = raw[(anchor[o] - (SIDE - r))[:, None] + span]
            wrong.append(a[(one != two).any(axis=1)])
    return np.concatenate(wrong) if wrong else np.zeros(0, np.int64)


def _redo(groups, group, doc, pos, left, around, low_r, high_r, earliest, latest) -> None:
    """The same for a few groups with windows compared as bytes."""
    for g in groups:
        rows = np.flatnonzero(group == g)
        earliest[rows], latest[rows] = SIDE + 1, -1
        seen: dict[tuple, tuple] = {}
        for i in sorted(rows, key=lambda i: (doc[i], pos[i])):
            for r in range(low_r[i], high_r[i] + 1):
                start = left[i] - (SIDE - r)
                if start < 0 or start + WINDOW > len(around[i]):
                    continue
                key = (r, around[i][start : start + WINDOW])
                if seen.setdefault(key, (doc[i], pos[i])) != (doc[i], pos[i]):
                    earliest[i], latest[i] = min(earliest[i], r), max(latest[i], r)


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (doc, low, high) out of rows sorted by bucket; whole buckets are taken at a time."""

    def work(columns: list) -> pa.RecordBatch:
        bucket, node, doc, pos, left, around = columns
        group = np.cumsum(np.concatenate([[0], bucket[1:] != bucket[:-1]]))
        rows, low, high = repeated_windows(group, node, doc, pos, left, around)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[rows]), pa.array(low), pa.array(high)], names=["doc", "low", "high"]
        )

    held: list | None = None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        new.append(batch.column(5).to_pylist())
        if held is not None:
            new = [*(np.concatenate(c) for c in zip(held[:5], new[:5])), held[5] + new[5]]
        # The last bucket may go on in the next batch.
        starts = np.flatnonzero(np.concatenate([[True], new[0][1:] != new[0][:-1]]))
        done = 0
        for edge in starts[1:].tolist():
            if edge - done >= _SORT_ROWS or edge == starts[-1]:
                yield work([c[done:edge] for c in new])
                done = edge
        held = [c[done:] for c in new]
    if held is not None and len(held[0]):
        yield work(held)


def _cut_texts(kept_columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in text_blocks(batches):
            names = rows.schema.names
            lows, highs = rows.column(names.index("low")), rows.column(names.index("high"))
            removed, spans, digest, kept_bytes = [], [], [], []
            for k in range(rows.num_rows):
                kept = own = raw[at[k] : at[k + 1]]
                low, high = lows[k].values, highs[k].values
                gone = runs = 0
                if low is not None and len(low):
                    depth = np.zeros(len(own) + 1, np.int64)
                    np.add.at(depth, np.clip(low.to_numpy(zero_copy_only=False), 0, len(own)), 1)
                    np.add.at(depth, np.clip(high.to_numpy(zero_copy_only=False), 0, len(own)), -1)
                    out = np.cumsum(depth[:-1]) > 0
                    kept = own[~out]
                    gone = int(out.sum())
                    runs = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum())
                removed.append(gone)
                spans.append(runs)
                kept_bytes.append(kept.tobytes())
                digest.append(hashlib.sha256(kept_bytes[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(names.index("doc")),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array([b.decode(errors="ignore") for b in kept_bytes], pa.string()),
                    *[rows.column(names.index(f"_{c}")) for c in kept_columns],
                ],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", *[f"_{c}" for c in kept_columns]],
            )

    return run


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, low, high): spans, not merged, whose union are the bytes to remove. ``texts``: doc, text.

    Spans may reach over a text's ends and are then cut there.
    """
    spark = bounded_batches(texts)
    long = texts.filter((F.octet_length("text") >= WINDOW) & F.col("doc").isNotNull())
    heavy = spark.sparkContext.broadcast(heavy_grams(long))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = materialized(
        long.mapInArrow(_deal(heavy, ranges), _PACKED)
        .groupBy("range")
        .applyInPandas(_meet(GIANT), "doc long, pos int, bucket long, node int")
    )
    to_sort = (
        marks.filter(F.col("node") != _WHOLE)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("pos", "bucket", "node")).alias("marks"))
    )
    around = long.join(to_sort, "doc").mapInArrow(
        _surroundings, "bucket long, node int, doc long, pos long, left int, bytes binary"
    )
    around = materialized(around)
    sorted_spans = (
        around.filter(F.col("node") < _FROM_GIANT - 1)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sort_buckets, "doc long, low long, high long")
    )
    whole = marks.filter(F.col("node") == _WHOLE).select(
        "doc", (F.col("pos") - SIDE).cast("long").alias("low"), (F.col("pos") + WINDOW).cast("long").alias("high")
    )
    # Windows of giant buckets: the first place of each by partial aggregation, the others are spans.
    windows = around.filter(F.col("node") >= _FROM_GIANT - 1).mapInArrow(
        _windows, "one long, two long, doc long, start long"
    )
    first = windows.groupBy("one", "two").agg(F.min(F.struct("doc", "start")).alias("first"))
    again = windows.join(first, ["one", "two"]).filter(F.struct("doc", "start") != F.col("first"))
    giant = again.select("doc", F.col("start").alias("low"), (F.col("start") + WINDOW).alias("high"))
    return materialized(sorted_spans).union(materialized(giant)).union(whole)


def cut_repeats(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, ``keep`` columns.

    A byte is removed if a 100-byte string that covers it also starts earlier: in a document of smaller id, or
    before in the same one. Overlaps count, and strings are judged on the input. Null text is empty. Texts
    under 100 bytes lose nothing, those over 256 MB raise ``ValueError``. Rows without an id keep their whole text and count for
    no other; rows that share an id are one document: what starts earlier in
    one is earlier for all, equal places of equal rows are one place. Removal may split a character: the hash
    is that of all remaining bytes, ``kept_text`` lacks the parts of split characters. An empty table gives an empty result. Columns not named in ``keep`` are not read;
    a kept column takes the place of one of the same name.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
    spans = repeated_spans(texts)
    of_doc = spans.groupBy("doc").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    # Both lists are collected from the same rows in the same order.
    carried = documents.select(
        F.col(id_column).cast("long").alias("doc"),
        F.col(text).alias("text"),
        *[F.col(c).alias(f"_{c}") for c in keep],
    )
    own = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    for c in keep:
        schema += f", `_{c}` {documents.schema[c].dataType.simpleString()}"
    cut = carried.join(of_doc, "doc", "left").mapInArrow(_cut_texts(list(keep)), schema)
    return cut.select(
        F.col("doc").alias(id_column),
        *[c for c in own if c not in keep],
        *[F.col(f"_{c}").alias(c) for c in keep],
    )
