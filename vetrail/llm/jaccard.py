"""N-gram Jaccard join: token-combination prefixes, then exact verification.

A document is its set of distinct word shingles; two link if their Jaccard likeness reaches a threshold.
Tokens (shingle hashes) have two classes and one global order: rare ones first, each class by hash. A pair that links must share a token of both documents' prefixes (their first
``n - ceil(t n) + 1`` tokens).

* Rare tokens are indexed one by one.
* A document with too few rare tokens extends its prefix over frequent ones and indexes 2-token combinations of
  them. Frequent tokens fall into sub-classes by hash; a sub-class with m tokens in the prefix survives m-2
  misses, so the prefix is extended until the sub-classes together withstand one miss more than the
  threshold allows. The number of sub-classes follows the set's size, in bands a factor of 1/t apart;
  each document is indexed for its band and the next, so that a linking pair meets in one of them.
  Sets of up to 50 tokens index frequent tokens one by one.

Classes only steer the work: any split into classes gives the same links. They come from document
frequencies counted over all documents, of tokens told apart by their leading bits (32 more than it takes
to number the ranges they are counted in); the most frequent ones, a bounded number, are told to every task.

Equal sets collapse first. Of the documents that meet under a signature each is first verified against the
smallest document it meets most often, and links are joined to components. While many pairs meet across
components (a large group of near copies), each document is verified against a few other ones it meets,
chosen at random per signature. Then every pair that still meets across components is examined, so no link
between components is lost: under signatures of up to ``HOT`` documents as pairs; documents that meet
under hotter ones form clusters, whose blocks are compared inside tasks by bit maps of their tokens, and
only pairs that the bit maps cannot rule out leave the task to be verified. Pairs inside a component need no check: they cannot change it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import bounded_batches, broadcast_ids, mix, shingle_lists, signed, text_blocks
from vetrail.llm.components import connected_components
from vetrail.session import materialized

PERCENT = 80
#: A token in at least this many documents is frequent.
FREQUENT = 50
#: Most frequent tokens told to every task (8 bytes each).
MAX_FREQUENT = 2_000_000
_SINGLES_TO, _PAIRS_FROM = 50, 41
#: Documents under a signature from which on they are compared in blocks, and the size of a block.
HOT, BLOCK_DOCS = 64, 512
#: Bits of the map of a set's tokens.
MAP_BITS = 4096
#: Turns with random partners at most, and how many open pairs per row need none.
MAX_TURNS, FEW_PAIRS = 3, 8
_FLUSH = 1 << 19

_EDGES = np.array(sorted({int(np.ceil(1.25**k)) for k in range(90)}), np.int64)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-(percent * n) // 100) + 1


def _needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Least intersection of two linking sets of n and m tokens."""
    return -(-percent * (n + m) // (100 + percent))


@dataclass
class Frequent:
    """Ascending leading bits of the frequent tokens: ``token >> shift``."""

    leading: np.ndarray
    shift: int

    def holds(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.leading):
            return np.zeros(len(tokens), bool)
        wanted = tokens >> np.uint64(self.shift)
        return self.leading[np.minimum(np.searchsorted(self.leading, wanted), len(self.leading) - 1)] == wanted


def signatures(tokens: np.ndarray, frequent: Frequent, percent: int = PERCENT) -> tuple[np.ndarray, bool]:
    """Signatures of a set of ascending tokens, and whether they are its prefix of rare tokens only."""
    n = len(tokens)
    if not n:
        return tokens, True
    length = prefix_length(n, percent)
    often = frequent.holds(tokens)
    rare, common = tokens[~often], tokens[often]
    if len(rare) >= length:
        return rare[:length], True
    needed, out = length - len(rare), [rare]
    if n <= _SINGLES_TO:
        out.append(common[:needed])
    if n >= _PAIRS_FROM:
        own = int(np.searchsorted(_EDGES, n, "right"))
        for band in (own, own + 1):
            classes = max(1, int(_EDGES[min(band, len(_EDGES) - 1)] * (100 - percent) // 300))
            of = (mix(common) % np.uint64(classes)).astype(np.int64)
            _, first = np.unique(of, return_index=True)
            new = np.zeros(len(common), np.int64)
            new[first] = 1
            withstood = np.arange(1, len(common) + 1) - np.cumsum(new)
            stop = int(np.searchsorted(withstood, needed)) + 1
            order = np.argsort(of[:stop], kind="stable")
            token, kind = common[:stop][order], of[:stop][order]
            # All pairs inside a sub-class: neighbours at distance 1, 2, ... of the sorted list.
            for step in range(1, stop):
                same = kind[step:] == kind[:-step]
                if not same.any():
                    break
                out.append(mix(token[:-step][same] * np.uint64(3) + mix(token[step:][same] + np.uint64(band))))
    return np.concatenate(out), False


def _count_tokens(ranges: int, shift: int):
    """Leading bits of tokens with their document counts, packed in 4 bytes per hash range."""
    width = -(-(1 << (64 - shift)) // ranges)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        leading, counts = np.unique(np.concatenate(held) >> np.uint64(shift), return_counts=True)
        of = leading // np.uint64(width)
        packed = (leading - of * np.uint64(width)).astype(np.uint32)
        at = np.searchsorted(of, np.arange(ranges + 1, dtype=np.uint64))
        rows = [(r, a, b) for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if b > a]
        one = counts == 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _, _ in rows], pa.int32()),
                pa.array([packed[a:b][one[a:b]].tobytes() for _, a, b in rows], pa.binary()),
                pa.array([packed[a:b][~one[a:b]].tobytes() for _, a, b in rows], pa.binary()),
                pa.array([counts[a:b][~one[a:b]].astype(np.int32).tobytes() for _, a, b in rows], pa.binary()),
            ],
            names=["range", "once", "more", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, raw, at in text_blocks(batches):
            for tokens in shingle_lists(raw, at):
                held.append(tokens)
                size += len(tokens)
            if size > _FLUSH:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    return run


def _merge_counts(least: int, most: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        def joined(column: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in rows[column]])

        once, again = np.unique(joined("once", np.uint32), return_counts=True)
        tokens, which = np.unique(np.concatenate([once, joined("more", np.uint32)]), return_inverse=True)
        counts = np.bincount(which, np.concatenate([again, joined("times", np.int32)]), len(tokens))
        keep = np.flatnonzero(counts >= least)
        if len(keep) > most:
            keep = keep[np.argsort(-counts[keep], kind="stable")[:most]]
        return pd.DataFrame({"range": rows["range"].iloc[:1], "tokens": [tokens[keep].tobytes()]})

    return merge


def frequent_tokens(texts: DataFrame, least: int = FREQUENT, most: int = MAX_FREQUENT) -> Frequent:
    """Tokens that ``least`` documents or more hold, at most ``most``: the commonest of each hash range."""
    ranges = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shift = 32 - (ranges.bit_length() - 1)
    width = -(-(1 << (64 - shift)) // ranges)
    counted = texts.mapInArrow(_count_tokens(ranges, shift), "range int, once binary, more binary, times binary")
    # Each hash range returns its share of the bound; the driver holds at most 8 * most bytes.
    share = -(-most // ranges)
    found = counted.groupBy("range").applyInPandas(_merge_counts(least, share), "range int, tokens binary").collect()
    parts = [np.frombuffer(r[1], np.uint32).astype(np.uint64) + np.uint64(r[0] * width) for r in found]
    return Frequent(np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64), shift)


def bit_map(tokens: np.ndarray) -> np.ndarray:
    """Which of the ``MAP_BITS`` places, told by their trailing bits, the tokens take; packed in bytes."""
    places = np.zeros(MAP_BITS, bool)
    places[(tokens & np.uint64(MAP_BITS - 1)).astype(np.int64)] = True
    return np.packbits(places)


def _compare_blocks(percent: int):
    """Pairs across components and across two blocks of a cluster that the bit maps cannot rule out.

    A place that only one set takes holds a token the other lacks. More such places than the threshold
    allows misses rule a pair out. A document without a map, or of several sizes (0), is never ruled out.
    """

    def places(part: pd.DataFrame) -> np.ndarray:
        none = bytes(MAP_BITS // 8)
        packed = b"".join(none if x is None else x for x in part["bits"])
        maps = np.frombuffer(packed, np.uint8).reshape(len(part), MAP_BITS // 8)
        return np.unpackbits(maps, axis=1).astype(np.float32)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["_i"].iloc[0]), int(rows["_j"].iloc[0])
        left, right = rows[rows["_own"] == i], rows[rows["_own"] == j]
        one, two = places(left), places(right)
        both = one @ two.T
        n, m = left["n"].to_numpy(np.int64)[:, None], right["n"].to_numpy(np.int64)[None]
        needed = -(-percent * (n + m) // (100 + percent))
        open_ = (one.sum(axis=1)[:, None] - both <= n - needed) & (two.sum(axis=1)[None] - both <= m - needed)
        several = (n == 0) | (m == 0)
        open_ |= several | left["bits"].isna().to_numpy()[:, None] | right["bits"].isna().to_numpy()[None]
        open_ &= several | (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
        open_ &= left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None]
        a, b = left["doc"].to_numpy(np.int64), right["doc"].to_numpy(np.int64)
        if i == j:
            open_ &= a[:, None] < b[None]
        x, y = np.nonzero(open_)
        return pd.DataFrame({"a": np.minimum(a[x], b[y]), "b": np.maximum(a[x], b[y])})

    return compare


def _map_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, at in text_blocks(batches):
        maps = [bit_map(tokens).tobytes() for tokens in shingle_lists(raw, at)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(maps, pa.binary())], names=["doc", "bits"])


def _mapped(facts: DataFrame, texts: DataFrame, members: DataFrame) -> DataFrame:
    """(doc, n, bits) of the members. A prefix of rare tokens has no map yet: tokens beyond the bound on
    frequent ones count as rare however many documents hold them. An id of several maps has none, one of several
    sizes has size 0: nothing about it rules a pair out."""
    known = facts.join(members.select("doc").distinct(), "doc", "left_semi").groupBy("doc")
    known = known.agg(
        F.when(F.min("n") == F.max("n"), F.min("n")).otherwise(0).alias("n"),
        F.when(
            (F.min("bits") == F.max("bits")) & (F.count("bits") == F.count(F.lit(1))), F.min("bits")
        ).alias("bits"),
    )
    bare = materialized(known.filter(F.col("bits").isNull()).select("doc"))
    drawn = (
        texts.join(broadcast_ids(bare), "doc", "left_semi")
        .mapInArrow(_map_sets, "doc long, bits binary")
        .groupBy("doc")
        .agg(F.min("bits").alias("_drawn"), F.max("bits").alias("_other"))
        .filter(F.col("_drawn") == F.col("_other"))
        .select("doc", "_drawn")
    )
    return known.join(drawn, "doc", "left").select("doc", "n", F.coalesce("bits", "_drawn").alias("bits"))


def _hot_pairs(hot: DataFrame, facts: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs to verify of documents that meet under hot signatures: clusters, compared block by block."""
    lead = hot.groupBy("sig").agg(F.min("doc").alias("a"))
    members = hot.select("doc", "component").distinct()
    cluster = materialized(connected_components(hot.join(lead, "sig").select("a", F.col("doc").alias("b"))))
    blocks = cluster.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_DOCS)).cast("int").alias("_blocks")
    )
    blocks = cluster.join(blocks, "component").select(
        F.col("node").alias("doc"), F.col("component").alias("_cluster"), "_blocks"
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda k: F.struct(F.least("_own", k).alias("_i"), F.greatest("_own", k).alias("_j")),
    )
    return (
        members.join(blocks, "doc")
        .join(_mapped(facts, texts, members), "doc")
        .withColumn("_own", F.pmod(F.xxhash64("doc", F.lit("block")), F.col("_blocks")).cast("int"))
        .withColumn("_pair", F.explode(pairs))
        .select("_cluster", "_pair._i", "_pair._j", "_own", "doc", "component", "n", "bits")
        .groupBy("_cluster", "_i", "_j")
        .applyInPandas(_compare_blocks(percent), "a long, b long")
    )


def _index_sets(frequent, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for rows, raw, at in text_blocks(batches):
            n, one, two, last, rare, bits, flat = [], [], [], [], [], [], []
            for tokens in shingle_lists(raw, at):
                sigs, only_rare = signatures(tokens, often, percent)
                n.append(len(tokens))
                one.append(int(np.add.reduce(mix(tokens))))
                two.append(int(np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)))))
                last.append(int(sigs[-1] >> np.uint64(1)) if len(sigs) and only_rare else 0)
                rare.append(only_rare)
                bits.append(None if only_rare else bit_map(tokens).tobytes())
                flat.append(sigs)
            lengths = np.zeros(len(flat) + 1, np.int32)
            np.cumsum([len(s) for s in flat], out=lengths[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(signed(np.array(one, np.uint64))),
                    pa.array(signed(np.array(two, np.uint64))),
                    pa.array(rare, pa.bool_()),
                    pa.array(last, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(signed(np.concatenate(flat)))),
                ],
                names=["doc", "n", "one", "two", "rare", "last", "bits", "sigs"],
            )

    return run


def _verify(percent: int):
    """Pairs whose sets link; the last text of column a is remembered, as pairs come sorted by it. An id of several
    texts brings each of them; empty sets link with nothing."""

    def sets(texts: pa.Array) -> list[np.ndarray]:
        out = []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for _, raw, at in text_blocks(iter([batch])):
            out += shingle_lists(raw, at)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                text_a = part.column(2)
                changes = pc.fill_null(pc.not_equal(text_a[1:], text_a[:-1]), True).to_numpy(zero_copy_only=False)
                heads = np.flatnonzero(np.concatenate([[True], changes]))
                of_a = sets(text_a.take(pa.array(heads)))
                head = np.searchsorted(heads, np.arange(len(a)), "right") - 1
                kept = []
                for i, own in enumerate(sets(part.column(3))):
                    other = of_a[head[i]]
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(other) - both):
                        kept.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64())],
                    names=["a", "b"],
                )

    return run


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose documents link, checked on the whole texts."""
    pairs = materialized(pairs)
    ids = materialized(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct())
    needed = materialized(texts.join(broadcast_ids(ids), "doc", "left_semi"))
    return (
        pairs.join(needed.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
        .join(needed.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(percent), "a long, b long")
    )


def _across(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(sig, doc, component) of the signatures under which several components meet."""
    placed = shared.join(found, F.col("doc") == F.col("node"), "left").select(
        "sig", "doc", F.coalesce("component", "doc").alias("component")
    )
    placed = materialized(placed)
    mixed = placed.groupBy("sig").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return materialized(placed.join(mixed.filter("_low < _high").select("sig"), "sig"))


def _open_pairs(mixed: DataFrame) -> tuple[int, int]:
    """Pairs that meet across components, each as often as it meets, and rows."""
    each = mixed.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("n"))
    per = each.groupBy("sig").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("q"))
    row = per.agg(F.sum((F.col("n") * F.col("n") - F.col("q")) / 2), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)


def _random_partners(mixed: DataFrame, turn: int) -> DataFrame:
    """Per document up to three of another component, those it meets most often of one random one per signature."""
    draw = F.xxhash64("doc", F.lit(turn))
    one = mixed.groupBy("sig").agg(F.min_by(F.struct("doc", "component"), draw).alias("_one"))
    met = (
        mixed.join(one, "sig")
        .filter(F.col("component") != F.col("_one.component"))
        .groupBy("doc", F.col("_one.doc").alias("other"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("doc")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "other")), asc=False), 1, 3).alias("best"))
        .select("doc", F.explode("best.other").alias("other"))
    )
    return met.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()


def jaccard_components(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links, itself included).

    Ids are whole numbers. Null and empty texts and texts without words have the empty set and link with
    nothing. Texts of fewer than five words are one shingle. Rows that share an id are one document: what
    one of them links with, all do. An empty table gives an empty result. Other columns are not read.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
    often = bounded_batches(texts).sparkContext.broadcast(frequent_tokens(texts, frequent))
    schema = "doc long, n long, one long, two long, rare boolean, last long, bits binary, sigs array<long>"
    sets = materialized(texts.mapInArrow(_index_sets(often, percent), schema))
    filled = sets.filter((F.col("n") > 0) & F.col("doc").isNotNull())
    classes = materialized(filled.groupBy("one", "two", "n").agg(F.min("doc").alias("rep")))
    reps = filled.join(
        classes.select(F.col("rep").alias("doc"), "one", "two", "n"), ["doc", "one", "two", "n"], "left_semi"
    )
    # An id of several sets has size 0 and no prefix: nothing is ruled out ahead of its texts.
    whole = (F.min("one") == F.max("one")) & (F.min("two") == F.max("two")) & (F.min("n") == F.max("n"))
    facts = filled.groupBy("doc").agg(
        F.when(whole, F.min("n")).otherwise(0).alias("n"),
        (whole & F.min("rare")).alias("rare"),
        F.min("last").alias("last"),
    )

    postings = reps.select(F.explode("sigs").alias("sig"), "doc")
    met = postings.groupBy("sig").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("sig")
    shared = materialized(postings.join(met, "sig").distinct())

    # First the pairs with the smallest document of a signature: one per document, the most often met.
    lead = shared.groupBy("sig").agg(F.min("doc").alias("a"))
    stars = (
        shared.join(lead, "sig")
        .filter(F.col("a") < F.col("doc"))
        .groupBy("a", F.col("doc").alias("b"))
        .agg(F.count(F.lit(1)).alias("_met"))
        .groupBy("b")
        .agg(F.max_by("a", F.struct("_met", -F.col("a"))).alias("a"), F.max("_met").alias("_met"))
    )
    a_facts = facts.select(*[F.col(c).alias(f"{c}_a") for c in facts.columns])
    b_facts = facts.select(*[F.col(c).alias(f"{c}_b") for c in facts.columns])

    def sized(pairs: DataFrame) -> DataFrame:
        least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        return (
            pairs.join(a_facts, F.col("a") == F.col("doc_a"))
            .join(b_facts, F.col("b") == F.col("doc_b"))
            .filter((least == 0) | (least * 100 >= most * percent))
        )

    # A heuristic limit: what it leaves out is verified in the second turn.
    likely = sized(stars).filter(F.col("_met") * 20 >= F.least("n_a", "n_b") * 2)
    first = materialized(verified(likely.select("a", "b"), texts, percent))
    found = materialized(connected_components(first))

    # Large groups: further turns with partners chosen at random, while they thin out what is left.
    links, before = first, None
    for turn in range(MAX_TURNS):
        mixed = _across(shared, found)
        left, rows = _open_pairs(mixed)
        if left <= FEW_PAIRS * rows or (before is not None and left > before * 0.5):
            break
        before = left
        tried = sized(_random_partners(mixed, turn)).select("a", "b")
        links = materialized(links.union(verified(tried, texts, percent)))
        found = materialized(connected_components(links))
    else:
        mixed = _across(shared, found)

    # Then all pairs that meet across components.
    sizes = mixed.groupBy("sig").agg(F.count(F.lit(1)).alias("_docs"))
    mixed = materialized(mixed.join(sizes, "sig"))
    hot = _hot_pairs(mixed.filter(F.col("_docs") > HOT), filled, texts, percent)
    cold = mixed.filter(F.col("_docs") <= HOT).drop("_docs")
    other = cold.select("sig", F.col("doc").alias("b"), F.col("component").alias("_other"))
    across = (
        cold.withColumnRenamed("doc", "a")
        .join(other, "sig")
        .filter((F.col("a") < F.col("b")) & (F.col("component") != F.col("_other")))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("_met"))
    )
    # Of two prefixes of rare tokens the one that ends first is known in full: its tokens that the other lacks
    # are misses. More of them than the threshold allows rule the pair out.
    both = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))

    def misses(side: str):
        n = F.col(f"n_{side}")
        prefix = n - F.ceil(F.lit(percent) * n / F.lit(100)) + 1
        return prefix - F.col("_met") > n - both

    out = (
        F.col("rare_a")
        & F.col("rare_b")
        & F.when(F.col("last_a") < F.col("last_b"), misses("a"))
        .when(F.col("last_b") < F.col("last_a"), misses("b"))
        .otherwise(misses("a") & misses("b"))
    )
    to_check = sized(across).filter(~out).select("a", "b").union(hot).distinct()
    second = verified(to_check, texts, percent)
    links = links.union(materialized(second))
    # Rows of one id but different texts are tied through the classes they are in.
    tied = filled.join(classes, ["one", "two", "n"]).filter(F.col("doc") != F.col("rep"))
    links = links.union(tied.select(F.col("rep").alias("a"), F.col("doc").alias("b")))
    components = connected_components(links)
    return sets.join(components, F.col("doc") == F.col("node"), "left").select(
        F.col("doc").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )
