"""Fuzzy name matching: the best target for each source name by TF-IDF cosine of its n-grams.

Only scores of at least the threshold can become a match, so the join need not look at every pair
that shares a gram. Each unit vector is ordered from its rarest gram to its most common one. If two
vectors reach the threshold t, then at their first shared gram the rest of each vector, from that
gram on, still has a norm of t or more (Cauchy-Schwarz; prefix filtering, Bayardo et al., WWW 2007).
So only those leading grams are joined, and common grams, the hot join keys, mostly drop out. The
result is exact. Equal names are matched once, however many rows carry them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrail.functions.text import (
    char_grams, locations_overlap, normalize_location, normalize_name,
)
from vetrail.operators.ordered import broadcast_if_small
from vetrail.session import materialized

# The score accepted without a location, and what a confirmed location adds.
SURE_SCORE = 0.8
LOCATION_BONUS = 0.15
DEFAULT_THRESHOLD = 0.6
# Scores are ranked at 9 places, so that the order of summation decides no tie.
RANK_DIGITS = 9
_SLACK = 1e-9
#: Pairs that one leading gram may join; grams that would join more are keys only together with a second gram.
HOT_PAIRS = 4_000_000


def name_vectors(names: DataFrame, name: str, weight: str) -> DataFrame:
    """Unit TF-IDF vectors of distinct names: sorted arrays ``grams``, ``parts``, ``rest``.

    ``weight`` is how often each name occurs; it enters the document frequencies. Grams run from
    the rarest to the most common; ``rest[i]`` is the norm of the vector from gram i on, and has a
    closing 0.
    """
    # Names are small but costly to cut, so they are spread by number and not by size. Being
    # clustered by name, they are counted per (name, gram) without a further shuffle.
    n = names.sparkSession.conf.get("spark.sql.shuffle.partitions")
    n = int(n) if n.isdigit() else names.sparkSession.sparkContext.defaultParallelism
    spread = names.select(name, weight).repartition(n, name)
    terms = (
        spread.select(name, weight, F.explode(char_grams(name)).alias("gram"))
        .groupBy(name, "gram")
        .agg(F.count("*").alias("tf"), F.first(weight).alias(weight))
    )
    rows = names.agg(F.sum(weight)).scalar()
    vocabulary = terms.groupBy("gram").agg(F.sum(weight).alias("df"))
    vocabulary = vocabulary.withColumn("idf", F.log((1 + rows) / (1 + F.col("df"))) + 1)
    ordered = F.sort_array(
        F.collect_list(F.struct("df", "gram", (F.col("tf") * F.col("idf")).alias("w")))
    )
    vectors = terms.join(vocabulary, "gram").groupBy(name).agg(
        ordered.alias("v"), F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("norm")
    )
    unit = vectors.select(
        name,
        F.transform("v", lambda x: x["gram"]).alias("grams"),
        F.transform("v", lambda x: x["w"] / F.col("norm")).alias("parts"),
    )
    squares = F.aggregate(
        F.reverse("parts"),
        F.array(F.lit(0.0)),
        lambda found, x: F.concat(F.array(found[0] + x * x), found),
    )
    return unit.withColumn("rest", F.transform(squares, F.sqrt))


def _postings(vectors: DataFrame, side: str, threshold: float) -> DataFrame:
    """One slim row per leading gram of a vector: its part, and the norms from it and after it."""
    size = F.size(F.filter("rest", lambda r: r >= threshold - _SLACK))
    return vectors.select(
        F.col("name").alias(f"{side}_name"),
        F.inline(
            F.arrays_zip(
                F.slice("grams", 1, size).alias("gram"),
                F.slice("parts", 1, size).alias(f"{side}_part"),
                F.slice("rest", 1, size).alias(f"{side}_rest"),
                F.slice("rest", 2, size).alias(f"{side}_after"),
            )
        ),
    )


def _hot_grams(left: DataFrame, right: DataFrame) -> DataFrame:
    """Leading grams that would join more than ``HOT_PAIRS`` pairs, with their largest parts on either side; written."""
    one = left.groupBy("gram").agg(F.count("*").alias("n_s"), F.max("s_part").alias("s_max"))
    two = right.groupBy("gram").agg(F.count("*").alias("n_t"), F.max("t_part").alias("t_max"))
    met = one.join(two, "gram").filter(F.col("n_s") * F.col("n_t") > HOT_PAIRS)
    return materialized(met.select("gram", "s_max", "t_max"))


def _pair_postings(vectors: DataFrame, hot: DataFrame, side: str, other: str, threshold: float) -> DataFrame:
    """Per hot leading gram one row per later gram that may be the second one shared, keyed by both.

    What a pair shares from its second gram on is at most the norm of the rest there, so the rest must make up for what
    the hot gram's part times the largest part of the other side leaves of the threshold.
    """
    size = F.size(F.filter("rest", lambda r: r >= threshold - _SLACK))
    found = vectors.select("name", "grams", "parts", "rest", F.posexplode(F.slice("grams", 1, size)).alias("i", "gram"))
    found = found.join(broadcast_if_small(hot), "gram").withColumn("part", F.get("parts", "i"))
    least = threshold - _SLACK - F.col("part") * F.col(f"{other}_max")
    later = F.transform(
        F.filter(F.sequence(F.col("i") + 1, F.greatest(F.size("grams"), F.col("i") + 1)), lambda j: F.get("rest", j) >= least),
        lambda j: F.struct(F.get("grams", j).alias("second"), F.get("rest", j).alias("rest")),
    )
    return found.select(
        F.col("name").alias(f"{side}_name"), "gram", F.col("part").alias(f"{side}_part"), F.explode(later).alias("x")
    ).select(f"{side}_name", "gram", f"{side}_part", "x.second", F.col("x.rest").alias(f"{side}_rest")).filter("second is not null")


def _candidates(vectors: DataFrame, threshold: float) -> DataFrame:
    """Pairs that can still reach the threshold.

    The rows kept of a pair are its first shared grams, so what their sum lacks is at most the
    product of the norms after the last of them. Hot grams are no keys by themselves, except among names that
    could reach the threshold by that gram alone; a pair whose first shared gram is hot meets under it and its second one.
    What hot grams may add to another pair is bounded by the largest parts.
    """
    least = threshold - _SLACK
    sources, targets = vectors.filter("is_source"), vectors.filter("target is not null")
    left, right = _postings(sources, "s", threshold), _postings(targets, "t", threshold)
    hot = None
    if vectors.count() ** 2 > HOT_PAIRS:
        hot = _hot_grams(left, right)
        hot = hot if hot.limit(1).count() else None
    if hot is not None:
        told = broadcast_if_small(hot)
        left, right = left.join(told, "gram", "left"), right.join(told, "gram", "left")
        alone = F.col("s_max").isNull()
        over = {}
        for side, other in (("s", "t"), ("t", "s")):
            rows = left if side == "s" else right
            bound = F.coalesce(F.col(f"{side}_part") * F.col(f"{other}_max"), F.lit(0.0))
            every = rows.groupBy(f"{side}_name").agg(F.sum(bound).alias(f"{side}_hot"))
            kept = rows.filter(alone | (bound >= least)).drop("s_max", "t_max")
            over[side] = kept.join(every.filter(F.col(f"{side}_hot") > 0), f"{side}_name", "left").na.fill(0.0, [f"{side}_hot"])
        left, right = over["s"], over["t"]
    else:
        left, right = left.withColumn("s_hot", F.lit(0.0)), right.withColumn("t_hot", F.lit(0.0))
    met = left.join(right, "gram").filter(F.col("s_rest") * F.col("t_rest") >= least)
    pairs = (
        met.groupBy("s_name", "t_name")
        .agg(
            F.sum(F.col("s_part") * F.col("t_part")).alias("seen"),
            F.min(F.col("s_after") * F.col("t_after")).alias("unseen"),
            F.least(F.first("s_hot"), F.first("t_hot")).alias("hot"),
        )
        .filter(F.col("seen") + F.col("unseen") + F.col("hot") >= least)
        .select("s_name", "t_name")
    )
    if hot is None:
        return pairs
    first = _pair_postings(sources, hot, "s", "t", threshold)
    second = _pair_postings(targets, hot, "t", "s", threshold)
    reach = F.col("s_part") * F.col("t_part") + F.col("s_rest") * F.col("t_rest")
    by_two = first.join(second, ["gram", "second"]).filter(reach >= least).select("s_name", "t_name")
    return pairs.union(by_two).distinct()


def _with_cosine(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact cosine of candidate pairs: both vectors are joined to the pair and multiplied batch by batch."""

    def side(s: str) -> DataFrame:
        return vectors.select(
            F.col("name").alias(f"{s}_name"), F.col("grams").alias(f"{s}_grams"), F.col("parts").alias(f"{s}_parts")
        )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, gram, part = {}, {}, {}
            for s in "st":
                grams, parts = (batch.column(batch.schema.get_field_index(f"{s}_{c}")) for c in ("grams", "parts"))
                row[s] = np.repeat(np.arange(len(grams)), pc.list_value_length(grams).to_numpy(zero_copy_only=False))
                gram[s], part[s] = grams.flatten(), parts.flatten().to_numpy(zero_copy_only=False)
            coded = pa.concat_arrays([gram["s"], gram["t"]]).dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keys = np.concatenate([row["s"], row["t"]]) * max(1, len(coded.dictionary)) + code
            of_s, of_t = keys[: len(row["s"])], keys[len(row["s"]) :]
            order = np.argsort(of_t)
            place = np.minimum(np.searchsorted(of_t[order], of_s), max(0, len(of_t) - 1))
            shared = of_t[order][place] == of_s if len(of_t) else np.zeros(len(of_s), bool)
            products = part["s"][shared] * part["t"][order[place[shared]]]
            cosine = np.bincount(row["s"][shared], products, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(cosine)], names=["s_name", "t_name", "cosine"])

    joined = pairs.join(side("s"), "s_name").join(side("t"), "t_name")
    columns = ["s_name", "t_name", "s_grams", "s_parts", "t_grams", "t_parts"]
    return joined.select(columns).mapInArrow(multiply, "s_name string, t_name string, cosine double")


def best_matches(
    sources: DataFrame,
    targets: DataFrame,
    source_name: str,
    target_name: str,
    target_id: str,
    threshold: float = DEFAULT_THRESHOLD,
    source_weight: str | None = None,
    carry: tuple[str, ...] = (),
    strip_first: bool = False,
) -> DataFrame:
    """Best target per normalised source name, where its cosine reaches the threshold.

    Columns ``norm_name``, ``target_id``, ``cosine`` and the ``carry`` columns of that target row.
    Among equal scores the smallest target id wins. ``source_weight`` counts rows per source.
    """
    one = F.lit(1).cast("bigint")
    named_s = sources.select(
        normalize_name(source_name, strip_first).alias("name"),
        (F.col(source_weight).cast("bigint") if source_weight else one).alias("weight"),
        F.lit(True).alias("is_source"),
    )
    named_t = targets.select(
        normalize_name(target_name, strip_first).alias("name"),
        one.alias("weight"),
        F.struct(F.col(target_id).alias("id"), *carry).alias("target"),
    )
    # Copies of a name collapse here, with partial sums before the shuffle. Smallest id first.
    # What is left is written once, so the raw rows are read and normalised once.
    names = materialized(
        named_t.unionByName(named_s, allowMissingColumns=True)
        .groupBy("name")
        .agg(
            F.sum("weight").alias("weight"),
            F.bool_or(F.coalesce("is_source", F.lit(False))).alias("is_source"),
            F.min("target").alias("target"),
        )
    )
    # The vectors are read four times below; one row per distinct name is written, once.
    vectors = materialized(
        name_vectors(names, "name", "weight").join(
            names.select("name", "is_source", "target"), "name"
        )
    )
    pairs = _with_cosine(_candidates(vectors, threshold), vectors)
    ids = vectors.filter("target is not null").select(F.col("name").alias("t_name"), "target")
    ranked = pairs.join(ids, "t_name").select(
        F.col("s_name").alias("norm_name"),
        F.struct(
            (-F.round("cosine", RANK_DIGITS)).alias("order"), "target", "cosine"
        ).alias("candidate"),
    )
    best = ranked.groupBy("norm_name").agg(F.min("candidate").alias("best"))
    return best.select(
        "norm_name",
        F.col("best.target.id").alias("target_id"),
        F.col("best.cosine").alias("cosine"),
        *[F.col(f"best.target.{c}").alias(c) for c in carry],
    ).filter(F.round("cosine", RANK_DIGITS) >= threshold)


def accepted_score(
    cosine: Column, threshold: float, overlap: Column | None, bonus: float = LOCATION_BONUS
) -> Column:
    """Final score of the best target, or null where it is rejected.

    A sure score stands alone. A lower one from the threshold on needs a shared location, which
    raises it, or stands if locations are not used at all (``overlap`` is None).
    """
    cosine9 = F.round(cosine, RANK_DIGITS)
    sure = F.when(cosine9 >= SURE_SCORE, cosine)
    if overlap is None:
        return sure.when(cosine9 >= threshold, cosine)
    return sure.when((cosine9 >= threshold) & overlap, cosine + bonus)


def match_names(
    sources: DataFrame,
    targets: DataFrame,
    source_name: str,
    target_name: str,
    target_id: str,
    threshold: float = DEFAULT_THRESHOLD,
    source_location: str | None = None,
    target_location: str | None = None,
    bonus: float = LOCATION_BONUS,
    source_weight: str | None = None,
    strip_first: bool = False,
) -> DataFrame:
    """Match table: the source columns of matched rows with ``matched_id`` and ``match_score``.

    Locations count only if both sides have them. A target of lower rank is never tried.
    """
    located = source_location is not None and target_location is not None
    carry, renamed = (), targets
    if located:
        renamed = targets.withColumn("_target_location", F.col(target_location))
        carry = ("_target_location",)
    best = best_matches(
        sources, renamed, source_name, target_name, target_id, threshold, source_weight, carry,
        strip_first,
    )
    overlap = (
        locations_overlap(F.col(source_location), F.col("_target_location")) if located else None
    )
    return (
        sources.withColumn("norm_name", normalize_name(source_name, strip_first))
        .join(best, "norm_name")
        .withColumn("match_score", accepted_score(F.col("cosine"), threshold, overlap, bonus))
        .filter("match_score is not null")
        .withColumnRenamed("target_id", "matched_id")
        .drop("norm_name", "cosine", *carry)
    )


def with_match(
    rows: DataFrame, matches: DataFrame, name: str, matched: str = "matched_fei"
) -> DataFrame:
    """Attach a match table by raw name: null and score 0.0 where there is no match."""
    table = matches.select(
        F.col(name).alias("_name"),
        F.col("matched_id").alias(matched),
        F.col("match_score").alias("_score"),
    )
    return (
        rows.join(table, F.col(name) == F.col("_name"), "left")
        .withColumn("match_score", F.coalesce("_score", F.lit(0.0)))
        .drop("_name", "_score")
    )


def match_letters(
    letters: DataFrame,
    facilities: DataFrame,
    company: str = "company_name",
    legal_name: str = "Legal Name",
    entity: str = "FEI Number",
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Letters with ``matched_fei`` and ``match_score``. Every letter row weighs in the
    frequencies; no location is used."""
    names = letters.groupBy(company).agg(F.count("*").alias("_rows"))
    matches = match_names(
        names, facilities, company, legal_name, entity, threshold, source_weight="_rows"
    )
    return with_match(letters, matches, company)


def first_per_name(rows: DataFrame, name: str, order: str, *columns: str) -> DataFrame:
    """The first row of each name in a given order, with the named columns."""
    first = F.min(F.struct(order, *columns)).alias("f")
    return rows.groupBy(name).agg(first).select(name, *[F.col(f"f.{c}").alias(c) for c in columns])


def match_recalls(
    recalls: DataFrame,
    facilities: DataFrame,
    order: str,
    firm: str = "recalling_firm",
    firm_location: tuple[str, ...] = ("city", "state", "country"),
    legal_name: str = "Legal Name",
    entity: str = "FEI Number",
    facility_location: tuple[str, ...] = ("City", "State", "Country/Area"),
    threshold: float = DEFAULT_THRESHOLD,
    nan_token: bool = False,
) -> DataFrame:
    """Recalls with ``matched_fei`` and ``match_score``. Each firm is matched once, with the
    location of its first row in ``order``; borderline scores need a shared location."""
    firms = first_per_name(recalls, firm, order, *firm_location).withColumn(
        "_location", normalize_location(*firm_location, nan_token=nan_token)
    )
    places = facilities.withColumn(
        "_place", normalize_location(*facility_location, nan_token=nan_token)
    )
    matches = match_names(
        firms, places, firm, legal_name, entity, threshold, "_location", "_place"
    )
    return with_match(recalls, matches, firm)


def match_mapping(matched: DataFrame, source: str, name: str) -> DataFrame:
    """The mapping (source, name, fei, score) of the names that were matched."""
    return (
        matched.filter("matched_fei is not null")
        .groupBy(F.col(name).alias("name"))
        .agg(F.min("matched_fei").alias("fei"), F.max("match_score").alias("score"))
        .select(F.lit(source).alias("source"), "name", "fei", "score")
    )


def match_rate(matched: DataFrame, name: str) -> DataFrame:
    """Distinct names, how many of them are matched, and the share."""
    hit = F.when(F.col("matched_fei").isNotNull(), 1).otherwise(0)
    names = matched.filter(F.col(name).isNotNull()).groupBy(name).agg(F.max(hit).alias("hit"))
    return names.agg(
        F.count("*").alias("n_names"),
        F.sum("hit").cast("bigint").alias("n_matched"),
        F.avg(F.col("hit").cast("double")).alias("rate"),
    )


def with_entity(rows: DataFrame, mapping: DataFrame, source: str, name: str) -> DataFrame:
    """Look up ``matched_fei`` by raw name in a mapping table; rows without one are dropped."""
    known = mapping.filter((F.col("source") == source) & F.col("fei").isNotNull()).select(
        F.col("name").alias("_name"), F.col("fei").alias("matched_fei")
    )
    return rows.join(known, F.col(name) == F.col("_name")).drop("_name")
