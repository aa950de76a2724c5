"""Point-in-time history of every event: what was known of the entity before it.

Two layouts give the same rows:

* ``entity``: events and side sums of an entity meet in one window partition. One shuffle and one
  sort serve every column.
* ``blocks``: for entities with more events than one task should hold. A block is one entity on
  one day. Rows are ordered inside their block, each block leaves one summary row, the summaries
  are windowed per entity (at most two rows per calendar day, however many events there are), and
  what a block carries in is joined back on (entity, day).

The number of events per entity is counted first, and only the entities above the limit take the
second way. Side events are always summed to one row per (entity, day) before they meet the
events, with partial sums ahead of that shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetrail.columns import FEATURE_TABLE, HISTORY_FEATURES, EventColumns
from vetrail.session import materialized

# Day number of rows without a date: they come after every dated row.
_UNDATED = 2**31 - 1


@dataclass(frozen=True)
class SideEvents:
    """A table of dated side events of an entity.

    ``measures`` maps an output name to the 0/1 or numeric column summed over earlier events;
    ``latest`` maps an output name to the condition of the events whose newest day it tells. One
    scan of a table can so serve several kinds of events.
    """

    rows: DataFrame
    entity: str
    date: str
    measures: Mapping[str, Column] = field(default_factory=dict)
    latest: Mapping[str, Column] = field(default_factory=dict)


def _day_number(date: str) -> Column:
    return F.unix_date(F.col(date).cast("date"))


def _daily_totals(sources: Sequence[SideEvents]) -> tuple[DataFrame, list[str], list[str]]:
    """One row per (entity, day) with the sums of all sources; undated events are dropped."""
    sums = [name for s in sources for name in s.measures]
    latest = [name for s in sources for name in s.latest]
    stacked = None
    for s in sources:
        own = s.rows.filter(F.col(s.entity).isNotNull() & F.col(s.date).isNotNull()).select(
            F.col(s.entity).alias("_entity"),
            _day_number(s.date).alias("_day"),
            *[
                (s.measures[m].cast("bigint") if m in s.measures else F.lit(0).cast("bigint")).alias(m)
                for m in sums
            ],
            *[
                (
                    F.when(s.latest[name], _day_number(s.date))
                    if name in s.latest
                    else F.lit(None).cast("int")
                ).alias(name)
                for name in latest
            ],
        )
        stacked = own if stacked is None else stacked.unionByName(own)
    daily = stacked.groupBy("_entity", "_day").agg(
        *[F.sum(m).alias(m) for m in sums], *[F.max(name).alias(name) for name in latest]
    )
    return daily, sums, latest


def _earlier_days() -> "Window":
    return (
        Window.partitionBy("_entity")
        .orderBy("_day")
        .rangeBetween(Window.unboundedPreceding, -1)
    )


def prior_side_totals(
    events: DataFrame, entity: str, date: str, sources: Sequence[SideEvents]
) -> DataFrame:
    """As-of aggregate join: per event, the sums over side events strictly before its date.

    Adds every measure (0 where nothing came before) and every ``latest`` output as whole days
    since then (-1 where nothing came before). An event without a date has no earlier events.
    """
    daily, sums, latest = _daily_totals(sources)
    keyed = events.withColumns(
        {"_entity": F.col(entity), "_day": F.coalesce(_day_number(date), F.lit(_UNDATED))}
    )
    marks = keyed.filter(F.col("_entity").isNotNull()).groupBy("_entity", "_day").agg(
        F.lit(True).alias("_mark")
    )
    earlier = _earlier_days()
    carried = (
        marks.unionByName(daily, allowMissingColumns=True)
        .select(
            "_entity",
            "_day",
            "_mark",
            *[F.sum(m).over(earlier).alias(m) for m in sums],
            *[F.max(name).over(earlier).alias(name) for name in latest],
        )
        .filter("_mark")
        .drop("_mark")
    )
    dated = F.col(date).isNotNull()
    return (
        keyed.join(carried, ["_entity", "_day"], "left")
        .withColumns(
            {m: F.when(dated, F.coalesce(m, F.lit(0))).otherwise(0).cast("bigint") for m in sums}
            | {
                name: F.when(dated & F.col(name).isNotNull(), F.col("_day") - F.col(name))
                .otherwise(-1)
                .cast("int")
                for name in latest
            }
        )
        .drop("_entity", "_day")
    )


def upcoming_side_total(
    events: DataFrame, entity: str, date: str, source: SideEvents, days: int = 365
) -> DataFrame:
    """Sums over the side events of the following days (the event's own day excluded).

    An alternative target: for example whether a letter follows within a year.
    """
    daily, sums, _ = _daily_totals([source])
    keyed = events.withColumns({"_entity": F.col(entity), "_day": _day_number(date)})
    marks = keyed.filter("_entity is not null and _day is not null").groupBy("_entity", "_day").agg(
        F.lit(True).alias("_mark")
    )
    later = Window.partitionBy("_entity").orderBy("_day").rangeBetween(1, days)
    carried = (
        marks.unionByName(daily, allowMissingColumns=True)
        .select("_entity", "_day", "_mark", *[F.sum(m).over(later).alias(m) for m in sums])
        .filter("_mark")
        .drop("_mark")
    )
    return (
        keyed.join(carried, ["_entity", "_day"], "left")
        .withColumns({m: F.coalesce(m, F.lit(0)).cast("bigint") for m in sums})
        .drop("_entity", "_day")
    )


def heavy_entities(keys: DataFrame, entity: str, limit: int) -> DataFrame | None:
    """Entities with more than ``limit`` rows, or None if there is none.

    Runs one job over the key column, and writes what it finds: at most (rows / limit) keys.
    """
    known = keys.filter(F.col(entity).isNotNull())
    counts = known.groupBy(F.col(entity).alias("_entity")).count()
    heavy = counts.filter(F.col("count") > limit).select("_entity")
    return None if heavy.isEmpty() else materialized(heavy)


#: Events whose history one task works out, where the session's partitions would hold more.
TASK_ROWS = 250_000


def _partitions(keys: DataFrame, entity: str) -> int | None:
    """Partitions that leave a task few enough events, or None where the session's number does (one job over the keys)."""
    wanted = -(-keys.filter(F.col(entity).isNotNull()).count() // TASK_ROWS)
    return wanted if wanted > int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


# What each row adds to the running totals of its entity.
_ADDS = {"n": "_one", "oai": "target_oai", "vai": "is_vai", "nai": "is_nai", "cit": "n_citations",
         "cfr": "n_unique_cfr"}


def history_features(
    events: DataFrame,
    cols: EventColumns = EventColumns(),
    side: Sequence[SideEvents] = (),
    ties: str = "positional",
    keep: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    keys: DataFrame | None = None,
    entity_limit: int = 2_000_000,
) -> DataFrame:
    """History of each event: earlier outcomes, recency, trend, citations, side events.

    ``events`` carries ``is_oai``, ``is_vai``, ``is_nai``, ``n_citations`` and ``n_unique_cfr``.
    Rows without an entity are dropped. ``ties="positional"`` orders the events of one day by
    (event id, area), and the later sees the earlier; ``ties="strict"`` shows it earlier days only.
    ``keep`` names further columns of ``events`` to carry through, ``totals`` further output sums
    over the earlier events (output name to column of ``events``). ``keys`` may give a cheaper
    frame than ``events`` in which to count the rows per entity; ``entity_limit`` is the number
    above which an entity is split into day blocks.
    """
    if ties not in ("positional", "strict"):
        raise ValueError("ties must be 'positional' or 'strict'")

    rows = events.filter(F.col(cols.entity).isNotNull()).select(
        F.col(cols.entity).alias("_entity"),
        F.coalesce(_day_number(cols.date), F.lit(_UNDATED)).alias("_day"),
        F.col(cols.event_id).alias("inspection_id"),
        F.col(cols.date).cast("date").alias("inspection_date"),
        F.col(cols.kind).alias("product_type"),
        F.col(cols.country).alias("country"),
        F.col(cols.area).alias("project_area"),
        F.col("is_oai").alias("target_oai"),
        *[F.col(c).cast("bigint") for c in ("is_vai", "is_nai", "n_citations", "n_unique_cfr")],
        *[F.col(c).cast("bigint").alias(f"_add_{name}") for name, c in (totals or {}).items()],
        *keep,
    )
    adds = _ADDS | {name: f"_add_{name}" for name in totals or {}}
    daily, sums, latest = _daily_totals(side) if side else (None, [], [])
    counted = events if keys is None else keys
    heavy = heavy_entities(counted, cols.entity, entity_limit)
    partitions = _partitions(counted, cols.entity)
    if heavy is None:
        found = _by_entity(rows, daily, sums, latest, ties, adds, partitions)
    else:
        few = F.broadcast(heavy)  # at most rows / entity_limit keys
        # Both layouts read the joined events and the daily sums; they are worked out once.
        rows, daily = materialized(rows), None if daily is None else materialized(daily)

        def part(frame: DataFrame | None, how: str) -> DataFrame | None:
            return None if frame is None else frame.join(few, "_entity", how)

        found = _by_entity(
            part(rows, "left_anti"), part(daily, "left_anti"), sums, latest, ties, adds, partitions
        ).unionByName(
            _by_day_blocks(
                part(rows, "left_semi"), part(daily, "left_semi"), sums, latest, ties, adds
            )
        )
    return _assemble(found, sums, latest, [*(totals or {}), *keep])


def _timeline(rows: DataFrame, daily: DataFrame | None) -> DataFrame:
    """Events and side sums in one frame; ``_event`` is null on side rows."""
    marked = rows.withColumn("_event", F.lit(True))
    return marked if daily is None else marked.unionByName(daily, allowMissingColumns=True)


def _by_entity(rows, daily, sums, latest, ties, per_row, partitions=None) -> DataFrame:
    """Running totals and the two newest earlier events, one window partition per entity."""
    line = Window.partitionBy("_entity").orderBy("_day", "inspection_id", "project_area")
    earlier = _earlier_days()
    adds = {k: F.lit(1) if c == "_one" else F.col(c) for k, c in per_row.items()}
    placed = _timeline(rows, daily)
    placed = placed if partitions is None else placed.repartition(partitions, "_entity")
    # The sums over side rows come first: without them the windows over events pass over fewer rows.
    carried = {m: F.sum(m).over(earlier) for m in sums} | {name: F.max(name).over(earlier) for name in latest}
    events = placed.withColumns(carried).filter("_event").drop("_event")
    if ties == "strict":
        # The newest event of earlier days, and through it the one before that.
        second = F.lag("target_oai").over(line)
        own = F.struct("_day", "inspection_id", "project_area", "target_oai", "is_vai", F.col("_1").alias("second"))
        frame, linked, newest = earlier, events.withColumn("_1", second), F.max(own).over(earlier)
        found = {"last_day": "_2._day", "last_oai": "_2.target_oai", "last_vai": "_2.is_vai", "second_oai": "_2.second"}
        two, found = {"_2": newest}, {name: F.col(c) for name, c in found.items()}
    else:
        frame, linked, found = line.rowsBetween(Window.unboundedPreceding, -1), events, {}
        two = {"last_day": F.lag("_day").over(line), "last_oai": F.lag("target_oai").over(line),
               "last_vai": F.lag("is_vai").over(line), "second_oai": F.lag("target_oai", 2).over(line)}
    totals = {f"t_{k}": F.coalesce(F.sum(c).over(frame), F.lit(0)).cast("bigint") for k, c in adds.items()}
    return linked.withColumns(two | totals | {"t_max": F.max("n_citations").over(frame)}).withColumns(found).drop("_1", "_2")


def _by_day_blocks(rows, daily, sums, latest, ties, per_row) -> DataFrame:
    """The same totals in two levels, so that no task holds all rows of an entity."""
    # Without this exchange the windows would accept rows that are clustered by entity alone.
    rows = rows.repartition("_entity", "_day")
    in_day = Window.partitionBy("_entity", "_day").orderBy("inspection_id", "project_area")
    before = in_day.rowsBetween(Window.unboundedPreceding, -1)
    adds = {k: F.lit(1) if c == "_one" else F.col(c) for k, c in per_row.items()}
    ranked = rows.withColumns(
        {
            **{f"d_{k}": F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint") for k, c in adds.items()},
            "d_max": F.max("n_citations").over(before),
            "d_oai1": F.lag("target_oai", 1).over(in_day),
            "d_vai1": F.lag("is_vai", 1).over(in_day),
            "d_oai2": F.lag("target_oai", 2).over(in_day),
            "d_closes": F.lead(F.lit(1), 1).over(in_day).isNull(),
        }
    )
    ranked = materialized(ranked)
    blocks = ranked.filter("d_closes").select(
        "_entity",
        "_day",
        *[(F.col(f"d_{k}") + c).alias(f"c_{k}") for k, c in adds.items()],
        F.greatest("d_max", "n_citations").alias("c_max"),
        F.col("target_oai").alias("l_oai"),
        F.col("is_vai").alias("l_vai"),
        F.col("d_oai1").alias("l_oai2"),
    )
    earlier = _earlier_days()
    linked = _timeline(blocks, daily).withColumn(
        "p", F.last(F.when(F.col("_event"), F.struct("_day", "l_oai", "l_vai")), ignorenulls=True).over(earlier)
    )
    second = F.when(F.col("_event"), F.struct(F.coalesce("l_oai2", "p.l_oai").alias("oai")))
    carried = (
        linked.select(
            "_entity",
            "_day",
            "_event",
            "p",
            F.last(second, ignorenulls=True).over(earlier)["oai"].alias("p_oai2"),
            *[F.coalesce(F.sum(f"c_{k}").over(earlier), F.lit(0)).alias(f"c_{k}") for k in per_row],
            F.max("c_max").over(earlier).alias("c_max"),
            *[F.sum(m).over(earlier).alias(m) for m in sums],
            *[F.max(name).over(earlier).alias(name) for name in latest],
        )
        .filter("_event")
        .drop("_event")
    )
    joined = ranked.join(carried, ["_entity", "_day"])
    if ties == "strict":  # the rows of the same day do not count
        joined = joined.withColumns({f"d_{k}": F.lit(0).cast("bigint") for k in per_row}).withColumn(
            "d_max", F.lit(None).cast("bigint")
        )
    inside, two_inside = F.col("d_n") > 0, F.col("d_n") > 1
    return joined.withColumns(
        {
            **{f"t_{k}": F.col(f"c_{k}") + F.col(f"d_{k}") for k in per_row},
            "t_max": F.greatest("c_max", "d_max"),
            "last_day": F.when(inside, F.col("_day")).otherwise(F.col("p._day")),
            "last_oai": F.when(inside, F.col("d_oai1")).otherwise(F.col("p.l_oai")),
            "last_vai": F.when(inside, F.col("d_vai1")).otherwise(F.col("p.l_vai")),
            "second_oai": F.when(two_inside, F.col("d_oai2"))
            .when(inside, F.col("p.l_oai"))
            .otherwise(F.col("p_oai2")),
        }
    ).drop(
        "p", "p_oai2", "c_max", "d_max", "d_oai1", "d_vai1", "d_oai2", "d_closes",
        *[f"{level}_{k}" for level in "cd" for k in per_row],
    )


def _assemble(found: DataFrame, sums, latest, keep) -> DataFrame:
    """Feature columns from the totals ``t_*`` and the two newest earlier events."""
    n = F.col("t_n")
    seen, two = n > 0, n >= 2
    at_least_one = F.greatest(n, F.lit(1).cast("bigint"))
    dated = F.col("inspection_date").isNotNull()
    last_oai, second_oai = F.col("last_oai"), F.col("second_oai")
    out = {
        "n_prior_inspections": n,
        "n_prior_oai": F.col("t_oai"),
        "n_prior_vai": F.col("t_vai"),
        "n_prior_nai": F.col("t_nai"),
        "pct_oai": F.col("t_oai") / at_least_one,
        "pct_vai": F.col("t_vai") / at_least_one,
        "days_since_last_inspection": F.when(~seen, -1).when(
            dated, F.col("_day") - F.col("last_day")
        ),
        "last_classification_oai": F.coalesce(last_oai, F.lit(0)).cast("int"),
        "last_classification_vai": F.coalesce("last_vai", F.lit(0)).cast("int"),
        "trend_worsening": F.coalesce(two & (last_oai > second_oai), F.lit(False)).cast("int"),
        "recent_oai_rate": F.when(two, (last_oai + second_oai) / 2).otherwise(0.0),
        "total_prior_citations": F.col("t_cit"),
        "avg_citations_per_inspection": F.col("t_cit") / at_least_one,
        "max_citations_single_inspection": F.coalesce("t_max", F.lit(0)).cast("bigint"),
        "total_unique_cfr_violated": F.col("t_cfr"),
    }
    assert list(out) == HISTORY_FEATURES
    for m in sums:
        out[m] = F.when(dated, F.coalesce(m, F.lit(0))).otherwise(0).cast("bigint")
    for name in latest:
        out[name] = (
            F.when(dated & F.col(name).isNotNull(), F.col("_day") - F.col(name))
            .otherwise(-1)
            .cast("int")
        )
    return found.select(
        "inspection_id",
        F.col("_entity").alias("fei_number"),
        "inspection_date",
        "product_type",
        "country",
        "project_area",
        "target_oai",
        *[c.alias(name) for name, c in out.items()],
        *[F.col(f"t_{c}").alias(c) if f"t_{c}" in found.columns else F.col(c) for c in keep],
    )


def side_sources(
    letters: DataFrame,
    recalls: DataFrame,
    forms: DataFrame,
    entity: str = "matched_fei",
    letter_date: str = "issue_date",
    recall_date: str = "recall_date",
    recall_class: str = "classification",
    form_entity: str = "FEI Number",
    form_date: str = "Record Date",
    classes: tuple[str, str] = ("Class I", "Class II"),
) -> list[SideEvents]:
    """The three side-event tables with their measures."""
    first, second = (F.col(recall_class).eqNullSafe(c).cast("int") for c in classes)
    one = F.lit(1)
    return [
        SideEvents(
            letters, entity, letter_date, {"n_warning_letters": one},
            {"days_since_last_wl": F.lit(True)},
        ),
        SideEvents(
            recalls,
            entity,
            recall_date,
            {"n_recalls": one, "n_class_I_recalls": first, "n_class_II_recalls": second},
        ),
        SideEvents(forms, form_entity, form_date, {"n_published_483s": one}),
    ]


def with_presence_flags(features: DataFrame) -> DataFrame:
    """Add the 0/1 columns that say whether there was any earlier letter, recall or form."""
    return features.withColumns(
        {
            "has_warning_letter": (F.col("n_warning_letters") > 0).cast("int"),
            "has_recall": (F.col("n_recalls") > 0).cast("int"),
            "has_published_483": (F.col("n_published_483s") > 0).cast("int"),
        }
    )


def feature_table(
    events: DataFrame,
    side: Sequence[SideEvents],
    cols: EventColumns = EventColumns(),
    **options,
) -> DataFrame:
    """The full feature table: 7 identity and static columns, 24 of history."""
    return with_presence_flags(history_features(events, cols, side, **options)).select(
        *FEATURE_TABLE
    )
