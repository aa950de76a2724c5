"""History features: worked example, brute force, layouts, ties, nulls."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from vetrail.columns import FEATURE_TABLE, OUTCOME_NAI, OUTCOME_OAI, OUTCOME_VAI
from vetrail.operators import clean, detail, history, score
from vetrail.sources import schemas

NAMES = {"N": OUTCOME_NAI, "V": OUTCOME_VAI, "O": OUTCOME_OAI}


def day(text):
    return date.fromisoformat(text) if text else None


def inspections(spark, rows):
    """Rows (id, facility, date, outcome, area)."""
    full = [
        (i, fei, f"Firm {fei}", None, None, "US", day(d), NAMES.get(o), area, "Drugs", 2020)
        for i, fei, d, o, area in rows
    ]
    return spark.createDataFrame(full, schemas.INSPECTIONS)


def citations(spark, rows):
    return spark.createDataFrame(
        [(i, None, code, None, None, None) for i, code in rows], schemas.CITATIONS
    )


def sides(spark, letters=(), recalls=(), forms=()):
    return history.side_sources(
        spark.createDataFrame([(f, day(d)) for f, d in letters], "matched_fei long, issue_date date"),
        spark.createDataFrame(
            [(f, day(d), c) for f, d, c in recalls],
            "matched_fei long, recall_date date, classification string",
        ),
        spark.createDataFrame([(f, day(d)) for f, d in forms], "`FEI Number` long, `Record Date` date"),
    )


def build(spark, rows, cites=(), side=None, **options):
    counts = detail.detail_counts(citations(spark, cites), "Inspection ID", "Act/CFR Number")
    events = detail.with_detail_counts(
        clean.prepare_inspections(inspections(spark, rows)), counts, "Inspection ID"
    )
    return history.feature_table(events, side or sides(spark), **options)


EXAMPLE = [
    (11, 1001, "2020-01-10", "N", "A"),
    (12, 1001, "2021-03-01", "O", "A"),
    (13, 1001, "2021-03-01", "V", "A"),
    (14, 1001, "2023-06-15", "N", "A"),
]
EXAMPLE_CITES = [(12, "A"), (12, "A"), (12, "B"), (12, None), (13, "C")]


def example_side(spark):
    return sides(
        spark,
        [(1001, "2021-03-01"), (1001, "2022-02-01")],
        [(1001, "2020-01-09", "Class I"), (1001, "2021-02-28", "Class II"), (1001, None, "Class I")],
        [(1001, "2021-03-15")],
    )


WORKED = {
    "n_prior_inspections": [0, 1, 2, 3],
    "n_prior_oai": [0, 0, 1, 1],
    "n_prior_vai": [0, 0, 0, 1],
    "n_prior_nai": [0, 1, 1, 1],
    "pct_oai": [0, 0, 0.5, 1 / 3],
    "pct_vai": [0, 0, 0, 1 / 3],
    "days_since_last_inspection": [-1, 416, 0, 836],
    "last_classification_oai": [0, 0, 1, 0],
    "last_classification_vai": [0, 0, 0, 1],
    "trend_worsening": [0, 0, 1, 0],
    "recent_oai_rate": [0, 0, 0.5, 0.5],
    "total_prior_citations": [0, 0, 3, 4],
    "avg_citations_per_inspection": [0, 0, 1.5, 4 / 3],
    "max_citations_single_inspection": [0, 0, 3, 3],
    "total_unique_cfr_violated": [0, 0, 2, 3],
    "n_warning_letters": [0, 0, 0, 2],
    "has_warning_letter": [0, 0, 0, 1],
    "days_since_last_wl": [-1, -1, -1, 499],
    "n_recalls": [1, 2, 2, 2],
    "n_class_I_recalls": [1, 1, 1, 1],
    "n_class_II_recalls": [0, 1, 1, 1],
    "n_published_483s": [0, 0, 0, 1],
    "has_published_483": [0, 0, 0, 1],
}


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_worked_example(spark, limit):
    found = build(spark, EXAMPLE, EXAMPLE_CITES, example_side(spark), entity_limit=limit)
    assert found.columns == FEATURE_TABLE
    rows = found.orderBy("inspection_id").collect()
    for name, expected in WORKED.items():
        assert [r[name] for r in rows] == pytest.approx(expected), name


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_strict_ties_hide_the_same_day(spark, limit):
    found = build(spark, EXAMPLE, EXAMPLE_CITES, example_side(spark), ties="strict", entity_limit=limit)
    r = {x["inspection_id"]: x for x in found.collect()}
    assert (r[13]["n_prior_inspections"], r[13]["days_since_last_inspection"]) == (1, 416)
    assert r[13]["trend_worsening"] == 0 and r[14]["n_prior_inspections"] == 3


def test_roll_forward(spark):
    rows = build(spark, EXAMPLE, EXAMPLE_CITES, example_side(spark))
    r = score.next_event_features(rows, date(2024, 1, 1)).first()
    assert (r["n_prior_inspections"], r["n_prior_oai"], r["n_prior_vai"], r["n_prior_nai"]) == (4, 1, 1, 2)
    assert (r["pct_oai"], r["pct_vai"], r["days_since_last_inspection"]) == (0.25, 0.25, 200)
    assert (r["last_classification_oai"], r["last_classification_vai"]) == (0, 0)
    assert (r["trend_worsening"], r["recent_oai_rate"]) == (0, 0.0)


def test_one_event_rolls_forward_with_its_own_outcome(spark):
    rows = build(spark, [(1, 5, "2020-01-01", "O", "A")])
    r = score.next_event_features(rows, date(2020, 1, 11)).first()
    assert (r["recent_oai_rate"], r["trend_worsening"], r["pct_oai"]) == (1.0, 0, 1.0)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_null_cases(spark, limit):
    rows = [
        (1, 7, "2020-01-01", None, None),  # null area stays, null outcome has no flag
        (2, 7, None, "O", "A"),  # undated: after all dated rows, sees no side event
        (3, None, "2020-01-01", "O", "A"),  # no facility: dropped
        (4, 7, "2020-05-01", "V", "Foodborne Biological Hazards"),  # out of scope
        (5, 7, "2020-02-01", "O", "A"),
    ]
    side = sides(spark, [(7, "2020-02-01"), (7, "2019-01-01"), (None, "2000-01-01")])
    r = {x["inspection_id"]: x for x in build(spark, rows, (), side, entity_limit=limit).collect()}
    assert set(r) == {1, 2, 5}
    assert r[1]["target_oai"] == 0 and r[1]["n_warning_letters"] == 1
    assert r[5]["n_warning_letters"] == 1  # the letter of the same day does not count
    assert r[2]["n_prior_inspections"] == 2 and r[2]["n_prior_oai"] == 1
    assert (r[2]["n_warning_letters"], r[2]["days_since_last_wl"]) == (0, -1)
    assert r[2]["days_since_last_inspection"] is None


def test_duplicate_event_ids_survive(spark):
    rows = [(1, 7, "2020-01-01", "O", "A"), (1, 7, "2020-01-01", "N", "B")]
    found = build(spark, rows, [(1, "x")]).orderBy("project_area").collect()
    assert [(x["n_prior_inspections"], x["n_prior_oai"]) for x in found] == [(0, 0), (1, 1)]
    assert found[1]["total_prior_citations"] == 1


def brute_force(rows, cites, letters, strict):
    """Plain loops over lists."""
    out = {}
    for i, fei, d, o, area in rows:
        place = (d, i, area)
        before = sorted(
            (r for r in rows if r[1] == fei and ((r[2] < d) if strict else (r[2], r[0], r[4]) < place)),
            key=lambda r: (r[2], r[0], r[4]),
        )
        bad = [int(r[3] == "O") for r in before]
        n_cites = [sum(c == r[0] and code is not None for c, code in cites) for r in before]
        earlier = [x for f, x in letters if f == fei and x < d]
        out[i] = (
            len(before), sum(bad), sum(r[3] == "V" for r in before),
            -1 if not before else (day(d) - day(before[-1][2])).days,
            bad[-1] if bad else 0,
            int(len(bad) > 1 and bad[-1] > bad[-2]),
            sum(bad[-2:]) / 2 if len(bad) > 1 else 0.0,
            sum(n_cites), max(n_cites, default=0), len(earlier),
            (day(d) - day(max(earlier))).days if earlier else -1,
        )
    return out


DAYS = st.integers(1, 9).map(lambda d: f"2020-01-0{d}")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(1, 3), DAYS, st.sampled_from("NVO"), st.sampled_from("AB")), min_size=1, max_size=25),
    st.lists(st.tuples(st.integers(0, 24), st.sampled_from(["x", "y", None])), max_size=20),
    st.lists(st.tuples(st.integers(1, 3), DAYS), max_size=10),
    st.booleans(),
)
def test_against_brute_force(spark, drawn, cites, letters, strict):
    rows = [(i, f, d, o, a) for i, (f, d, o, a) in enumerate(drawn)]
    expected = brute_force(rows, cites, letters, strict)
    for limit in (1_000_000, 2):
        found = build(
            spark, rows, cites or [(-1, None)], sides(spark, letters or [(99, "2020-01-01")]),
            ties="strict" if strict else "positional", entity_limit=limit,
        )
        for r in found.collect():
            got = (
                r["n_prior_inspections"], r["n_prior_oai"], r["n_prior_vai"],
                r["days_since_last_inspection"], r["last_classification_oai"], r["trend_worsening"],
                r["recent_oai_rate"], r["total_prior_citations"],
                r["max_citations_single_inspection"], r["n_warning_letters"], r["days_since_last_wl"],
            )
            assert got == pytest.approx(expected[r["inspection_id"]]), (limit, r["inspection_id"])


def test_hot_entity_takes_the_block_layout(spark):
    """A third of all rows on one facility, several per day: same result as in one partition."""
    rows = spark.range(3000).select(
        F.col("id").alias("Inspection ID"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 97 + 2).cast("long").alias("FEI Number"),
        F.expr("date_add(date'2020-01-01', cast(pmod(hash(id), 60) as int))").alias("Inspection End Date"),
        F.lit("Drugs").alias("Product Type"), F.lit("US").alias("Country/Area"),
        F.lit("A").alias("Project Area"),
        *[(F.expr(f"pmod(hash(id, {k}), 3)") == 0).cast("int").alias(c) for k, c in enumerate(("is_oai", "is_vai", "is_nai"))],
        F.expr("pmod(hash(id, 9), 5)").cast("long").alias("n_citations"),
        F.expr("pmod(hash(id, 9), 3)").cast("long").alias("n_unique_cfr"),
    )
    a, b = (history.history_features(rows, entity_limit=n) for n in (1_000_000, 500))
    assert a.count() == 3000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partitions_follow_the_events(spark, monkeypatch):
    rows = spark.range(600).select(
        F.col("id"), (F.col("id") % 40).alias("fei"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 97).cast("int")).alias("d"),
        (F.col("id") % 3 == 0).cast("int").alias("is_oai"), (F.col("id") % 3 == 1).cast("int").alias("is_vai"),
        (F.col("id") % 3 == 2).cast("int").alias("is_nai"), (F.col("id") % 4).alias("n_citations"), F.lit(0).alias("n_unique_cfr"),
        F.lit("US").alias("country"), F.lit("Drugs").alias("kind"), F.lit("A").alias("area"),
    )
    columns = history.EventColumns(
        entity="fei", event_id="id", date="d", kind="kind", country="country", area="area"
    )
    wanted = sorted(map(tuple, history.history_features(rows, columns).collect()))
    monkeypatch.setattr(history, "TASK_ROWS", 20)
    found = history.history_features(rows, columns)
    assert found.rdd.getNumPartitions() == 30
    assert sorted(map(tuple, found.collect())) == wanted


@pytest.mark.parametrize("ties", ["positional", "strict"])
def test_windows_over_events_pass_over_no_side_rows(spark, ties):
    rows = spark.sql(
        "SELECT id, id % 3 AS fei, date_add(date'2020-01-01', CAST(id % 5 AS int)) AS d, CAST(id % 2 AS int) AS is_oai, 0 AS is_vai, 0 AS is_nai, "
        "id % 4 AS n_citations, 0 AS n_unique_cfr, 'US' AS country, 'Drugs' AS kind, 'A' AS area FROM range(30)"
    )
    columns = history.EventColumns(entity="fei", event_id="id", date="d", kind="kind", country="country", area="area")
    side = history.SideEvents(rows, "fei", "d", {"n_warning_letters": F.lit(1)}, {"days_since_last_wl": F.lit(True)})
    found = history.history_features(rows, columns, [side], ties=ties)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    nodes = [line.split("_event")[0] for line in plan.splitlines() if "Window [" in line or ("Filter" in line and "_event" in line)]
    assert ["Filter" in n for n in nodes][0] is False and any("Filter" in n for n in nodes[1:-1])
    for r in found.collect():
        earlier = [i for i in range(30) if i % 3 == r["fei_number"] and i % 5 < (r["inspection_id"] % 5)]
        assert r["n_warning_letters"] == len(earlier)
