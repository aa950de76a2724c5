"""The registered queries: every operator on the star-schema tables, whole tables always."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.columns import HISTORY_FEATURES
from vetrail.functions.coerce import coerced_date, coerced_long, strict_date, whole_days
from vetrail.functions import html, scores, text
from vetrail.operators import (
    boost, categories, clean, detail, explain, history, metrics, monitor, profile, quality, resolve, score,
    scraped, split, train,
)
from vetrail.plans import driver_tables as d
from vetrail.plans import retrain, scoring
from vetrail.session import fresh_folder, materialized
from vetrail.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tidy(rows: DataFrame) -> DataFrame:
    """Whole numbers as bigint and doubles to 6 places, so that results compare across engines."""
    out = []
    for name, kind in rows.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind in ("double", "float"):
            c = F.round(c.cast("double"), 6)
        out.append(c.alias(name))
    return rows.select(*out)


# --- scope, flags, coercion ---------------------------------------------------------------------


@query
def scope_filter(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("area")
    )
    return clean.in_scope(orders, "area", ["1-URGENT", "5-LOW"])


@query
def class_flags(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status")
    )
    return tidy(clean.with_outcome_flags(orders, "status", d.STATUSES))


@query
def date_coerce(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    texts = d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .when(F.col("o_orderpriority") == "2-HIGH", "20200230")
        .otherwise(F.date_format(day, "yyyyMMdd"))
        .alias("compact"),
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("dashed"),
        F.when(F.col("o_orderstatus") == "F", "unknown")
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .alias("number"),
    )
    return texts.select(
        "o_orderkey",
        coerced_date("compact", "yyyyMMdd").alias("coerced"),
        strict_date("dashed").alias("strict"),
        F.year(strict_date("dashed")).cast("bigint").alias("year"),
        coerced_long("number").alias("number"),
    )


@query
def complete_rows(spark, sf_dir):
    rows = date_coerce(spark, sf_dir).select("o_orderkey", "coerced", "number")
    return clean.complete(rows, "coerced", "number")


@query
def text_exclusion(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("area")
    )
    return clean.without_text(orders, "area", "Urgent")


@query
def year_range(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_date")
    )
    return tidy(clean.with_year(clean.from_year(orders, "o_date", 1998), "o_date"))


@query
def elapsed_days(spark, sf_dir):
    events = d.table(spark, sf_dir, "events")
    return events.select(
        "event_id", whole_days(F.lit("2024-03-01").cast("timestamp"), "ts").cast("bigint").alias("days")
    )


# --- details ------------------------------------------------------------------------------------


@query
def detail_counts(spark, sf_dir):
    counts = detail.detail_counts(d.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey")
    return detail.with_detail_counts(orders, counts, "o_orderkey")


@query
def semi_join_details(spark, sf_dir):
    items = d.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = d.table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'")
    return tidy(detail.details_in_scope(items, "l_orderkey", orders, "o_orderkey"))


# --- history ------------------------------------------------------------------------------------


def _history(spark, sf_dir, ties):
    found = history.history_features(
        d.counted_inspections(spark, sf_dir),
        d.ORDERS,
        ties=ties,
        keys=d.table(spark, sf_dir, "orders"),
    )
    return tidy(found.select("inspection_id", "fei_number", *HISTORY_FEATURES))


@query
def history_positional(spark, sf_dir):
    return _history(spark, sf_dir, "positional")


@query
def history_strict(spark, sf_dir):
    return _history(spark, sf_dir, "strict")


def _prior(spark, sf_dir, which):
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_date")
    )
    source = d.side_tables(spark, sf_dir)[which]
    return tidy(history.prior_side_totals(orders, "o_custkey", "o_date", [source]))


@query
def prior_letters(spark, sf_dir):
    return _prior(spark, sf_dir, 0)


@query
def prior_recalls(spark, sf_dir):
    return _prior(spark, sf_dir, 1)


@query
def prior_483s(spark, sf_dir):
    return _prior(spark, sf_dir, 2)


@query
def feature_table(spark, sf_dir):
    return tidy(d.features(spark, sf_dir))


# --- profiles -----------------------------------------------------------------------------------


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(d.table(spark, sf_dir, "orders"), "o_orderstatus")


@query
def top_codes(spark, sf_dir):
    return profile.value_counts(d.table(spark, sf_dir, "lineitem"), "l_partkey", top=15)


@query
def share_of_total(spark, sf_dir):
    return tidy(profile.value_shares(d.table(spark, sf_dir, "orders"), "o_orderstatus"))


@query
def crosstab(spark, sf_dir):
    orders = clean.with_year(d.table(spark, sf_dir, "orders"), "o_orderdate")
    return tidy(profile.crosstab(orders, "year", "o_orderstatus", ["F", "O", "P"]))


@query
def crosstab_unlisted(spark, sf_dir):
    """A class that is not listed counts in the total and has a column of its own."""
    orders = clean.with_year(d.table(spark, sf_dir, "orders"), "o_orderdate")
    return tidy(profile.crosstab_rate(orders, "year", "o_orderstatus", ["F", "P"], "F"))


@query
def crosstab_rate(spark, sf_dir):
    rows = d.inspections(spark, sf_dir)
    return tidy(
        profile.crosstab_rate(rows, "c_mktsegment", "o_orderstatus", ["F", "O", "P"], "F")
    )


@query
def rate_by_group(spark, sf_dir):
    orders = clean.with_year(d.table(spark, sf_dir, "orders"), "o_orderdate")
    return tidy(profile.rate_by_group(orders, "year", F.col("o_orderstatus") == "F"))


@query
def mean_of_rates(spark, sf_dir):
    orders = clean.with_year(d.table(spark, sf_dir, "orders"), "o_orderdate")
    return tidy(profile.mean_of_rates(orders, "year", F.col("o_orderstatus") == "F"))


@query
def detail_by_class(spark, sf_dir):
    return tidy(profile.detail_by_class(d.counted_inspections(spark, sf_dir), "o_orderstatus"))


def _offenders(spark, sf_dir):
    return profile.repeat_offenders(
        d.inspections(spark, sf_dir),
        "o_custkey",
        "o_orderstatus",
        "F",
        "o_date",
        {"country": "n_name", "product_type": "c_mktsegment", "first_area": "o_orderpriority"},
        ["o_orderkey"],
    )


@query
def repeat_offenders(spark, sf_dir):
    return _offenders(spark, sf_dir)


@query
def top_offenders(spark, sf_dir):
    return _offenders(spark, sf_dir).limit(15)


@query
def offenders_over(spark, sf_dir):
    return profile.offenders_over(_offenders(spark, sf_dir))


@query
def count_of_counts(spark, sf_dir):
    return profile.count_of_counts(_offenders(spark, sf_dir))


@query
def topk_groups_rate(spark, sf_dir):
    rows = d.inspections(spark, sf_dir)
    return tidy(profile.top_groups_rate(rows, "n_name", F.col("o_orderstatus") == "F"))


@query
def distinct_codes(spark, sf_dir):
    return profile.distinct_values(d.table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def yearly_counts(spark, sf_dir):
    return tidy(profile.yearly_counts(d.table(spark, sf_dir, "orders"), "o_orderdate"))


# --- splits and categories ----------------------------------------------------------------------


def _flagged(spark, sf_dir):
    return clean.with_outcome_flags(
        d.table(spark, sf_dir, "orders").withColumn("o_date", F.col("o_orderdate").cast("date")),
        "o_orderstatus",
        d.STATUSES,
    )


@query
def split_profile(spark, sf_dir):
    rows = _flagged(spark, sf_dir)
    return tidy(profile.target_profile(rows, "is_oai", split.split_part("o_date", 2000)))


@query
def rolling_split(spark, sf_dir):
    train, valid = split.rolling_split(_flagged(spark, sf_dir), "o_date")
    part = train.withColumn("p", F.lit("train")).unionByName(valid.withColumn("p", F.lit("valid")))
    return tidy(profile.target_profile(part, "is_oai", F.col("p")))


@query
def class_ratio(spark, sf_dir):
    return tidy(profile.class_ratio(_flagged(spark, sf_dir), "is_oai"))


@query
def label_encode(spark, sf_dir):
    rows = d.inspections(spark, sf_dir).select("o_orderkey", "n_name", "c_mktsegment")
    rows = rows.withColumn("n_name", F.nullif("n_name", F.lit("NATION_7")))
    return tidy(split.label_encode(rows, ["n_name", "c_mktsegment"]))


# --- ranking metrics ----------------------------------------------------------------------------


def _scored(spark, sf_dir):
    """Two score columns of different kinds: few distinct values, and nearly all distinct."""
    return d.table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10).alias("tied"),
        (F.col("l_extendedprice") / 110000).alias("fine"),
    )


def _by_model(spark, sf_dir):
    both = F.array(
        F.struct(F.lit("fine").alias("model"), F.col("fine").alias("score")),
        F.struct(F.lit("tied").alias("model"), F.col("tied").alias("score")),
    )
    return _scored(spark, sf_dir).select("y", F.inline(both))


@query
def roc_auc(spark, sf_dir):
    found = metrics.evaluate(_scored(spark, sf_dir), "y", "fine")
    return tidy(found.select("n_rows", "n_pos", "roc_auc"))


@query
def avg_precision(spark, sf_dir):
    return tidy(metrics.evaluate(_scored(spark, sf_dir), "y", "tied").select("pr_auc", "f1"))


@query
def model_comparison(spark, sf_dir):
    return tidy(metrics.compare_models(_by_model(spark, sf_dir), "y", "score"))


@query
def roc_curve(spark, sf_dir):
    points = tidy(metrics.roc_curve(_scored(spark, sf_dir), "y", "fine"))
    return points.withColumn("threshold", F.nullif("threshold", F.lit(float("inf"))))


@query
def pr_curve(spark, sf_dir):
    return tidy(metrics.pr_curve(_scored(spark, sf_dir), "y", "tied"))


@query
def threshold_table(spark, sf_dir):
    return tidy(metrics.threshold_table(_scored(spark, sf_dir), "y", "fine"))


@query
def threshold_at_recall(spark, sf_dir):
    return tidy(metrics.threshold_at_recall(_scored(spark, sf_dir), "y", "fine"))


@query
def class_report(spark, sf_dir):
    guessed = _scored(spark, sf_dir).withColumn("guess", (F.col("fine") >= 0.3).cast("int"))
    return tidy(metrics.classification_report(guessed, "y", "guess", ("Non-OAI", "OAI")))


# --- names, locations, grams, matching ----------------------------------------------------------


@query
def normalize_names(spark, sf_dir):
    part = d.table(spark, sf_dir, "part")
    raw = F.concat(
        F.lit("  "), F.initcap("p_name"), F.lit(", "), F.initcap("p_type"),
        F.when(F.col("p_size") % 3 == 0, " Co., Inc.")
        .when(F.col("p_size") % 3 == 1, " (GmbH) dba Other")
        .otherwise("/Ltd www.x.com"),
    )
    return part.select(
        "p_partkey",
        text.normalize_name(raw).alias("norm"),
        text.normalize_name(raw, strip_first=True).alias("norm_stripped"),
    )


@query
def normalize_locations(spark, sf_dir):
    part = d.table(spark, sf_dir, "part")
    here = text.normalize_location(
        F.nullif("p_brand", F.lit("Brand#7")), F.when(F.col("p_size") > 40, "N/A").otherwise(F.lit(" TX ")),
        "p_type",
    )
    there = text.normalize_location(
        F.lit("-"), F.when(F.col("p_size") < 20, "tx").otherwise(F.lit(""))
    )
    return part.select(
        "p_partkey",
        here.alias("location"),
        text.locations_overlap(here, there).cast("int").cast("bigint").alias("overlap"),
    )


@query
def char_grams(spark, sf_dir):
    names = d.table(spark, sf_dir, "part").select(text.normalize_name("p_name").alias("name"))
    return (
        names.select("name", F.explode(text.char_grams("name")).alias("gram"))
        .groupBy("gram")
        .agg(F.count("*").alias("n"), F.count_distinct("name").alias("n_names"))
    )


def _facilities(spark, sf_dir):
    return d.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("FEI Number"),
        F.concat_ws(" ", "p_name", "p_brand").alias("Legal Name"),
        F.col("p_brand").alias("City"),
        F.lit("").alias("State"),
        F.col("p_type").alias("Country/Area"),
    )


def _firms(spark, sf_dir):
    return d.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws(" ", F.concat_ws(", ", "p_name", "p_type"), F.lit("Inc.")).alias("recalling_firm"),
        F.col("p_brand").alias("city"),
        F.lit("N/A").alias("state"),
        F.col("p_type").alias("country"),
    )


def _matched_letters(spark, sf_dir):
    letters = _firms(spark, sf_dir).select("p_partkey", F.col("recalling_firm").alias("company_name"))
    return resolve.match_letters(letters, _facilities(spark, sf_dir), threshold=0.5)


def _matched_recalls(spark, sf_dir):
    return resolve.match_recalls(
        _firms(spark, sf_dir), _facilities(spark, sf_dir), "p_partkey", threshold=0.5
    )


@query
def tfidf_match(spark, sf_dir):
    return tidy(_matched_letters(spark, sf_dir))


@query
def match_accept(spark, sf_dir):
    rows = _matched_recalls(spark, sf_dir)
    return tidy(rows.select("p_partkey", "recalling_firm", "matched_fei", "match_score"))


@query
def match_table(spark, sf_dir):
    return tidy(resolve.match_mapping(_matched_letters(spark, sf_dir), "letters", "company_name"))


@query
def match_rate(spark, sf_dir):
    return tidy(resolve.match_rate(_matched_recalls(spark, sf_dir), "recalling_firm"))


@query
def lookup_join(spark, sf_dir):
    nation = d.table(spark, sf_dir, "nation").filter("n_nationkey <> 3")
    mapping = nation.select(
        F.lit("suppliers").alias("source"), F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("bigint").alias("fei"),
    )
    rows = d.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("label")
    )
    return resolve.with_entity(rows, mapping, "suppliers", "label")


# --- HTML cells ---------------------------------------------------------------------------------


@query
def html_links(spark, sf_dir):
    pages = d.table(spark, sf_dir, "pages")
    cells = pages.select(
        "page_id", F.posexplode(F.regexp_extract_all("html", F.lit("(?s)<a [^>]*>.*?</a>"), 0))
    )
    return cells.select(
        "page_id",
        F.col("pos").cast("bigint").alias("pos"),
        html.anchor_text(F.col("col")).alias("link_text"),
        html.absolute_url(html.anchor_href(F.col("col")), "https://host.example").alias("url"),
    )


@query
def html_cells(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    key = F.col("o_orderkey").cast("string")
    rows = orders.select(
        "o_orderkey",
        F.array(
            F.concat(F.lit('<time datetime="'), stamp, F.lit('">shown</time>')),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(
                F.concat(F.lit('<p><time datetime="'), stamp, F.lit('">x</time></p>'))
            ),
            F.concat(
                F.lit('<a class="l" href="'),
                F.when(F.col("o_orderstatus") == "F", "https://other.example/").otherwise(F.lit("/c/")),
                key, F.lit('"> Firm <b>'), key, F.lit("</b> &amp; Co </a>"),
            ),
            F.concat(F.lit("<p> "), F.col("o_orderpriority"), F.lit(" </p>")),
        ).alias("cells"),
    )
    return scraped.letter_rows(rows, "cells", "https://host.example", "o_orderkey")


@query
def html_markup(spark, sf_dir):
    """Links and texts out of careless markup: quoted brackets, bare values, references, scripts, open tags."""
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("k"), "o_orderstatus")
    k = F.col("k")
    link = F.concat(
        F.lit('<script>if (a<b) s="<a href=/no>no</a>"</script><a title="x>y href=/no" data-href=\'/no\' href='),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/p?a=1&amp;b="), k, F.lit(" >")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("'/q/"), k, F.lit("'>")))
        .otherwise(F.concat(F.lit('"http://x.example/'), k, F.lit('">'))),
        F.lit(" Firm &#8217;"), k, F.lit("&#x2019; <b class='>'>&nbsp;AT&T&nbsp;</b>&eacute;&lt;b&gt;"),
    )
    text = F.concat(F.lit("1 < 2 <!-- > <b> --> <style>p > a {}</style><p>"), k, F.lit("&unknown; &amp;lt;</p> x"))
    return orders.select(
        "o_orderkey", html.anchor_text(link).alias("link_text"),
        html.absolute_url(html.anchor_href(link), "https://host.example").alias("url"), html.cell_text(text).alias("cell"),
    )


@query
def html_inspections(spark, sf_dir):
    customer = d.table(spark, sf_dir, "customer")
    rows = customer.select(
        "c_custkey",
        F.array(
            F.concat(F.lit("<td>"), F.col("c_name"), F.lit("</td>")),
            F.lit("<td> Springfield </td>"),
            F.lit(""),
            F.concat(F.lit("<span>"), F.col("c_nationkey").cast("string"), F.lit("</span>")),
            F.lit("00000"),
            F.when(F.col("c_nationkey") < 9, '<time datetime="2021-02-03T00:00:00Z">3 Feb</time>')
            .otherwise("<td>unknown</td>"),
            F.col("c_mktsegment"),
        ).alias("cells"),
    )
    return scraped.inspection_rows(rows, "cells", "c_custkey")


# --- scoring ------------------------------------------------------------------------------------

AS_OF = Date(2002, 1, 1)


def _with_rule_score(features: DataFrame) -> DataFrame:
    """A score that needs no model: the mean of two history rates."""
    return features.withColumn(
        "risk_score", (F.col("pct_oai") + F.col("recent_oai_rate")) / 2
    )


@query
def latest_nonnull(spark, sf_dir):
    rows = d.features(spark, sf_dir).withColumn(
        "country", F.when(F.col("target_oai") == 0, F.col("project_area"))
    )
    return tidy(
        score.latest_values(
            rows, ["inspection_id", "inspection_date", "country", "n_recalls", "pct_oai"]
        )
    )


@query
def next_event_features(spark, sf_dir):
    return tidy(score.next_event_features(d.features(spark, sf_dir), AS_OF))


@query
def next_event_exact(spark, sf_dir):
    found = score.next_event_exact(
        d.counted_inspections(spark, sf_dir), d.side_events(spark, sf_dir), AS_OF, d.ORDERS,
        keys=d.table(spark, sf_dir, "orders"),
    )
    return tidy(found.drop("inspection_id", "target_oai"))


@query
def risk_tier_app(spark, sf_dir):
    items = d.table(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10).alias("score"))
    return tidy(
        items.groupBy("score").agg(F.count("*").alias("n")).select(
            "score", "n", scores.lookup_tier(F.col("score")).alias("risk_tier")
        )
    )


@query
def risk_tier_batch(spark, sf_dir):
    items = d.table(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10).alias("score"))
    tier = scores.batch_tier(F.col("score"))
    return tidy(
        items.groupBy("score").agg(F.count("*").alias("n")).select(
            "score", "n", tier.alias("risk_tier"), scores.tier_rank(tier).alias("tier_rank")
        )
    )


def _batch(spark, sf_dir):
    rows = score.latest_values(
        d.features(spark, sf_dir),
        ["product_type", "country", "inspection_date", "pct_oai", "recent_oai_rate"],
    )
    return score.batch_scores(_with_rule_score(rows))


@query
def batch_scores(spark, sf_dir):
    return tidy(_batch(spark, sf_dir))


@query
def alerts(spark, sf_dir):
    return tidy(score.alerts(_batch(spark, sf_dir)))


@query
def tier_counts(spark, sf_dir):
    return profile.value_counts(_batch(spark, sf_dir), "risk_tier")


@query
def profile_cards(spark, sf_dir):
    rows = _with_rule_score(score.next_event_features(d.features(spark, sf_dir), AS_OF))
    return tidy(score.profile_cards(rows))


@query
def entity_history(spark, sf_dir):
    return score.entity_history(d.features(spark, sf_dir))


@query
def riskiest(spark, sf_dir):
    rows = _with_rule_score(d.features(spark, sf_dir)).select(
        "fei_number", "inspection_id", "inspection_date", "risk_score", "target_oai"
    )
    return tidy(
        profile.ranked(rows, F.desc("risk_score"), F.col("inspection_id"), k=5)
    )


# --- gates and monitoring -----------------------------------------------------------------------


@query
def quality_gates(spark, sf_dir):
    return tidy(quality.feature_gates(d.features(spark, sf_dir), 2000, min_rows=10_000))


@query
def score_gates(spark, sf_dir):
    items = d.table(spark, sf_dir, "lineitem").select(
        (1 - F.col("l_discount") * 11).alias("p0"), (F.col("l_discount") * 11).alias("p1")
    )
    return tidy(quality.score_gates(items, "p0", "p1"))


def _order_scores(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("o_date"),
        (F.col("o_totalprice") / 500000).alias("score"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"),
    )


@query
def score_drift(spark, sf_dir):
    rows = _order_scores(spark, sf_dir).withColumn(
        "week", F.date_trunc("week", "o_date").cast("date")
    )
    base = split.before_year(rows, "o_date", 1998)
    return tidy(monitor.score_drift(split.since_year(rows, "o_date", 1998), base, "score", "week", 0.25))


SCORE_EDGES = [i / 10 for i in range(1, 10)]


@query
def distribution_drift(spark, sf_dir):
    """Shift of each month's distribution of scores against the years before."""
    rows = _order_scores(spark, sf_dir).withColumn("month", F.date_trunc("month", "o_date").cast("date"))
    base = split.before_year(rows, "o_date", 1998)
    late = split.since_year(rows, "o_date", 1998)
    return tidy(monitor.distribution_drift(late, base, "score", "month", SCORE_EDGES))


@query
def sketch_drift(spark, sf_dir):
    """Months against earlier years from stored weekly sketches; the exact shift beside them."""
    path = fresh_folder(spark)
    rows = _order_scores(spark, sf_dir)
    sinks.write_parquet(monitor.score_sketches(rows.withColumn("week", F.date_trunc("week", "o_date").cast("date")), "score", "week"), path)
    stored = spark.read.parquet(path)
    base = monitor.merged_sketches(stored.filter(F.year("week") < 1998))
    months = monitor.merged_sketches(stored.filter(F.year("week") >= 1998), F.date_trunc("month", "week").cast("date").alias("month"))
    return tidy(monitor.sketch_drift(months, base, "month"))


@query
def sketched_years(spark, sf_dir):
    """Counts of ranges of years out of stored yearly sketches; distinct counts are held against the exact ones."""
    path = fresh_folder(spark)
    items = d.shipped_items(spark, sf_dir).select("l_orderkey", "l_date")
    quantities = d.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("l_date"), F.col("l_quantity").cast("bigint").alias("q"))
    sinks.write_parquet(profile.yearly_sketches(quantities, "l_date", "q"), f"{path}/q")
    sinks.write_parquet(profile.yearly_sketches(items, "l_date", "l_orderkey"), f"{path}/orders")
    out = None
    for first, last in ((1996, 1997), (1995, 2000)):
        frequent = profile.counts_of_years(spark.read.parquet(f"{path}/q"), first, last, 5)
        counted = profile.counts_of_years(spark.read.parquet(f"{path}/orders"), first, last, 1).select("n_distinct")
        exact = profile.distinct_values(items.filter(F.year("l_date").between(first, last)), "l_orderkey").scalar()
        one = frequent.select(
            F.lit(first).alias("first"), F.lit(last).alias("last"), "n", F.col("n_distinct").alias("quantities"), "item", "count",
            (F.abs(counted.scalar() - exact) <= 0.05 * exact).cast("int").alias("near"),
        )
        out = one if out is None else out.unionByName(one)
    return tidy(out)


@query
def predicted_vs_actual(spark, sf_dir):
    rows = _order_scores(spark, sf_dir)
    return tidy(
        monitor.predicted_vs_actual(
            rows.select("o_orderkey", "score"), rows.drop("score"), "o_orderkey", "o_date", "score", "target"
        )
    )


@query
def training_window(spark, sf_dir):
    rows = _order_scores(spark, sf_dir)
    recent = split.training_window(rows, "o_date", Date(2000, 7, 1))
    return tidy(profile.target_profile(recent, "target", F.year("o_date")))


@query
def letter_within_year(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_date")
    )
    letters = d.side_tables(spark, sf_dir)[0]
    return tidy(history.upcoming_side_total(orders, "o_custkey", "o_date", letters))


@query
def severity_history(spark, sf_dir):
    codes = d.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("21 CFR 211."), (F.col("l_partkey") % 200).cast("string"), F.lit("(a)")).alias("code"),
    )
    counts = categories.severity_counts(codes, "l_orderkey", "code")
    totals = categories.severity_totals()
    events = d.counted_inspections(spark, sf_dir).join(
        counts.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left"
    ).na.fill(0, list(totals.values()))
    found = history.history_features(
        events, d.ORDERS, totals=totals, keys=d.table(spark, sf_dir, "orders")
    )
    return tidy(found.select("inspection_id", *totals))


@query
def subject_history(spark, sf_dir):
    subject = (
        F.when(F.col("l_linestatus") == "F", F.lit("CGMP/Finished Pharmaceuticals/Adulterated"))
        .otherwise(F.lit("Unapproved New Drugs/Misbranded"))
    )
    letters = d.shipped_items(spark, sf_dir).filter("l_returnflag = 'R'").withColumn("subject", subject)
    orders = d.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_date")
    )
    source = categories.letter_subjects(letters, "o_custkey", "l_date")
    return tidy(
        history.prior_side_totals(orders, "o_custkey", "o_date", [source]).drop("o_custkey", "o_date")
    )


# --- models -------------------------------------------------------------------------------------
# Fitted at the default size with early stopping. What SQL can say of them (rules, codes, splits, registry rows,
# additivity) has a twin; the fits themselves are tested by their own arithmetic.

CUT_YEAR = 2000


def _model_rows(spark, sf_dir):
    """Encoded feature table, materialised because every fit reads it several times."""
    rows = split.label_encode(d.features(spark, sf_dir), split.CATEGORIES)
    return materialized(rows)


def _lists(rows):
    encoded = [f"{c}_encoded" for c in split.CATEGORIES]
    dropped = [*split.NOT_FEATURES, *encoded]
    every = split.numeric_features(rows.columns, dropped) + encoded
    trees = split.numeric_features(
        rows.columns, dropped, redundant=[*split.REDUNDANT_FOR_TREES, split.DOMINANT_FEATURE]
    ) + encoded
    return every, trees


def _parts(rows):
    return (
        split.before_year(rows, "inspection_date", CUT_YEAR),
        split.since_year(rows, "inspection_date", CUT_YEAR),
    )


def _model_table(spark, sf_dir):
    """Names of the trees' features, the test rows and all rows."""
    rows = _model_rows(spark, sf_dir)
    return _lists(rows)[1], _parts(rows)[1], rows


_FITTED: dict[tuple[str, str], tuple] = {}


def _fitted_trees(spark, sf_dir):
    """Weighted and plain trees at the default size, features, test rows, all rows: fitted once per session and data set."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _FITTED:
        names, test, rows = _model_table(spark, sf_dir)
        early, late = split.rolling_split(_parts(rows)[0], "inspection_date")
        models = train.fit_boosted_models(early, names, [{"positive_weight": None}, {}], valid=late)
        _FITTED[place] = models, names, test, rows
    return _FITTED[place]


@query
def feature_lists(spark, sf_dir):
    """Names and places of the columns that trees and the linear model read."""
    names = d.features(spark, sf_dir).columns
    trees = split.numeric_features(names, redundant=[*split.REDUNDANT_FOR_TREES, split.DOMINANT_FEATURE])
    every = split.numeric_features(names)
    pairs = [("linear", i, n) for i, n in enumerate(every)] + [("trees", i, n) for i, n in enumerate(trees)]
    used = d.features(spark, sf_dir).agg(*[F.count(c).alias(c) for c in every])
    counts = used.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_known")) for c in every])))
    listed = spark.createDataFrame(pairs, "model string, place bigint, feature string")
    return listed.join(counts, "feature").select("model", "place", "feature", "n_known")


@query
def codes_of_older_rows(spark, sf_dir):
    """Codes fitted on the orders before the cut, applied to all: what was not seen gets the fixed code."""
    rows = d.inspections(spark, sf_dir).select("o_orderkey", "o_date", "n_name", "c_mktsegment")
    year = F.year("o_date").cast("string")
    rows = rows.withColumn("segment", F.concat_ws(" ", "c_mktsegment", F.when(F.col("o_orderkey") % 7 == 0, year)))
    codes = split.fit_codes(split.before_year(rows, "o_date", CUT_YEAR), ["n_name", "segment"])
    return tidy(split.apply_codes(rows, codes, ["n_name", "segment"]).drop("o_date"))


@query
def class_weights(spark, sf_dir):
    """Balanced weights of both classes, and the weight that balances the positives, before the cut."""
    fit = split.before_year(_flagged(spark, sf_dir).withColumn("o_date", F.col("o_orderdate").cast("date")), "o_date", CUT_YEAR)
    counts = train.ClassCounts.of(fit, "is_oai")
    neg, pos = counts.balanced()
    one = fit.limit(1).select(F.lit(counts.neg).alias("n_neg"), F.lit(counts.pos).alias("n_pos"))
    return tidy(
        one.withColumns({"w_neg": F.lit(neg), "w_pos": F.lit(pos), "ratio": F.lit(counts.ratio)}).select(
            F.col("n_neg").cast("bigint"), F.col("n_pos").cast("bigint"), "w_neg", "w_pos", "ratio"
        )
    )


@query
def time_folds(spark, sf_dir):
    """Sizes of the parts of three expanding folds."""
    rows = d.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("o_date"))
    out = None
    for i, (start, end) in enumerate(split.expanding_folds(rows, "o_date", 3), 1):
        fit, valid = split.fold_parts(rows, "o_date", start, end)
        one = fit.agg(F.count("*").alias("n_train")).join(valid.agg(F.count("*").alias("n_valid")), how="full")
        one = one.select(F.lit(i).cast("bigint").alias("fold"), F.lit(start).alias("start"), "n_train", "n_valid")
        out = one if out is None else out.unionByName(one)
    return out


@query
def scaled_features(spark, sf_dir):
    """Mean and population deviation of the scaled columns the linear model reads."""
    rows = d.table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    names = ["l_quantity", "l_discount"]
    model = train.fit_logistic(rows, names, "y", max_iter=1)
    scaled = train.scaled(model, rows, names, "y")
    means = [F.avg(scaled[f"{n}_scaled"]).alias(f"{n}_mean") for n in names]
    spreads = [F.stddev_pop(scaled[f"{n}_scaled"]).alias(f"{n}_sd") for n in names]
    return tidy(scaled.agg(F.count("*").alias("n"), *means, *spreads).withColumns(
        {f"{n}_mean": F.round(F.abs(F.col(f"{n}_mean")), 6) for n in names}
    ))


@query
def logistic_of_one_flag(spark, sf_dir):
    """With one 0/1 column and hardly any penalty the fitted score is the rate of each of its groups."""
    rows = d.table(spark, sf_dir, "lineitem").select(
        (F.col("l_linestatus") == "F").cast("int").alias("flag"),
        ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 45)).cast("int").alias("y"),
    )
    model = train.fit_logistic(rows, ["flag"], "y", c=1e6)
    scored = train.score_rows(model, rows, ["flag"])
    return scored.groupBy(F.col("flag").cast("bigint").alias("flag")).agg(
        F.count("*").alias("n"), F.round(F.avg("risk_score"), 3).alias("score")
    )


@query
def trees_of_one_flag(spark, sf_dir):
    """One tree of depth 1 on one 0/1 column: a leaf is the Newton step of its rows from the common log odds."""
    rows = d.table(spark, sf_dir, "lineitem").select(
        (F.col("l_linestatus") == "F").cast("int").alias("flag"),
        ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 45)).cast("int").alias("y"),
    )
    model = train.fit_boosted_trees(rows, ["flag"], "y", trees=1, depth=1)
    scored = train.score_rows(model, rows, ["flag"])
    return tidy(
        scored.groupBy(F.col("flag").cast("bigint").alias("flag")).agg(
            F.count("*").alias("n"), F.avg("risk_score").alias("score")
        )
    )


@query
def boosted_splits(spark, sf_dir):
    """The splits and leaves of two trees of depth 1 over every value of two columns."""
    rows = d.table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("double").alias("l_quantity"), F.col("l_discount").cast("double").alias("l_discount"),
        ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 45)).cast("int").alias("y"),
    )
    names = ["l_quantity", "l_discount"]
    model = boost.fit_many(boost.binned(rows, names, "y", bins=255), [boost.Spec(trees=2, depth=1)])[0]
    table = spark.createDataFrame(list(model.nodes()), boost.NODES)
    root, left, right = (table.filter(F.col("node") == i) for i in range(3))
    return root.join(left.select("tree", F.col("value").alias("left_value")), "tree").join(
        right.select("tree", F.col("value").alias("right_value")), "tree"
    ).select(
        F.col("tree").cast("bigint").alias("tree"), F.element_at(F.array(*map(F.lit, names)), F.col("feature") + 1).alias("feature"),
        F.round("threshold", 2).alias("threshold"), F.round("gain", 1).alias("gain"),
        F.round("left_value", 6).alias("left_value"), F.round("right_value", 6).alias("right_value"),
    )


@query
def shapley_of_two_flags(spark, sf_dir):
    """Shapley values of one tree of depth 2 over two 0/1 columns, by the rows' pattern; b splits the root."""
    rows = d.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), (F.col("l_linestatus") == "F").cast("int").alias("a"),
        (F.col("l_quantity") > 25).cast("int").alias("b"),
        ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 45)).cast("int").alias("y"),
    )
    model = train.fit_boosted_trees(rows, ["a", "b"], "y", trees=1, depth=2)
    found = explain.tree_contributions(model, rows, ["a", "b"], "id")
    by = [F.col("values")[i].cast("bigint").alias(c) for i, c in enumerate("ab")]
    return found.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.avg("margin"), 6).alias("margin"),
        *[F.round(F.avg(F.col("contributions")[i]), 6).alias(f"{c}_value") for i, c in enumerate("ab")],
        F.round(F.lit(explain.base_margin(model)), 6).alias("base"),
    )


@query
def train_logreg(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    every, _ = _lists(rows)
    fit, test = _parts(rows)
    named = {
        "logistic": (train.fit_logistic(fit, every), every),
        "logistic balanced": (train.fit_logistic(fit, every, balanced=True), every),
    }
    return tidy(train.model_metrics(named, test, "target_oai"))


@query
def train_gbt(spark, sf_dir):
    (weighted, plain), names, test, _ = _fitted_trees(spark, sf_dir)
    return tidy(train.model_metrics({"trees": (plain, names), "trees weighted": (weighted, names)}, test, "target_oai"))


@query
def watched_rounds(spark, sf_dir):
    """Average precision on the watched year after every round, and which rounds were kept."""
    models, _, _, _ = _fitted_trees(spark, sf_dir)
    rows = [
        (name, r, value, int(r < len(m.trees)))
        for name, m in zip(("trees weighted", "trees"), models)
        for r, value in enumerate(m.history)
    ]
    return tidy(spark.createDataFrame(rows, "model string, round bigint, pr_auc double, kept bigint"))


@query
def ablation(spark, sf_dir):
    names, test, rows = _model_table(spark, sf_dir)
    early, late = split.rolling_split(_parts(rows)[0], "inspection_date")
    names = [*names, split.DOMINANT_FEATURE]
    return tidy(train.ablation(early, test, names, [split.DOMINANT_FEATURE], valid=late))


@query
def search(spark, sf_dir):
    """Thirty draws of the default ranges over three folds in shared scans, and the best one fitted on all training rows."""
    names, test, rows = _model_table(spark, sf_dir)
    early, late = split.rolling_split(_parts(rows)[0], "inspection_date")
    trials = train.random_search(early, names, stop_early=True)
    tuned = train.fit_best(early, names, trials, valid=late)
    metrics_ = train.model_metrics({"tuned": (tuned, names)}, test, "target_oai").drop("model")
    return tidy(spark.createDataFrame(trials).join(F.broadcast(metrics_.withColumnsRenamed(
        {c: f"tuned_{c}" for c in metrics_.columns}
    )), how="left"))


@query
def feature_importance(spark, sf_dir):
    (model, _), names, _, _ = _fitted_trees(spark, sf_dir)
    return tidy(train.feature_importances(spark, model, names))


@query
def champion(spark, sf_dir):
    """Two retrainings on all but the last year, a small and a larger model; the registry keeps the better one."""
    folder = fresh_folder(spark)
    names, _, rows = _model_table(spark, sf_dir)
    names = [n for n in names if not n.endswith("_encoded")]
    for version, size in (("v9", {"trees": 10, "depth": 2}), ("v10", {"trees": 40, "depth": 4})):
        retrain.retrain(
            rows.drop(*[f"{c}_encoded" for c in split.CATEGORIES]), names, folder, version, Date(2001, 8, 1),
            categories=split.CATEGORIES, stop_early=True, **size,
        )
    return tidy(train.registry_table(spark, f"{folder}/registry").drop("path", "codes_path"))


@query
def champion_scores(spark, sf_dir):
    """Retrain with stored codes, then score every facility from the registry, with audit columns, by date."""
    folder = fresh_folder(spark)
    names, _, rows = _model_table(spark, sf_dir)
    names = [n for n in names if not n.endswith("_encoded")]
    raw = rows.drop(*[f"{c}_encoded" for c in split.CATEGORIES])
    retrain.retrain(
        raw, names, folder, "v10", Date(2001, 8, 1), categories=split.CATEGORIES, stop_early=True, trees=40
    )
    scores_ = scoring.score_champion(raw, folder, AS_OF, {"threshold": 0.5})
    scoring.write_scores(scores_, f"{folder}/out", AS_OF)
    return tidy(spark.read.parquet(f"{folder}/out/facility_scores"))


@query
def registry(spark, sf_dir):
    """Entries in the order of registration, by metrics of four score columns: only a better one replaces the champion."""
    folder = f"{fresh_folder(spark)}/registry"
    rows = d.table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_quantity").cast("double").alias("v8"),
        (-F.col("l_quantity")).cast("double").alias("v9"), F.col("l_discount").cast("double").alias("v10"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).otherwise(-F.col("l_tax")).cast("double").alias("v11"),
    )
    for version in ("v8", "v9", "v10", "v11"):
        found = metrics.evaluate(rows, "y", version).first().asDict()
        train.register_challenger(spark, folder, version, version, Date(2001, 8, 1), found, ["a"])
    table = train.registry_table(spark, folder)
    now = train.champion(spark, folder)["version"]
    return tidy(
        table.select("sequence", "version", "pr_auc", F.col("promoted").cast("bigint").alias("promoted")).withColumn(
            "is_champion", (F.col("version") == now).cast("bigint")
        )
    )


@query
def model_gates(spark, sf_dir):
    """The floor of a model, on the metrics of two score columns."""
    found = metrics.evaluate(_by_model(spark, sf_dir), "y", "score", by=["model"])
    return tidy(quality.model_gates(found, 12))


def _explained(spark, sf_dir):
    (model, _), names, test, _ = _fitted_trees(spark, sf_dir)
    keep = ("fei_number", "product_type", "country", "project_area", "inspection_date", "target_oai")
    return explain.tree_contributions(model, test, names, "inspection_id", keep), names, model


@query
def contributions(spark, sf_dir):
    rows, names, _ = _explained(spark, sf_dir)
    return tidy(explain.top_drivers(rows, names, "inspection_id", len(names)))


@query
def additivity(spark, sf_dir):
    """Per row what contributions and base lack of the margin: nothing, also where ids repeat."""
    (model, _), names, test, _ = _fitted_trees(spark, sf_dir)
    twice = test.unionByName(test)
    rows = explain.tree_contributions(model, twice, names, "inspection_id")
    total = F.aggregate("contributions", F.lit(explain.base_margin(model)), lambda a, x: a + x)
    return rows.select("inspection_id", F.round(F.abs(total - F.col("margin")), 6).alias("off"))


@query
def linear_contributions(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    every, _ = _lists(rows)
    fit, test = _parts(rows)
    model = train.fit_logistic(fit, every)
    found = explain.linear_contributions(model, test, every, "inspection_id")
    return tidy(explain.global_importance(found, every, len(every)))


@query
def global_importance(spark, sf_dir):
    rows, names, _ = _explained(spark, sf_dir)
    return tidy(explain.global_importance(rows, names))


@query
def direction_summary(spark, sf_dir):
    rows, names, _ = _explained(spark, sf_dir)
    return tidy(explain.direction_summary(rows, names))


@query
def dependence(spark, sf_dir):
    rows, names, _ = _explained(spark, sf_dir)
    chosen = ["n_prior_oai", "n_prior_nai", "days_since_last_inspection", "total_prior_citations"]
    return tidy(explain.dependence(rows, names, chosen))


@query
def top_drivers(spark, sf_dir):
    rows, names, _ = _explained(spark, sf_dir)
    return tidy(explain.top_drivers(rows, names, "inspection_id"))


@query
def waterfall(spark, sf_dir):
    rows, names, model = _explained(spark, sf_dir)
    return tidy(
        explain.waterfall(rows, names, "target_oai", "inspection_id", explain.base_margin(model))
    )


@query
def risk_report(spark, sf_dir):
    rows, names, _ = _explained(spark, sf_dir)
    keep = ("fei_number", "product_type", "country", "project_area", "inspection_date")
    return tidy(explain.risk_report(rows, names, "inspection_id", keep, "target_oai"))


@query
def model_scores(spark, sf_dir):
    """Roll every facility forward, score it, and attach tier and audit columns."""
    (model, _), names, _, rows = _fitted_trees(spark, sf_dir)
    return tidy(
        scoring.score_facilities(
            model, rows, names, AS_OF, {"model_version": "v1", "threshold": 0.5, "scored_on": AS_OF}
        )
    )


# --- explanations of a given rule ---------------------------------------------------------------

RULE = {"n_prior_oai": 0.375, "n_prior_nai": -0.125, "n_recalls": 0.0625}
RULE_BASE = -0.5


def _ruled(spark, sf_dir):
    keep = ("fei_number", "target_oai")
    return explain.rule_contributions(d.features(spark, sf_dir), RULE, RULE_BASE, "inspection_id", keep)


@query
def rule_drivers(spark, sf_dir):
    return tidy(explain.top_drivers(_ruled(spark, sf_dir), list(RULE), "inspection_id", 2))


@query
def rule_importance(spark, sf_dir):
    return tidy(explain.global_importance(_ruled(spark, sf_dir), list(RULE)))


@query
def rule_direction(spark, sf_dir):
    return tidy(explain.direction_summary(_ruled(spark, sf_dir), list(RULE)))


@query
def rule_dependence(spark, sf_dir):
    return tidy(explain.dependence(_ruled(spark, sf_dir), list(RULE), ["n_prior_oai", "n_recalls"], 2.0))


@query
def rule_waterfall(spark, sf_dir):
    rows = _ruled(spark, sf_dir)
    return tidy(explain.waterfall(rows, list(RULE), "target_oai", "inspection_id", RULE_BASE))


@query
def rule_report(spark, sf_dir):
    rows = _ruled(spark, sf_dir)
    return tidy(explain.risk_report(rows, list(RULE), "inspection_id", ("fei_number",), "target_oai", 5, 3))


# --- readers and sinks --------------------------------------------------------------------------
# Whole tables are written in a raw form and read back through the reader.


@query
def csv_inspections(spark, sf_dir):
    """Orders as a CSV of inspections; dates are parsed strictly."""
    path = fresh_folder(spark)
    orders = d.table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").alias("Inspection ID"), F.col("o_custkey").alias("FEI Number"),
        F.concat(F.lit('Firm "'), F.col("o_custkey"), F.lit('", Inc.')).alias("Legal Name"),
        F.lit(None).cast("string").alias("City"), F.lit("x").alias("State"), F.lit("y").alias("Country/Area"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Inspection End Date"),
        F.col("o_orderstatus").alias("Classification"), F.col("o_orderpriority").alias("Project Area"),
        F.lit("z").alias("Product Type"), F.year("o_orderdate").alias("Fiscal Year"),
    )
    raw.write.option("header", True).option("escape", '"').csv(path)
    rows = readers.read_inspections(spark, path)
    return tidy(rows.select(
        F.col("Inspection ID").alias("id"), F.col("FEI Number").alias("fei"), F.col("Legal Name").alias("name"),
        F.col("City").alias("city"), F.col("Inspection End Date").alias("day"),
        F.col("Classification").alias("outcome"), F.col("Fiscal Year").alias("year"),
    ))


@query
def csv_citations(spark, sf_dir):
    """Line items through the CSV sink and the reader of citations."""
    path = fresh_folder(spark)
    items = d.table(spark, sf_dir, "lineitem")
    sinks.write_csv(items.select(
        F.col("l_orderkey").alias("Inspection ID"), F.col("l_suppkey").alias("FEI Number"),
        F.nullif("l_returnflag", F.lit("N")).alias("Act/CFR Number"), F.lit("a, b").alias("Short Description"),
        F.lit("c").alias("Long Description"), F.lit("d").alias("Program Area"),
    ), path)
    rows = readers.read_citations(spark, path)
    return tidy(rows.groupBy(F.col("Act/CFR Number").alias("code"), F.col("Short Description").alias("text")).agg(
        F.count("*").alias("n"), F.sum("Inspection ID").alias("ids"), F.sum("FEI Number").alias("keys")
    ))


@query
def csv_forms(spark, sf_dir):
    """Coerced dates and facility keys, also beyond 2^53; rows that lack either go."""
    path = fresh_folder(spark)
    orders = d.table(spark, sf_dir, "orders")
    key = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .when(F.col("o_orderstatus") == "O", (F.col("o_custkey") + F.lit(9007199254740993)).cast("string"))
        .otherwise("unknown")
    )
    day = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    sinks.write_csv(orders.select(
        key.alias("FEI Number"), day.alias("Record Date"), F.col("o_orderkey").alias("Download"), F.lit("p").alias("Publish Date")
    ), path)
    rows = readers.read_forms(spark, path)
    return rows.select(
        F.col("Download").cast("bigint").alias("id"), F.col("FEI Number").alias("fei"), F.col("Record Date").alias("day")
    )


@query
def json_letters(spark, sf_dir):
    """Letters as JSON lines through the JSON sink."""
    path = fresh_folder(spark)
    orders = d.table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    sinks.write_json(orders.select(
        day.alias("issue_date"), F.col("o_custkey").cast("string").alias("company_name"), F.col("o_orderkey").cast("string").alias("subject")
    ), path)
    rows = readers.read_letters(spark, path, lines=True)
    return rows.select(F.col("subject").cast("bigint").alias("id"), "company_name", "issue_date", "letter_url")


@query
def json_recalls(spark, sf_dir):
    """Two sources of recalls as JSON lines, tagged and united; absent fields are empty text."""
    items = d.table(spark, sf_dir, "lineitem")
    paths = {}
    for source, flag in (("drug", "R"), ("device", "A")):
        paths[source] = fresh_folder(spark)
        sinks.write_json(items.filter(F.col("l_returnflag") == flag).select(
            F.col("l_suppkey").cast("string").alias("recalling_firm"),
            F.when(F.col("l_linestatus") == "F", "Class I").alias("classification"),
            F.when(F.col("l_linenumber") == 1, "20200230").otherwise(
                F.date_format("l_shipdate", "yyyyMMdd")).alias("recall_initiation_date"),
        ), paths[source])
    fields = ["recalling_firm", "classification", "recall_initiation_date", "status"]
    rows = readers.with_recall_date(readers.read_recalls(spark, paths, fields, lines=True))
    return rows.groupBy("_source", "recalling_firm", "classification", "status").agg(
        F.count("*").alias("n"), F.count("recall_date").alias("n_dated"), F.max("recall_date").alias("newest")
    ).withColumnRenamed("_source", "source")


#: Order keys whose lines make one bulk document: its size is bounded, their number follows the table.
DOCUMENT_KEYS = 10_000


def _bulk_documents(lines):
    """(part, value): documents of a results array, one per range of order keys."""
    items = lines.select(
        F.floor(F.col("l_orderkey") / DOCUMENT_KEYS).alias("part"), F.col("l_suppkey").cast("string").alias("recalling_firm"),
        F.col("l_returnflag").alias("classification"),
    )
    return items.groupBy("part").agg(
        F.to_json(F.struct(F.collect_list(F.struct("recalling_firm", "classification")).alias("results"))).alias("value")
    )


@query
def document_recalls(spark, sf_dir):
    """Bulk documents, one object with a results array per file, turned into lines and read."""
    folder = fresh_folder(spark)
    # A folder per document: a file never holds two.
    _bulk_documents(d.table(spark, sf_dir, "lineitem")).write.partitionBy("part").text(f"{folder}/documents")
    readers.document_to_lines(spark, f"{folder}/documents", f"{folder}/lines")
    rows = readers.read_recalls(spark, {"bulk": f"{folder}/lines"}, ["recalling_firm", "classification"], lines=True)
    return rows.groupBy("recalling_firm", "classification").agg(F.count("*").alias("n"))


@query
def whole_recalls(spark, sf_dir):
    """The same documents, each parsed as it is."""
    folder = fresh_folder(spark)
    _bulk_documents(d.table(spark, sf_dir, "lineitem")).write.partitionBy("part").text(f"{folder}/documents")
    rows = readers.read_recalls(spark, {"bulk": f"{folder}/documents"}, ["recalling_firm", "classification"])
    return rows.groupBy("recalling_firm", "classification").agg(F.count("*").alias("n"))


@query
def array_letters(spark, sf_dir):
    """Letters out of JSON arrays, one per range of order keys, read in byte ranges."""
    folder = fresh_folder(spark)
    orders = d.table(spark, sf_dir, "orders")
    letter = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("issue_date"), F.concat(F.lit('Firm } "{'), F.col("o_custkey")).alias("company_name"),
        F.col("o_orderkey").cast("string").alias("subject"),
    )
    arrays = orders.groupBy(F.floor(F.col("o_orderkey") / DOCUMENT_KEYS).alias("part")).agg(
        F.to_json(F.collect_list(letter)).alias("value")
    )
    arrays.write.partitionBy("part").text(folder)
    rows = readers.read_letter_document(spark, folder)
    return rows.select(F.col("subject").cast("bigint").alias("id"), "company_name", "issue_date", "letter_url")


@query
def document_mapping(spark, sf_dir):
    """The mapping as nested documents, one per range of facilities."""
    folder = fresh_folder(spark)
    customer = d.table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    names = customer.groupBy(F.floor(F.col("c_custkey") / DOCUMENT_KEYS).alias("part")).agg(
        F.map_from_entries(F.collect_list(F.struct("c_name", F.struct(F.col("c_custkey").alias("fei"))))).alias("names")
    )
    documents = names.select("part", F.to_json(F.create_map(F.lit("letters"), "names")).alias("value"))
    documents.write.partitionBy("part").text(folder)
    return tidy(readers.read_mapping(spark, folder, "document").select("source", "name", "fei"))


@query
def stored_features(spark, sf_dir):
    """The feature table, written and read back."""
    path = fresh_folder(spark)
    sinks.write_parquet(d.features(spark, sf_dir), path)
    rows = readers.read_features(spark, path)
    return tidy(rows.groupBy("project_area").agg(
        F.count("*").alias("n"), F.sum("n_prior_oai").alias("n_prior_oai"), F.sum("total_prior_citations").alias("citations")
    ))


@query
def stored_mapping(spark, sf_dir):
    """The mapping of matched names, written and read back as a table."""
    path = fresh_folder(spark)
    sinks.write_parquet(resolve.match_mapping(_matched_letters(spark, sf_dir), "letters", "company_name"), path)
    return tidy(readers.read_mapping(spark, path))


@query
def dated_partitions(spark, sf_dir):
    """Run dates replace their own partition only; the older run of a date is gone, other dates stay."""
    path = fresh_folder(spark)
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    days = [Date(2001, 8, 1), Date(2001, 8, 2)]
    for flag, day in (("F", days[0]), ("P", days[1]), ("O", days[0])):
        sinks.write_dated(orders.filter(F.col("o_orderstatus") == flag), path, day)
    return spark.read.parquet(path)
