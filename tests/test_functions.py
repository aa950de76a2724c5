"""Column functions: coercion, names, locations, grams, HTML, tiers."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from vetrail.functions import coerce, html, scores, text


def values(spark, column, rows, schema="v string"):
    frame = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in frame.select(column).collect()]


def test_exclusion_keeps_null(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    kept = frame.filter(coerce.not_in_or_null("v", ["a"])).collect()
    assert [r[0] for r in kept] == ["b", None]


def test_dates(spark):
    rows = ["20200131", "20200230", "", None, "x"]
    assert values(spark, coerce.coerced_date("v", "yyyyMMdd"), rows) == [
        date(2020, 1, 31), None, None, None, None,
    ]
    assert values(spark, coerce.strict_date("v"), ["2020-01-31", ""]) == [date(2020, 1, 31), None]
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|cannot be"):
        values(spark, coerce.strict_date("v"), ["garbage"])


def test_whole_numbers(spark):
    assert values(spark, coerce.coerced_long("v"), ["12.0", "x", "", None, " 7 "]) == [12, None, None, None, 7]
    assert values(spark, coerce.coerced_long("v"), ["9007199254740993", "-5"]) == [9007199254740993, -5]
    with pytest.raises(Exception, match="not a whole number"):
        values(spark, coerce.coerced_long("v"), ["12.5"])


@pytest.mark.parametrize(
    "raw, default, stripped",
    [
        ("Quorvex, Inc.", "quorvex", "quorvex"),
        ("Acme d/b/a Foo", "acme d b a foo", "acme"),
        ("Acme dba Foo", "acme", "acme"),
        ("Coco Company Co", "coco", "coco"),
        ("Foo www.foo-bar.com Ltd", "foo www foo-bar com", "foo"),
        ("  (A)  &  B  LLC ", "a & b", "a & b"),
        ("Ünal AG", "ünal", "ünal"),
        ("éco", "éco", "éco"),
        ("", "", ""),
        (None, "", ""),
    ],
)
def test_normalize_name(spark, raw, default, stripped):
    assert values(spark, text.normalize_name("v"), [raw]) == [default]
    assert values(spark, text.normalize_name("v", strip_first=True), [raw]) == [stripped]


def test_locations(spark):
    frame = spark.createDataFrame(
        [("Basel", "N/A", " CH "), ("", "-", None), ("X", None, "ch")], "a string, b string, c string"
    )
    got = [r[0] for r in frame.select(text.normalize_location("a", "b", "c")).collect()]
    assert got == ["basel|ch", "", "x|ch"]
    with_nan = [r[0] for r in frame.select(text.normalize_location("a", "b", "c", nan_token=True)).collect()]
    assert with_nan == ["basel|ch", "nan", "x|nan|ch"]
    pairs = spark.createDataFrame([("a|b", "b"), ("a", "b"), ("", ""), ("a", "")], "l string, r string")
    assert [r[0] for r in pairs.select(text.locations_overlap("l", "r")).collect()] == [True, False, False, False]


def plain_grams(name):
    out = []
    for word in name.split():
        framed = f" {word} "
        for n in (2, 3, 4):
            slides = [framed[i : i + n] for i in range(max(len(framed) - n + 1, 1))]
            out += slides
            if len(framed) <= n:
                break
    return out


def test_grams_of_a_letter(spark):
    assert values(spark, text.char_grams("v"), ["a"]) == [[" a", "a ", " a "]]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab éz-", max_size=12), min_size=1, max_size=20))
def test_grams_against_plain_python(spark, names):
    assert values(spark, text.char_grams("v"), names) == [plain_grams(n) for n in names]


def test_html_cells(spark):
    cell = '<p> A <b> b </b> &lt;c&gt; <!-- no --> </p>'
    assert values(spark, html.cell_text(F.col("v")), [cell, "", None]) == ["Ab<c>", "", ""]
    stamp = '<time datetime="2024-05-07T04:00:00Z">05/07/2024</time>'
    assert values(spark, html.cell_date(F.col("v")), [stamp, "x", None]) == ["2024-05-07", "", ""]
    link = '<abbr>x</abbr><a class="y" href="/p?a=1&amp;b=2"> Acme <i>&amp;</i> Co </a><a href="/z">Z</a>'
    assert values(spark, html.anchor_text(F.col("v")), [link]) == ["Acme&Co"]
    url = html.absolute_url(html.anchor_href(F.col("v")), "https://h")
    assert values(spark, url, [link, '<a href="http://q">q</a>', "<p>none</p>"]) == [
        "https://h/p?a=1&b=2", "http://q", "",
    ]


def test_tiers(spark):
    points = [0.0, 0.1, 0.3, 0.6, 1.0]
    assert values(spark, scores.batch_tier(F.col("v")), points, "v double") == [
        None, "Low", "Medium", "High", "Critical",
    ]
    assert values(spark, scores.lookup_tier(F.col("v")), points, "v double") == [
        "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL",
    ]


def test_driver_text(spark):
    got = values(spark, scores.driver_text(F.lit("f"), F.lit(3.0), F.col("v")), [0.25, -0.5], "v double")
    assert got == ["↑ f = 3 (impact: +0.250)", "↓ f = 3 (impact: -0.500)"]
    assert values(spark, scores.percent_text(F.col("v")), [0.1234], "v double") == ["12.3%"]


MARKUP = [
    ('<a title="x>y" href=/p>Firm</a>', "Firm", "/p"),
    ("<A HREF='/p?a=1&amp;b=2'>Firm", "Firm", "/p?a=1&b=2"),
    ('<a data-href="/no" title="href=/no" href = "/p">F<b> ir</b>m</a> more', "Firm", "/p"),
    ("<a disabled href=/p><img alt='>'>Firm</a>", "Firm", "/p"),
    ("<a href='/p'>one<a href='/q'>two</a>", "one", "/p"),
    ("<!-- <a href='/no'>no</a> --><a href=\"/p\">Firm<!-- > --></a>", "Firm", "/p"),
    ("<script>x = '<a href=/no>no</a>'</script><a href=/p>Firm</a>", "Firm", "/p"),
    ("<abbr href=/no>no</abbr><a name=x>Firm</a>", "Firm", ""),
    ("<a href=''>&nbsp; Firm &amp;amp; &#8217;&#x2014;&nope;&copy &#0;</a>", "Firm &amp; ’—&nope;© &#0;", ""),
    ("no link", "", ""),
    ("", "", ""),
    (None, "", ""),
    ("<a href='/p'", "", ""),
    ("<a/href=/p>x</a>", "x", "/p"),
    ("<a " + "x='1' " * 2000 + "href=/p>" + "<b>y</b>" * 2000 + "</a>", "y" * 2000, "/p"),
]


def test_malformed_links(spark):
    cells = [c for c, _, _ in MARKUP]
    assert values(spark, html.anchor_text(F.col("v")), cells) == [t for _, t, _ in MARKUP]
    assert values(spark, html.anchor_href(F.col("v")), cells) == [h for _, _, h in MARKUP]


def test_malformed_cells(spark):
    table = {
        "1 < 2 <b>and 3 > 2</b>": "1 < 2and 3 > 2", "<p>a<br/>b</p>": "ab", "x<!-- never closed": "x",
        "a<style>p > q</style>b<STYLE>c": "ab", "&lt;b&gt; &amp;lt;": "<b> &lt;", "&#128512;&#xD800;&#x110000;": "😀&#xD800;&#x110000;",
        "&": "&", "&&amp;&": "&&&", "<td\n class='a'>\tx\n</td>": "x", "</p >x": "x", "a <3 b": "a <3 b", "&apos;&eacute;": "'é",
    }
    assert values(spark, html.cell_text(F.col("v")), list(table)) == list(table.values())
