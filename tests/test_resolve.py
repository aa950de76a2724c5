"""Name matching against a dense brute-force loop, and the accept rule."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_functions import plain_grams
from vetrail.operators import resolve

TARGETS = [
    (1, "Quorvex, Inc", "basel|ch"), (2, "Harper and Harper", "nj|us"),
    (3, "Lumenor Pharmaceuticals", "basel|ch"), (4, "Quorvex Inc.", "ny|us"), (5, "Acme Tools", ""),
    (6, "Acme Tooling Works", "oh|us"), (7, None, ""), (8, "Zeta Labs GmbH", "bonn|de"),
    (9, "Beta Labs", "oh|us"), (10, "Co", "oh|us"),
]
SOURCES = [
    ("Quorvex Inc.", "ny|us"), ("Harper & Harper LLC", "nj|us"), ("Lumenor AG", "basel|ch"),
    ("ACME TOOLS CO", ""), ("Acme Tool", "oh|us"), ("zeta lab", "bonn|de"), ("Gamma Labs", "oh|us"),
    ("Unrelated Quux", "x"), ("", ""), (None, ""), ("Quorvex", "la|us"),
]


def norm(name):
    words = "".join(" " if c in ".,;:!?'\"()[]{}/\\" else c for c in (name or "").lower()).split()
    forms = "llc inc corp corporation ltd limited co company plc gmbh ag sa".split()
    return " ".join(w for w in words if w not in forms)


def brute_force(weights=None):
    """Best (target id, cosine) for every source, by dense loops."""
    weights = weights or [1] * len(SOURCES)
    t, s = [norm(n) for _, n, _ in TARGETS], [norm(n) for n, _ in SOURCES]
    every = t + [n for n, w in zip(s, weights) for _ in range(w)]
    df = Counter(g for n in every for g in set(plain_grams(n)))

    def vector(name):
        v = {g: c * (math.log((1 + len(every)) / (1 + df[g])) + 1) for g, c in Counter(plain_grams(name)).items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / size for g, x in v.items()}

    tv = [vector(n) for n in t]
    out = []
    for n in s:
        v = vector(n)
        cosines = [round(sum(x * w.get(g, 0.0) for g, x in v.items()), 9) for w in tv]
        best = max(range(len(tv)), key=lambda j: (cosines[j], -j))
        out.append((TARGETS[best][0], cosines[best]))
    return out


def frames(spark, weights=None):
    rows = [(n, loc, w) for (n, loc), w in zip(SOURCES, weights or [1] * len(SOURCES))]
    return (
        spark.createDataFrame(rows, "name string, loc string, w long"),
        spark.createDataFrame(TARGETS, "id long, legal string, place string"),
    )


@pytest.mark.parametrize("threshold", [0.25, 0.6])
@pytest.mark.parametrize("weights", [None, [3, 1, 1, 5, 1, 1, 2, 1, 1, 1, 1]])
def test_matches_brute_force(spark, threshold, weights):
    s, t = frames(spark, weights)
    found = resolve.match_names(s, t, "name", "legal", "id", threshold, source_weight="w").collect()
    got = {r["name"]: (r["matched_id"], round(r["match_score"], 9)) for r in found}
    expected = {
        name: best for (name, _), best in zip(SOURCES, brute_force(weights)) if best[1] >= threshold
    }
    assert set(got) == set(expected)
    for name, (target, cosine) in expected.items():
        assert got[name][0] == target and got[name][1] == pytest.approx(cosine, abs=2e-9)


@pytest.mark.parametrize("threshold", [0.25, 0.6])
@pytest.mark.parametrize("pairs", [0, 3])
def test_hot_grams_lose_no_match(spark, monkeypatch, threshold, pairs):
    monkeypatch.setattr(resolve, "HOT_PAIRS", pairs)
    sources, targets = frames(spark)
    found = resolve.best_matches(sources, targets, "name", "legal", "id", threshold)
    got = {r["norm_name"]: (r["target_id"], round(r["cosine"], 9)) for r in found.collect()}
    want = {norm(n): b for (n, _), b in zip(SOURCES, brute_force()) if b[1] >= threshold}
    assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in want.items()}, abs=2e-9)


def test_names_with_one_common_prefix(spark, monkeypatch):
    """All names begin alike: with a bound on hot grams far fewer pairs meet, and the matches are the same."""
    words = ["amber", "birch", "cedar", "delta", "ember", "flint", "grove", "haven", "islet", "jumbo"]
    names = [f"consolidated international {a} {b}" for a in words for b in words if a != b]
    targets = spark.createDataFrame(list(enumerate(names)), "id long, legal string")
    sources = spark.createDataFrame([(n.replace("o", "oo", 1) + " x",) for n in names[::2]], "name string")
    kept = []
    candidates = resolve._candidates

    def counted(*args):
        out = candidates(*args)
        kept.append(out.count())
        return out

    monkeypatch.setattr(resolve, "_candidates", counted)
    results = []
    for pairs in (10**9, 200):
        monkeypatch.setattr(resolve, "HOT_PAIRS", pairs)
        found = resolve.best_matches(sources, targets, "name", "legal", "id", 0.85)
        results.append({r["norm_name"]: (r["target_id"], round(r["cosine"], 8)) for r in found.collect()})
    assert results[0] == results[1] and len(results[0]) > 10
    assert kept[1] <= 2 * kept[0]


def test_location_rule(spark):
    threshold = 0.3
    s, t = frames(spark)
    found = resolve.match_names(
        s, t, "name", "legal", "id", threshold, "loc", "place"
    ).collect()
    got = {r["name"]: (r["matched_id"], round(r["match_score"], 6)) for r in found}
    places = {i: p for i, _, p in TARGETS}
    expected = {}
    for (name, loc), (target, cosine) in zip(SOURCES, brute_force()):
        shared = bool(loc) and bool(places[target]) and bool(set(loc.split("|")) & set(places[target].split("|")))
        if cosine >= 0.8:
            expected[name] = (target, cosine)
        elif cosine >= threshold and shared:
            expected[name] = (target, cosine + 0.15)
    assert set(got) == set(expected)
    for name, (target, value) in expected.items():
        assert got[name][0] == target and got[name][1] == pytest.approx(value, abs=1e-6)
    assert any(0.3 <= c < 0.8 for _, c in brute_force())  # the rule was exercised


def test_accepted_score(spark):
    frame = spark.createDataFrame([(0.65, True), (0.65, False), (0.85, False), (0.5, True)], "c double, o boolean")
    got = [r[0] for r in frame.select(resolve.accepted_score(F.col("c"), 0.6, F.col("o"))).collect()]
    assert got == [pytest.approx(0.8), None, 0.85, None]
    alone = [r[0] for r in frame.select(resolve.accepted_score(F.col("c"), 0.6, None)).collect()]
    assert alone == [0.65, 0.65, 0.85, None]


def test_letters_and_recalls(spark):
    facilities = spark.createDataFrame(
        [(10, "Acme Tools Inc", "Akron", "OH", "US"), (11, "Zeta Labs", "Bonn", None, "DE")],
        "`FEI Number` long, `Legal Name` string, City string, State string, `Country/Area` string",
    )
    letters = spark.createDataFrame([("ACME Tools",), ("ACME Tools",), ("nobody",), (None,)], "company_name string")
    got = resolve.match_letters(letters, facilities).collect()
    assert len(got) == 4
    assert sorted(str(r["matched_fei"]) for r in got) == ["10", "10", "None", "None"]
    assert all(r["match_score"] == 0.0 for r in got if r["matched_fei"] is None)
    recalls = spark.createDataFrame(
        [(1, "Zeta Labs", "Bonn", "", "DE"), (2, "Zeta Labs", "Paris", "", "FR"), (3, "other firm", "", "", "")],
        "n long, recalling_firm string, city string, state string, country string",
    )
    found = resolve.match_recalls(recalls, facilities, "n")
    assert {r["n"]: r["matched_fei"] for r in found.collect()} == {1: 11, 2: 11, 3: None}
    rate = resolve.match_rate(found, "recalling_firm").first()
    assert (rate["n_names"], rate["n_matched"]) == (2, 1)
    mapping = resolve.match_mapping(found, "enforcement", "recalling_firm")
    assert resolve.with_entity(recalls, mapping, "enforcement", "recalling_firm").count() == 2
