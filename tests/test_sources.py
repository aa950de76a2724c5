"""Readers and sinks on small files."""

import json
from datetime import date

import pytest
from vetrail.operators import quality
from vetrail.plans import feature_pipeline, queries, scoring
from vetrail.sources import readers, schemas, sinks


def write(path, content):
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


def test_inspections_from_csv_and_parquet(spark, tmp_path):
    path = write(
        tmp_path / "i.csv",
        "Inspection ID,FEI Number,Legal Name,City,State,Country/Area,Inspection End Date,"
        "Classification,Project Area,Product Type,Fiscal Year\n"
        '1,10,"Acme, Inc.",Akron,OH,US,2020-01-02,No Action Indicated (NAI),Drug,Drugs,2020\n'
        "2,,Beta,,,,,,,,\n",
    )
    rows = readers.read_inspections(spark, path)
    assert rows.schema.simpleString() == schemas.INSPECTIONS.simpleString()
    first, second = rows.orderBy("Inspection ID").collect()
    assert first["Legal Name"] == "Acme, Inc." and first["Inspection End Date"] == date(2020, 1, 2)
    assert second["FEI Number"] is None and second["Inspection End Date"] is None
    sinks.write_parquet(rows, str(tmp_path / "p"))
    assert readers.read_inspections(spark, str(tmp_path / "p"), "parquet").count() == 2


def test_forms_are_coerced(spark, tmp_path):
    path = write(
        tmp_path / "f.csv",
        "FEI Number,Record Date,Download,Publish Date\n12.0,2020-01-02,a,b\nx,2020-01-02,a,b\n13,n/a,a,b\n",
    )
    got = readers.read_forms(spark, path).collect()
    assert [(r["FEI Number"], r["Record Date"]) for r in got] == [(12, date(2020, 1, 2))]


def test_letters(spark, tmp_path):
    path = write(
        tmp_path / "w.json",
        [{"issue_date": "2020-01-02", "company_name": "A"}, {"issue_date": "", "company_name": "B"}],
    )
    got = {r["company_name"]: r["issue_date"] for r in readers.read_letters(spark, path).collect()}
    assert got == {"A": date(2020, 1, 2), "B": None}


def test_recalls_of_two_sources(spark, tmp_path):
    drug = write(
        tmp_path / "drug.json",
        {"meta": {"x": 1}, "results": [{"recalling_firm": "A", "recall_initiation_date": "20200131"},
                                       {"classification": "Class I", "recall_initiation_date": "20200230"}]},
    )
    device = write(tmp_path / "device.json", {"results": [{"recalling_firm": "B", "status": "Ongoing"}]})
    fields = ["recalling_firm", "classification", "recall_initiation_date", "status"]
    rows = readers.with_recall_date(readers.read_recalls(spark, {"drug": drug, "device": device}, fields))
    got = sorted((r["_source"], r["recalling_firm"], r["classification"], r["recall_date"] is None) for r in rows.collect())
    assert got == [("device", "B", "", True), ("drug", "", "Class I", True), ("drug", "A", "", False)]
    lines = write(tmp_path / "l.json", '{"recalling_firm": "C"}\n{"recalling_firm": "D"}\n')
    assert readers.read_recalls(spark, {"x": lines}, lines=True).count() == 2


def test_mapping_document_and_table(spark, tmp_path):
    path = write(tmp_path / "m.json", {"warning_letters": {"A": {"fei": 1}, "B": {}}, "enforcement": {"C": {"fei": 2}}})
    rows = readers.read_mapping(spark, path, "document")
    got = {(r["source"], r["name"]): r["fei"] for r in rows.collect()}
    assert got == {("warning_letters", "A"): 1, ("warning_letters", "B"): None, ("enforcement", "C"): 2}
    sinks.write_parquet(rows, str(tmp_path / "t"))
    assert readers.read_mapping(spark, str(tmp_path / "t")).count() == 3


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    sinks.write_csv(rows, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["k", "v"]
    sinks.write_json(rows, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    for day, n in ((1, 2), (2, 1), (1, 1)):
        sinks.write_dated(rows.limit(n), str(tmp_path / "d"), date(2024, 1, day))
    kept = spark.read.parquet(str(tmp_path / "d")).groupBy("run_date").count().collect()
    assert {r["run_date"]: r["count"] for r in kept} == {date(2024, 1, 1): 1, date(2024, 1, 2): 1}


def test_scores_are_written_with_alerts(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "Drugs", "US", 0.7, "Critical", date(2020, 1, 1)), (2, "Drugs", "US", 0.05, "Low", None)],
        schemas.SCORES,
    )
    alerts = scoring.write_scores(rows, str(tmp_path), date(2024, 1, 1))
    assert [r["fei_number"] for r in alerts.collect()] == [1]
    assert spark.read.option("header", True).csv(str(tmp_path / "high_risk_alerts")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "facility_scores_csv")).count() == 2


@pytest.fixture
def raw(tmp_path):
    head = ("Inspection ID,FEI Number,Legal Name,City,State,Country/Area,Inspection End Date,"
            "Classification,Project Area,Product Type,Fiscal Year\n")
    bad = "Official Action Indicated (OAI)"
    return {
        "inspections": write(
            tmp_path / "i.csv",
            head + f"1,10,Acme Tools Inc,Akron,OH,US,2020-01-02,{bad},Drug,Drugs,2020\n"
            "2,10,Acme Tools Inc,Akron,OH,US,2021-01-02,No Action Indicated (NAI),Drug,Drugs,2021\n",
        ),
        "citations": write(
            tmp_path / "c.csv",
            "Inspection ID,FEI Number,Act/CFR Number,Short Description,Long Description,Program Area\n"
            "1,10,21 CFR 211.113,a,b,c\n1,10,21 CFR 211.22,a,b,c\n",
        ),
        "letters": write(tmp_path / "w.json", [{"issue_date": "2020-06-01", "company_name": "ACME Tools"}]),
        "recalls": {
            "drug": write(
                tmp_path / "d.json",
                {"results": [{"recalling_firm": "Acme Tools", "classification": "Class II",
                              "recall_initiation_date": "20200301", "city": "Akron"}]},
            )
        },
        "forms": write(tmp_path / "f.csv", "FEI Number,Record Date,Download,Publish Date\n10,2020-02-01,a,b\n"),
    }


def test_pipeline_from_files(spark, tmp_path, raw):
    """Match the names, store the mapping, and build the feature table from the files."""
    facilities = readers.read_inspections(spark, raw["inspections"])
    mapping = feature_pipeline.build_mapping(
        readers.read_letters(spark, raw["letters"]),
        readers.read_recalls(spark, raw["recalls"]),
        facilities, "recall_initiation_date",
    )
    stored = str(tmp_path / "mapping")
    sinks.write_parquet(mapping, stored)
    out = feature_pipeline.run(
        spark, raw["inspections"], raw["citations"], raw["letters"], raw["recalls"], raw["forms"],
        stored, str(tmp_path / "features"),
    )
    r = out.filter("inspection_id = 2").first()
    assert (r["n_prior_oai"], r["total_prior_citations"], r["n_warning_letters"]) == (1, 2, 1)
    assert (r["n_recalls"], r["n_class_II_recalls"], r["n_published_483s"]) == (1, 1, 1)
    assert r["days_since_last_wl"] == 215


def test_pipeline_builds_and_writes_the_mapping(spark, tmp_path, raw):
    stored = str(tmp_path / "mapping")
    out = feature_pipeline.run(
        spark, raw["inspections"], raw["citations"], raw["letters"], raw["recalls"], raw["forms"],
        stored, str(tmp_path / "features"), match=True,
    )
    assert readers.read_mapping(spark, stored).count() == 2
    assert out.filter("inspection_id = 2").first()["n_warning_letters"] == 1


@pytest.mark.parametrize(
    ("gate", "limits"),
    [("letters_rows", {"letters": 10**6}), ("recalls_rows", {"recalls": 10**6}), ("rows", {"rows": 10**6}),
     ("target_rate", {"rate_limits": (0.9, 1.0)})],
)
def test_gates_stop_the_pipeline(spark, tmp_path, raw, gate, limits):
    open_ = {"cut_year": 2020, "letters": 0, "recalls": 0, "rows": 0, "rate_limits": (0.0, 1.0)}
    with pytest.raises(quality.GateFailed, match=gate):
        feature_pipeline.run(
            spark, raw["inspections"], raw["citations"], raw["letters"], raw["recalls"], raw["forms"],
            str(tmp_path / "mapping"), str(tmp_path / "features"), match=True,
            gates=feature_pipeline.Gates(**(open_ | limits)),
        )
    assert not (tmp_path / "features").exists()


def test_documents_become_lines(spark, tmp_path):
    folder = tmp_path / "documents"
    folder.mkdir()
    write(folder / "a.json", {"meta": 1, "results": [{"recalling_firm": "A", "x": "1"}, {"recalling_firm": "B"}]})
    write(folder / "b.json", {"results": []})
    readers.document_to_lines(spark, str(folder), str(tmp_path / "lines"))
    rows = readers.read_recalls(spark, {"s": str(tmp_path / "lines")}, ["recalling_firm", "status"], lines=True)
    assert sorted(r["recalling_firm"] for r in rows.collect()) == ["A", "B"]


def test_bulk_documents_follow_the_table(spark, tmp_path):
    """Documents stay bounded as the table grows, and every record of every one of them is read."""
    lines = spark.range(120_000).selectExpr(
        "id * 5 as l_orderkey", "id % 3 as l_suppkey", "if(id % 2 = 0, 'A', 'N') as l_returnflag"
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    sizes = [r["value"].count("recalling_firm") for r in queries._bulk_documents(lines).collect()]
    assert len(sizes) == 60 and max(sizes) == 2000
    found = queries.document_recalls(spark, str(tmp_path)).collect()
    assert sorted(r["n"] for r in found) == [20_000] * 6
