import pytest

from carbonsieve.plans import jobs
from carbonsieve.sources import schemas
from carbonsieve.streaming import rowlevel

RESPONSE = '{"emissions":[{"reporting_year":2020,"scope_1":-5.0,"scope_2_location":1,"scope_3":2}],"methodology_notes":"m","confidence_score":80}'


def test_extraction(spark):
    companies = schemas.conform(spark.createDataFrame([(1, "A & B"), (2, "C"), (3, "D"), (4, "E")], "id long, name string"), schemas.COMPANIES)
    results = spark.createDataFrame([(1, 0, "h/x", "t"), (1, 1, "h/y.pdf", "t"), (2, 0, "h/z", "t"), (3, 0, "h/w.xlsx", "t")], schemas.SEARCH_RESULTS)
    pages = spark.createDataFrame([(1, 0, "| a |\n| b |")], schemas.DOC_PAGES)
    html = spark.createDataFrame([(2, "h/z", "<table><tr><td>q</td></tr></table>")], schemas.HTML_PAGES)
    cells = spark.createDataFrame([(3, 0, r, 0, "v") for r in range(2)], schemas.CELLS)
    found = jobs.parsed_tables(pages, html, cells)
    ranks = spark.createDataFrame([(d, '{"ranked":[{"index":0,"score":90}]}') for d in (1, 2, 3)], schemas.RANK_RESPONSES)
    responses = spark.createDataFrame([(1, 0, RESPONSE), (2, 0, "bad"), (2, None, RESPONSE), (3, 0, "bad")], schemas.EXTRACT_RESPONSES)
    out = jobs.extract_records(companies, results, found, ranks, responses)
    assert {r["company_id"]: r["reporting_year"] for r in out.records.collect()} == {1: 2020, 2: 2020}
    assert {r["company_id"]: (r["document_type"], r["s3_pdf_key"]) for r in out.sources.collect()} == {1: ("pdf", "sources/a_and_b/report.pdf"), 2: ("html", None)}
    assert {r["company_id"]: (r["status"], r["records"], r["error"]) for r in out.outcomes.collect()} == {
        1: ("success", 1, None), 2: ("success", 1, None), 3: ("failed", 0, "No emissions data found for D"), 4: ("failed", 0, "No search results found for 'E'."),
    }


def test_main_checks_and_exports(spark, tmp_path):
    recs = schemas.conform(spark.createDataFrame([(1, 1, 2020, -5.0)], "id long, company_id long, reporting_year int, scope_1 double"), schemas.RECORDS, schemas.DEFAULTS["records"])
    recs.write.parquet(str(tmp_path / "r"))
    schemas.conform(spark.createDataFrame([(1, "A")], "id long, name string"), schemas.COMPANIES).write.parquet(str(tmp_path / "c"))
    jobs.main(["check", "--records", str(tmp_path / "r"), "--year", "2024", "--out", str(tmp_path / "o")])
    assert spark.read.parquet(str(tmp_path / "o")).first()["flag_reason"] == "Scope 1 is negative (-5.0)"
    jobs.main(["export", "--records", str(tmp_path / "o"), "--companies", str(tmp_path / "c"), "--out", str(tmp_path / "e")])
    assert spark.read.option("header", True).csv(str(tmp_path / "e")).first()["Status"] == "flagged"


@pytest.mark.parametrize("status", ["pending", "approved"])
def test_streamed_records_are_checked(spark, tmp_path, status):
    spark.createDataFrame([(1, 0, RESPONSE)], schemas.EXTRACT_RESPONSES).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.EXTRACT_RESPONSES).parquet(str(tmp_path / "in"))
    flat = rowlevel.records_from_responses(stream)
    recs = schemas.with_missing_columns(flat, schemas.RECORDS, schemas.DEFAULTS["records"])
    out = rowlevel.checked(recs.withColumn("review_status", recs["review_status"] if status == "pending" else recs["unit"]), 2024)
    q = rowlevel.write(out.select("flag_reason"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == (["Scope 1 is negative (-5.0)"] if status == "pending" else [None])
