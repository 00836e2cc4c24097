"""Ids, unique keys, updates in place, layout, generations of files, databases."""

import datetime
import hashlib
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carbonsieve.operators import checks, review
from carbonsieve.plans import jobs
from carbonsieve.sources import keys, schemas
from carbonsieve.sources import tables as io
from carbonsieve.sources.staging import read_or_empty

DAY = datetime.datetime(2024, 5, 1, 12)


def records(spark, rows, columns="id long, company_id long, reporting_year int, extraction_date timestamp_ntz, scope_1 double"):
    return schemas.conform(spark.createDataFrame(rows, columns), schemas.RECORDS, schemas.DEFAULTS["records"])


@pytest.mark.parametrize("after", [0, 41])
def test_numbers_are_dense_and_in_order(spark, after):
    names = [f"n{random.Random(k).randrange(10**6)}" for k in range(500)] + [None, "same", "same"]
    rows = spark.createDataFrame([(n, "x", -1) for n in names], "name string, _id string, id int").repartition(7)
    out = keys.numbered(rows, ["name"], after)
    got = sorted((r["id"], r["name"]) for r in out.collect())
    want = sorted(names, key=lambda n: (n is not None, n))
    assert got == [(after + 1 + k, n) for k, n in enumerate(want)]
    assert out.columns == ["id", "name", "_id"] and sorted(map(tuple, out.collect())) == sorted(map(tuple, out.collect()))
    assert keys.numbered(rows.limit(0), ["name"], after).count() == 0 and keys.last_id(rows.limit(0)) == 0


def test_ids_leave_few_rows_to_the_driver_and_one_shuffle(spark):
    plan = keys.numbered(spark.range(10).withColumnRenamed("id", "k"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_appends_respect_the_key(spark, tmp_path):
    at = str(tmp_path / "records")
    write = lambda rows: keys.append_new(records(spark, rows), at, schemas.RECORDS, keys.RECORD_KEY, ["company_id", "extraction_date"], partition="reporting_year")
    first = [(None, c, 2020 + c % 2, DAY, float(c)) for c in range(6)]
    assert write(first).count() == 6 and write(first).count() == 0
    # overlapping, with repeats among themselves, a null date and a year not stored yet
    more = [*first[3:], (None, 9, 2020, DAY, 9.0), (None, 9, 2020, DAY, 8.0), (None, 9, 2020, None, 7.0), (None, 9, 2031, DAY, 6.0)]
    assert write(more).count() == 3 and write(more).count() == 0 and write([]).count() == 0
    stored = read_or_empty(spark, at, schemas.RECORDS).orderBy("id").collect()
    assert [r["id"] for r in stored] == list(range(1, 10)) and len({(r["company_id"], r["reporting_year"], r["extraction_date"]) for r in stored}) == 9


def test_an_append_that_died_is_run_again(spark, tmp_path):
    """Half of a batch is there, as after a job that died while it moved its files."""
    at = str(tmp_path / "records")
    rows = [(None, c, 2020, DAY, float(c)) for c in range(10)]
    keys.append_new(records(spark, rows[:4]), at, schemas.RECORDS, keys.RECORD_KEY, ["company_id"], partition="reporting_year")
    keys.append_new(records(spark, rows), at, schemas.RECORDS, keys.RECORD_KEY, ["company_id"], partition="reporting_year")
    assert sorted((r["id"], r["company_id"]) for r in read_or_empty(spark, at, schemas.RECORDS).collect()) == [(c + 1, c) for c in range(10)]


def test_an_append_searches_its_years_only(spark, tmp_path):
    at = str(tmp_path / "records")
    records(spark, [(y, 1, y, DAY, 1.0) for y in range(2000, 2020)]).write.partitionBy("reporting_year").parquet(at)
    table = read_or_empty(spark, at, schemas.RECORDS)
    searched = table.where(F.col("reporting_year").isin([2003, 2004]))
    plan = keys.unseen_rows(records(spark, [(None, 1, 2003, DAY, 1.0)]), searched, keys.RECORD_KEY, ["company_id"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [reporting_year" in plan


def digests(folder):
    return {p.name + str(p.parent.name): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(folder).rglob("part-*.parquet")}


def test_decisions_touch_their_years_only(spark, tmp_path):
    at = jobs.Tables.under(str(tmp_path))
    rows = records(spark, [(k, k % 5, 2010 + k % 10, DAY, 1.0) for k in range(100)])
    rows.repartition(3).write.partitionBy("reporting_year").parquet(at.records)
    before = digests(at.records)
    chosen = [(1, 3, DAY, "approve", None), (2, 13, DAY, "reject", None), (3, 7, DAY, "edit", 5.0), (4, 9999, DAY, "flag", None)]
    decisions = schemas.conform(spark.createDataFrame(chosen, "decision_id long, record_id long, decided_at timestamp_ntz, action string, new_scope_1 double"), schemas.DECISIONS)
    assert jobs.decide(at, decisions) == [2013, 2017]
    after = digests(at.records)
    untouched = {k for k in before if not k.endswith(("2013", "2017"))}
    assert {k: before[k] for k in untouched} == {k: after.get(k) for k in untouched} and not {k for k in before if k.endswith(("2013", "2017"))} & set(after)
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert key(read_or_empty(spark, at.records, schemas.RECORDS)) == key(review.apply_decisions(rows, decisions))
    assert jobs.decide(at, decisions.limit(0)) == []


def test_counts_come_with_the_snapshot(spark, tmp_path):
    rows = records(spark, [(k, k % 3, 2010 + k % 10, DAY, -1.0 if k % 7 == 0 else float(k * k)) for k in range(60)])
    checked, counts = jobs.observed_checks(rows, 2024)
    checked.write.parquet(str(tmp_path / "out"))
    assert counts.get == checks.check_counts(rows, 2024).first().asDict()
    key = lambda df: sorted(map(str, df.collect()))
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(checks.run_all_checks(rows, 2024))


def test_records_by_company_are_read_without_a_shuffle(spark, tmp_path):
    rows = records(spark, [(k, k % 9, 2010 + k % 10, DAY, float(k)) for k in range(90)])
    io.write_by_company(rows, "by_company_test", str(tmp_path / "t"), buckets=4)
    try:
        table = spark.table("by_company_test")
        assert len(list((tmp_path / "t").glob("part-*"))) <= 4
        for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.requireAllClusterKeysForCoPartition", "false")):
            spark.conf.set(name, value)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan(review.prior_years(rows)) and "Exchange" not in plan(review.prior_years(table))
        assert "Exchange" in plan(checks.run_all_checks(rows, 2024)) and "Exchange" not in plan(checks.run_all_checks(table, 2024))
        key = lambda df: sorted(map(str, df.collect()))
        assert key(checks.run_all_checks(table, 2024)) == key(checks.run_all_checks(rows, 2024))
        assert key(review.prior_years(table).select("id", "prior")) == key(review.prior_years(rows).select("id", "prior"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        spark.sql("DROP TABLE by_company_test")


def test_generations_of_files(spark, tmp_path):
    schema = schemas._struct("id long, unit string, is_restated boolean, n int, note string")
    spark.createDataFrame([(1,)], "id long").write.parquet(str(tmp_path / "g/a"))
    spark.createDataFrame([(2, None, None, None), (3, "kt", True, 5)], "id long, unit string, is_restated boolean, n int").write.parquet(str(tmp_path / "g/b"))
    out = io.read_generations(spark, str(tmp_path / "g/*"), schema, {"unit": "it's \\ t", "is_restated": False, "n": 7})
    assert sorted(map(tuple, out.collect())) == [(1, "it's \\ t", False, 7, None), (2, None, None, None, None), (3, "kt", True, 5, None)]
    assert [r["id"] for r in out.where("unit = 'kt'").collect()] == [3] and out.where("unit is null").count() == 1
    assert [r["id"] for r in out.where("n = 7").collect()] == [1]


def test_database_round_trip_with_skewed_ids(spark):
    url = "jdbc:derby:memory:carbonsieve;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    ids = [*range(1000), *(10**9 + k for k in range(10)), *(2 * 10**9 + 10**6 * k for k in range(5))]
    rows = spark.createDataFrame([(i, f"n{i}") for i in ids] + [(None, "none")], "id long, name string")
    io.write_jdbc(rows, url, "companies", properties=driver)
    back = io.read_jdbc(spark, url, "companies", 8, properties=driver)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    sizes = [len(p) for p in back.rdd.glom().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert io.read_jdbc(spark, url, "companies", 1, properties=driver).count() == len(ids) + 1
    assert io.id_predicates([]) == ["1 = 1"] and io.id_predicates([5]) == ["id < 5 OR id IS NULL", "id >= 5"]


RESPONSE = '{"emissions":[{"reporting_year":2020,"scope_1":-5.0,"scope_2_location":1,"scope_3":2},{"reporting_year":2020,"scope_1":7,"scope_2_location":1,"scope_3":2}],"methodology_notes":"m","confidence_score":80}'


@pytest.fixture
def documents(spark, tmp_path):
    """Search results, documents and answers of five companies, of which one has an unreadable page."""
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "docs" / name))
    put("search_results", [(1, 0, "h/a.pdf", "A"), (2, 0, "h/b", "B"), (3, 0, "h/c.xlsx", "C"), (4, 0, "h/d", "D"), (7, 0, "h/x", "no such company")], schemas.SEARCH_RESULTS)
    put("doc_pages", [(1, 0, "| a |\n| --- |")], schemas.DOC_PAGES)
    put("html_pages", [(2, "h/b", "<table><tr><td>q</td></tr></table>"), (4, "h/d", "<table><tr><td>q</td></tr></table><![foo[x]]>")], schemas.HTML_PAGES)
    put("cells", [(3, 0, r, 0, "v") for r in range(2)], schemas.CELLS)
    put("rank_responses", [(d, '{"ranked":[{"index":0,"score":90}]}') for d in (1, 2, 3, 4)], schemas.RANK_RESPONSES)
    put("extract_responses", [(1, 0, RESPONSE), (2, None, RESPONSE), (3, 0, "bad"), (4, 0, RESPONSE)], schemas.EXTRACT_RESPONSES)
    (tmp_path / "seed.csv").write_text("name,ticker\nAlpha plc,A\nBeta,B\nGamma,C\nDelta,D\nEpsilon,E\n")
    return tmp_path


def run(capsys, *args):
    jobs.main([str(a) for a in args])
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_from_seed_to_review(spark, documents, capsys):
    tables, at = documents / "t", jobs.Tables.under(str(documents / "t"))
    registry = schemas.conform(spark.createDataFrame([("L1", "ALPHA PLC", "GB", "ACTIVE")], schemas.REGISTRY), schemas.REGISTRY)
    registry.write.parquet(str(documents / "registry"))
    assert run(capsys, "init", "--tables", tables, "--seed", documents / "seed.csv", "--registry", documents / "registry") == {"added": 5, "existed": 0, "with_lei": 1}
    assert run(capsys, "init", "--tables", tables, "--seed", documents / "seed.csv") == {"added": 0, "existed": 5, "with_lei": 1}
    companies = read_or_empty(spark, at.companies, schemas.COMPANIES).orderBy("id").collect()
    assert [(r["id"], r["name"], r["lei"], r["lei_review_status"], r["index_membership"]) for r in companies][:2] == [(1, "Alpha plc", "L1", "approved", "FTSE100"), (2, "Beta", None, "pending", "FTSE100")]
    assert [r["name"] for r in companies] == ["Alpha plc", "Beta", "Delta", "Epsilon", "Gamma"]

    extract = ["extract", "--tables", tables, "--documents", documents / "docs", "--started", "2024-05-01T12:00:00"]
    assert run(capsys, *extract) == {"successful": 2, "failed": 3, "skipped": 0, "records": 4}
    assert run(capsys, *extract) == {"successful": 2, "failed": 3, "skipped": 0, "records": 0}
    stored = read_or_empty(spark, at.records, schemas.RECORDS).orderBy("id").collect()
    sources = {r["id"]: (r["company_id"], r["url"]) for r in read_or_empty(spark, at.sources, schemas.SOURCES).collect()}
    assert sources == {1: (1, "h/a.pdf"), 2: (2, "h/b")}
    assert [(r["id"], r["company_id"], r["scope_1"], r["source_id"], r["extraction_date"].microsecond) for r in stored] == [(1, 1, -5.0, 1, 0), (2, 1, 7.0, 1, 1), (3, 2, -5.0, 2, 0), (4, 2, 7.0, 2, 1)]
    log = read_or_empty(spark, at.runs, schemas.RUNS).first()
    assert (log["id"], log["total_companies"], log["failed"]) == (1, 5, 3)
    assert log["error_log"] == "Delta: No emissions data found for Delta\nEpsilon: Page cannot be parsed: unknown status keyword 'foo' in marked section\nGamma: No search results found for 'Gamma'."

    counts = run(capsys, "check", "--records", at.records, "--year", 2024, "--out", documents / "checked")
    assert counts["range_flags"] == 2 and counts["flagged"] >= 2
    spark.read.parquet(str(documents / "checked")).write.mode("overwrite").partitionBy("reporting_year").parquet(at.records)
    decided = spark.createDataFrame([(1, 1, DAY, "approve", None), (2, 2, DAY, "edit", 9.0)], "decision_id long, record_id long, decided_at timestamp_ntz, action string, new_scope_1 double")
    schemas.conform(decided, schemas.DECISIONS).write.parquet(str(documents / "decisions"))
    assert run(capsys, "decide", "--tables", tables, "--decisions", documents / "decisions", "--reviewer", "me") == {"years": [2020]}
    found = run(capsys, "status", "--tables", tables)
    assert (found["n_companies"], found["n_records"], found["approved"]) == (5, 4, 1) and found["last_run"]["failed"] == 3
    report = jobs.review_report(read_or_empty(spark, at.records, schemas.RECORDS), read_or_empty(spark, at.companies, schemas.COMPANIES), read_or_empty(spark, at.sources, schemas.SOURCES))
    rows = {r["id"]: r for r in report.collect()}
    assert (rows[1]["company"], rows[1]["url"], rows[1]["reviewed_by"], rows[1]["review_status"], rows[2]["scope_1_text"]) == ("Alpha plc", "h/a.pdf", "me", "approved", "9")


def test_a_run_for_some_companies(spark, documents, capsys):
    tables = documents / "t"
    run(capsys, "init", "--tables", tables, "--seed", documents / "seed.csv")
    assert run(capsys, "status", "--tables", tables)["last_run"] is None
    spark.createDataFrame([(2,), (99,)], "id long").write.parquet(str(documents / "ids"))
    assert run(capsys, "extract", "--tables", tables, "--documents", documents / "docs", "--ids", documents / "ids") == {"successful": 1, "failed": 0, "skipped": 0, "records": 2}
    assert run(capsys, "extract", "--tables", tables, "--documents", documents / "docs")["records"] == 4
    assert sorted(r["id"] for r in read_or_empty(spark, str(tables / "records"), schemas.RECORDS).collect()) == [1, 2, 3, 4, 5, 6]


def test_prior_years_in_the_report(spark):
    rows = records(spark, [(1, 1, 2020, DAY, 0.0), (2, 1, 2021, DAY, 1234.4)])
    companies = schemas.conform(spark.createDataFrame([(1, "A")], "id long, name string"), schemas.COMPANIES)
    sources = spark.createDataFrame([], schemas.SOURCES)
    prior = {r["id"]: r["prior"] for r in jobs.review_report(rows, companies, sources).collect()}
    assert prior[1] == [] and prior[2][0].asDict() == {"id": 1, "reporting_year": 2020, "scope_1_text": "—", "scope_2_location_text": "—", "scope_3_text": "—"}
