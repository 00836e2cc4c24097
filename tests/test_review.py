from datetime import datetime

from carbonsieve.operators import review, runs
from carbonsieve.sources import schemas
from carbonsieve.sources import tables as io

T = [datetime(2024, 1, d) for d in range(1, 9)]


def records(spark, *rows):
    df = spark.createDataFrame(list(rows), "id long, company_id long, reporting_year int, scope_1 double, review_status string, flag_reason string, extraction_date timestamp_ntz")
    return schemas.conform(df, schemas.RECORDS, schemas.DEFAULTS["records"])


def decide(spark, *rows):
    full = [(i, 1, T[t], a, *(s or (None,) * 4), n) for i, (t, a, s, n) in enumerate(rows)]
    d = spark.createDataFrame(full, schemas.DECISIONS)
    return review.apply_decisions(records(spark, (1, 1, 2020, 9.0, "pending", None, T[0])), d).first()


def test_edit(spark):
    r = decide(spark, (1, "edit", (0.0, 5.0, -1.0, 7.0), "ok"))
    assert (r["scope_1"], r["scope_2_location"], r["scope_2_market"], r["scope_3"]) == (None, 5.0, None, 7.0)
    assert r["flag_reason"] == "; Review note: ok" and r["review_status"] == "pending" and r["reviewed_by"] is None


def test_actions_fold_in_time_order(spark):
    r = decide(spark, (3, "flag", None, None), (1, "approve", None, None), (2, "edit", (1.0, 1.0, 1.0, 1.0), "b"), (0, "edit", (2.0, 2.0, 2.0, 2.0), "a"))
    assert r["review_status"] == "flagged" and r["reviewed_by"] == "reviewer" and r["reviewed_at"] == T[1]
    assert r["scope_1"] == 1.0 and r["flag_reason"] == "; Review note: a; Review note: b"


def test_untouched_records_stay(spark):
    d = spark.createDataFrame([], schemas.DECISIONS)
    r = review.apply_decisions(records(spark, (1, 1, 2020, 9.0, "pending", "x", T[0])), d).first()
    assert (r["scope_1"], r["review_status"], r["flag_reason"]) == (9.0, "pending", "x")


def test_prior_years_are_strictly_earlier_and_three(spark):
    rows = [(i, 1, y, 1.0, "pending", None, T[i % 8]) for i, y in enumerate([2015, 2016, 2016, 2017, 2018, 2018])]
    got = {r["id"]: [p["id"] for p in r["prior"]] for r in review.prior_years(records(spark, *rows)).collect()}
    assert got == {0: [], 1: [0], 2: [0], 3: [0, 1, 2], 4: [1, 2, 3], 5: [1, 2, 3]}


def test_counts_show_zeros(spark):
    got = {r["status"]: r["n"] for r in review.status_counts(records(spark, (1, 1, 2020, 1.0, "pending", None, T[0]))).collect()}
    assert got == {"pending": 1, "approved": 0, "rejected": 0, "flagged": 0, "total": 1}


def test_listing_and_export(spark, tmp_path):
    co = spark.createDataFrame([(1, "B", "b"), (2, "A", "a")], "id long, name string, ticker string")
    src = spark.createDataFrame([(5, "u", "t")], "id long, url string, title string")
    recs = records(spark, (1, 1, 2020, 1.0, "pending", None, T[0]), (2, 2, 2021, None, "pending", None, T[0]), (3, 9, 2021, None, "pending", None, T[0]))
    assert {r["id"]: r["url"] for r in review.listing(recs, co, src).collect()} == {1: None, 2: None}
    io.write_csv(review.overview(recs, co), str(tmp_path / "x"), single_file=True)
    back = spark.read.option("header", True).csv(str(tmp_path / "x"))
    assert back.columns == io.EXPORT_COLUMNS and [r["Company"] for r in back.collect()] == ["A", "B"]


def test_append_records(spark, tmp_path):
    recs = records(spark, (1, 1, 2020, 1.0, "pending", None, T[0]))
    for _ in range(2):
        io.append_records(recs, str(tmp_path / "r"))
    assert io.read_parquet(spark, str(tmp_path / "r"), schemas.RECORDS).count() == 2


def test_account(spark):
    df = spark.createDataFrame([(2, "B", "x"), (1, "A", "y"), (3, "C", None)], "ord long, name string, error string")
    r = runs.account(df).first()
    assert tuple(r) == (3, 1, 2, 0, "completed", "A: y\nB: x")
    assert runs.account(df.where("error is null")).first()["error_log"] is None


def test_latest_run(spark):
    df = spark.createDataFrame([(1, T[0]), (2, T[2]), (3, T[1])], "id long, started_at timestamp_ntz")
    assert review.latest_run(df).first()["id"] == 2


def test_latest_run_of_equal_starts(spark):
    df = spark.createDataFrame([(1, T[2], 5), (2, T[2], 9), (3, T[2], 7), (4, T[1], 10)], "id long, started_at timestamp_ntz, key long")
    assert review.latest_run(df, "key").first()["id"] == 2


def test_latest_run_is_taken_from_all_orders(spark, tmp_path, monkeypatch):
    from carbonsieve.plans import catalog

    rows = [(1, 10, datetime(1998, 3, 1)), (2, 20, datetime(1998, 8, 2)), (3, 30, datetime(1998, 8, 2)), (4, 40, datetime(1995, 1, 1))]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    seen, whole = [], review.latest_run
    monkeypatch.setattr(review, "latest_run", lambda df, *ties: seen.append(df.count()) or whole(df, *ties))
    assert [r["id"] for r in catalog.queries()["latest_run"](spark, str(tmp_path)).collect()] == [30]
    assert seen == [4]
