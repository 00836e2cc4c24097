from datetime import datetime

import pytest
from pyspark.sql import functions as F

from carbonsieve.operators import checks

SCHEMA = (
    "id long, company_id long, reporting_year int, scope_1 double, scope_2_location double, scope_2_market double, scope_3 double, unit string, "
    "confidence_score int, review_status string, flag_reason string, extraction_date timestamp_ntz"
)
DAY = datetime(2024, 1, 1)


def rec(i=1, company=None, year=2020, s1=1.0, s2l=1.0, s2m=1.0, s3=1.0, unit="tonnes CO2e", conf=90, status="pending", flag=None):
    return (i, i if company is None else company, year, s1, s2l, s2m, s3, unit, conf, status, flag, DAY)


def run(spark, *rows):
    out = checks.run_all_checks(spark.createDataFrame(list(rows), SCHEMA), 2024)
    return {r["id"]: (r["review_status"], r["flag_reason"]) for r in out.collect()}


CASES = [
    (rec(s1=-5.0), "Scope 1 is negative (-5.0)"),
    (rec(s1=-10000000.0), "Scope 1 is negative (-10000000.0)"),
    (rec(s1=5e8), None),
    (rec(s1=6e8, year=1999), "Scope 1 implausibly high (600,000,000); Reporting year out of range (1999)"),
    (rec(year=2025), "Reporting year out of range (2025)"),
    (rec(unit="KT CO2e"), "Unit is 'KT CO2e' — values may not be in tonnes CO2e"),
    (rec(conf=49), "Low confidence score (49/100)"),
    (rec(conf=50), None),
    (rec(conf=None), None),
    (rec(s1=None, s2l=None, s2m=5.0, s3=None), "Missing: Scope 1, Scope 3"),
    (rec(s2l=None, s2m=None), "Missing: Scope 2"),
    (rec(s1=-1.0, conf=10, s3=None), "Scope 1 is negative (-1.0)"),
    (rec(conf=10, flag="old"), "old; Low confidence score (10/100)"),
    (rec(s1=-1.0, status="approved"), None),
    (rec(s1=float("nan")), None),
]


def test_single_records(spark):
    rows = [(n + 1, n + 1, *row[2:]) for n, (row, _) in enumerate(CASES)]
    got = run(spark, *rows)
    for n, (row, reason) in enumerate(CASES):
        assert got[n + 1] == (("flagged", reason) if reason else (row[9], row[10])), row


@pytest.mark.parametrize(
    ("before", "after", "reason"),
    [
        ((2020, 100.0), (2021, 151.0), "Scope 1: 51% increase vs 2020 (100 -> 151)"),
        ((2020, 100.0), (2021, 150.0), None),
        ((2020, 100.0), (2021, 0.0), None),
        ((2020, 0.0), (2021, 100.0), None),
        ((2019, 100.0), (2021, 300.0), None),
        ((2020, 100.0), (2021, None), "Missing: Scope 1"),
        ((2020, 1000.0), (2021, 400.0), "Scope 1: 60% decrease vs 2020 (1,000 -> 400)"),
    ],
)
def test_year_on_year(spark, before, after, reason):
    got = run(spark, rec(1, 7, before[0], s1=before[1]), rec(2, 7, after[0], s1=after[1]))
    assert got[2][1] == reason


def test_approved_records_are_flagged_by_changes_and_again_on_a_second_run(spark):
    df = spark.createDataFrame([rec(1, 7, 2020, s1=100.0), rec(2, 7, 2021, s1=300.0, status="approved")], SCHEMA)
    once = checks.run_all_checks(df, 2024)
    text = "Scope 1: 200% increase vs 2020 (100 -> 300)"
    assert {r["id"]: r["flag_reason"] for r in once.collect()}[2] == text
    assert {r["id"]: r["flag_reason"] for r in checks.run_all_checks(once, 2024).collect()}[2] == f"{text}; {text}"


def test_fused_equals_five_passes(spark):
    import random

    rng = random.Random(3)
    pick = lambda *x: rng.choice(x)
    rows = [
        (i, i % 9, 1998 + rng.randrange(30), pick(None, -1.0, 10.0, 100.0, 6e8), pick(None, 5.0, 50.0), pick(None, 1.0), pick(None, 3e9, 7.0), pick("kt", "tonnes CO2e", None), pick(None, 10, 90), pick("pending", "approved", "flagged"), pick(None, "", "x"), DAY)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    step = checks.single_check(df, checks.range_reason(2024))
    step = checks.single_check(step, checks.unit_reason())
    step = checks.yoy_check(step)
    step = checks.single_check(step, checks.confidence_reason())
    step = checks.single_check(step, checks.missing_reason())
    cols = ["id", "review_status", "flag_reason"]
    fused = checks.run_all_checks(df, 2024)
    assert sorted(map(str, fused.select(cols).collect())) == sorted(map(str, step.select(cols).collect()))
    counts = checks.check_counts(df, 2024).first()
    done = fused.groupBy("review_status").count().collect()
    assert counts["flagged"] == {r[0]: r[1] for r in done}["flagged"]
    assert counts["pending"] == {r[0]: r[1] for r in done}.get("pending", 0)


def test_suite_has_one_exchange(spark):
    df = spark.createDataFrame([rec()], SCHEMA).repartition(3)
    base = df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    plan = checks.run_all_checks(df, 2024).select(F.col("id"), "flag_reason")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") - base <= 1
