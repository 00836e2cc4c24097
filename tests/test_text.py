import random

import pytest
from pyspark.sql import functions as F

from carbonsieve.functions import text as t


def values(spark, data, schema, f):
    return [r[0] for r in spark.createDataFrame([(x,) for x in data], schema).select(f(F.col("x"))).collect()]


def test_clean_name(spark):
    got = values(spark, ["ABF (Associated British Foods)", "Sainsbury's (J)", "BP", " BP ", "A () (B)"], "x string", t.clean_name)
    assert got == ["Associated British Foods", "J", "BP", "BP", "B"]


def test_words_and_similarity(spark):
    got = values(spark, ["Marks & Spencer Group", "St James's Place", "The Group plc", None], "x string", t.significant_words)
    assert [g and sorted(g) for g in got] == [["marks", "spencer"], ["james", "place", "st"], [], None]
    pairs = [("ABF (Associated British Foods)", "ASSOCIATED BRITISH FOODS PLC"), ("The Group plc", "Anything"), ("a b", "c")]
    df = spark.createDataFrame(pairs, "a string, b string")
    sim = [r[0] for r in df.select(t.set_similarity(t.significant_words(F.col("a")), t.significant_words(F.col("b")))).collect()]
    assert sim == [0.75, 0.0, 0.0]


def test_source_type(spark):
    got = values(spark, ["h/A.PDF?x=1", "h/a.xls", "h/a.xlsx", "h/a.pdf#p=2", "h/a", "h/?a.pdf"], "x string", t.source_type)
    assert got == ["pdf", "excel", "excel", "html", "html", "html"]


def test_query_variants(spark):
    assert values(spark, ["X (Y)", "BP"], "x string", t.query_variants) == [["X (Y)", "X (Y) plc", "Y", "Y plc"], ["BP", "BP plc"]]


def test_keys_preview_bands(spark):
    assert values(spark, ["Marks & Co"], "x string", t.report_key) == ["sources/marks_and_co/report.pdf"]
    assert values(spark, ["a" * 600, "a" * 601], "x string", lambda c: F.length(t.preview(c))) == [600, 603]
    assert values(spark, [70, 69, 40, 39, None], "x int", t.confidence_band) == ["green", "yellow", "yellow", "red", None]
    assert values(spark, [0.0, None, 1234.5], "x double", t.shown) == ["0", "—", "1,234"]
    assert values(spark, [0.0, None, 1235.5], "x double", t.shown_prior) == ["—", "—", "1,236"]


@pytest.mark.parametrize("x", [0.125, 0.135, 0.5, 1.005, 2.0, 0.0, 12.345, 1e9])
def test_percent_text(spark, x):
    assert values(spark, [x], "x double", t.percent_text) == [f"{x:.0%}"]


def test_float_text(spark):
    rng = random.Random(4)
    data = [0.0, -5.0, 0.5, 1e6, 9999999.0, 1e7, -10000000.0, 12345678.5, 1e15, 123456789012345.6, 1e16, -1.5e16, 5e-05, 0.0001, 0.00025, 1e-7, 1.5e300, float("inf"), float("nan")]
    data += [round(rng.uniform(-1e9, 1e9), 2) for _ in range(200)]
    assert values(spark, data, "x double", t.float_text) == [str(x) for x in data]
