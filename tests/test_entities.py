import random
import re

from carbonsieve.functions import text as t
from carbonsieve.operators import entities
from carbonsieve.sources import schemas


def cands(spark, *rows):
    return spark.createDataFrame([(1, "Severn Trent", q, p, lei, name, c) for q, p, lei, name, c in rows], schemas.CANDIDATES)


def best(spark, *rows):
    r = entities.resolve(cands(spark, *rows)).collect()
    return (r[0]["lei"], r[0]["confidence"], r[0]["flag_reason"]) if r else None


def test_tiers(spark):
    assert best(spark, (0, 0, "A", "Severn Trent Plc", "GB")) == ("A", "high", None)
    assert best(spark, (0, 0, "A", "Severn River Trust Fund", "GB")) == ("A", "low", "Low name similarity (25%): searched 'Severn Trent', found 'Severn River Trust Fund'")
    assert best(spark, (0, 0, "A", "Severn River Crossing", "GB")) == ("A", "medium", "Low name similarity (33%): searched 'Severn Trent', found 'Severn River Crossing'")
    assert best(spark, (0, 0, "A", "Severn Trent", "US")) is None
    assert best(spark, (0, 0, "A", "Severn Trent", "US"), (0, 1, "B", "Zeta", "GB"))[:2] == ("B", "low")
    assert best(spark) is None


def test_ties_go_to_the_first_seen(spark):
    assert best(spark, (1, 0, "B", "Severn Trent", "GB"), (0, 1, "A", "Severn Trent", "GB"))[0] == "A"


def test_first_per_lei_is_idempotent_and_joins_nulls(spark):
    df = cands(spark, (0, 0, None, "x", "GB"), (1, 0, None, "y", "GB"), (0, 1, "A", "z", "GB"), (1, 1, "A", "z", "GB"))
    once = entities.first_per_lei(df)
    assert sorted((r["lei"] or "", r["query_no"]) for r in once.collect()) == [("", 0), ("A", 0)]
    assert entities.first_per_lei(once).count() == 2


def test_rejected_reason_names_the_country(spark):
    r = entities.scored(cands(spark, (0, 0, "A", "Severn Trent", "US"))).first()
    assert r["confidence"] == "rejected" and r["flag_reason"] == "Country 'US' not in expected list for FTSE 100"


def test_flatten_registry(spark):
    docs = [
        '{"id":"L1","attributes":{"entity":{"legalName":{"name":"N"},"legalAddress":{"country":"GB"},"headquartersAddress":{"country":"FR"}}},"more":1}',
        '{"id":"L2","attributes":{"entity":{"legalAddress":{"country":""},"headquartersAddress":{"country":"FR"}}}}',
        "{",
    ]
    got = entities.flatten_registry(spark.createDataFrame([(d,) for d in docs], "record string")).collect()
    assert [tuple(r) for r in got] == [("L1", "N", "GB"), ("L2", "", "FR"), (None, "", "")]


def test_unseen_keeps_repeats_of_the_seed(spark):
    seed = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B")], schemas.SEED)
    assert entities.unseen(seed, spark.createDataFrame([("b",)], "name string")).count() == 2


def test_backfill_fills_only_gaps(spark):
    companies = schemas.conform(spark.createDataFrame([(1, "Severn Trent", None), (2, "BP", "OLD"), (3, "Q", None)], "id long, name string, lei string"), schemas.COMPANIES, schemas.DEFAULTS["companies"])
    matches = entities.resolve(cands(spark, (0, 0, "A", "Severn Trent Plc", "GB")))
    got = {r["id"]: (r["lei"], r["lei_confidence"], r["lei_review_status"]) for r in entities.backfill(companies, matches).collect()}
    assert got == {1: ("A", "high", "approved"), 2: ("OLD", None, "pending"), 3: (None, None, "pending")}


def test_registry_mode_has_no_cartesian_product(spark):
    reg = spark.createDataFrame([("L1", "Severn Trent Plc", "GB", "ACTIVE"), ("L0", "Severn Trent", "GB", "INACTIVE")], schemas.REGISTRY)
    out = entities.resolve_by_registry(spark.createDataFrame([(1, "Severn Trent")], "id long, name string"), reg)
    assert "Cartesian" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r["lei"] for r in out.collect()] == ["L1"]


def plain_best(names, entities_of):
    """Per name the greatest share of common words over all entities, and the lowest LEI that has it."""
    words = lambda n: {w for w in re.findall("[a-z0-9]+", n.lower()) if len(w) > 1 and w not in t.STOP_WORDS}
    out = {}
    for i, n in names:
        mine = words(n)
        rated = [(-len(mine & words(x)) / max(len(mine), len(words(x))), lei) for lei, x in entities_of if mine & words(x)]
        if rated:
            out[i] = min(rated)[1]
    return out


def test_coded_names_give_what_all_pairs_give(spark):
    """Random names of frequent and rare words, some unknown to the registry, in all tiers; the index
    is also built in two deliveries."""
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(60)] + ["north"] * 9 + ["steel"] * 5 + ["group", "plc", "x"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    names = [(i, say(rng.randrange(0, 7)) + rng.choice(["", " only-here"])) for i in range(150)]
    given = [(f"L{k:04d}", say(rng.randrange(0, 9))) for k in range(400)]
    companies = spark.createDataFrame(names, "id long, name string")
    registry = spark.createDataFrame([(lei, n, "GB", "ACTIVE") for lei, n in given], schemas.REGISTRY)
    want = plain_best(names, given)
    found = entities.resolve_by_registry(companies, registry).collect()
    assert {r["company_id"]: r["lei"] for r in found} == want and len(found) == len(want)
    tiers = {r["confidence"] for r in found}
    assert tiers == {"high", "medium", "low"}
    index = entities.name_index(registry.where("lei < 'L0300'")).extended(registry.where("lei >= 'L0300'"))
    assert {r["company_id"]: r["lei"] for r in entities.resolve_by_registry(companies, registry, index).collect()} == want
    assert index.words.groupBy("code").count().where("count > 1").count() == 0
    assert entities.resolve_by_registry(companies.limit(0), registry).count() == 0 == entities.resolve_by_registry(companies, registry.limit(0)).count()


def test_key_violations_ignore_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "lei string")
    assert [tuple(r) for r in schemas.key_violations(df, ["lei"]).collect()] == [("a", 2)]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id long, name string")
    out = schemas.with_missing_columns(df, schemas.COMPANIES, schemas.DEFAULTS["companies"])
    assert out.first()["lei_review_status"] == "pending" and set(out.columns) == set(schemas.COMPANIES.names)
    assert schemas.conform(df, schemas.COMPANIES).schema.names == schemas.COMPANIES.names
