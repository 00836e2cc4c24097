"""Listings for reviewers, prior years, counts, and folding reviewers' actions back in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t

STATUSES = ["pending", "approved", "rejected", "flagged"]
SCOPE_LABELS = {"scope_1": "Scope 1", "scope_2_location": "Scope 2 (location)", "scope_2_market": "Scope 2 (market)", "scope_3": "Scope 3"}


def with_status(records: DataFrame, status: str | None) -> DataFrame:
    return records if status in (None, "All") else records.where(F.col("review_status") == status)


def listing(records: DataFrame, companies: DataFrame, sources: DataFrame) -> DataFrame:
    """Records with their company and, where there is one, their source."""
    co = companies.select(F.col("id").alias("_cid"), F.col("name").alias("company"), "ticker")
    src = sources.select(F.col("id").alias("_sid"), "url", "title")
    return records.join(co, F.col("company_id") == F.col("_cid")).join(src, F.col("source_id") == F.col("_sid"), "left").drop("_cid", "_sid")


def overview(records: DataFrame, companies: DataFrame) -> DataFrame:
    """The columns of the overview, with the record's id for a fixed order."""
    co = companies.select(F.col("id").alias("_cid"), F.col("name").alias("company"))
    both = records.join(co, F.col("company_id") == F.col("_cid"))
    return both.select("id", "company", "reporting_year", "scope_1", "scope_2_location", "scope_3", "confidence_score", "review_status")


def in_listing_order(df: DataFrame) -> DataFrame:
    return df.orderBy("company", "reporting_year", "id")


def prior_years(records: DataFrame, most: int = 3) -> DataFrame:
    """Adds ``prior``: the company's last records of strictly earlier years, oldest first, in the
    fixed order (year, extraction date, id).

    Only the last records of each year can be among them, so a company's years are cut to those
    first, and of earlier years as many as there are records to find are looked at."""
    entry = F.struct("reporting_year", "extraction_date", "id", "scope_1", "scope_2_location", "scope_3").alias("entry")
    latest = Window.partitionBy("company_id", "reporting_year").orderBy(F.col("extraction_date").desc(), F.col("id").desc())
    top = records.where("company_id is not null and reporting_year is not null").withColumn("_n", F.row_number().over(latest)).where(F.col("_n") <= most)
    years = top.groupBy("company_id", "reporting_year").agg(F.collect_list(entry).alias("entries"))
    before = Window.partitionBy("company_id").orderBy("reporting_year").rowsBetween(-most, -1)
    history = F.array_sort(F.flatten(F.collect_list("entries").over(before)))
    last = F.slice(history, F.greatest(F.size(history) - most + 1, F.lit(1)), most)
    found = years.select(F.col("company_id").alias("_c"), F.col("reporting_year").alias("_y"), last.alias("prior"))
    both = records.join(found, (F.col("company_id") == F.col("_c")) & (F.col("reporting_year") == F.col("_y")), "left").drop("_c", "_y")
    return both.withColumn("prior", F.coalesce("prior", F.array().cast(found.schema["prior"].dataType)))


def prior_display(records: DataFrame) -> DataFrame:
    """The prior records one to a row, (id, prior_id, prior_year and numbers as they are shown
    in the list of prior years, where a zero counts as missing)."""
    rows = records.select("id", F.explode("prior").alias("p"))
    shown = [t.shown_prior(F.col(f"p.{c}")).alias(f"{c}_text") for c in ("scope_1", "scope_2_location", "scope_3")]
    return rows.select("id", F.col("p.id").alias("prior_id"), F.col("p.reporting_year").alias("prior_year"), *shown)


def with_prior_shown(records: DataFrame) -> DataFrame:
    """``prior`` with its numbers as the list of prior years shows them."""
    texts = lambda p: [t.shown_prior(p[c]).alias(f"{c}_text") for c in ("scope_1", "scope_2_location", "scope_3")]
    return records.withColumn("prior", F.transform("prior", lambda p: F.struct(p["id"].alias("id"), p["reporting_year"].alias("reporting_year"), *texts(p))))


def display(records: DataFrame) -> DataFrame:
    """Numbers and bands as they are shown."""
    shown = {f"{c}_text": t.shown(F.col(c)) for c in SCOPE_LABELS}
    return records.withColumns(shown | {"confidence_band": t.confidence_band(F.col("confidence_score"))})


def company_display(companies: DataFrame) -> DataFrame:
    return companies.select(
        "id",
        "name",
        t.lei_band(F.col("lei"), F.col("lei_confidence")).alias("lei_band"),
        t.or_default(F.col("lei_confidence"), "unknown").alias("lei_tier"),
        t.or_default(F.col("lei_legal_name"), t.UNKNOWN).alias("legal_name_text"),
        t.or_default(F.col("lei_country"), t.UNKNOWN).alias("country_text"),
        t.or_default(F.col("lei_review_status"), "pending").alias("lei_status"),
    )


def scopes_long(records: DataFrame) -> DataFrame:
    """id, scope, value, unit: four rows per record."""
    unit = t.or_default(F.col("unit"), t.UNKNOWN)
    wide = records.select("id", unit.alias("unit"), *[F.col(c).alias(label) for c, label in SCOPE_LABELS.items()])
    return wide.unpivot(["id", "unit"], list(SCOPE_LABELS.values()), "scope", "value").select("id", "scope", "value", "unit")


def status_counts(records: DataFrame) -> DataFrame:
    """status, n for every status, none left out, and the total."""
    counted = records.groupBy("review_status").agg(F.count("*").alias("n"))
    names = records.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    each = names.join(counted, F.col("status") == F.col("review_status"), "left").select("status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return each.unionByName(counted.agg(F.lit("total").alias("status"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")))


def status_report(companies: DataFrame, records: DataFrame) -> DataFrame:
    """One row of totals, from one pass over either table."""
    r = records.agg(F.count("*").alias("n_records"), *[F.count_if(F.col("review_status") == s).alias(s) for s in ("pending", "flagged", "approved")])
    c = companies.agg(F.count("*").alias("n_companies"))
    return c.withColumn("_one", F.lit(1)).join(r.withColumn("_one", F.lit(1)), "_one").drop("_one")


def fold_decisions(decisions: DataFrame) -> DataFrame:
    """All actions on a record as one row: an aggregation, one shuffle by record.

    The last approve, reject or flag sets the status, the last approve or reject the reviewer's
    time; the last edit sets the scopes, and the notes of all edits stay in order."""
    when = F.struct("decided_at", "decision_id")
    status = F.element_at(F.create_map(*[F.lit(x) for kv in {"approve": "approved", "reject": "rejected", "flag": "flagged"}.items() for x in kv]), F.col("action"))
    decided = F.col("action").isin("approve", "reject")
    edit = F.col("action") == "edit"
    new = F.struct("new_scope_1", "new_scope_2_location", "new_scope_2_market", "new_scope_3")
    noted = edit & (F.coalesce("note", F.lit("")) != "")
    return decisions.groupBy("record_id").agg(
        F.max_by(F.when(~edit, status), F.when(~edit, when)).alias("new_status"),
        F.max(F.when(decided, when)).alias("_decided"),
        F.max_by(F.when(edit, new), F.when(edit, when)).alias("new_scopes"),
        F.array_sort(F.collect_list(F.when(noted, F.struct("decided_at", "decision_id", "note")))).alias("_notes"),
    ).select(
        "record_id", "new_status", F.col("_decided.decided_at").alias("decided_at"), "new_scopes", F.array_join(F.transform("_notes", lambda n: F.concat(F.lit("; Review note: "), n["note"])), "").alias("notes")
    )


def apply_decisions(records: DataFrame, decisions: DataFrame, reviewer: str = "reviewer") -> DataFrame:
    """Records after all actions. Scopes that are not above zero become null on an edit."""
    d = fold_decisions(decisions)
    both = records.join(d, F.col("id") == F.col("record_id"), "left")
    scopes = {}
    for c in SCOPE_LABELS:
        new = F.col(f"new_scopes.new_{c}")
        scopes[c] = F.when(F.col("new_scopes").isNotNull(), F.when(new > 0, new)).otherwise(F.col(c))
    noted = F.coalesce("notes", F.lit("")) != ""
    decided = F.col("decided_at").isNotNull()
    return both.withColumns(
        scopes
        | {
            "review_status": F.coalesce("new_status", "review_status"),
            "reviewed_by": F.when(decided, reviewer).otherwise(F.col("reviewed_by")),
            "reviewed_at": F.when(decided, F.col("decided_at")).otherwise(F.col("reviewed_at")),
            "flag_reason": F.when(noted, F.concat(F.coalesce("flag_reason", F.lit("")), F.col("notes"))).otherwise(F.col("flag_reason")),
        }
    ).select(*records.columns)


def latest_run(runs: DataFrame, *ties: str) -> DataFrame:
    """The run that started last; of equal starts the one with the largest ``ties``."""
    return runs.orderBy(F.col("started_at").desc_nulls_first(), *[F.col(c).desc() for c in ties]).limit(1)
