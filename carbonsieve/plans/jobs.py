"""The workloads end to end, each from tables to tables.

``python -m carbonsieve.plans.jobs check --records IN --out OUT --year 2024`` and the like, for
spark-submit. Snapshots are written to a new path, never over their input.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import report_key
from ..operators import checks, entities, extract, review, runs, tables
from ..sources import keys, schemas
from ..sources import tables as io
from ..sources.staging import read_or_empty, staged


def check_records(records: DataFrame, year: int) -> DataFrame:
    return checks.run_all_checks(records, year)


def resolve_companies(companies: DataFrame, candidates: DataFrame | None = None, registry: DataFrame | None = None) -> DataFrame:
    """Fills LEIs from given candidates, or else from a whole registry."""
    open_ones = entities.lacking_lei(companies).select("id", "name")
    matches = entities.resolve(candidates) if candidates is not None else entities.resolve_by_registry(open_ones, registry)
    return entities.backfill(companies, matches)


@dataclass
class Extraction:
    """What a run of the extraction gives."""

    sources: DataFrame
    records: DataFrame
    outcomes: DataFrame


def parsed_tables(pages: DataFrame, html: DataFrame, cells: DataFrame) -> DataFrame:
    """Tables of all kinds of documents as doc_id, table_index, markdown."""
    sheets = tables.sheet_tables(cells).select("doc_id", F.col("sheet_no").alias("table_index"), "markdown")
    web = tables.html_tables(html).select(F.col("page_id").alias("doc_id"), "table_index", "markdown")
    return tables.markdown_tables(pages).unionByName(web).unionByName(sheets)


def extract_records(companies: DataFrame, results: DataFrame, found: DataFrame, rank_responses: DataFrame, responses: DataFrame, failures: DataFrame | None = None) -> Extraction:
    """From search results, tables and the model's responses to sources, records and outcomes.
    A company's document has the company's id. Only keys go through the ranking. ``failures``
    (doc_id, error) are documents that could not be read: they have no tables, and their error
    stands in the outcome unless records were found all the same."""
    best = extract.chosen_source(results)
    named = companies.select(F.col("id").alias("company_id"), "name")
    documents = best.join(named, "company_id").select(F.col("company_id").alias("doc_id"), "company_id", "name", "url", "title", "source_type")
    top = extract.pick_tables(extract.top_tables(extract.rankings(rank_responses)), extract.table_counts(found))
    parsed = extract.parsed_responses(responses)
    from_tables = extract.first_result(top, parsed)
    both = extract.with_text_fallback(documents, from_tables, parsed.where("table_index is null"))
    if failures is not None:
        unread = failures.groupBy("doc_id").agg(F.min("error").alias("_unread"))
        both = both.join(unread, "doc_id", "left").withColumn("error", F.when(F.col("error").isNotNull(), F.coalesce("_unread", "error"))).drop("_unread")
    done = both.where("error is null")
    records = extract.flatten_results(done.select("company_id", F.col("url").alias("source_url"), "result"), position="position")
    bad = extract.incomplete_results(done).select("company_id", F.lit("a figure has no reporting year").alias("error"))
    errors = extract.source_errors(companies, results).select("company_id", "error").unionByName(both.where("error is not null").select("company_id", "error")).unionByName(bad)
    key = F.when(F.col("source_type") == "pdf", report_key(F.col("name")))
    sources = done.where(extract.complete(F.col("result"))).select("company_id", "url", "title", F.col("source_type").alias("document_type"), key.alias("s3_pdf_key"))
    return Extraction(sources, records, runs.outcomes(companies, records, errors))


@dataclass
class Tables:
    """Where the stored tables are."""

    companies: str
    sources: str
    records: str
    runs: str

    @classmethod
    def under(cls, folder: str) -> Tables:
        return cls(*[f"{folder.rstrip('/')}/{x}" for x in ("companies", "sources", "records", "runs")])


def save_extraction(out: Extraction, at: Tables, started: datetime, completed: datetime | None = None) -> dict[str, int]:
    """Stores what a run found: sources and records with ids, records with the id of their source,
    and the account of the run. The run's start names it: saving the run again adds nothing.

    The figures of a response are taken a microsecond apart, as the key of a record (company,
    year, time of extraction) tells them apart by that."""
    spark = out.records.sparkSession
    fetched = F.lit(started).cast("timestamp_ntz")
    sources = schemas.conform(out.sources.withColumn("fetched_at", fetched), schemas.SOURCES)
    keys.append_new(sources, at.sources, schemas.SOURCES, ["company_id", "url", "fetched_at"], ["company_id", "url"])
    stored = read_or_empty(spark, at.sources, schemas.SOURCES).where(F.col("fetched_at") == fetched)
    of_run = stored.select("company_id", F.col("id").alias("source_id"))
    taken = (fetched.cast("timestamp") + F.make_dt_interval(secs=F.col("position").cast("decimal(18,6)") / 1000000)).cast("timestamp_ntz")
    rows = out.records.join(of_run, "company_id").withColumn("extraction_date", taken)
    rows = schemas.conform(rows, schemas.RECORDS, schemas.DEFAULTS["records"])
    saved = keys.append_new(rows, at.records, schemas.RECORDS, keys.RECORD_KEY, ["company_id", "extraction_date", "reporting_year"], partition="reporting_year")
    order = out.outcomes.select(F.col("company_id").alias("ord"), "name", "error")
    account = runs.account(order).withColumns({"started_at": fetched, "completed_at": F.lit(completed or started).cast("timestamp_ntz")})
    for c in ("total_companies", "successful", "failed", "skipped"):
        account = account.withColumn(c, F.col(c).cast("int"))
    keys.append_new(schemas.conform(account, schemas.RUNS, schemas.DEFAULTS["runs"]), at.runs, schemas.RUNS, ["started_at"], ["started_at"])
    totals = account.select("successful", "failed", "skipped").first().asDict()
    return totals | {"records": saved.count()}


def init_companies(seed: DataFrame, at: Tables, index_membership: str, registry: DataFrame | None = None) -> dict[str, int]:
    """Adds the seed's new companies, with ids above those there are, and fills in the LEIs that
    are missing, from a registry if one is given. Companies are a small table of one file set; the
    new state is staged and then takes the place of the old one."""
    spark = seed.sparkSession
    existing = schemas.conform(read_or_empty(spark, at.companies, schemas.COMPANIES), schemas.COMPANIES, schemas.DEFAULTS["companies"])
    n_before = existing.count()
    added = keys.numbered(entities.unseen(seed, existing), ["name", "ticker"], keys.last_id(existing))
    added = added.withColumns({"index_membership": F.lit(index_membership), "created_at": F.localtimestamp()})
    both = staged(existing.unionByName(schemas.conform(added, schemas.COMPANIES, schemas.DEFAULTS["companies"])), "companies")
    filled = resolve_companies(both, registry=registry) if registry is not None else both
    staged(filled, "companies-filled").write.mode("overwrite").parquet(at.companies)
    n = read_or_empty(spark, at.companies, schemas.COMPANIES).agg(F.count("*").alias("n"), F.count("lei").alias("lei")).first()
    return {"added": n["n"] - n_before, "existed": n_before, "with_lei": n["lei"]}


def status(spark: SparkSession, at: Tables) -> dict:
    """Totals of the stored tables and the last run."""
    companies, records = read_or_empty(spark, at.companies, schemas.COMPANIES), read_or_empty(spark, at.records, schemas.RECORDS)
    found = review.status_report(companies, records).first().asDict()
    last = review.latest_run(read_or_empty(spark, at.runs, schemas.RUNS), "id").first()
    return found | {"last_run": {c: last[c] for c in ("started_at", "status", "successful", "failed", "skipped")} if last else None}


def decide(at: Tables, decisions: DataFrame, reviewer: str = "reviewer") -> list[int]:
    """Folds reviewers' actions into the stored records. Only the years in which a decided record
    lies are read in full and written; the folders of all others keep their files. Gives the years."""
    spark = decisions.sparkSession
    records = read_or_empty(spark, at.records, schemas.RECORDS)
    ids = decisions.select(F.col("record_id").alias("id")).distinct()
    years = sorted(r[0] for r in records.select("id", "reporting_year").join(ids, "id", "left_semi").select("reporting_year").distinct().collect())
    if years:
        touched = records.where(F.col("reporting_year").isin(years))
        keys.overwrite_touched(spark, at.records, review.apply_decisions(touched, decisions, reviewer), "reporting_year")
    return years


def review_report(records: DataFrame, companies: DataFrame, sources: DataFrame, status: str | None = None) -> DataFrame:
    """The listing with what reviewers see beside each record: ``prior`` as the list of prior
    years shows it."""
    rows = review.with_prior_shown(review.prior_years(records))
    return review.in_listing_order(review.display(review.listing(review.with_status(rows, status), companies, sources)))


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(dest="job", required=True)

    def job(name: str, needed: list[str], **optional: str | None) -> argparse.ArgumentParser:
        one = sub.add_parser(name)
        for flag in needed:
            one.add_argument(f"--{flag}", required=True)
        for flag, default in optional.items():
            one.add_argument(f"--{flag}", default=default)
        return one

    job("init", ["tables", "seed"], registry=None, index="FTSE100")
    job("extract", ["tables", "documents"], started=None, ids=None)
    job("check", ["records", "out"]).add_argument("--year", type=int, required=True)
    job("status", ["tables"])
    job("decide", ["tables", "decisions"], reviewer="reviewer")
    job("export", ["records", "companies", "out"])
    job("resolve", ["companies", "registry", "out"])
    a = p.parse_args(args)
    spark = SparkSession.builder.appName(f"carbonsieve-{a.job}").getOrCreate()
    if a.job == "init":
        registry = io.read_parquet(spark, a.registry, schemas.REGISTRY) if a.registry else None
        print(json.dumps(init_companies(io.read_seed(spark, a.seed), Tables.under(a.tables), a.index, registry)))
    elif a.job == "extract":
        print(json.dumps(extract_folder(spark, Tables.under(a.tables), a.documents, a.started, a.ids)))
    elif a.job == "status":
        print(json.dumps(status(spark, Tables.under(a.tables)), default=str))
    elif a.job == "decide":
        print(json.dumps({"years": decide(Tables.under(a.tables), io.read_parquet(spark, a.decisions, schemas.DECISIONS), a.reviewer)}))
    elif a.job == "check":
        reasoned, counts = observed_checks(io.read_parquet(spark, a.records, schemas.RECORDS), a.year)
        reasoned.write.parquet(a.out)
        print(json.dumps(counts.get))
    elif a.job == "export":
        io.write_csv(review.overview(io.read_parquet(spark, a.records, schemas.RECORDS), io.read_parquet(spark, a.companies, schemas.COMPANIES)), a.out)
    else:
        companies = io.read_parquet(spark, a.companies, schemas.COMPANIES)
        resolve_companies(companies, registry=io.read_parquet(spark, a.registry, schemas.REGISTRY)).write.parquet(a.out)


def extract_folder(spark: SparkSession, at: Tables, folder: str, started: str | None = None, ids: str | None = None) -> dict[str, int]:
    """A run over a folder of given documents and answers: Parquet tables named search_results,
    doc_pages, html_pages, cells, rank_responses and extract_responses, those without rows left
    out. ``ids``: a Parquet table of the companies to run for (a column id); all without it."""
    read = lambda name, schema: read_or_empty(spark, f"{folder.rstrip('/')}/{name}", schema)
    companies = read_or_empty(spark, at.companies, schemas.COMPANIES)
    if ids:
        companies = extract.chosen_from_table(companies, spark.read.parquet(ids))
    html = read("html_pages", schemas.HTML_PAGES)
    found = staged(parsed_tables(read("doc_pages", schemas.DOC_PAGES), html, read("cells", schemas.CELLS)), "tables")
    unread = tables.unreadable(html).select(F.col("page_id").alias("doc_id"), "error")
    results = extract.chosen_from_table(read("search_results", schemas.SEARCH_RESULTS).withColumnRenamed("company_id", "id"), companies).withColumnRenamed("id", "company_id")
    out = extract_records(companies, results, found, read("rank_responses", schemas.RANK_RESPONSES), read("extract_responses", schemas.EXTRACT_RESPONSES), unread)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return save_extraction(out, at, datetime.fromisoformat(started) if started else now, now)


def observed_checks(records: DataFrame, year: int) -> tuple[DataFrame, Observation]:
    """The checked records and, once they are written, the counts of what the checks found, from
    the same pass over the data."""
    counts = Observation("checks")
    return checks.flag(checks.with_reasons(records, year).observe(counts, *checks.count_columns())), counts


if __name__ == "__main__":
    main()
