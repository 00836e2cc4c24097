"""Registered queries of stored tables: ids, unique keys, updates in place, layout, generations
of files, and documents that cannot be read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import checks, entities, review, tables
from ..sources import keys, schemas
from ..sources import tables as io
from ..sources.staging import read_or_empty, staged, staging_path
from ..streaming import rowlevel
from . import jobs
from .catalog import SQL, SQL_GIVEN, YEAR, _records, query
from .fixtures import frame

def same_as(name: str, other: str):
    """Registers a query that gives the rows of another one, so their SQL is the same."""

    def add(f):
        query(name)(f)
        SQL[name] = SQL[other]
        return f

    return add


def _full_records(spark, d):
    rows = _records(spark, d)
    return schemas.conform(rows, schemas.RECORDS, schemas.DEFAULTS["records"])


@query(
    "numbered_companies",
    SQL_GIVEN
    + """, m as (select * from best where confidence<>'rejected'), co as (select id, name from fx_seed where id%3=0), seed as (select s.id, s.name from fx_seed s left join co on co.name=s.name where co.id is null),
nw as (select (select max(id) from co) + row_number() over (order by seed.name) as id, seed.name, m.lei, m.confidence from seed left join m on m.company_id=seed.id)
select id, name, null::varchar as lei, 'pending' as lei_review_status, 'INDEX' as index_membership from co
union all select id, name, lei, case when confidence='high' then 'approved' else 'pending' end, 'INDEX' from nw""",
)
def numbered_companies(spark, d):
    """J1 with keys: a third of the seed is stored; the others are numbered after it, by name."""
    seed = frame(spark, d, "fx_seed")
    stored = seed.where("id % 3 = 0")
    fresh = keys.numbered(entities.unseen(seed, stored).withColumnRenamed("id", "seed_id"), ["name"], keys.last_id(stored))
    given = entities.resolve(frame(spark, d, "fx_candidates"))
    ids = fresh.select("id", F.col("seed_id").alias("company_id"))
    matches = given.join(ids, "company_id").drop("company_id").withColumnRenamed("id", "company_id")
    added = entities.new_companies(fresh.select("id", "name"), stored.select("id", "name"), matches, "INDEX")
    old = schemas.with_missing_columns(stored.select("id", "name"), schemas.COMPANIES, schemas.DEFAULTS["companies"]).withColumn("index_membership", F.lit("INDEX"))
    columns = ["id", "name", "lei", "lei_review_status", "index_membership"]
    return old.select(*columns).unionByName(added.select(*columns))


@query(
    "appended_once",
    """with f as (select * from fx_records qualify row_number() over (partition by company_id, reporting_year, extraction_date order by id)=1)
select company_id, reporting_year, extraction_date, scope_1, row_number() over (order by id%3=0, company_id, extraction_date, reporting_year) as id from f""",
)
def appended_once(spark, d):
    """S3 with the unique key: two batches that overlap, the first of them written twice. The keys of
    both are those of all records, each once, with ids in the order of writing."""
    path = staging_path(spark, "appended")
    first = keys.unseen_rows(_full_records(spark, d), _full_records(spark, d).limit(0), keys.RECORD_KEY, ["id"])
    rows = staged(first, "batches")
    some = rows.where("id % 3 <> 0")
    for batch in (some, some, rows):
        keys.append_new(batch, path, schemas.RECORDS, keys.RECORD_KEY, ["company_id", "extraction_date", "reporting_year"], partition="reporting_year")
    return read_or_empty(spark, path, schemas.RECORDS).select("company_id", "reporting_year", "extraction_date", "scope_1", "id")


@same_as("decisions_in_place", "review_decisions")
def decisions_in_place(spark, d):
    """R1-R3 on stored records, one folder a year: only the years with decided records are written."""
    at = jobs.Tables.under(staging_path(spark, "decided"))
    _full_records(spark, d).write.partitionBy("reporting_year").parquet(at.records)
    jobs.decide(at, frame(spark, d, "fx_decisions"))
    return read_or_empty(spark, at.records, schemas.RECORDS).select("id", *review.SCOPE_LABELS, "review_status", "reviewed_by", "reviewed_at", "flag_reason")


@same_as("check_counts_observed", "check_counts")
def check_counts_observed(spark, d):
    """Q6 and A3: the checked snapshot is written, and its counts come from that very pass."""
    checked, counts = jobs.observed_checks(_records(spark, d), YEAR)
    checked.write.parquet(staging_path(spark, "checked"))
    columns = ["range_flags", "unit_flags", "yoy_flags", "confidence_flags", "missing_flags", "flagged", "pending"]
    return spark.createDataFrame([tuple(counts.get[c] for c in columns)], ", ".join(f"{c} long" for c in columns))


@same_as("check_suite_by_company", "check_suite")
def check_suite_by_company(spark, d):
    """W1 and Q6 on records laid out by company: the suite shuffles nothing."""
    name = f"records_{uuid.uuid4().hex[:12]}"
    io.write_by_company(_records(spark, d), name, staging_path(spark, "by-company"), buckets=16)
    return checks.run_all_checks(spark.table(name), YEAR).select("id", "company_id", "reporting_year", "review_status", "flag_reason")


@query(
    "file_generations",
    "select id, scope_1, case when id%2=0 then 'tonnes CO2e' else unit end as unit, case when id%2=0 then 'pending' else review_status end as review_status, case when id%2=0 then null else confidence_score end as confidence_score, case when id%2=0 then false else id%3=0 end as is_restated from fx_records",
)
def file_generations(spark, d):
    """S9 on files: half of the records lie in files from before four columns were added; nulls that
    the newer files hold stay."""
    rows, path = _records(spark, d), staging_path(spark, "generations")
    rows.where("id % 2 = 0").select("id", "scope_1").write.parquet(f"{path}/old")
    rows.where("id % 2 = 1").select("id", "scope_1", "unit", "review_status", "confidence_score", (F.col("id") % 3 == 0).alias("is_restated")).write.parquet(f"{path}/new")
    back = io.read_generations(spark, f"{path}/*", schemas.RECORDS, schemas.DEFAULTS["records"])
    return back.select("id", "scope_1", "unit", "review_status", "confidence_score", "is_restated")


@query(
    "unreadable_pages",
    "select page_id, 'Page cannot be parsed: unknown status keyword ''foo'' in marked section' as error from pages where page_id%5=1",
)
def unreadable_pages(spark, d):
    """A fifth of the pages holds what the parser refuses; each gives one error row."""
    return tables.unreadable(_odd_pages(spark, d))


@query(
    "tables_beside_unreadable_pages",
    "select page_id, 0 as table_index, '| url | odd |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || url || ' | x |' as markdown from pages where page_id%5<>1",
)
def tables_beside_unreadable_pages(spark, d):
    """The other pages give their tables, of which the first is checked."""
    return tables.html_tables(_odd_pages(spark, d)).where("table_index = 0")


@same_as("streamed_page_tables", "tables_beside_unreadable_pages")
def streamed_page_tables(spark, d):
    """E3 on a stream: the same pages as they come, each batch written once."""
    pages, arriving = spark.read.parquet(f"{d}/pages.parquet"), staging_path(spark, "arriving")
    out, marks = staging_path(spark, "streamed"), staging_path(spark, "streamed-marks")
    pages.repartition(6).write.parquet(arriving)
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    rowlevel.write_once(_odd(stream), out, marks, tables.html_tables, available_now=True).awaitTermination()
    return spark.read.parquet(out).drop("batch").where("table_index = 0")


@query("seed_read", "select c_name as name, case when c_custkey%3=0 then null else 'T' || c_custkey end as ticker from customer")
def seed_read(spark, d):
    """A seed list as CSV, with empty fields, read back."""
    c, path = spark.read.parquet(f"{d}/customer.parquet"), staging_path(spark, "seed")
    ticker = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("T"), F.col("c_custkey").cast("string")))
    c.select(F.col("c_name").alias("name"), ticker.alias("ticker")).write.option("header", True).csv(path)
    return io.read_seed(spark, path)


def _odd_pages(spark, d):
    """The pages, each with a table of its address before its own html, a fifth with a marked section
    that no parser knows."""
    return _odd(spark.read.parquet(f"{d}/pages.parquet"))


def _odd(p):
    head = F.concat(F.lit("<table><tr><th>url</th><th>odd</th></tr><tr><td>"), F.col("url"), F.lit("</td><td>x</td></tr></table>"))
    odd = F.when(F.col("page_id") % 5 == 1, "<![foo[x]]>").when(F.col("page_id") % 5 == 2, "<![CDATA[x]]>").otherwise("")
    return p.select("page_id", F.concat(head, odd, F.col("html")).alias("html"))
