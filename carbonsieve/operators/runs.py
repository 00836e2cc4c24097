"""Accounting of extraction runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcomes(companies: DataFrame, records: DataFrame, errors: DataFrame) -> DataFrame:
    """Per company: status, records saved, source_url, confidence and error. ``records`` has
    company_id, source_url and confidence_score; ``errors`` company_id and error."""
    saved = records.groupBy("company_id").agg(F.count("*").alias("records"), F.max("source_url").alias("source_url"), F.max("confidence_score").alias("confidence"))
    bad = errors.groupBy("company_id").agg(F.min("error").alias("error"))
    rows = companies.select(F.col("id").alias("company_id"), "name").join(saved, "company_id", "left").join(bad, "company_id", "left")
    return rows.withColumns({"status": F.when(F.col("error").isNull(), "success").otherwise("failed"), "records": F.coalesce("records", F.lit(0))})


def failures(results: DataFrame) -> DataFrame:
    """The log as rows (ord, line) in processing order: for runs whose log is too long for a cell."""
    return results.where("error is not null").select("ord", F.concat("name", F.lit(": "), "error").alias("line")).orderBy("ord")


def account(results: DataFrame) -> DataFrame:
    """One row from (ord, name, error): totals and the log of errors in processing order. Only
    failures are collected into the log, which is the feature."""
    failed = F.col("error").isNotNull()
    line = F.struct("ord", F.concat("name", F.lit(": "), "error").alias("line"))
    log = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(failed, line))), lambda x: x["line"]), "\n")
    return results.agg(
        F.count("*").alias("total_companies"),
        F.count_if(~failed).alias("successful"),
        F.count_if(failed).alias("failed"),
        F.lit(0).cast("long").alias("skipped"),
        F.lit("completed").alias("status"),
        F.nullif(log, F.lit("")).alias("error_log"),
    )
