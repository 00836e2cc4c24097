"""Reading and writing the tables: Parquet, CSV, JDBC and page files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

EXPORT_COLUMNS = ["Company", "Year", "Scope 1", "Scope 2 (loc)", "Scope 3", "Confidence", "Status"]


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The list of companies, a CSV with a header."""
    return spark.read.schema(schemas.SEED).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_generations(spark: SparkSession, path: str, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Parquet files of several generations: a file that lacks a column gives the column's default
    (or null), while nulls that a file holds stay nulls. Types are those of ``schema``.

    The defaults go to the reader with the schema, so each file is read once and filters and
    column selection reach it; no file's footer is looked at beforehand."""
    told = {name: _sql_literal(v) for name, v in (defaults or {}).items()}
    fields = [T.StructField(f.name, f.dataType, f.nullable, {"EXISTS_DEFAULT": told[f.name], "CURRENT_DEFAULT": told[f.name]} if f.name in told else None) for f in schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _sql_literal(value: str | bool | int | float) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower() if isinstance(value, bool) else repr(value)


def write_by_company(records: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Records as a table whose files are dealt out by company: the checks, prior years and
    whatever else looks at a company's records as a whole read it without a shuffle. Rows of a
    bucket meet in one task first, so that every bucket is one file."""
    dealt = records.repartition(buckets, "company_id")
    dealt.write.mode("overwrite").bucketBy(buckets, "company_id").sortBy("company_id", "reporting_year").option("path", path).saveAsTable(table)


def id_cuts(ids: DataFrame, partitions: int, id_col: str = "id") -> list[int]:
    """At most ``partitions`` - 1 ids that cut a table into parts of about as many rows each."""
    shares = [k / partitions for k in range(1, partitions)]
    found = ids.where(F.col(id_col).isNotNull()).approxQuantile(id_col, shares, 0.1 / partitions) if shares else []
    return sorted({int(x) for x in found})


def id_predicates(cuts: list[int], id_col: str = "id") -> list[str]:
    """Conditions that part all rows, those without an id too, each row into one part."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{id_col} >= {a} AND {id_col} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{id_col} < {cuts[0]} OR {id_col} IS NULL", *inner, f"{id_col} >= {cuts[-1]}"]


def read_jdbc(spark: SparkSession, url: str, table: str, partitions: int = 64, id_col: str = "id", properties: dict | None = None) -> DataFrame:
    """A table read over as many connections as ``partitions``, cut at quantiles of its ids, so
    that gaps and crowds among the ids leave no part much larger than the others. The ids alone
    are read first; their quantiles, one number per part, reach the driver."""
    ids = spark.read.jdbc(url, table, properties=properties or {}).select(id_col)
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(id_col)
    return spark.read.jdbc(url, table, predicates=id_predicates(id_cuts(ids, partitions, id_col), quoted), properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, partitions: int = 16, properties: dict | None = None) -> None:
    """Appends to a table over at most so many connections."""
    df.coalesce(partitions).write.jdbc(url, table, mode="append", properties=properties or {})


def append_records(records: DataFrame, path: str) -> None:
    """Appends records, one folder per reporting year. Rows of a year meet in a few tasks
    first, so a year gets a few files per run."""
    records.repartition("reporting_year", F.pmod(F.xxhash64("company_id"), F.lit(16))).write.mode("append").partitionBy("reporting_year").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as (url, html)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def export_frame(overview: DataFrame) -> DataFrame:
    """The review overview under its export headings, in listing order."""
    ordered = overview.orderBy("company", "reporting_year", "id")
    cols = ["company", "reporting_year", "scope_1", "scope_2_location", "scope_3", "confidence_score", "review_status"]
    return ordered.select(*[F.col(c).alias(h) for c, h in zip(cols, EXPORT_COLUMNS, strict=True)])


def write_csv(overview: DataFrame, path: str, single_file: bool = False) -> None:
    """The export with a header. One file only where asked for: it goes through one task."""
    frame = export_frame(overview)
    (frame.coalesce(1) if single_file else frame).write.mode("overwrite").option("header", True).csv(path)
