"""Explicit schemas of the persistent tables and of the tables at the job boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(columns: str) -> T.StructType:
    """A flat schema from "name type [not null], ..."; needs no running session."""
    fields = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind], not rest) for name, kind, *rest in fields])


COMPANIES = _struct(
    "id long, name string not null, ticker string, lei string, lei_legal_name string, lei_country string, lei_confidence string, "
    "lei_flag_reason string, lei_review_status string, index_membership string, created_at timestamp_ntz"
)
RECORDS = _struct(
    "id long, company_id long not null, reporting_year int not null, scope_1 double, scope_2_location double, scope_2_market double, scope_3 double, "
    "scope_3_categories string, unit string, boundary string, methodology_notes string, is_restated boolean, source_id long, extraction_date timestamp_ntz, "
    "confidence_score int, review_status string, flag_reason string, reviewed_by string, reviewed_at timestamp_ntz"
)
SOURCES = _struct(
    "id long, company_id long not null, url string, title string, document_type string, s3_pdf_key string, s3_screenshot_key string, page_number int, fetched_at timestamp_ntz"
)
RUNS = _struct(
    "id long, started_at timestamp_ntz, completed_at timestamp_ntz, total_companies int, successful int, failed int, skipped int, status string, error_log string"
)
SEED = _struct("name string, ticker string")
CANDIDATES = _struct("company_id long, search_name string, query_no int, pos int, lei string, legal_name string, country string")
REGISTRY = _struct("lei string, legal_name string, country string, status string")
SEARCH_RESULTS = _struct("company_id long, pos int, url string, title string")
DOC_PAGES = _struct("doc_id long, page_no int, text string")
HTML_PAGES = _struct("page_id long, url string, html string")
CELLS = _struct("doc_id long, sheet_no int, row_no int, col_no int, value string")
RANK_RESPONSES = _struct("doc_id long, response string")
EXTRACT_RESPONSES = _struct("doc_id long, table_index int, response string")
DECISIONS = _struct(
    "decision_id long, record_id long, decided_at timestamp_ntz, action string, new_scope_1 double, new_scope_2_location double, new_scope_2_market double, new_scope_3 double, note string"
)

#: values that missing columns and missing fields take
DEFAULTS = {
    "companies": {"lei_review_status": "pending"},
    "records": {"unit": "tonnes CO2e", "is_restated": False, "review_status": "pending"},
    "runs": {"successful": 0, "failed": 0, "skipped": 0, "status": "running"},
}

#: nested schemas of JSON texts, as from_json takes them
REGISTRY_RECORD = (
    "id string, attributes struct<entity: struct<legalName: struct<name: string>, legalAddress: struct<country: string>, headquartersAddress: struct<country: string>>>"
)
RANKING = ("ranked array<struct<index: int, score: int>>")
EXTRACTION = (
    "emissions array<struct<reporting_year: int, scope_1: double, scope_2_location: double, scope_2_market: double, scope_3: double, "
    "scope_3_categories: string, unit: string, boundary: string>>, methodology_notes string, confidence_score int"
)


def with_missing_columns(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Adds the columns of ``schema`` that ``df`` lacks, with a default or null; the columns
    that are there stay as they are."""
    given = set(df.columns)
    new = {f.name: F.lit((defaults or {}).get(f.name)).cast(f.dataType) for f in schema if f.name not in given}
    return df.withColumns(new) if new else df


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types."""
    full = with_missing_columns(df, schema, defaults)
    return full.select(*[_cast(full, f) for f in schema])


def _cast(df: DataFrame, field: T.StructField) -> Column:
    same = df.schema[field.name].dataType == field.dataType
    return F.col(field.name) if same else F.col(field.name).cast(field.dataType).alias(field.name)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n``. Nulls never clash."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
