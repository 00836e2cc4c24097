"""From search results and model responses to records.

The model itself stays outside: prompts go out as a table, responses come in as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import capped, preview, search_query, source_type
from ..sources.schemas import EXTRACTION, RANKING

LEAST_SCORE = 30
TRIES = 3
UNIT = "tonnes CO2e"


def chosen_companies(companies: DataFrame, ids: list[int] | None) -> DataFrame:
    """Those with these ids; no list or an empty one means all."""
    return companies.where(F.col("id").isin(ids)) if ids else companies


def chosen_from_table(companies: DataFrame, ids: DataFrame) -> DataFrame:
    return companies.join(ids.select("id"), "id", "left_semi")


def search_queries(companies: DataFrame) -> DataFrame:
    return companies.select(F.col("id").alias("company_id"), search_query(F.col("name")).alias("query"))


def ranked_results(results: DataFrame) -> DataFrame:
    """PDFs first, otherwise in the order given; ``rank`` from 1."""
    typed = results.withColumn("source_type", source_type(F.col("url")))
    w = Window.partitionBy("company_id").orderBy((F.col("source_type") == "pdf").desc(), "pos")
    return typed.withColumn("rank", F.row_number().over(w))


def chosen_source(results: DataFrame) -> DataFrame:
    return ranked_results(results).where("rank = 1")


def source_errors(companies: DataFrame, results: DataFrame) -> DataFrame:
    """company_id, error for companies without any result, or whose best has no address."""
    best = chosen_source(results).select("company_id", "url", F.lit(True).alias("_found"))
    joined = companies.select(F.col("id").alias("company_id"), "name").join(best, "company_id", "left")
    error = F.when(F.col("_found").isNull(), F.concat(F.lit("No search results found for '"), "name", F.lit("'."))).when(
        F.coalesce("url", F.lit("")) == "", F.concat(F.lit("Could not identify a suitable source for '"), "name", F.lit("'."))
    )
    return joined.select("company_id", "name", error.alias("error")).where("error is not null")


def table_prompts(tables: DataFrame) -> DataFrame:
    """doc_id, prompt: the previews of a document's tables; cut before they are collected."""
    short = tables.select("doc_id", "table_index", F.concat(F.lit("TABLE "), F.col("table_index").cast("string"), F.lit(":\n"), preview(F.col("markdown"))).alias("part"))
    return _assembled(short, "doc_id", "table_index", "\n\n")


def search_prompts(results: DataFrame) -> DataFrame:
    """company_id, prompt: the numbered results, PDFs first."""
    title = F.coalesce(F.nullif("title", F.lit("")), F.lit("(no title)"))
    part = F.concat(F.col("rank").cast("string"), F.lit(". Title: "), title, F.lit("\n   URL: "), F.coalesce("url", F.lit("")))
    return _assembled(ranked_results(results).select("company_id", "rank", part.alias("part")), "company_id", "rank", "\n")


def _assembled(parts: DataFrame, key: str, order: str, sep: str) -> DataFrame:
    sorted_parts = F.array_sort(F.collect_list(F.struct(order, "part")))
    return parts.groupBy(key).agg(F.array_join(F.transform(sorted_parts, lambda x: x["part"]), sep).alias("prompt"))


def rankings(responses: DataFrame) -> DataFrame:
    """doc_id, pos, index, score as the responses list them; bad or empty ones give no rows."""
    parsed = F.from_json("response", RANKING)["ranked"]
    rows = responses.select("doc_id", F.posexplode(parsed).alias("pos", "r"))
    return rows.select("doc_id", "pos", F.col("r.index").alias("index"), F.col("r.score").alias("score"))


def top_tables(ranked: DataFrame, least: int = LEAST_SCORE, most: int = TRIES) -> DataFrame:
    """In the order of the response, the first few with a fair score."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    return ranked.where(F.col("score") >= least).withColumn("try", F.row_number().over(w)).where(F.col("try") <= most)


def pick_tables(top: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds table_index; negative ones count from the end of the document's ``n`` tables, and
    those out of range stay as tries without a table."""
    at = F.when(F.col("index") < 0, F.col("index") + F.col("n")).otherwise(F.col("index"))
    both = top.join(counts, "doc_id", "left").withColumn("_at", at)
    return both.withColumn("table_index", F.when((F.col("_at") >= 0) & (F.col("_at") < F.col("n")), F.col("_at").cast("int"))).drop("_at", "n")


def table_counts(tables: DataFrame) -> DataFrame:
    return tables.groupBy("doc_id").agg(F.count("*").cast("int").alias("n"))


def parsed_responses(responses: DataFrame) -> DataFrame:
    """doc_id, table_index, result (null when the JSON is bad or a required field is missing)."""
    r = F.from_json("response", EXTRACTION)
    out = responses.withColumn("_r", r)
    valid = F.col("_r.emissions").isNotNull() & F.col("_r.confidence_score").isNotNull()
    return out.select("doc_id", "table_index", F.when(valid, F.col("_r")).alias("result"))


def first_result(picked: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per document the first of its tries whose response lists any figures."""
    joined = picked.where("table_index is not null").join(parsed, ["doc_id", "table_index"])
    some = joined.where("size(result.emissions) > 0")
    best = some.groupBy("doc_id").agg(F.min_by(F.struct("table_index", "result"), "try").alias("b"))
    return best.select("doc_id", "b.table_index", "b.result")


def with_text_fallback(documents: DataFrame, from_tables: DataFrame, from_text: DataFrame) -> DataFrame:
    """documents (doc_id, company_id, name, source_type) with the result of a table, else for
    html that of the page's text; ``error`` where there is neither."""
    text = from_text.select("doc_id", F.col("result").alias("_text"))
    joined = documents.join(from_tables.select("doc_id", F.col("result").alias("_table")), "doc_id", "left").join(text, "doc_id", "left")
    fallback = F.when((F.col("source_type") == "html") & (F.size("_text.emissions") > 0), F.col("_text"))
    out = joined.withColumn("result", F.coalesce("_table", fallback)).drop("_table", "_text")
    return out.withColumn("error", F.when(F.col("result").isNull(), F.concat(F.lit("No emissions data found for "), "name")))


def complete(result: Column) -> Column:
    """A company is saved all or not at all: every entry needs its year."""
    return F.forall(result["emissions"], lambda e: e["reporting_year"].isNotNull())


def flatten_results(results: DataFrame, position: str | None = None) -> DataFrame:
    """One row per figure of complete results; other columns of ``results`` stay. ``position``
    names a column for the figure's place in its result, from 0."""
    keep = [c for c in results.columns if c != "result"]
    rows = results.where(complete(F.col("result"))).select(*keep, F.posexplode("result.emissions").alias("_at", "e"), F.col("result.methodology_notes").alias("_notes"), F.col("result.confidence_score").alias("confidence_score"))
    return rows.select(
        *keep,
        *([F.col("_at").alias(position)] if position else []),
        "e.reporting_year",
        "e.scope_1",
        "e.scope_2_location",
        "e.scope_2_market",
        "e.scope_3",
        "e.scope_3_categories",
        F.coalesce("e.unit", F.lit(UNIT)).alias("unit"),
        "e.boundary",
        F.coalesce("_notes", F.lit("")).alias("methodology_notes"),
        "confidence_score",
        F.lit("pending").alias("review_status"),
    )


def incomplete_results(results: DataFrame) -> DataFrame:
    return results.where(~complete(F.col("result")))


def to_tonnes(records: DataFrame) -> DataFrame:
    """Opt-in: kilo- and megatonnes to tonnes, in all scopes; to be run before the checks."""
    unit = F.lower("unit")
    factor = F.when(unit.isin("kt", "kt co2e"), 1e3).when(unit.isin("mt", "mt co2e"), 1e6)
    scopes = ["scope_1", "scope_2_location", "scope_2_market", "scope_3"]
    scaled = {s: F.when(factor.isNotNull(), F.col(s) * factor).otherwise(F.col(s)) for s in scopes}
    return records.withColumns(scaled | {"unit": F.when(factor.isNotNull(), UNIT).otherwise(F.col("unit"))})
