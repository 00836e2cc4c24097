"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_automaton, exact_dedup, lang_id, mixing, multiset_hash, page_diff, period_runs, set_sketch, suffix_search, token_alignment, token_blocks, warc, weak_pii
from .shared import shared_dir, small_batches


#: batches for operators that encode each distinct piece of a batch once
LARGE = {"size": "8m", "rows": 2000}


def _table(spark: SparkSession, sf_dir: str, name: str, **batches) -> DataFrame:
    small_batches(spark, **batches)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_set_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_sketch.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    token_blocks.write_tokens(_table(spark, sf_dir, "documents", **LARGE), folder, _vocabulary("byte_bpe_50k.json"), end_id=2)
    back = token_blocks.read_tokens(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return weak_pii.digest_columns(weak_pii.marked(docs, weak_pii.train(docs)))


def op5_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.with_next(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"), keep="max")


def op8_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(_table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lang_id.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return rows.select("doc_id", lang_id.held_out(F.col("doc_id")).alias("held_out"), F.col("_lang.lang").alias("lang_pred"), F.col("_lang.score").alias("score"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", **LARGE)
    rows = docs.select("doc_id", bpe_automaton.round_trip(F.col("text"), _vocabulary("word_bpe_49k.json")).alias("r"))
    return rows.select(
        "doc_id", F.expr("cast(octet_length(r.ids) div 4 as bigint)").alias("n_tokens"), F.sha2("r.ids", 256).alias("ids_sha256"), F.sha2("r.decoded", 256).alias("decoded_sha256")
    )


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = period_runs.planted(_table(spark, sf_dir, "documents"))
    return period_runs.digest_columns(docs.select("doc_id", period_runs.repetitions(F.col("text")).alias("found")))


def op12_suffix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = suffix_search.item_blocks(_table(spark, sf_dir, "benchmark"))
    docs = _table(spark, sf_dir, "documents", **LARGE)
    return suffix_search.digest_columns(docs.select("doc_id", suffix_search.searched(F.col("text"), blocks).alias("found")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_alignment.alignments(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


OP7_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
FROM t
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_set_sketch_dedup": op1_set_sketch_dedup, "op2_token_blocks": op2_token_blocks, "op3_warc": op3_warc, "op4_weak_pii": op4_weak_pii, "op5_multiset_fingerprints": op5_multiset_fingerprints, "op6_mixing": op6_mixing, "op7_exact_dedup": op7_exact_dedup, "op8_page_differencing": op8_page_differencing, "op9_language_id": op9_language_id, "op10_bpe_automaton": op10_bpe_automaton, "op11_period_runs": op11_period_runs, "op12_suffix_search": op12_suffix_search, "op13_token_alignment": op13_token_alignment}


def oracle_sql() -> dict[str, str]:
    return {"op6_mixing": mixing.ORACLE, "op7_exact_dedup": OP7_SQL, "op11_period_runs": period_runs.ORACLE, "op12_suffix_search": suffix_search.ORACLE}
