"""The corpus pipeline: from raw documents to token ids, one operator per stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes the result of each stage to the shared folder and reads it
for the next, so a lost executor costs at most the stage that it was in.

No SQL can state the result, as language identification and near-duplicates are no relational
terms; a test holds the rows of ``run`` against the stages done by hand on a small table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carbonsieve.llm import bpe_automaton, exact_dedup, lang_id, mixing, set_sketch
from carbonsieve.llm.shared import small_batches, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (without a letter) go, and those without a label get the language
    that a model finds, which is trained on those labelled. Without any label nothing can be told,
    and all documents with a letter stay as they are."""
    small_batches(spark)
    trained = lang_id.train(lang_id.training_rows(docs))
    if not trained.model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return lang_id.labelled(docs, trained)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs, keep="max")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles the one with the least id stays."""
    small_batches(spark)
    return set_sketch.drop_near_duplicates(docs, shingle=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids (little-endian unsigned 32-bit), decoded_sha256."""
    small_batches(spark)
    rows = docs.select("doc_id", "source", "lang", bpe_automaton.round_trip(F.col("text"), TOKENIZER).alias("r"))
    n = F.expr("cast(octet_length(r.ids) div 4 as bigint)")
    return rows.select("doc_id", "source", "lang", n.alias("n_tokens"), F.col("r.ids").alias("ids"), F.sha2("r.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
