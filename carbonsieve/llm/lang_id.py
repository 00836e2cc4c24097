"""Language identification by words first, then by ever shorter character n-grams.

Training counts every word of every labelled document per language, and every character
n-gram of those words, as DataFrame aggregations. Scoring adds, word by word, the logarithm
of the word's share in each language; a word that the model lacks is scored by the n-grams of
the greatest length at which the model knows any, the shorter ones after the longer ones.

Every trained word and n-gram counts, and shares are of all that a language trained. The most
frequent words (``max_words`` at most, over all languages) are broadcast; the words of a text
outside them become rows (text, word, count) that Spark joins with the written table of all
words and, where a word was never trained, with that of all n-grams, and sums by text. Where
the broadcast tables hold all that was trained (n-grams: ``max_grams`` an order), they settle
everything alone. Log shares are held to multiples of 2**-18, so their sums are exact: both ways
give the same sums, in whatever order.

Rules for odd input: rows without text or language train nothing; a text that is null or has
no letter is ``und`` with score 0; without any training rows everything is ``und``. Repeated
rows count as often as they occur. Ties go to the language that sorts first. Other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .shared import byte_digest, own_name, released, small_side, written

UND = "und"
ORDERS = (4, 3, 2, 1)
LETTERS = regex.compile(r"\p{L}+")
MAX_WORDS = 120_000
MAX_GRAMS = 40_000
#: longer words are not broadcast
LONGEST_WORD = 24
#: log shares are multiples of one by this
UNIT = 2**18


@dataclass
class Table:
    """Entries and, per entry, a row of log shares by language."""

    keys: dict[str, int]
    rows: np.ndarray

    def get(self, key: str) -> np.ndarray | None:
        at = self.keys.get(key)
        return None if at is None else self.rows[at]


@dataclass
class Model:
    """Languages in order, the table of words and that of each n-gram order (none where only
    the written tables hold all)."""

    langs: list[str]
    words: Table
    grams: dict[int, Table]


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, word, n over all rows; summed within tasks before the shuffle."""
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(\p{L}+)"), 1)
    return (
        docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.explode(words).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )


def word_grams(words: DataFrame) -> DataFrame:
    """lang, n, size, entry: the n-grams of all words, each padded by a space on either side."""
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    sizes = F.array(*[F.lit(k) for k in ORDERS])
    starts = F.sequence(F.lit(1), F.greatest(F.length("padded") - F.col("size") + 1, F.lit(1)))
    return (
        words.withColumn("padded", padded)
        .select("lang", "n", "padded", F.explode(sizes).alias("size"))
        .select("lang", "n", "size", "padded", F.explode(starts).alias("at"))
        .select("lang", "n", "size", F.expr("substring(padded, at, size)").alias("entry"))
    )


@dataclass
class Counted:
    """The written counts of all entries by language (``entry``, ``n0`` and on) and their sums."""

    rows: DataFrame
    totals: list[int]
    size: int
    #: how many entries may be broadcast by class of frequency
    classes: list[tuple[int, int]]

    def shares(self) -> list[Column]:
        """s0 and on: the log shares in units, half a count for what a language has not shown."""
        spare = 0.5 * (self.size + 1)
        return [F.floor(F.log((F.col(f"n{i}") + 0.5) / F.lit(n + spare)) * UNIT + 0.5).cast("int").alias(f"s{i}") for i, n in enumerate(self.totals)]

    def head(self, limit: int) -> Table:
        """The most frequent entries over all languages: as many whole classes of frequency (4 %
        wide) as fit into ``limit``, so no more flat rows reach the driver from all tasks together."""
        room, least = limit, None
        for number, n in self.classes:
            if n > room:
                break
            room, least = room - n, number
        short = (F.col("class") >= least) & (F.length("entry") <= LONGEST_WORD) if least is not None else F.lit(False)
        kept = self.rows.where(short).select("entry", *self.shares()).toArrow()
        rows = np.column_stack([np.asarray(kept[f"s{i}"], dtype=np.float64) for i in range(len(self.totals))]) if self.totals else np.zeros((0, 0))
        return Table({e: i for i, e in enumerate(kept["entry"].to_pylist())}, (rows / UNIT).astype(np.float32))


def _counted(counts: DataFrame, langs: list[str], sizes: tuple[int, ...]) -> dict[int, Counted]:
    """The entries of each size, of ``counts`` (lang, n, size, entry); all are one written table."""
    own = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(langs)]
    rows = counts.groupBy("size", "entry").agg(F.sum("n").alias("total"), *own)
    rows = written(rows.withColumn("class", F.floor(F.log2("total") * 16).cast("int")).drop("total"), "lang-entries")
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(langs))]
    found = rows.groupBy("size", "class").agg(F.count("*").alias("all"), F.count_if(F.length("entry") <= LONGEST_WORD).alias("short"), *sums).collect()
    out = {}
    for k in sizes:
        own = [r for r in found if r["size"] == k]
        classes = sorted(((r["class"], r["short"]) for r in own), reverse=True)
        out[k] = Counted(rows.where(F.col("size") == k).drop("size"), [sum(r[f"n{i}"] for r in own) for i in range(len(langs))], sum(r["all"] for r in own), classes)
    return out


@dataclass
class Trained:
    """The model to broadcast, and the written tables behind it where it does not hold all."""

    model: Model
    words: Counted | None = None
    grams: dict[int, Counted] | None = None


def train(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS, counts: DataFrame | None = None
) -> Trained:
    counts = written(word_counts(docs, text_col, lang_col), "lang-words") if counts is None else counts
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    words = _counted(counts.select("lang", "n", F.lit(0).alias("size"), F.col("word").alias("entry")), langs, (0,))[0]
    grams = _counted(word_grams(counts), langs, ORDERS)
    head = words.head(max_words)
    if len(head.keys) == words.size and all(g.size <= max_grams for g in grams.values()):
        return Trained(Model(langs, head, {k: g.head(max_grams) for k, g in grams.items()}))
    return Trained(Model(langs, head, {}), words, grams)


class Scorer:
    """Scores texts with a model; keeps the scores of words it has scored by n-grams, within a bound."""

    def __init__(self, model: Model, limit: int = 100_000):
        self.model, self.limit = model, limit
        self.seen: dict[str, np.ndarray] = {}

    def backoff(self, w: str) -> np.ndarray:
        """The mean over the n-grams of the greatest order of which the model knows any."""
        padded = f" {w} "
        for k in ORDERS:
            table = self.model.grams[k]
            found = [at for i in range(len(padded) - k + 1) if (at := table.keys.get(padded[i : i + k])) is not None]
            if found:
                return np.floor(table.rows[found].sum(axis=0, dtype=np.float64) / len(found) * UNIT + 0.5) / UNIT
        return np.zeros(len(self.model.langs))

    def sums(self, text: str | None) -> tuple[np.ndarray, dict[str, int]] | None:
        """The sum over the words in the model's table, and how often each other word occurs;
        nothing for a text without a letter."""
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.model.langs:
            return None
        counts = Counter(words)
        at = list(map(self.model.words.keys.get, counts))
        others = {w: n for (w, n), i in zip(counts.items(), at, strict=True) if i is None} if None in at else {}
        known = [i for i in at if i is not None] if others else at
        times = [n for n, i in zip(counts.values(), at, strict=True) if i is not None] if others else list(counts.values())
        return np.array(times, np.float64) @ self.model.words.rows[known].astype(np.float64), others

    def text(self, text: str | None) -> tuple[str, float]:
        if (found := self.sums(text)) is None:
            return UND, 0.0
        total, others = found
        if len(self.seen) > self.limit:
            self.seen = {}
        for w, n in others.items():
            if (v := self.seen.get(w)) is None:
                v = self.seen[w] = self.backoff(w)
            total = total + n * v
        best = int(total.argmax())
        odds = np.exp(np.maximum(total - total[best], -700))
        return self.model.langs[best], float(1 / odds.sum())


def predicted(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct<lang, score> of a text by a model that holds all that was trained."""
    sent = spark.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for batch in batches:
            yield pd.DataFrame([scorer.text(t) for t in batch], columns=["lang", "score"])
        released()

    return predict(text)


def _by_head(texts: DataFrame, model: Model) -> DataFrame:
    """digest, head (the sum over the broadcast words; null without a letter), words and times
    (of the other words) of every text."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("digest", pa.binary()), ("head", pa.list_(pa.float64())), ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            found = [scorer.sums(t) for t in batch.column("text").to_pylist()]
            columns = (
                [f and f[0] for f in found],
                [list(f[1]) if f else [] for f in found],
                [list(f[1].values()) if f else [] for f in found],
            )
            yield pa.RecordBatch.from_arrays([batch.column("digest").cast(pa.binary()), *(pa.array(c, t.type) for c, t in zip(columns, list(schema)[1:], strict=True))], schema=schema)
        released()

    return texts.select("digest", "text").mapInArrow(scored, "digest binary, head array<double>, words array<string>, times array<long>")


def _by_grams(words: DataFrame, grams: dict[int, Counted]) -> list[DataFrame]:
    """word, s0 and on of words that were never trained: the means over the n-grams of the
    greatest order of which any was."""
    out = []
    for k in ORDERS:
        if words.isEmpty():
            break
        padded = words.select("word", F.concat(F.lit(" "), F.col("word"), F.lit(" ")).alias("padded")).where(F.length("padded") >= k)
        pieces = padded.select("word", "padded", F.explode(F.sequence(F.lit(1), F.length("padded") - k + 1)).alias("at"))
        pieces = pieces.select("word", F.expr(f"substring(padded, at, {k})").alias("entry"))
        table = small_side(grams[k].rows, MAX_GRAMS).select("entry", *grams[k].shares())
        means = [F.floor(F.avg(f"s{i}") + 0.5).cast("int").alias(f"s{i}") for i in range(len(grams[k].totals))]
        found = pieces.join(table, "entry").groupBy("word").agg(*means)
        met = written(words.join(found, "word", "left"), f"lang-grams-{k}")
        out.append(met.where(F.col("s0").isNotNull()))
        words = met.where(F.col("s0").isNull()).select("word")
    return out


def scores(docs: DataFrame, trained: Trained, text_col: str = "text") -> DataFrame:
    """digest, lang, score: one row per distinct text, by the model and the tables behind it."""
    langs = trained.model.langs
    texts = docs.select(byte_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    parts = _by_head(texts, trained.model).dropDuplicates(["digest"])
    # numbered while they are written: fixed from there on, and shorter than the digest
    parts = written(parts.withColumn("part", F.monotonically_increasing_id()), "lang-parts")
    others = parts.select("part", F.explode(F.arrays_zip("words", "times")).alias("w")).select("part", F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    full = trained.words.rows.select(F.col("entry").alias("word"), *trained.words.shares())
    met = written(others.select("word").distinct().join(full, "word", "left"), "lang-met")
    known = met.where(F.col("s0").isNotNull())
    for found in _by_grams(met.where(F.col("s0").isNull()).select("word"), trained.grams):
        known = known.unionByName(found)
    sums = [F.sum(F.col("n") * F.col(f"s{i}")).alias(f"s{i}") for i in range(len(langs))]
    tails = others.join(known, "word").groupBy("part").agg(*sums)
    total = F.array(*[F.col("head")[i] + F.coalesce(F.col(f"s{i}"), F.lit(0)) / UNIT for i in range(len(langs))])
    best = F.array_max("total")
    odds = F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(F.greatest(x - F.col("best"), F.lit(-700.0))))
    rows = parts.drop("words", "times").join(tails, "part", "left").select("digest", F.when(F.col("head").isNotNull(), total).alias("total"))
    rows = rows.withColumn("best", best)
    named = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("total", F.col("best")).cast("int"))
    return written(rows.select("digest", F.when(F.col("total").isNull(), UND).otherwise(named).alias("lang"), F.coalesce(1 / odds, F.lit(0.0)).alias("score")), "lang-scores")


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of which crc32 of the id, modulo 4, is not 2."""
    return docs.where(~held_out(F.col(id_col)))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(
    docs: DataFrame, *, train_on: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS
) -> DataFrame:
    """``docs`` with the struct column ``_lang`` (lang, score), in place of one of that name."""
    rows = training_rows(docs, id_col) if train_on is None else train_on
    trained = train(rows, text_col=text_col, lang_col=lang_col, max_words=max_words, max_grams=max_grams)
    if trained.words is None:
        return docs.withColumn("_lang", predicted(docs.sparkSession, F.col(text_col), trained.model))
    own, text, digest = docs.drop("_lang"), own_name(docs, "_text"), own_name(docs, "_digest")
    found = scores(docs, trained, text_col).select(F.col("digest").alias(digest), F.struct("lang", "score").alias("_lang"))
    return own.withColumn(text, byte_digest(F.col(text_col))).join(found, F.col(text) == F.col(digest)).drop(text, digest)


def in_a_language(docs: DataFrame, trained: Trained, text_col: str = "text") -> DataFrame:
    """``docs`` but for those that the model finds in no language."""
    if trained.words is None:
        return docs.where(predicted(docs.sparkSession, F.col(text_col), trained.model)["lang"] != UND)
    own = own_name(docs, "_gone")
    gone = scores(docs, trained, text_col).where(F.col("lang") == UND).select(F.col("digest").alias(own))
    return docs.join(small_side(gone), byte_digest(F.col(text_col)) == F.col(own), "left_anti")


def labelled(docs: DataFrame, trained: Trained, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` but for those that the model finds in no language; a null in ``lang_col`` becomes
    the language that it finds. Only the results of such documents and of those that go are
    joined with the texts."""
    own, digest = own_name(docs, "_found"), own_name(docs, "_digest")
    if trained.words is None:
        rows = docs.withColumn(own, predicted(docs.sparkSession, F.col(text_col), trained.model)["lang"])
    else:
        found = scores(docs, trained, text_col)
        open_ = docs.where(F.col(lang_col).isNull()).select(byte_digest(F.col(text_col)).alias("digest")).distinct()
        wanted = found.where(F.col("lang") == UND).unionByName(found.where(F.col("lang") != UND).join(open_, "digest", "left_semi"))
        wanted = written(wanted.select(F.col("digest").alias(digest), F.col("lang").alias(own)), "lang-wanted")
        rows = docs.join(small_side(wanted), byte_digest(F.col(text_col)) == F.col(digest), "left")
    kept = rows.where(F.coalesce(F.col(own), F.lit("")) != UND)
    return kept.withColumn(lang_col, F.coalesce(F.col(lang_col), F.col(own))).drop(own, digest)
