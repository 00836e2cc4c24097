"""Exact deduplication by a log-structured merge index of digests.

Every scan task is a memtable: it sorts the digests of its rows and flushes one sorted run.
Compaction merges the runs of a level that is full to one of the next, one row per digest with
one identifier and the count, and drops them; other levels are not touched. Runs have filters, a
bit per hashed digest, of bounded size: a lookup reads a run only for digests that pass. To
deduplicate a whole table its runs are merged to one, and a filter of the digests that several
rows have settles every row whose bit is not set where it is scanned; only the others are
looked up by digest. Hits are verified byte by byte against the text of the row that stays, so
a digest collision cannot drop a document.

All of it is DataFrame operations.

Rules for odd input: a null text counts as empty; rows with a null id never stay while a row
with an id has the same text, and if no row has one, ``keep_id`` is null and all of them
stay; rows repeated with the same id and text are one document, so they stay or go together in
``duplicates``, and each counts in ``group_size``; ``drop_duplicates`` keeps one of those that
would stay, and one of several rows without an id. An empty table gives an empty result. Other columns, of
whatever name, are ignored by ``duplicates`` and carried through by ``drop_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import byte_digest, own_name, removed, shared_dir, small_side, written

RUN_SCHEMA = "digest binary, id long, n long"
#: bits of the filter per digest, and at most in all (64 MB, which is what is broadcast)
BITS_EACH, MOST_BITS = 16, 2**29
#: runs of a level that are merged to one of the next
FANOUT = 4


def _write_sorted(df: DataFrame, path: str) -> None:
    df.sortWithinPartitions("digest").write.parquet(path)


class DigestFilter:
    """A bit per hashed digest. What is in ``digests`` always passes, of other digests few do
    (more where the most bits are reached, which costs time, not rows)."""

    def __init__(self, digests: DataFrame, name: str = "digest-filter"):
        self.bits = min(MOST_BITS, max(2**15, 2 ** math.ceil(math.log2(BITS_EACH * max(1, digests.count())))))
        place = self._place(F.col("digest"))
        bitmaps = digests.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap"))
        self.path = shared_dir(digests.sparkSession, name)
        bitmaps.write.parquet(self.path)
        self.bitmaps = digests.sparkSession.read.schema(bitmaps.schema).parquet(self.path)

    def _place(self, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.bits)) + 1

    def mark(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the boolean ``_maybe``; bitmaps are broadcast, ``MOST_BITS`` at most."""
        place = self._place(F.col("digest"))
        at = F.bitmap_bit_position(place)
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
        met = rows.join(F.broadcast(self.bitmaps), F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
        return met.withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("_bucket", "_bitmap")


@dataclass
class Run:
    """A sorted run of the index, how many entries it has, and its filter once one was needed."""

    path: str
    level: int
    size: int
    filter: DigestFilter | None = None


class DigestIndex:
    """The index: sorted runs in levels of growing size.

    A flush adds a run to level 0. When ``FANOUT`` runs have come together on a level, they are
    merged to one of the next, so an entry is written about as often as there are levels: the
    logarithm of the number of batches. ``compact`` merges all there is to a single run."""

    def __init__(self, spark: SparkSession, path: str | None = None, *, keep: str = "max", digest: Callable[[Column], Column] = byte_digest):
        if keep not in ("min", "max"):
            raise ValueError("keep is 'min' or 'max'")
        self.spark, self.path, self.digest = spark, path or shared_dir(spark, "digest-index"), digest
        self.best = F.min if keep == "min" else F.max
        self.runs: list[Run] = []
        self.written = 0
        #: entries written so far, by flushes and merges
        self.entries_written = 0

    def _add(self, rows: DataFrame, level: int) -> None:
        self.written += 1
        path = f"{self.path}/run-{self.written}-level-{level}"
        _write_sorted(rows, path)
        run = Run(path, level, self._read(path).count())
        self.entries_written += run.size
        self.runs.append(run)

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths)

    def flush(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Adds a batch: every task writes its own sorted run; nothing is shuffled."""
        self._add(docs.select(self.digest(F.col(text_col)).alias("digest"), F.col(id_col).cast("long").alias("id"), F.lit(1).cast("long").alias("n")), 0)

    def settle(self) -> None:
        """Merges full levels, from the lowest up. Runs of other levels are left alone."""
        level = 0
        while any(r.level >= level for r in self.runs):
            full = [r for r in self.runs if r.level == level]
            if len(full) >= FANOUT:
                self._merge(full, level + 1)
            level += 1

    def compact(self) -> None:
        """Merges all runs to one."""
        if self.runs and not (len(self.runs) == 1 and self.runs[0].level):
            self._merge(list(self.runs), 1 + max(r.level for r in self.runs))

    def _merge(self, runs: list[Run], level: int) -> None:
        rows = self._read(*[r.path for r in runs])
        self._add(self._merged(rows), level)
        self.runs = [r for r in self.runs if r not in runs]
        for run in runs:
            removed(run.path)
            if run.filter:
                removed(run.filter.path)

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("digest").agg(self.best("id").alias("id"), F.sum("n").alias("n"))

    def entries(self) -> DataFrame:
        """digest, id, n over all runs."""
        rows = self._read(*[r.path for r in self.runs]) if self.runs else self.spark.createDataFrame([], RUN_SCHEMA)
        return rows if len(self.runs) == 1 and self.runs[0].level else self._merged(rows)

    def groups(self) -> DataFrame:
        """The entries that several rows share."""
        return self.entries().where("n > 1")

    def lookup(self, digests: DataFrame) -> DataFrame:
        """digest, id, n of those of ``digests`` (a column digest) that the index holds. Each run is
        searched only for what its filter lets through."""
        wanted = written(digests.select("digest").distinct(), "digest-wanted")
        found = self.spark.createDataFrame([], RUN_SCHEMA)
        for run in self.runs:
            run.filter = run.filter or DigestFilter(self._read(run.path), "digest-run-filter")
            likely = run.filter.mark(wanted).where("_maybe").select("digest")
            found = found.unionByName(self._read(run.path).join(small_side(written(likely, "digest-likely")), "digest", "left_semi"))
        return self._merged(found)


def _collisions(rows: DataFrame, groups: DataFrame, seen: DigestFilter) -> DataFrame:
    """Digests under which a hit differs in its bytes from the row that stays. ``rows``: doc_id,
    text, digest.

    Only texts that pass the filter are moved. The row that stays is found by digest and id, so
    a large group does not meet in one task; its text then joins the hits by a plain join on the
    digest, which Spark splits where one digest is frequent."""
    likely = seen.mark(rows).where("_maybe").drop("_maybe")
    staying = likely.join(small_side(groups.select(F.col("digest").alias("d"), "id")), (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # rows that repeat the staying document agree with it or are hits themselves
    staying = written(staying.groupBy("digest").agg(F.max("text").alias("kept_text")), "digest-staying")
    hits = likely.join(small_side(groups.select("digest")), "digest", "left_semi").select("digest", "text")
    # written before they are made distinct, so that the join by itself may be split
    return written(hits.join(staying, "digest").where("text <> kept_text").select("digest"), "digest-collisions").distinct()


def duplicates(
    docs: DataFrame, *, keep: str = "max", digest: Callable[[Column], Column] = byte_digest, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    index = DigestIndex(spark, keep=keep, digest=digest)
    index.flush(rows)
    index.compact()
    groups = written(index.groups(), "digest-groups")
    seen = DigestFilter(groups)
    keyed = rows.withColumn("digest", digest(F.col("text")))
    bad = written(_collisions(keyed, groups, seen), "digest-bad")

    sha = F.sha2("text", 256).alias("text_sha256")
    out = ["doc_id", "keep_id", "group_size", "text_sha256"]
    narrow = seen.mark(keyed.select("doc_id", sha, "digest"))
    alone = narrow.where("not _maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    known = groups.select("digest", F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
    likely = narrow.where("_maybe").join(small_side(bad), "digest", "left_anti").join(small_side(known), "digest", "left")
    looked_up = likely.select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), "text_sha256")

    # texts that share a digest but not their bytes are grouped by the text itself
    mixed = keyed.join(small_side(bad), "digest", "left_semi")
    groups_of = mixed.groupBy("text").agg(index.best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    split = mixed.select("doc_id", "text").join(groups_of, "text").withColumn("text_sha256", sha)

    return (
        alone.unionByName(looked_up)
        .unionByName(split.select(*out))
        .select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")
    )


def drop_duplicates(docs: DataFrame, *, keep: str = "max", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    own, sha, n = (own_name(docs, x) for x in ("_id", "_sha", "_n"))
    found = duplicates(docs, keep=keep, id_col=id_col, text_col=text_col).where("group_size > 1")
    found = written(found.groupBy(F.col("doc_id").alias(own), F.unhex("text_sha256").alias(sha), "kept").agg(F.count("*").alias(n)), "copies")
    same = F.col(id_col).eqNullSafe(F.col(own)) & (byte_digest(F.col(text_col)) == F.col(sha))
    stay = docs.join(small_side(found.where(f"not kept or `{n}` > 1").select(own, sha)), same, "left_anti")
    again = docs.join(small_side(found.where(f"kept and `{n}` > 1").select(own, sha)), same).dropDuplicates([own, sha])
    return stay.unionByName(again.drop(own, sha))
