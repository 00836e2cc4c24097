"""Where intermediate tables and files go, and rows in a global order.

Everything that one task writes and another reads lies under
``spark.checkpoint.dir``, the folder that the driver and all executors share.
"""

from __future__ import annotations

import math
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import resolve

WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this name in the shared folder of the cluster.

    Where the session names none, a local one will do for local tests only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="carbonsieve-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage is cut there,
    and the files outlive the executors that wrote them."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(path: str) -> None:
    """Deletes a folder that nothing reads any more. A store that pyarrow cannot reach keeps it
    until the shared folder is cleared."""
    try:
        fs, at = resolve(path)
    except (OSError, ValueError):
        return
    fs.delete_dir(at)


def own_name(df: DataFrame, name: str) -> str:
    """A name for a column beside those of ``df``, none of which it is in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession, size: str = "2m", rows: int = 500) -> None:
    """Python workers get texts in batches of about this size, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def released() -> None:
    """A Python worker gives back what Arrow has freed: it waits for other stages' tasks."""
    pa.default_memory_pool().release_unused()


def byte_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: a range of so many times the mean holds a frequent key
UNEVEN = 2


def _ends(df: DataFrame, key: list[Column], ranges: int) -> list:
    """The first and last key and the number of rows of each range of the order by ``key``."""
    keys = df.select(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(key)]).alias("_key"))
    dealt = keys.repartitionByRange(ranges, "_key").groupBy(F.spark_partition_id().alias("p"))
    return dealt.agg(F.min("_key").alias("first"), F.max("_key").alias("last"), F.count("*").alias("n")).orderBy("last").collect()


def in_order(df: DataFrame, key: list[Column], ranges: int, both_sides: bool = False, ties: Column | None = None) -> DataFrame:
    """``df`` dealt out and sorted so that each partition is one range of the global order by
    ``key`` and also holds copies of the rows that stand beside the range.

    Added columns: ``_range`` (number of the range), ``_key`` (struct of the key) and ``_side``:
    0 for the rows themselves, -1 for a copy of the row before the range (the first range gets
    the globally last row, so the order is a ring) and, with ``both_sides``, 1 for a copy of
    the row after it. A reader that goes through a partition row by row thus sees the
    neighbours of every row.

    The bounds of the ranges (two keys each, so keys should be short) are the only rows that
    reach the driver; they are literals afterwards, so a lost task is dealt the same rows again,
    and a row is compared with about twice the square root of their number.
    ``key`` must have no nulls. Of rows with an equal key at a bound, all are copied, so the
    neighbour is the last of those before the range and the first of those after it.

    ``ties`` orders the rows of one key. It may be costly, like the hash of a text: the bounds
    come from ``key`` alone, so what only ``ties`` reads is read once, when the rows are dealt.
    Where a key is so frequent that its range would be ``UNEVEN`` times the mean, ``ties`` becomes
    part of the key and parts such rows too.
    """
    ends = _ends(df, key, ranges)
    if ties is not None and max((e["n"] for e in ends), default=0) * ranges > UNEVEN * sum(e["n"] for e in ends):
        key, ties = [*key, ties], None
        ends = _ends(df, key, ranges)
    keyed = df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(key)]))
    kind = keyed.schema["_key"].dataType.simpleString()
    if not ends:
        return keyed.withColumns({"_range": F.lit(0), "_side": F.lit(0)})
    literal = lambda key: F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate(key)]).cast(kind)
    width = math.isqrt(len(ends) - 1) + 1
    blocks = [ends[i : i + width] for i in range(0, len(ends), width)]
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < F.col("_key")))
    nested = lambda name: F.array(*[F.array(*[literal(e[name]) for e in block]) for block in blocks])
    # the range of a key is how many ranges end before it; no key is above the last bound
    rows = keyed.withColumn("_block", below(F.array(*[literal(block[-1]["last"]) for block in blocks])))
    rows = rows.withColumn("_place", below(F.get(nested("last"), F.col("_block"))))
    at = F.col("_block") * width + F.col("_place")
    is_bound = lambda name: F.get(F.get(nested(name), F.col("_block")), F.col("_place")) == F.col("_key")
    seat = lambda number, side: F.struct(number.cast("int").alias("range"), F.lit(side).alias("side"))
    seats = [seat(at, 0), F.when(is_bound("last"), seat((at + 1) % len(ends), -1))]
    if both_sides:
        seats.append(F.when(is_bound("first") & (at > 0), seat(at - 1, 1)))
    out = rows.withColumn("_seat", F.explode(F.array_compact(F.array(*seats))))
    out = out.select(*keyed.columns, F.col("_seat.range").alias("_range"), F.col("_seat.side").alias("_side"))
    order = ["_range", "_side", "_key"] if ties is None else ["_range", "_side", "_key", ties]
    return out.repartitionById(len(ends), F.col("_range")).sortWithinPartitions(*order)


def small_side(table: DataFrame, rows: int = 500_000) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it has at most so many rows;
    beyond that Spark joins it by a shuffle."""
    return F.broadcast(table) if table.count() <= rows else table
