"""Keys of stored tables: dense ids, appends that respect a unique key, updates in place.

Ids continue above the largest one. Rows are dealt out by ranges of a fixed order and written;
how many rows each part holds then gives the part's first id, so numbering is one shuffle, no
task sees more than its part, and a retry gives the same ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import read_or_empty, staged

#: what must not occur twice among records
RECORD_KEY = ["company_id", "reporting_year", "extraction_date"]
#: monotonically_increasing_id: the partition's number above so many bits, the row's below
PLACE_BITS = 33


def last_id(table: DataFrame, id_col: str = "id") -> int:
    return table.agg(F.max(id_col)).first()[0] or 0


def numbered(rows: DataFrame, order: list[str], after: int = 0, id_col: str = "id") -> DataFrame:
    """``rows`` with ids after + 1, after + 2, ... in ascending order of the columns ``order``
    (nulls first), in place of a column of that name. Rows equal in ``order`` follow each other in
    any order, which is fixed by then.

    The number of rows of each part, one long per part, is all that reaches the driver."""
    ranged = rows.drop(id_col).repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", PLACE_BITS)
    counts = sorted(tuple(r) for r in fixed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    firsts, free = [], after + 1
    for p, n in counts:
        firsts.append((p, free))
        free += n
    offsets = rows.sparkSession.createDataFrame(firsts, "_part long, _first long")
    both = fixed.join(F.broadcast(offsets), part == F.col("_part"))
    own = (F.col("_first") + F.col("_at").bitwiseAND(F.lit(2**PLACE_BITS - 1))).alias(id_col)
    return both.select(own, *[F.col(c) for c in fixed.columns if c != "_at"])


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def unseen_rows(rows: DataFrame, table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` whose key ``table`` lacks, one of each key: the first by ``order``. Nulls in a key
    equal each other, so a repeat is found whatever its key holds."""
    first = Window.partitionBy(*keys).orderBy(*order)
    once = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n")
    return once.alias("new").join(table.select(*keys).alias("old"), _same(keys, "new", "old"), "left_anti")


def append_new(rows: DataFrame, path: str, schema: T.StructType, keys: list[str], order: list[str], partition: str | None = None, id_col: str = "id") -> DataFrame:
    """Appends those of ``rows`` whose key the table in ``path`` lacks, with ids above its
    largest; gives what was appended. Doing it again with the same rows appends nothing.

    With ``partition`` the table has a folder for each value of that column (part of the key),
    and only the folders of the values in ``rows`` are searched for the key. The rows to add are
    staged before the table is touched, and a job that dies on the way is simply run again:
    what it had committed is found by its key. One writer at a time."""
    spark = rows.sparkSession
    table = read_or_empty(spark, path, schema)
    searched = table
    if partition:
        values = [r[0] for r in rows.select(partition).distinct().collect()]
        known = [v for v in values if v is not None]
        here = F.col(partition).isin(known) if known else F.lit(False)
        searched = table.where(here | F.col(partition).isNull() if None in values else here)
    fresh = staged(unseen_rows(rows, searched, keys, order), "append")
    columns = [f.name for f in schema]
    ready = staged(numbered(fresh, order, last_id(table, id_col), id_col).select(*columns), "append-ids")
    if partition:
        # a value's rows meet in a few tasks first, so that it gets a few files
        few = ready.repartition(partition, F.pmod(F.xxhash64(*keys), F.lit(16)))
        few.write.mode("append").partitionBy(partition).parquet(path)
    else:
        ready.write.mode("append").parquet(path)
    return ready


def overwrite_touched(spark: SparkSession, path: str, rows: DataFrame, partition: str) -> None:
    """Puts ``rows`` in place of the folders of their values of ``partition``; all other folders
    keep their files. ``rows`` may come from the table itself: they are staged first."""
    fixed = staged(rows, "touched")
    few = fixed.repartition(partition, F.pmod(F.xxhash64(*fixed.columns[:1]), F.lit(16)))
    few.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
