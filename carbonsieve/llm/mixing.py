"""Mixing sources to target weights.

Tokens are summed per source, every source gets a target, and rate = target / tokens says how
often its documents are repeated: floor(rate) copies and one more with the probability of the
fraction, drawn from a hash of the document's id, so that reruns and lost tasks draw alike.

Targets share the total by weight and stop at ``max_epochs`` times what a source has; the
excess goes to the others by weight until none is above (solved exactly in one pass over the
sources in the order of their size per weight, with integers).

The only rows in one task are the sums per source. Null sources are one source, the last; a
null text has size 0; a source without tokens has target and rate 0; documents with the same
id share a draw, all those with a null id too. Empty tables give empty results; other columns
are carried by ``mixed`` and ignored by ``plan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import word_count

DRAW_BITS = 52


def draw(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from the MD5 of the seed and the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long").cast("double") / float(1 << DRAW_BITS)


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """source, source_size, target from rows (source, size)."""
    # one row per source from here on
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sums.withColumn("weight", pick).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rows = rows.withColumns(
        {
            "k": F.row_number().over(order),
            "cap_before": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "weight_from": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(Window.partitionBy()),
        }
    )
    # the first source that stays below its cap when it and those after it share the rest
    rows = rows.withColumn("open", F.col("cap") * F.col("weight_from") >= (F.col("total") - F.col("cap_before")) * F.col("weight"))
    first = F.min(F.when(F.col("open"), F.struct("k", "cap_before", "weight_from"))).over(Window.partitionBy())
    rows = rows.withColumn("first", first)
    share = (F.col("total") - F.col("first.cap_before")).cast("double") * F.col("weight") / F.col("first.weight_from")
    target = F.when(F.col("first").isNull() | (F.col("k") < F.col("first.k")), F.col("cap").cast("double")).otherwise(share)
    return rows.select("source", "source_size", target.alias("target"))


def plan(
    docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, taken."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    goal = targets(sized, weights, max_epochs).withColumnRenamed("source", "goal_source")
    rows = sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
    return rows.select("doc_id", "size", "source_size", "target", copies(F.col("doc_id"), seed).alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def copies(id_col: Column, seed: str) -> Column:
    """How often a document with this id is taken; needs source_size and target beside it."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw(id_col, seed) < rate - F.floor(rate)).cast("long")).cast("long")


def mixed(
    docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``docs`` with each row as often as it is taken (not at all, or up to max_epochs times)."""
    names = docs.columns
    sized = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    goal = targets(sized, weights, max_epochs).withColumnRenamed("source", "_goal_source")
    wide = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"))
    rows = wide.join(goal, F.col("_source").eqNullSafe(F.col("_goal_source")))
    taken = rows.withColumn("_n", copies(F.col("_id"), seed).cast("int")).where("_n > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).select(*[F.col("_row")[n].alias(n) for n in names])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS weight,
         source_size * 3 AS cap FROM sums
), cums AS (
  SELECT *, row_number() OVER o AS k,
         coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cap_before,
         (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight_from,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight, encode(source) NULLS LAST)
), level AS (
  SELECT min(k) AS k0 FROM cums WHERE cap * weight_from >= (total - cap_before) * weight
), goals AS (
  SELECT c.source, c.source_size,
         CASE WHEN l.k0 IS NULL OR c.k < l.k0 THEN c.cap::DOUBLE
              ELSE (c.total - f.cap_before)::DOUBLE * c.weight / f.weight_from END AS target
  FROM cums c CROSS JOIN level l LEFT JOIN cums f ON f.k = l.k0
), drawn AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)))::BIGINT AS taken
FROM drawn
"""
