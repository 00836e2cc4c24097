"""Rows that are fixed before they are used: staging tables in the shared folder.

What a job numbers, or writes into the table that it has read, is written first. A retry then
sees the same rows, whatever executors are lost, and no table is read and written at once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def staging_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the driver and all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="carbonsieve-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in a folder, or one without rows where there is no such folder yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def small_side(table: DataFrame, rows: int = 500_000) -> DataFrame:
    """A staged table of narrow rows, marked for broadcast if it has at most so many; beyond that
    Spark joins it by a shuffle."""
    return F.broadcast(table) if table.count() <= rows else table
