"""Shared helpers: words, stage tables in the shared folder, partition counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: White space between words, as a character class of both Java and RE2.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a temporary one only in local mode (tests)."""
    return shared_folder(spark)


def stage_table(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lost executors lose nothing, lineage ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Bound the Arrow batches of this session by bytes as well as rows, unless it has a bound: long texts fill memory otherwise."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > 1 << 28:
        spark.conf.set(key, limit)


def group_count(df: DataFrame, target_bytes: int = 8 << 20) -> int:
    """Groups to deal rows into: follows the size of the tables read and the session's shuffle partitions."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    held = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(held, min(size // target_bytes, 1 << 20), 1)
