"""Physical layout: partitioned files, incremental overwrite, caching, partition counts."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, redirect_stdout

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Write one directory per combination of the ``by`` columns.

    The rebalance hint gathers the rows of a directory, so that small ones get one
    file instead of one per task, and splits large ones at the advisory size, so
    that a value holding most rows is still written by many tasks.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the directories that occur in ``df``.

    The mode is set on this write, so the session stays as it is.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def list_partitions(
    spark: SparkSession, path: str, by: Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """The directories of a partitioned dataset with their rows; reads no data column.

    Directory names carry no types: without the ``schema`` that was written Spark
    guesses them, and codes such as 007 and 07 become one number.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


@contextmanager
def cached(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """``df`` kept for repeated use inside the block, and released after it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def release_all(spark: SparkSession) -> None:
    """Drop every cached frame and table of the session, whoever cached it."""
    spark.catalog.clearCache()


def partition_count(df: DataFrame) -> DataFrame:
    """Rows and non-empty partitions."""
    per_partition = df.groupBy(F.spark_partition_id().alias("_pid")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return per_partition.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
    )


def partition_skew(df: DataFrame) -> DataFrame:
    """Rows of every non-empty partition and their ratio to the mean, fullest first."""
    rows = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
    mean = rows.select(F.avg("rows")).scalar()
    return rows.withColumn("ratio_to_mean", F.col("rows") / mean).orderBy(F.desc("rows"), "partition")


def adaptive_settings(spark: SparkSession) -> DataFrame:
    """Adaptive execution settings in force, as (key, value)."""
    settings = spark.sql("SET -v").select("key", "value")
    return settings.filter(F.col("key").startswith("spark.sql.adaptive."))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as :meth:`DataFrame.explain` prints it."""
    printed = io.StringIO()
    with redirect_stdout(printed):
        df.explain(mode)
    return printed.getvalue()
