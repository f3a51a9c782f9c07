"""Grouped, distinct, pivoted and approximate aggregates.

Spark combines these on the map side, so a key that holds a large share of the
rows sends one partial row per map task and needs no salting.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.numbers import exact_doubles
from brindle.operators.windows import top_n


def pivot(
    df: DataFrame, by: Sequence[str], column: str, values: Sequence[str] | None, aggregate: Column
) -> DataFrame:
    """One column per value, in the order of ``values`` or else sorted.

    Naming the values saves the job that looks for them; a row with a value that
    is not named is an error, as its share of the result would be lost. Null is
    named by None or found like any other value. Without names Spark holds the
    number of values to ``spark.sql.pivotMaxValues``.
    """
    if values is None:
        return df.groupBy(*by).pivot(column).agg(aggregate)
    named = reduce(lambda a, b: a | b, [F.col(column).eqNullSafe(F.lit(v)) for v in values], F.lit(False))
    lost = F.raise_error(F.concat(F.lit(f"pivot: {column} has a value that is not named: "), F.col(column).cast("string")))
    checked = df.withColumn(column, F.when(named | F.col(column).isNull(), F.col(column)).otherwise(lost.cast(df.schema[column].dataType)))
    return checked.groupBy(*by).pivot(column, list(values)).agg(aggregate)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``: ``dropDuplicates`` with a defined survivor."""
    return top_n(df, keys, order, 1, "_place").drop("_place")


def approximate_distinct(df: DataFrame, column: str, rsd: float = 0.05) -> DataFrame:
    """Exact and approximate distinct counts side by side.

    Two aggregates on purpose: in one, the exact count would group by the column
    first and carry a sketch for every value of it.
    """
    sketch = df.select(F.approx_count_distinct(column, rsd)).scalar()
    return df.agg(F.count_distinct(column).alias("exact")).withColumn("approximate", sketch)


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, log_size: int = 12) -> DataFrame:
    """One sketch of the distinct values of ``column`` per group, to be stored and merged later.

    2^``log_size`` registers bound a sketch's bytes whatever it has seen; nulls are not counted.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, log_size).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str], name: str = "distinct") -> DataFrame:
    """Distinct values per coarser group, from stored sketches alone."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def distinct_ids(df: DataFrame, by: Sequence[str], column: str, name: str = "distinct") -> DataFrame:
    """Exact distinct counts of non-negative 64-bit ids per group, by bitmaps of 32,768 ids.

    A task combines its ids into bitmaps before anything is shuffled, so dense ids (row
    numbers, order keys) travel as a bit each. Sparse ones would take a bitmap for
    each id: for those ``count_distinct`` is the better plan. Nulls are not counted.
    """
    rows = df.where(F.col(column).isNotNull()).withColumn("_bucket", F.bitmap_bucket_number(F.col(column)))
    bits = rows.groupBy(*by, "_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column))).alias("_bits"))
    return bits.groupBy(*by).agg(F.sum(F.bitmap_count("_bits")).alias(name))


def sum_doubles(df: DataFrame, by: Sequence[str], column: str, name: str = "total") -> DataFrame:
    """Exact sums of any doubles per group, rounded once, whatever the order of rows."""
    exact = exact_doubles(df, column)
    summed = df.groupBy(*by).agg(*[F.sum(c).alias(n) for n, c in exact.addends.items()])
    return summed.withColumn(name, exact.total(F.col)).drop(*exact.addends)


def skew_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their ratio to the mean, heaviest first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    mean = counts.select(F.avg("count")).scalar()
    return counts.withColumn("ratio_to_mean", F.col("count") / mean).orderBy(
        F.col("count").desc(), F.col(key)
    )


def late_cutoff(df: DataFrame, time: str, interval: str) -> DataFrame:
    """Rows no older than ``interval`` before the newest row."""
    newest = df.select(F.max(time)).scalar()
    return df.filter(F.col(time) >= newest - F.expr(f"INTERVAL {interval}"))
