"""Text and array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: Column | str) -> Column:
    """The text split at single spaces."""
    return F.split(text, " ")


def word_count(df: DataFrame, text: str) -> DataFrame:
    """How often each space-separated word occurs, over whole texts.

    The aggregation combines on the map side, so a frequent word costs no more
    shuffle than a rare one.
    """
    return (
        df.select(F.explode(words(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def flat_map(df: DataFrame, value: str, factors: list[int], name: str) -> DataFrame:
    """One row per factor with ``value * factor``."""
    products = F.array(*[F.col(value) * factor for factor in factors])
    return df.withColumn(name, F.explode(products))


def array_size(values: Column | str) -> Column:
    return F.size(values).cast("bigint")


def element(values: Column | str, position: int) -> Column:
    """1-based element, null when out of range."""
    return F.try_element_at(values, F.lit(position))
