"""Joins that hold for skewed keys and tables too large to broadcast.

A plain inner ``DataFrame.join`` needs no helper: adaptive execution splits the
skewed partitions of either side. The functions here cover what it does not:
outer joins whose hot key is on the side that may not be split, a join that must
not shuffle, and broadcasts whose size has to be checked first.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from brindle.operators.windows import MAX_GROUP_ROWS
from brindle.workspace import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    broadcast_within,
    fits_broadcast,
    materialize,
    measured,
    scratch_path,
)

_LEFT_SALT, _RIGHT_SALT = "_left_salt", "_right_salt"

# All names that Spark takes, without underscores.
JOIN_KINDS = {
    "inner": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """Enrich ``facts`` from ``lookup``, broadcast if its counted size allows."""
    return facts.join(broadcast_within(lookup), on, how)


def join_and_sum(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    by: list[str],
    sums: dict[str, Column],
    max_lookup_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Sums of fact columns, grouped by columns of ``lookup``, whose key is unique.

    A lookup small enough is broadcast and the facts are summed as they are read.
    Otherwise they are summed per key before the join, so that a hot key arrives
    there as one row and its facts are combined on the map side.
    """
    matched = F.col(fact_key) == F.col(lookup_key)
    rows = facts.select(fact_key, *[c.alias(name) for name, c in sums.items()])
    totals = [F.sum(name).alias(name) for name in sums]
    if fits_broadcast(lookup, max_lookup_rows):
        joined = rows.join(F.broadcast(lookup), matched)
    else:
        joined = rows.groupBy(fact_key).agg(*totals).join(lookup, matched)
    return joined.groupBy(*by).agg(*totals)


def sort_merge_join(left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """Join by sorting both sides, whatever the broadcast threshold of the session."""
    return left.join(right.hint("merge"), on, how)


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    The keys of ``right`` are made distinct first, so a frequent one is one row.
    """
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")


# Pairs of one key that one task makes, as a multiple of the rows it may hold.
PAIRS_PER_ROW = 16


class HotKeys(NamedTuple):
    """Keys with too many rows or pairs for one task, with their rows on both sides and their grid of cells.

    Whether a side has no other keys, and the cells of the key that has most.
    """

    keys: DataFrame
    all_left: bool
    all_right: bool
    left_cells: int
    right_cells: int


def _hot_keys(left: DataFrame, right: DataFrame, on: str, max_group_rows: int) -> HotKeys | None:
    """The keys that need cells, or None: one pass over the keys of both sides, combined on the map side.

    A cell has at most ``max_group_rows`` rows of a side and ``PAIRS_PER_ROW`` times as
    many pairs; the cells of a key are cut so that the fewest copies are made.
    """
    most_pairs = max_group_rows * PAIRS_PER_ROW
    sides = [side.select(on, F.lit(i).alias("_side")) for i, side in enumerate((left, right))]
    in_left, in_right = (F.count(F.when(F.col("_side") == i, 1)) for i in (0, 1))
    both = sides[0].union(sides[1]).groupBy(on).agg(in_left.alias("_l"), in_right.alias("_r"))
    whole = Observation()
    both = both.observe(whole, F.coalesce(F.sum("_l"), F.lit(0)).alias("left"), F.coalesce(F.sum("_r"), F.lit(0)).alias("right"))
    pairs = F.col("_l").cast("double") * F.col("_r")
    hot = both.filter((F.greatest("_l", "_r") > max_group_rows) | (F.col(on).isNotNull() & (pairs > most_pairs)))
    # left rows are copied to each column of cells, right rows to each row of them
    cells = F.ceil(pairs / most_pairs)
    columns = F.greatest(F.ceil(F.sqrt(cells * F.col("_r") / F.col("_l"))), F.ceil(F.col("_r") / max_group_rows))
    columns = F.least(columns, F.col("_r"))
    lines = F.least(F.greatest(F.ceil(cells / columns), F.ceil(F.col("_l") / max_group_rows)), F.col("_l"))
    paired = (F.col("_l") > 0) & (F.col("_r") > 0) & F.col(on).isNotNull()
    sized = hot.withColumns({"_left_cells": F.when(paired, lines.cast("bigint")), "_right_cells": F.when(paired, columns.cast("bigint"))})
    found, size = measured(
        sized, "hot-keys", left=F.sum("_l"), right=F.sum("_r"), lines=F.max("_left_cells"), columns=F.max("_right_cells")
    )
    if not size["rows"]:
        return None
    if size["rows"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES:
        found = F.broadcast(found)
    rows = whole.get
    return HotKeys(found, size["left"] == rows["left"], size["right"] == rows["right"], size["lines"], size["columns"])


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Equi-join on a column of both sides, with salting for the hot keys only.

    ``how`` is any name Spark has for an inner, outer, semi or anti join. The
    result has the columns of Spark's join on a column name, the sides may share
    other column names as well. Semi and anti joins meet the distinct keys of the
    right side only. Keys with at most ``max_group_rows`` rows on either side and
    ``PAIRS_PER_ROW`` times as many pairs are joined plainly. The rows of a hot key are
    spread over a grid of cells: each left row goes to one row of cells, each right row
    to one column, so that every pair meets in exactly one cell, no cell holds more
    than about ``max_group_rows`` rows of a side, and none makes more pairs than that
    bound. A hot key whose other side is empty has no pairs, and its rows are kept or
    dropped as ``how`` says.
    """
    how = JOIN_KINDS[how.lower().replace("_", "")]
    if how in ("left_semi", "left_anti"):
        return left.join(right.select(on).distinct(), on, how)
    plain = left.join(right, on, how)
    hot = _hot_keys(left, right, on, max_group_rows)
    if hot is None:
        return plain

    # Shared names would be ambiguous from here on; the sides have the key first in the result.
    names = plain.columns
    left, right = (
        side.select(on, *[F.col(c).alias(f"_{mark}{i}") for i, c in enumerate(side.columns) if c != on])
        for side, mark in ((left, "left"), (right, "right"))
    )
    columns = left.columns + right.columns[1:]
    return _split_join(left, right, on, how, hot).select(*columns).toDF(*names)


def _split_join(left: DataFrame, right: DataFrame, on: str, how: str, hot: HotKeys) -> DataFrame:
    """:func:`skew_join` where the sides share no other name than that of the key."""
    columns = left.columns + right.columns[1:]

    # Null keys match nothing and would all meet in one task.
    (left, left_null), (right, right_null) = (
        (side.filter(F.col(on).isNotNull()), side.filter(F.col(on).isNull()))
        for side in (left, right)
    )
    keys = hot.keys.filter(F.col(on).isNotNull())
    paired = keys.filter("_left_cells IS NOT NULL").select(on, "_left_cells", "_right_cells")
    by_left, by_right = (_LEFT_SALT, "_left_cells"), (_RIGHT_SALT, "_right_cells")
    parts = [
        _in_cells(left, paired, on, by_left, by_right, hot.left_cells > 1)
        .join(_in_cells(right, paired, on, by_right, by_left, hot.right_cells > 1), [on, _LEFT_SALT, _RIGHT_SALT])
        .select(*columns)
    ]
    all_hot = (hot.all_left, hot.all_right)
    nothing_cold = {"inner": any(all_hot), "left": hot.all_left, "right": hot.all_right, "full": all(all_hot)}
    if not nothing_cold[how]:
        cold_left, cold_right = (side.join(keys.select(on), on, "left_anti") for side in (left, right))
        parts.append(cold_left.join(cold_right, on, how))
    if how in ("left", "full"):
        parts.append(left.join(keys.filter("_r = 0"), on, "left_semi").unionByName(left_null))
    if how in ("right", "full"):
        parts.append(right.join(keys.filter("_l = 0"), on, "left_semi").unionByName(right_null))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _in_cells(
    side: DataFrame,
    cells: DataFrame,
    on: str,
    own: tuple[str, str],
    other: tuple[str, str],
    is_hot: bool = True,
) -> DataFrame:
    """The hot rows of one side: one salt of its own, one copy per salt of the other side.

    The own salt comes from the row's place in the input, which also spreads
    identical rows. It is written down before the copies are made: a salt that
    changed in a repeated task would lose or double rows. A side without a hot key
    of its own has one salt only.
    """
    (own_salt, own_cells), (other_salt, other_cells) = own, other
    matched = side.join(cells, on)
    if is_hot:
        place = F.pmod(F.monotonically_increasing_id(), F.col(own_cells))
        salted = materialize(matched.withColumn(own_salt, place), "salted")
    else:
        salted = matched.withColumn(own_salt, F.lit(0).cast("bigint"))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_cells) - 1))
    return salted.withColumn(other_salt, copies).drop(own_cells, other_cells)


def bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Save ``df`` as a table of sorted buckets, one file each, and read it back.

    No more buckets than the session allows (``spark.sql.sources.bucketing.maxBuckets``).
    Writing them shuffles ``df``, which pays when several joins read them. The files go to the shared folder. The catalog entry is removed at once: the
    returned frame keeps the bucketed layout without it.
    """
    spark = df.sparkSession
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", scratch_path(spark, table))
        .saveAsTable(table)
    )
    saved = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return saved


def bucketed_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    buckets: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Inner join of two tables saved in the same buckets: both are shuffled to write them, the join is not.

    A bucket is read by one task, so keys too large for one go through
    :func:`skew_join` instead of the buckets. Null keys match nothing and are left out.
    """
    left, right = (side.filter(F.col(on).isNotNull()) for side in (left, right))
    hot = _hot_keys(left, right, on, max_group_rows)
    rows, others = left, right
    if hot is not None:
        keys = hot.keys.select(on)
        rows, others = (side.join(keys, on, "left_anti") for side in (left, right))
    name = uuid.uuid4().hex
    joined = (
        bucketed(rows, f"bucketed_left_{name}", on, buckets)
        .hint("merge")
        .join(bucketed(others, f"bucketed_right_{name}", on, buckets), on)
    )
    if hot is None:
        return joined
    hot_left, hot_right = (side.join(keys, on, "left_semi") for side in (left, right))
    return joined.unionByName(skew_join(hot_left, hot_right, on, "inner", max_group_rows))


class Buckets(NamedTuple):
    """A table kept in sorted buckets of a key, and its rows of keys too large for one bucket; None for none."""

    rows: DataFrame
    hot: DataFrame | None
    key: str


HOT_TABLE = "_hot"


def save_buckets(
    df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, max_group_rows: int = MAX_GROUP_ROWS
) -> Buckets:
    """Write ``df`` as the catalog table ``name``, bucketed and sorted by ``key``, and its hot keys as a table beside it.

    Both replace tables of their names. They stay in the catalog for any number of
    joins; the files go to ``path``, or to the application's shared folder. A bucket is
    read by one task: keys with more than ``max_group_rows`` rows, and null keys, which
    would share one bucket, go to the table beside it.
    """
    spark = df.sparkSession
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    too_large = F.col(key).isNull() | (F.col("_rows") > max_group_rows)
    found, size = measured(counts.filter(too_large).select(key), f"{name}-hot")
    base = path or scratch_path(spark, name)
    for table in (name, name + HOT_TABLE):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if size["rows"]:
        found = F.broadcast(found) if size["rows"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES else found
        renamed = found.withColumnRenamed(key, "_hot_key")
        is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
        df.join(renamed, is_hot, "left_semi").write.option("path", f"{base}/hot").saveAsTable(name + HOT_TABLE)
        df = df.join(renamed, is_hot, "left_anti")
    ordered = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    ordered.option("path", f"{base}/rows").saveAsTable(name)
    return load_buckets(spark, name, key)


def load_buckets(spark: SparkSession, name: str, key: str) -> Buckets:
    """The tables that :func:`save_buckets` has written under ``name``."""
    hot = spark.table(name + HOT_TABLE) if spark.catalog.tableExists(name + HOT_TABLE) else None
    return Buckets(spark.table(name), hot, key)


def has_buckets(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def join_buckets(left: Buckets, right: Buckets, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Inner join of two tables kept in the same buckets of the same key: without a shuffle or a write.

    Only keys that are hot on a side leave the buckets: they meet in :func:`skew_join`.
    """
    on = left.key
    joined = left.rows.hint("merge").join(right.rows, on)
    if left.hot is None and right.hot is None:
        return joined
    hot = [side.hot.filter(F.col(on).isNotNull()).select(on) for side in (left, right) if side.hot is not None]
    keys = broadcast_within(materialize(reduce(DataFrame.unionByName, hot).distinct(), "hot-keys"))

    def of_hot(side: Buckets) -> DataFrame:
        rows = side.rows.join(keys, on, "left_semi")
        return rows if side.hot is None else rows.unionByName(side.hot.filter(F.col(on).isNotNull()))

    return joined.unionByName(skew_join(of_hot(left), of_hot(right), on, "inner", max_group_rows))
