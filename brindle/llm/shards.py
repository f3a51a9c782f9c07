"""Sharding into runs of near equal bytes by histogram sort.

Rows are ordered by a key: a hash of the text, so that equal texts are
neighbours, followed by a hash of the id. Candidate boundaries are the prefixes
of the key. Each round counts the exact bytes and rows of every prefix below the
open ones, over all partitions, and goes one level deeper only where a splitter
is not found to the tolerance, or where more rows share a prefix than one task
should take. The counts that reach the driver are bounded by the prefixes
opened, not by the rows. The rows are exchanged once, by their prefix; a prefix
lies in one shard, so the place of a row follows from the rows of the prefixes
before it and its place within.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from brindle import workspace
from brindle.llm.tasks import col, without

# Hexadecimal digits of the key: a level, those from the text, all of them.
LEVEL, OF_TEXT, DIGITS = 3, 9, 24

# How far a splitter may be off, as a share of a shard's bytes.
TOLERANCE = 0.002

# A prefix is opened if it holds this many times the mean rows of a first-level prefix.
CROWDED, LEAST_CROWD = 4, 64


def size(text: Column) -> Column:
    """UTF-8 bytes of a text (none if null) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _key(doc_id: Column, text: Column) -> Column:
    """Digits of the text's hash, then digits of a hash of the id and the row's place in its file.

    The place tells wholly equal rows apart; the key is written before it is used.
    """
    def digits(h: Column, n: int) -> Column:
        return F.substring(F.lpad(F.hex(h), 16, "0"), 1, n)

    row = F.xxhash64(doc_id.cast("string"), F.monotonically_increasing_id())
    return F.concat(digits(F.xxhash64(text), OF_TEXT), digits(row, DIGITS - OF_TEXT))


def _histogram(keys: DataFrame, open_prefixes: list[str], level: int) -> list:
    """(prefix, bytes, rows) of every prefix of ``level`` below the open ones, in order."""
    rows = keys
    if level > 1:
        parents = keys.sparkSession.createDataFrame([(p,) for p in open_prefixes], "parent string")
        parent = F.substring("key", 1, LEVEL * (level - 1))
        rows = keys.join(F.broadcast(parents), parent == F.col("parent"), "left_semi")
    prefix = F.substring("key", 1, LEVEL * level).alias("prefix")
    counted = rows.groupBy(prefix).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return sorted(counted.collect())


def _leaves(keys: DataFrame, shards: int) -> list[tuple[str, int, int, int]]:
    """(prefix, bytes below, bytes, rows) of prefixes that cover all keys, fine enough to be dealt."""
    first = _histogram(keys, [], 1)
    total = sum(r["bytes"] for r in first)
    crowd = max(LEAST_CROWD, CROWDED * -(-sum(r["rows"] for r in first) // 16**LEVEL))
    targets = [total * s / shards for s in range(1, shards)]
    tolerance = TOLERANCE * total / shards
    leaves, level, fresh, below = [], 1, first, {"": 0}
    while fresh:
        opened = {}
        at: dict[str, int] = {}
        for r in fresh:
            parent = r["prefix"][:-LEVEL]
            low = at.setdefault(parent, below[parent])
            at[parent] = low + r["bytes"]
            k = bisect_left(targets, low)
            holds = k < len(targets) and targets[k] < low + r["bytes"]
            deeper = level * LEVEL < DIGITS and r["rows"] > 1
            if deeper and ((holds and r["bytes"] > tolerance) or r["rows"] > crowd):
                opened[r["prefix"]] = low
            else:
                leaves.append((r["prefix"], low, r["bytes"], r["rows"]))
        level, below = level + 1, opened
        fresh = _histogram(keys, list(opened), level) if opened else []
    return sorted(leaves)


def assign(df: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot`` and ``grown_shard``.

    Shards take near equal bytes: a boundary is off by the tolerance or half a
    row at most. Slots count the rows of a shard from 0 without a gap, in the order
    of the key. A null text has 8 bytes and a null checksum; an empty one has the
    checksum 0. Repeated rows each get a place of their own. ``grown_shard`` is
    null, as this law moves rows among all shards.
    """
    spark = df.sparkSession
    rows = df.select(
        col(doc_id).alias("doc_id"),
        size(col(text)).alias("size"),
        F.crc32(col(text).cast("binary")).alias("text_crc32"),
        _key(col(doc_id), col(text)).alias("key"),
    )
    rows = workspace.materialize(rows, "keys")
    leaves = _leaves(rows, shards)
    total = sum(n for _, _, n, _ in leaves)
    placed, filled = [], [0] * shards
    for prefix, low, n, count in leaves:
        # the shard that holds the middle of the prefix
        shard = min(shards - 1, (2 * low + n) * shards // (2 * total))
        placed.append((prefix, shard, filled[shard]))
        filled[shard] += count
    schema = StructType(
        [StructField("prefix", StringType()), StructField("shard", IntegerType()), StructField("before", LongType())]
    )
    table = workspace.broadcast_within(workspace.materialize(spark.createDataFrame(placed, schema), "leaves"))
    lengths = sorted({len(p) for p, _, _ in placed})
    opened = {n: sorted({p[:n] for p, _, _ in placed if len(p) > n}) for n in lengths}
    prefix = F.substring("key", 1, lengths[-1] if lengths else LEVEL)
    for n in reversed(lengths[:-1]):
        prefix = F.when(F.substring("key", 1, n).isin(opened[n]), prefix).otherwise(F.substring("key", 1, n))
    dealt = rows.withColumn("prefix", prefix).join(table, "prefix")
    within = Window.partitionBy("prefix").orderBy("key", "doc_id", "text_crc32")
    return dealt.select(
        F.col("doc_id").alias(doc_id),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.row_number().over(within) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write(df: DataFrame, path: str, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the rows of ``df`` as Parquet, one directory per shard, files within ordered by slot.

    Ids must be unique here, as rows are matched to their places by id. Every
    shard is spread over several tasks by ranges of its slots.
    """
    kept = without(df, ["shard", "slot"])
    places = assign(df, shards, doc_id, text).select(col(doc_id).alias("placed_id"), "shard", "slot")
    whole = df.select(*map(col, kept)).join(places, col(doc_id).eqNullSafe(F.col("placed_id"))).drop("placed_id")
    parts = max(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    whole.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
