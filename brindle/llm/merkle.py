"""Merkle manifest of a dataset: leaves per row, a tree per group, one root, a proof for every row.

Rows become leaves, numbered within their group by a range partitioning. Every
level is a sibling-shift self-join: each node computes the indices of its
siblings (slot offsets 1 to arity - 1, around the run), and an equijoin on
(group, index) brings every node the digests of its own. The rows in slot zero
then hold the whole run and emit the parents. The subroots of the groups are the
leaves of a last tree. Proofs are handed down from the root, one join a level.

Only digests move: a leaf's text is hashed where it is read. A level holds an
eighth of the rows of the one below, and a group of any size is spread over all
tasks, as nodes are dealt by (group, index).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle import workspace
from brindle.llm.tasks import col, without

ARITY = 8

DIGEST_BYTES = 32

# Rows of a segment, which one task sorts and numbers.
SEGMENT_ROWS = 1_000_000

OUTPUTS = ["position", "group_rows", "subroot", "root", "path"]


def encoded(column: Column) -> Column:
    """A field as it is hashed: its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields in their order."""
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _run(idx: Column, arity: int) -> Column:
    return F.shiftright(idx, arity.bit_length() - 1)


def _numbered(df: DataFrame, group: Column, order: Column, leaf: Column) -> DataFrame:
    """Rows with ``g``, the number of their group, ``idx``, their place in it from 0, and ``n``, its rows.

    The rows are written with their place in the input, which tells identical ones
    apart, then laid out by one range partitioning and written again, so that neither
    places nor sampled borders change between counting the segments and numbering them.
    """
    spark = df.sparkSession
    placed = workspace.materialize(
        df.withColumns({"group": group, "order": order, "hash": F.unhex(leaf), "place": F.monotonically_increasing_id()}), "merkle-rows"
    )
    segments = max(-(-placed.count() // SEGMENT_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    layout = [F.col("group").asc_nulls_first(), F.col("order").asc_nulls_first(), F.col("hash").asc(), F.col("place").asc()]
    laid = workspace.materialize(
        placed.repartitionByRange(segments, *layout)
        .sortWithinPartitions(*layout)
        .withColumn("segment", F.spark_partition_id())
        .withColumn("offset", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("order", "place"),
        "merkle-segments",
    )
    # one row per segment and group in it
    counts = laid.groupBy("segment", "group").agg(F.count(F.lit(1)).alias("rows"), F.min("offset").alias("first"))
    of_group = Window.partitionBy("group")
    earlier = of_group.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "segment", "group", "first",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(of_group).alias("n"),
    )
    counts = workspace.materialize(counts.withColumn("opens", (F.col("before") == 0).cast("long")), "merkle-counts")
    # a group's number is the count of groups that open up to it; one row per segment here
    opened = counts.groupBy("segment").agg(F.sum("opens").alias("opens"))
    preceding = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.select("segment", F.coalesce(F.sum("opens").over(preceding), F.lit(0)).alias("open_before"))
    through = Window.partitionBy("segment").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    shifts = counts.join(opened, "segment").select(
        F.col("segment").alias("of_segment"), F.col("group").alias("of_group"), "n",
        (F.col("before") - F.col("first")).alias("shift"),
        (F.col("open_before") + F.sum("opens").over(through) - 1).alias("g"),
    )
    shifts = workspace.summary(shifts, "merkle-shifts")
    matched = (F.col("segment") == F.col("of_segment")) & F.col("group").eqNullSafe(F.col("of_group"))
    joined = laid.join(shifts, matched).withColumn("idx", F.col("offset") + F.col("shift"))
    return joined.drop("segment", "offset", "of_segment", "of_group", "shift", "group")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with the digests of their siblings, one after the other in the order of their slots."""
    slot = F.col("idx").bitwiseAND(F.lit(arity - 1))
    shifts = F.sequence(F.lit(1), F.lit(arity - 1))
    shifted = nodes.select("g", "n", "idx", F.col("hash").alias("sibling"), slot.cast("int").alias("slot"), F.explode(shifts).alias("shift"))
    target = F.col("idx") - F.col("slot") + F.pmod(F.col("slot") + F.col("shift"), F.lit(arity))
    asked = shifted.select("g", target.alias("idx"), "slot", "sibling", "n").where(F.col("idx") < F.col("n"))
    lists = asked.groupBy("g", "idx").agg(F.array_sort(F.collect_list(F.struct("slot", "sibling"))).alias("list"))
    joined_up = F.unhex(F.array_join(F.transform("list", lambda s: F.hex(s["sibling"])), ""))
    siblings = lists.select("g", "idx", joined_up.alias("siblings"))
    return nodes.join(siblings, ["g", "idx"], "left").withColumn("siblings", F.coalesce("siblings", F.lit(b"")))


def _climb(nodes: DataFrame, most: int, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The written levels of trees of up to ``most`` leaves, and per level the nodes that stand alone."""
    levels, alone = [], []
    while True:
        alone.append(nodes.where("n = 1").select("g", "hash"))
        if most <= 1:
            return levels, alone
        levels.append(workspace.materialize(_with_siblings(nodes.where("n > 1"), arity), "merkle-level"))
        most = -(-most // arity)
        zero = levels[-1].where(F.col("idx").bitwiseAND(F.lit(arity - 1)) == 0)
        nodes = zero.select(
            "g", _run(F.col("idx"), arity).alias("idx"), _run(F.col("n") + (arity - 1), arity).alias("n"),
            _digest(F.concat(hex_text(F.col("hash")), hex_text(F.col("siblings")))).alias("hash"),
        )


def _step(arity: int) -> Column:
    """A level of a path: the node's slot, and its siblings."""
    slot = F.col("idx").bitwiseAND(F.lit(arity - 1)).cast("int")
    return F.array(F.struct(slot.alias("slot"), F.col("siblings").alias("siblings")))


def _descend(levels: list[DataFrame], alone: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The first level's rows (and lone nodes' groups) with the paths to the root.

    ``tops`` has ``g``, ``path`` and ``subroot`` of every tree's last node. Returns
    the rows of ``levels[0]`` with ``path`` and ``subroot``.
    """
    paths = None
    for level in range(len(levels), 0, -1):
        ended = alone[level].select("g").join(tops, "g").withColumn("idx", F.lit(0).cast("long"))
        above = ended if paths is None else paths.unionByName(ended)
        above = above.select(F.col("g").alias("of_g"), F.col("idx").alias("of_idx"), F.col("path").alias("rest"), "subroot")
        here = levels[level - 1]
        joined = here.join(above, (F.col("g") == F.col("of_g")) & (_run(F.col("idx"), arity) == F.col("of_idx")))
        paths = joined.withColumn("path", F.concat(_step(arity), "rest")).drop("of_g", "of_idx", "rest")
        if level > 1:
            paths = workspace.materialize(paths.select("g", "idx", "path", "subroot"), "merkle-paths")
    return paths


def prove(df: DataFrame, group: str, order: str, leaf: str = "leaf", arity: int = ARITY) -> DataFrame:
    """``df`` with each row's place in the tree and the way from its leaf to the root.

    ``leaf`` holds lowercase hex SHA-256 digests, never null (see :func:`leaf_digest`).
    Per ``group``, leaves ascend by ``order``; while several nodes remain, each run
    of ``arity`` (a power of two; the last run may be shorter) becomes the digest of
    its hex texts. The subroots, ordered by group (null first, bytewise), give the
    root in the same way. New columns, which replace columns of their names:
    ``position`` (from 0) and ``group_rows``, ``subroot`` and ``root`` (hex), and
    ``path``: per level the node's ``slot`` and its ``siblings``, raw digests in order.

    A null group is a group of its own; null orders come first; ties in ``order`` are
    placed by leaf, so repeated rows are leaves side by side that share every digest's
    value but not their place. An empty table has no rows and no root.
    """
    if arity < 2 or arity & (arity - 1):
        raise ValueError("arity has to be a power of two")
    kept = without(df, OUTPUTS)
    slim = df.select(*(col(c).alias(f"kept_{i}") for i, c in enumerate(kept)))
    at = {c: F.col(f"kept_{i}") for i, c in enumerate(kept)}
    leaves = workspace.materialize(_numbered(slim, at[group], at[order], at[leaf]), "merkle-leaves")
    totals = leaves.agg(F.max("n"), F.max("g")).first()
    most, n_groups = totals[0] or 0, (totals[1] if totals[1] is not None else -1) + 1

    levels, alone = _climb(leaves, most, arity)
    subroots = reduce(DataFrame.unionByName, alone).select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(n_groups).cast("long").alias("n"), "hash")
    subroots = workspace.materialize(subroots, "merkle-subroots")
    top_levels, top_alone = _climb(subroots, n_groups, arity)
    last = top_alone[-1].first()
    root = hex_text(F.lit(last["hash"] if last else None).cast("binary"))

    path_type = "array<struct<slot:int,siblings:binary>>"
    start = top_alone[-1].select("g", F.array().cast(path_type).alias("path"), F.col("hash").alias("subroot"))
    if top_levels:
        tops = _descend(top_levels, top_alone, start, arity)
        tops = tops.select(F.col("idx").alias("g"), "path", F.col("hash").alias("subroot"))
    else:
        tops = subroots.select(F.col("idx").alias("g"), F.array().cast(path_type).alias("path"), F.col("hash").alias("subroot"))
    tops = workspace.materialize(tops, "merkle-tops")

    lone = leaves.where("n = 1").join(tops, "g")
    parts = [lone] if not levels else [_descend(levels, alone, tops, arity).drop("siblings"), lone]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(
        *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(kept)),
        F.col("idx").alias("position"), F.col("n").alias("group_rows"),
        hex_text(F.col("subroot")).alias("subroot"), root.alias("root"), "path",
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 of the hex digests of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: hex_text(s["siblings"])), "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` (hex) and its siblings give."""

    def parent(digest: Column, step: Column) -> Column:
        left = step["slot"] * DIGEST_BYTES
        before = F.substring(step["siblings"], F.lit(1), left)
        after = F.substring(step["siblings"], left + 1, F.octet_length(step["siblings"]))
        return F.sha2(F.concat(hex_text(before), digest, hex_text(after)).cast("binary"), 256)

    return F.aggregate(path, leaf, parent)
