"""Ranking, offset and framed window functions that hold for oversized groups.

A plain window sorts each group in one task, and a window without a partition
sorts the whole table in one task. Here groups of up to ``max_group_rows`` rows
use the plain window. Larger groups are laid out once by a range partitioning on
(keys, order), which gives every row its exact position; each function then works
on fixed-length chunks of positions and adds what the earlier chunks carry over.
Results are the same either way.

``order`` lists column names, ``"-name"`` meaning descending. End it with a unique
column where the result depends on the order of ties: it also tells apart the rows
that the range partitioning is to spread.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce, wraps
from inspect import signature
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.functions.numbers import ExactSum, exact_doubles, from_parts, unit_parts
from brindle.workspace import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, ROWS_PER_PARTITION, counted, materialize, measured, partitions_for, summary, variable_bytes

# A group beyond it is split.
MAX_GROUP_ROWS = ROWS_PER_PARTITION

# So is one with more bytes of variable width.
MAX_GROUP_BYTES = 1 << 30

# Without keys the table is one group, and one task does all the work: split earlier.
MAX_TABLE_ROWS = 1_000_000

# A range partition is worth a task of its own.
SEGMENT_ROWS = 100_000

# More map tasks than a shuffle has.
MOST_TASKS = 1_000_000

_SEGMENT, _OFFSET, _POSITION = "_segment", "_offset", "_position"
_CHUNK, _COPY, _OUTPUT, _PLACE = "_chunk", "_copy", "_output", "_place_of_row"


def _replacing(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let the output take the place of a column of its name, whichever form the operator takes."""
    takes = signature(operator)

    @wraps(operator)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        bound = takes.bind(df, *args, **options)
        bound.apply_defaults()
        name = bound.arguments["name"]
        if name.lower() not in {c.lower() for c in df.columns}:
            return operator(df, *args, **options)
        bound.arguments["name"] = _OUTPUT
        done = operator(*bound.args, **bound.kwargs)
        return done.withColumn(name, F.col(_OUTPUT)).drop(_OUTPUT)

    return run


def order_names(order: Sequence[str]) -> list[str]:
    return [name.removeprefix("-") for name in order]


def order_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in order]


def _same_keys(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality: a window treats null keys as one group."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def _attach(df: DataFrame, extra: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` with the other columns of ``extra``, matched null-safely on ``names``."""
    renamed = extra.select(
        *[F.col(n).alias(f"_m_{n}") for n in names],
        *[F.col(n) for n in extra.columns if n not in names],
    )
    matched = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_m_{n}")) for n in names])
    return df.join(renamed, matched, how).drop(*[f"_m_{n}" for n in names])


class Groups(NamedTuple):
    """Rows of the groups one task can hold, and rows of larger groups; None for neither.

    ``bound`` is how many rows of the larger groups a task can hold.
    """

    small: DataFrame | None
    large: DataFrame | None
    large_rows: int
    bound: int


def split_size(rows: int, parts: int = 64) -> int:
    """A group size that cuts ``rows`` rows into ``parts`` parts, or more of the default size."""
    return min(max(rows // parts, 1), MAX_GROUP_ROWS)


def _bound(max_group_rows: int, rows: int, size: int) -> int:
    """Rows of average width that are within both bounds of a group."""
    return max(min(max_group_rows, MAX_GROUP_BYTES * rows // size if size else max_group_rows), 1)


def split_groups(
    df: DataFrame, keys: Sequence[str], max_group_rows: int, known: tuple[int, int] | None = None
) -> Groups:
    """Groups beyond ``max_group_rows`` rows or ``MAX_GROUP_BYTES`` apart from the rest.

    One pass counts the table; only if it is larger than a group may be, a second
    one counts the groups, combined on the map side, and measures those it finds.
    ``known`` are the rows and bytes of a table that was counted before.
    """
    rows, size = known or counted(df)
    if not keys:
        bound = _bound(max_group_rows, rows, size)
        whole = rows <= min(bound, MAX_TABLE_ROWS)
        return Groups(df, None, 0, bound) if whole else Groups(None, df, rows, bound)
    if rows <= max_group_rows and size <= MAX_GROUP_BYTES:
        return Groups(df, None, 0, max_group_rows)
    lengths = variable_bytes(df) if size > MAX_GROUP_BYTES else None
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), (F.lit(0) if lengths is None else F.sum(lengths)).alias("_bytes")
    )
    too_large = (F.col("_rows") > max_group_rows) | (F.col("_bytes") > MAX_GROUP_BYTES)
    found, of_large = measured(counts.filter(too_large), "oversized", in_rows=F.sum("_rows"), in_bytes=F.sum("_bytes"))
    if not of_large["rows"]:
        return Groups(df, None, 0, max_group_rows)
    bound = _bound(max_group_rows, of_large["in_rows"], of_large["in_bytes"])
    if of_large["in_rows"] == rows:
        return Groups(None, df, rows, bound)
    found = found.select(*keys)
    if of_large["rows"] <= MAX_BROADCAST_ROWS and of_large["bytes"] <= MAX_BROADCAST_BYTES:
        found = F.broadcast(found)
    is_large = _same_keys(df, found, keys)
    return Groups(df.join(found, is_large, "left_anti"), df.join(found, is_large, "left_semi"), of_large["in_rows"], bound)


def _over_groups(
    df: DataFrame,
    keys: Sequence[str],
    max_group_rows: int,
    small_form: Callable[[DataFrame], DataFrame],
    large_form: Callable[[DataFrame, int, int], DataFrame],
    known: tuple[int, int] | None = None,
) -> DataFrame:
    """``small_form(rows)`` and ``large_form(rows, how many, rows per task)`` on the groups they are for."""
    small, large, large_rows, bound = split_groups(df, keys, max_group_rows, known)
    if large is None:
        return small_form(small)
    done = large_form(large, large_rows, bound)
    return done if small is None else small_form(small).unionByName(done)


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    rows: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact 1-based position of each of the ``rows`` rows in its group, of any size.

    The rows are written with their place in the input, which tells identical ones
    apart, then range-partitioned once and written again: neither the places nor the
    sampled range bounds may change between counting the segments and numbering the rows.
    """
    placed = materialize(df.withColumn(_PLACE, F.monotonically_increasing_id()), "places")
    # The hash spreads rows that tie in ``order`` but differ elsewhere, the place all others.
    hashed = F.xxhash64(*[c for c, t in df.dtypes if "map<" not in t])
    layout = [*[F.col(k).asc() for k in keys], *order_columns(order), hashed.asc(), F.col(_PLACE).asc()]
    # A number that is asked for is not coalesced: no segment holds more than a group may.
    session = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // SEGMENT_ROWS)
    needed = -(-rows // min(max_group_rows, ROWS_PER_PARTITION))
    # below a thousand rows each, sixteen are enough
    segments = max(min(needed, max(16, rows // 1000)), session, 1)
    ordered = placed.repartitionByRange(segments, *layout).sortWithinPartitions(*layout)
    laid = materialize(
        ordered.drop(_PLACE).withColumn(_SEGMENT, F.spark_partition_id()).withColumn(
            _OFFSET, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "positions",
    )
    # One row per shuffle partition and group in it: what to add to the offset there.
    earlier = Window.partitionBy(*keys).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifts = (
        laid.groupBy(_SEGMENT, *keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(_OFFSET).alias("_first"))
        .select(_SEGMENT, *keys, (before - F.col("_first") + 1).alias("_shift"))
    )
    shifted = _attach(laid, summary(shifts, "shifts"), [_SEGMENT, *keys])
    return shifted.withColumn(name, F.col(_OFFSET) + F.col("_shift")).select(*df.columns, name)


@_replacing
def row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_num",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """1, 2, 3, ... per group."""
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return _over_groups(
        df,
        keys,
        max_group_rows,
        lambda small: small.withColumn(name, F.row_number().over(window).cast("bigint")),
        lambda large, rows, bound: positions(large, keys, order, name, rows, bound),
    )


def _through_peers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: Column, max_group_rows: int
) -> DataFrame:
    """One row per distinct order value of a group, with its ``_peers`` and those ``_through`` it."""
    peers = df.groupBy(*keys, *order_names(order)).agg(count.cast("bigint").alias("_peers"))
    peers, size = measured(peers, "peers")
    return _running_sums(peers, keys, order, {"_through": "_peers"}, max_group_rows, (size["rows"], size["bytes"]))


@_replacing
def rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Rank with gaps: 1 + the rows that sort strictly before."""
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))

    def by_peers(large: DataFrame, rows: int, bound: int) -> DataFrame:
        summed = _through_peers(large, keys, order, F.count(F.lit(1)), max_group_rows)
        ranks = summed.withColumn(name, F.col("_through") - F.col("_peers") + 1)
        by = [*keys, *order_names(order)]
        return _attach(large, ranks.select(*by, name), by)

    return _over_groups(
        df,
        keys,
        max_group_rows,
        lambda small: small.withColumn(name, F.rank().over(window).cast("bigint")),
        by_peers,
    )


@_replacing
def dense_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "dense_rank",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Rank without gaps: the position of the row's value among the distinct values."""
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))

    def by_values(large: DataFrame, rows: int, bound: int) -> DataFrame:
        by = [*keys, *order_names(order)]
        distinct = materialize(large.select(*by).distinct(), "values")
        values = row_number(distinct, keys, order, name, max_group_rows)
        return _attach(large, values, by)

    return _over_groups(
        df,
        keys,
        max_group_rows,
        lambda small: small.withColumn(name, F.dense_rank().over(window).cast("bigint")),
        by_values,
    )


def _chunk_rows(spark: SparkSession, rows: int, max_group_rows: int) -> int:
    """Rows per chunk: enough chunks for the session's partitions, none above the group size."""
    return min(max_group_rows, -(-rows // int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int, rows: int, max_group_rows: int
) -> DataFrame:
    """Rows with their position and the number of their fixed-length chunk."""
    placed = positions(df, keys, order, _POSITION, rows, max_group_rows)
    return placed.withColumn(_CHUNK, F.expr(f"({_POSITION} - 1) div {chunk_rows}"))


def _gathered(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """Rows shuffled for a window over ``by``, into more partitions where ``rows`` needs them."""
    partitions = partitions_for(df.sparkSession, rows)
    return df.repartition(*partitions, *by) if partitions else df


@_replacing
def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "running_total",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Sum from the first row of the group to this one (ROWS frame).

    The type is that of Spark's plain sum at any size. Doubles and floats are
    summed exactly and rounded once, so the result does not depend on the order of
    addition or on how a group is split; NaN and infinities prevail, as in Spark's sum.
    """
    if dict(df.dtypes)[value] not in ("double", "float"):
        return _running_sums(df, keys, order, {name: value}, max_group_rows)
    exact = exact_doubles(df, value)
    sums = {f"{n}_sum": n for n in exact.addends}
    summed = _running_sums(df.withColumns(exact.addends), keys, order, sums, max_group_rows)
    return summed.withColumn(name, exact.total(lambda n: F.col(f"{n}_sum"))).drop(*sums, *exact.addends)


def _running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    max_group_rows: int,
    known: tuple[int, int] | None = None,
) -> DataFrame:
    """Running sums of several columns, by the name of the sum."""
    plain = df.select(*[F.sum(value).alias(name) for name, value in sums.items()]).schema

    def to_here(*by: str) -> Window:
        return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, 0)

    def by_chunks(large: DataFrame, rows: int, bound: int) -> DataFrame:
        chunk_rows = _chunk_rows(df.sparkSession, rows, bound)
        placed = _chunked(large, keys, order, chunk_rows, rows, bound)
        by = [*keys, _CHUNK]
        local = {f"_local_{name}": F.sum(value).over(to_here(*by).orderBy(_POSITION)) for name, value in sums.items()}
        within_chunk = _gathered(placed, by, rows).withColumns(local)
        # One row per chunk and group.
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK)
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            placed.groupBy(*by)
            .agg(*[F.sum(value).alias(f"_sum_{name}") for name, value in sums.items()])
            .select(*by, *[F.sum(f"_sum_{name}").over(earlier).alias(f"_carried_{name}") for name in sums])
        )
        joined = _attach(within_chunk, summary(carried, "carried"), by)

        def total(name: str) -> Column:
            here, before = F.col(f"_local_{name}"), F.col(f"_carried_{name}")
            return F.coalesce(here + before, here, before).cast(plain[name].dataType)

        return joined.withColumns({name: total(name) for name in sums}).select(*df.columns, *sums)

    window = to_here(*keys).orderBy(*order_columns(order))
    return _over_groups(
        df,
        keys,
        max_group_rows,
        lambda small: small.withColumns({name: F.sum(value).over(window) for name, value in sums.items()}),
        by_chunks,
        known,
    )


@_replacing
def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "running_count",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Non-null values up to this row and its ties (the default RANGE frame)."""
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))

    def by_peers(large: DataFrame, rows: int, bound: int) -> DataFrame:
        counts = _through_peers(large, keys, order, F.count(value), max_group_rows)
        by = [*keys, *order_names(order)]
        return _attach(large, counts.select(*by, F.col("_through").alias(name)), by)

    return _over_groups(
        df,
        keys,
        max_group_rows,
        lambda small: small.withColumn(name, F.count(value).over(window)),
        by_peers,
    )


def _over_nearby_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    compute: Callable[[Window], dict[str, Column]],
    max_group_rows: int,
) -> DataFrame:
    """Columns that look at most ``before`` rows back and ``after`` rows ahead."""

    def by_chunks(large: DataFrame, rows: int, bound: int) -> DataFrame:
        # A chunk also gets copies of the rows just outside it.
        chunk_rows = max(_chunk_rows(df.sparkSession, rows, bound), before, after)
        placed = _chunked(large, keys, order, chunk_rows, rows, bound)
        within_chunk = F.pmod(F.col(_POSITION) - 1, F.lit(chunk_rows))
        first = F.col(_CHUNK) - F.when(within_chunk < after, 1).otherwise(0)
        last = F.col(_CHUNK) + F.when(within_chunk >= chunk_rows - before, 1).otherwise(0)
        copies = placed.withColumn(_COPY, F.explode(F.sequence(first, last)))
        by = [*keys, _COPY]
        computed = compute(Window.partitionBy(*by).orderBy(_POSITION))
        return (
            _gathered(copies, by, rows)
            .withColumns(computed)
            .filter(F.col(_COPY) == F.col(_CHUNK))
            .select(*df.columns, *computed)
        )

    plain = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return _over_groups(
        df, keys, max_group_rows, lambda small: small.withColumns(compute(plain)), by_chunks
    )


@_replacing
def lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    offset: int = 1,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value ``offset`` rows earlier in the group."""
    return _over_nearby_rows(
        df, keys, order, offset, 0, lambda w: {name: F.lag(value, offset).over(w)}, max_group_rows
    )


@_replacing
def lead(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    offset: int = 1,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value ``offset`` rows later in the group."""
    return _over_nearby_rows(
        df, keys, order, 0, offset, lambda w: {name: F.lead(value, offset).over(w)}, max_group_rows
    )


@_replacing
def change(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "change",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value minus the previous row's; null on the first row."""
    return _over_nearby_rows(
        df,
        keys,
        order,
        1,
        0,
        lambda w: {name: F.col(value) - F.lag(value, 1).over(w)},
        max_group_rows,
    )


def _addends(df: DataFrame, value: str, scale: int | None) -> ExactSum:
    """How a column is summed exactly: in units of ``scale`` decimals if given, else as its type asks for."""
    rows = {"_exact_rows": F.when(F.col(value).isNotNull(), F.lit(1).cast("bigint")).otherwise(0)}
    if scale is not None:
        parts = unit_parts(value, "_exact", scale)
        return ExactSum(parts | rows, lambda s: from_parts(s("_exact_high"), s("_exact_low"), scale))
    if dict(df.dtypes)[value] in ("double", "float"):
        return exact_doubles(df, value)
    return ExactSum({"_exact_value": F.col(value)} | rows, lambda s: s("_exact_value").cast("double"))


@_replacing
def moving_avg(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    preceding: int,
    name: str = "moving_avg",
    scale: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Mean over the row and the ``preceding`` rows before it, of an exact sum.

    ``scale`` says that the values have that many decimals, which is cheaper; it is
    an error if one has more. Without it any doubles are summed as they are.
    """
    exact = _addends(df, value, scale)

    def sums(window: Window) -> dict[str, Column]:
        frame = window.rowsBetween(-preceding, 0)
        return {f"{n}_sum": F.sum(n).over(frame) for n in exact.addends}

    summed = _over_nearby_rows(df.withColumns(exact.addends), keys, order, preceding, 0, sums, max_group_rows)
    at = lambda n: F.col(f"{n}_sum")
    mean = F.try_divide(exact.total(at), at("_exact_rows"))
    return summed.withColumn(name, mean).drop(*exact.addends, *[f"{n}_sum" for n in exact.addends])


def with_group_totals(
    df: DataFrame,
    keys: Sequence[str],
    totals: dict[str, Column],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Each row with plain aggregates over its whole group, as from an unbounded frame."""
    if not keys:
        return df.withColumns({n: df.select(c).scalar() for n, c in totals.items()})
    window = Window.partitionBy(*keys)

    def by_totals(large: DataFrame, rows: int, bound: int) -> DataFrame:
        summed = large.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
        return _attach(large, summary(summed, "totals"), keys)

    return _over_groups(
        df,
        keys,
        max_group_rows,
        lambda small: small.withColumns({n: c.over(window) for n, c in totals.items()}),
        by_totals,
    )


def _with_total(
    df: DataFrame, keys: Sequence[str], value: str, scale: int | None, max_group_rows: int, compute: Callable[[Column, Column], Column], name: str
) -> DataFrame:
    """``compute(the group's exact sum, its values that are not null)`` per row."""
    exact = _addends(df, value, scale)
    sums = {f"{n}_sum": F.sum(column) for n, column in exact.addends.items()}
    with_sums = with_group_totals(df, keys, sums, max_group_rows)
    at = lambda n: F.col(f"{n}_sum")
    return with_sums.withColumn(name, compute(exact.total(at), at("_exact_rows"))).drop(*sums)


@_replacing
def percent_of_total(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "pct_of_total",
    scale: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value as a percentage of its group's exact sum; null where that is zero. ``scale`` as in :func:`moving_avg`."""
    share = lambda total, rows: F.try_divide(F.col(value), total) * 100
    return _with_total(df, keys, value, scale, max_group_rows, share, name)


@_replacing
def difference_from_avg(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "diff_from_avg",
    scale: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The value minus its group's mean, of an exact sum. ``scale`` as in :func:`moving_avg`."""
    difference = lambda total, rows: F.col(value) - F.try_divide(total, rows)
    return _with_total(df, keys, value, scale, max_group_rows, difference, name)


@_replacing
def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark limits each group to ``n`` rows per map task before the shuffle
    (``WindowGroupLimit``). Where it does not, or where ``n`` rows of that many
    tasks could be more than a group may have, :func:`row_number` numbers the rows.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > min(limit, MAX_GROUP_ROWS // MOST_TASKS):
        return row_number(df, keys, order, name).filter(F.col(name) <= n)
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))
    numbered = df.withColumn(name, F.row_number().over(window))
    return numbered.filter(F.col(name) <= n).withColumn(name, F.col(name).cast("bigint"))


def nth_highest(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    n: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The ``n``-th highest distinct value of each group that has one.

    On a table larger than a group may be the values are made distinct before they
    are gathered by group, at the price of a second shuffle.
    """
    values = df.select(*keys, value)
    if df.count() <= max_group_rows:
        window = Window.partitionBy(*keys).orderBy(F.col(value).desc())
        best = values.withColumn("_place", F.dense_rank().over(window))
        return best.filter(F.col("_place") == n).select(*keys, value).distinct()
    best = top_n(values.distinct(), keys, [f"-{value}"], n, "_place")
    return best.filter(F.col("_place") == n).drop("_place")
