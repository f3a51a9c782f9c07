"""Exact arithmetic: money held as doubles, and sums of any doubles."""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums of minor units are held in two longs: the low bits and the rest. Each has room
# for 2^43 rows of values up to 2^40, or for 2^30 rows of the largest whole doubles.
LOW_BITS = 20

# Whole doubles up to it have room for the check that a value has no more decimals.
CHECKED = float(1 << 51)

# Any double is a sum of whole multiples of the powers of two where bins begin, one below
# 2^24 per bin. A long sums 2^39 such multiples.
BIN_BITS = 24
LOWEST_BIT = -1074


def minor_units(value: Column | str, scale: int = 2) -> Column:
    """A double with ``scale`` decimals as whole minor units (cents for 2).

    Sums of whole units do not depend on the order of rows. A value that has more
    decimals is an error.
    """
    column = F.col(value) if isinstance(value, str) else value
    factor = F.lit(float(10**scale))
    units = F.rint(column * factor)
    rounded = (F.abs(units) < CHECKED) & (units / factor != column)
    failure = F.raise_error(F.concat(F.lit(f"more than {scale} decimals: "), column.cast("string")))
    return F.when(rounded, failure.cast("bigint")).otherwise(units.cast("bigint"))


def major_units(units: Column, scale: int = 2) -> Column:
    """Inverse of :func:`minor_units`, rounded once."""
    return (units.cast("decimal(36,0)") * F.lit(Decimal(1).scaleb(-scale))).cast("double")


def unit_parts(value: Column | str, name: str, scale: int = 2) -> dict[str, Column]:
    """:func:`minor_units` as two longs to be summed apart, ``<name>_high`` and ``<name>_low``.

    Sums of longs keep fixed-width aggregation buffers, unlike those of wide
    decimals; two of them do not overflow where one would.
    """
    units = minor_units(value, scale)
    low = units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    return {f"{name}_high": F.shiftright(units, LOW_BITS), f"{name}_low": low}


def from_parts(high: Column, low: Column, scale: int = 2) -> Column:
    """The double that the sums of both parts stand for, rounded once."""
    whole = high.cast("decimal(20,0)") * F.lit(Decimal(1 << LOW_BITS)) + low.cast("decimal(20,0)")
    return major_units(whole, scale)


def exact_sum(value: Column | str, scale: int = 2) -> Column:
    """Order-independent sum of any number of rows, rounded once."""
    high, low = unit_parts(value, "units", scale).values()
    return from_parts(F.sum(high), F.sum(low), scale)


def exact_avg(value: Column | str, scale: int = 2) -> Column:
    """Order-independent mean over the non-null values."""
    column = F.col(value) if isinstance(value, str) else value
    return exact_sum(column, scale) / F.count(column)


class ExactSum(NamedTuple):
    """How doubles are summed exactly: whole addends per row, and the double that their sums stand for.

    ``total`` takes a function from an addend's name to its sum.
    """

    addends: dict[str, Column]
    total: Callable[[Callable[[str], Column]], Column]


def exact_doubles(df: DataFrame, value: str, prefix: str = "_exact") -> ExactSum:
    """The way to sum a column of any doubles or floats: order-free, and rounded once.

    Every value is cut into whole multiples of the powers of two where bins begin;
    each bin is a sum of longs. One pass finds the bins in use. As in Spark's own
    sum nulls are left out, nothing sums to null, and NaN and infinities prevail.
    """
    x = F.col(value).cast("double")
    size = F.abs(x)
    finite = size < float("inf")
    least, most, special = df.agg(
        F.min(F.when(size > 0, size)), F.max(F.when(finite, size)), F.max(F.when(finite, 0).when(x.isNotNull(), 1))
    ).first()
    low = high = 0
    if most:
        # a double has 53 bits, the least of them 2^-1074
        if not math.isinf(least):
            low = (max(math.frexp(least)[1] - 53, LOWEST_BIT) - LOWEST_BIT) // BIN_BITS
        high = (math.frexp(most)[1] - 1 - LOWEST_BIT) // BIN_BITS
    sign = F.signum(x).cast("bigint")
    addends = {f"{prefix}_rows": F.when(x.isNotNull(), F.lit(1).cast("bigint")).otherwise(0)}
    for number in range(low, high + 1):
        begins = LOWEST_BIT + BIN_BITS * number
        rest = size % F.lit(2.0 ** (begins + BIN_BITS)) if begins + BIN_BITS < 1024 else size
        part = F.floor(_scaled(rest, F.lit(-begins))) * sign
        addends[f"{prefix}_{number - low}"] = F.when(finite, part).otherwise(F.lit(0).cast("bigint"))
    bins = [name for name in addends if name != f"{prefix}_rows"]
    if special:
        for name, found in {"nan": F.isnan(x), "up": x == float("inf"), "down": x == float("-inf")}.items():
            addends[f"{prefix}_{name}"] = F.when(found, F.lit(1).cast("bigint")).otherwise(0)

    def total(summed: Callable[[str], Column]) -> Column:
        out = _from_bins(F.array(*[summed(name) for name in bins]), LOWEST_BIT + BIN_BITS * low)
        if special:
            nan, up, down = (summed(f"{prefix}_{name}") > 0 for name in ("nan", "up", "down"))
            out = F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).otherwise(out)
        return F.when(summed(f"{prefix}_rows") > 0, out)

    return ExactSum(addends, total)


def _scaled(value: Column, exponent: Column) -> Column:
    """``value`` times 2^exponent, in two steps, as the power itself may be no double."""
    half = F.floor(exponent / 2).cast("int")
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _from_bins(sums: Column, begins: int) -> Column:
    """The double nearest to the sum of sums[i] * 2^(begins + 24 i)."""
    zeros = F.array(*[F.lit(0).cast("bigint")] * 3)
    mask = F.lit((1 << BIN_BITS) - 1)

    def carried(parts: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

        def step(done: Column, part: Column) -> Column:
            here = done["carry"] + part
            digit = F.array(here.bitwiseAND(mask))
            return F.struct(F.shiftright(here, BIN_BITS).alias("carry"), F.concat(done["digits"], digit).alias("digits"))

        return F.aggregate(F.concat(parts, zeros), start, step)

    def rounded(digits: Column, top: Column) -> Column:
        # 73 bits or more in two whole doubles, so that one addition rounds; a half stands for what is below
        high = (F.get(digits, top) * (1 << BIN_BITS) + F.get(digits, top - 1)).cast("double")
        low = (F.get(digits, top - 2) * (1 << BIN_BITS) + F.get(digits, top - 3)).cast("double")
        below = F.when(F.exists(F.slice(digits, F.lit(1), top - 3), lambda d: d > 0), 0.5).otherwise(0.0)
        exponent = (top - 6) * BIN_BITS + begins
        return _scaled(high * float(1 << (2 * BIN_BITS)) + (low + below), exponent)

    def signed(found: Column) -> Column:
        negative = found["carry"] < 0
        digits = F.when(negative, carried(F.transform(sums, lambda s: -s))["digits"]).otherwise(found["digits"])
        value = _let(
            F.concat(zeros, digits),
            lambda d: _let(
                F.array_max(F.transform(d, lambda x, i: F.when(x > 0, i).otherwise(-1))),
                lambda top: F.when(top < 0, 0.0).otherwise(rounded(d, top)),
            ),
        )
        return F.when(negative, -value).otherwise(value)

    return _let(carried(sums), signed)


def count_rows() -> Column:
    """Rows of the group, whatever they hold."""
    return F.count(F.lit(1))
