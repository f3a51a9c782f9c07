"""Exact sums of any doubles, in windows and groups, against exact fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from brindle.functions.numbers import exact_doubles, minor_units
from brindle.operators import windows

INF, NAN = float("inf"), float("nan")


def exact(values):
    """Spark's sum of these, if it did not round on the way."""
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values) or {INF, -INF} <= set(values):
        return NAN
    for end in (INF, -INF):
        if end in values:
            return end
    total = sum(map(Fraction, values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return INF if total > 0 else -INF


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def drawn(kind, n=120, seed=0):
    draw = random.Random(f"{kind}{seed}")
    make = {
        "tiny": lambda: draw.choice([1e-11, -3e-11, 7e-12]),
        "mills": lambda: 0.004,
        "mixed": lambda: draw.choice([1e15, -1e15, 0.1, 0.7, 1e-11, 3.3]),
        "any": lambda: draw.uniform(-1, 1) * 2.0 ** draw.randrange(-60, 60),
        "all": lambda: draw.choice([5e-324, -5e-324, 2.2e-308, 1.7e308, -1.7e308, 1.0, 1e-300, 2.0**-1022]),
        "ties": lambda: draw.choice([2.0**53, 1.0, -1.0, 2.0**-53, 2.0**106]),
        "special": lambda: draw.choice([NAN, INF, -INF, 1.5, None, 2.25, 0.0, -0.0]) if draw.random() < 0.1 else 0.125,
        "zeros": lambda: draw.choice([0.0, -0.0, None]),
        "ints": lambda: float(draw.randrange(-5, 6)),
    }[kind]
    return [None if draw.random() < 0.1 else make() for _ in range(n)]


KINDS = ["tiny", "mills", "mixed", "any", "all", "ties", "special", "zeros", "ints"]


@pytest.mark.parametrize("kind", KINDS)
def test_group_sums(spark, kind):
    values = {k: drawn(kind, 40, k) for k in range(12)}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, v double")
    plan = exact_doubles(df, "v")
    sums = df.groupBy("k").agg(*[F.sum(c).alias(n) for n, c in plan.addends.items()])
    got = {r["k"]: r["total"] for r in sums.select("k", plan.total(F.col).alias("total")).collect()}
    assert all(same(got[k], exact(vs)) for k, vs in values.items()), {k: (got[k], exact(vs)) for k, vs in values.items()}


@pytest.mark.parametrize("size", [1000, 7])
def test_windows_over_any_doubles(spark, size):
    values = {k: drawn(k, 40) for k in KINDS}
    df = spark.createDataFrame([(k, i, v) for k, vs in values.items() for i, v in enumerate(vs)], "k string, i int, v double")
    summed = windows.running_sum(df, ["k"], ["i"], "v", "total", size)
    averaged = windows.moving_avg(summed, ["k"], ["i"], "v", 2, "mean", max_group_rows=size)
    shared = windows.percent_of_total(averaged, ["k"], "v", "share", max_group_rows=size)
    out = windows.difference_from_avg(shared, ["k"], "v", "apart", max_group_rows=size)
    assert out.columns == ["k", "i", "v", "total", "mean", "share", "apart"]
    divide = lambda a, b: None if a is None or not b else a / b
    for r in out.collect():
        group, v = values[r["k"]], r["v"]
        before = group[: r["i"] + 1]
        near = before[-3:]
        assert same(r["total"], exact(before))
        assert same(r["mean"], divide(exact(near), sum(x is not None for x in near)))
        whole = exact(group)
        if v is None:
            assert r["share"] is None and r["apart"] is None
            continue
        share = divide(v, whole)
        assert same(r["share"], None if share is None else share * 100)
        assert same(r["apart"], v - whole / sum(x is not None for x in group))


def test_floats_sum_as_doubles(spark):
    df = spark.createDataFrame([(i, 0.1) for i in range(5)], "i int, v float")
    out = windows.running_sum(df, [], ["i"], "v", "total")
    assert dict(out.dtypes)["total"] == "double"
    assert max(r["total"] for r in out.collect()) == exact([0.10000000149011612] * 5)


def test_nothing_sums_to_nothing(spark):
    df = spark.createDataFrame([], "k int, i int, v double")
    assert windows.running_sum(df, ["k"], ["i"], "v").collect() == []
    assert windows.moving_avg(df, ["k"], ["i"], "v", 2).collect() == []


def test_more_decimals_than_said_are_an_error(spark):
    df = spark.createDataFrame([(1, 0.29), (2, 1234567.89), (3, -0.07), (4, None), (5, 4503599627370.5)], "i int, v double")
    assert [r[0] for r in df.orderBy("i").select(minor_units("v")).collect()] == [29, 123456789, -7, None, 450359962737050]
    windows.percent_of_total(df, [], "v", scale=2).collect()
    fine = spark.createDataFrame([(1, 0.004)], "i int, v double")
    for run in (
        lambda: windows.moving_avg(fine, [], ["i"], "v", 2, scale=2),
        lambda: windows.percent_of_total(fine, [], "v", scale=2),
        lambda: windows.difference_from_avg(fine, [], "v", scale=2),
    ):
        with pytest.raises(Exception, match="more than 2 decimals"):
            run().collect()
    assert windows.moving_avg(fine, [], ["i"], "v", 2, scale=3).first()["moving_avg"] == 0.004
