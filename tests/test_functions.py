"""Scalar, array and aggregate functions on toy rows."""

import pytest
from pyspark.sql import functions as F

from brindle.functions import text
from brindle.functions.categories import band, band_sql, band_udf
from brindle.functions.numbers import exact_avg, exact_sum, minor_units
from brindle.operators import aggregates
from brindle.operators.layout import plan_text

BOUNDS, LABELS = [50.0, 100.0], ["Low", "Medium", "High"]


@pytest.mark.parametrize("form", ["native", "sql", "udf"])
def test_bands_agree(spark, form):
    prices = [25.0, 75.0, 150.0, 10.0, 50.0, 100.0, None, float("nan")]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    label = {
        "native": lambda: band("price", BOUNDS, LABELS),
        "sql": lambda: band_sql("price", BOUNDS, LABELS),
        "udf": lambda: band_udf(BOUNDS, LABELS)("price"),
    }[form]()
    got = [r[0] for r in df.select(label).collect()]
    assert got == ["Low", "Medium", "High", "Low", "Medium", "High", None, "High"]


def test_bands_need_matching_labels():
    for form in (band, band_sql):
        with pytest.raises(ValueError, match="one more label"):
            form("x", [1.0], ["a"])
    with pytest.raises(ValueError, match="one more label"):
        band_udf([1.0], ["a"])


def test_exact_sum_ignores_row_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9] * 40
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for order in (df, df.orderBy("x"), df.repartition(7)):
        total, mean = order.agg(exact_sum("x"), exact_avg("x")).first()
        assert total == 24.4 and mean == 24.4 / 200
    assert df.select(minor_units(F.lit(0.29))).first()[0] == 29


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert df.agg(exact_avg("x")).first()[0] == 1.5


def test_word_count(spark):
    df = spark.createDataFrame([("big data",), ("data data",), (None,), ("",)], "text string")
    counts = {r["word"]: r["count"] for r in text.word_count(df, "text").collect()}
    assert counts == {"big": 1, "data": 3, "": 1}


def test_array_functions(spark):
    rows = [(1, [1, 2, 3]), (2, [4, 5]), (3, [7, 8, 9]), (4, []), (5, None)]
    df = spark.createDataFrame(rows, "id int, scores array<bigint>")
    got = df.select(text.array_size("scores"), text.element("scores", 1), F.to_json("scores")).collect()
    assert [tuple(r) for r in got] == [
        (3, 1, "[1,2,3]"), (2, 4, "[4,5]"), (3, 7, "[7,8,9]"), (0, None, "[]"), (None, None, None),
    ]
    assert df.select(F.explode("scores")).count() == 8


def test_flat_map(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "value int")
    assert text.flat_map(df, "value", [1, 10, 100], "y").count() == 15
    assert text.flat_map(df, "value", [1, 10, 100], "y").agg(F.sum("y")).first()[0] == 15 * 111


# Toy rows with known answers.
SALES = [
    ("2024-01-01", "Electronics", 1000), ("2024-01-01", "Clothing", 500),
    ("2024-01-02", "Electronics", 1500), ("2024-01-02", "Clothing", 600),
    ("2024-01-03", "Electronics", 1200), ("2024-01-03", "Clothing", 700),
]


def test_pivot(spark):
    sales = spark.createDataFrame(SALES, "date string, category string, amount bigint")
    wide = aggregates.pivot(sales, ["date"], "category", ["Clothing", "Electronics"], F.sum("amount"))
    assert sorted(map(tuple, wide.collect())) == [
        ("2024-01-01", 500, 1000), ("2024-01-02", 600, 1500), ("2024-01-03", 700, 1200),
    ]


def test_first_per_key_keeps_a_defined_row(spark):
    rows = [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (1, "z"), (2, "a")]
    df = spark.createDataFrame(rows, "id int, value string").repartition(3)
    kept = aggregates.first_per_key(df, ["id"], ["value"])
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "a"), (3, "c"), (4, "d")]


def test_skew_profile_is_sorted(spark):
    df = spark.range(100).selectExpr("IF(id < 60, 'hot', concat('k', id % 4)) AS k")
    rows = aggregates.skew_profile(df, "k").collect()
    assert rows[0]["k"] == "hot" and rows[0]["count"] == 60 and rows[0]["ratio_to_mean"] == 3.0
    assert [r["k"] for r in rows[1:]] == ["k0", "k1", "k2", "k3"]


def test_late_cutoff_keeps_the_newest_interval(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' + make_dt_interval(id) AS t FROM range(30)")
    assert aggregates.late_cutoff(df, "t", "7 DAYS").count() == 8


def test_approximate_distinct(spark):
    df = spark.range(10_000).selectExpr("id % 1000 AS k")
    exact, approximate = aggregates.approximate_distinct(df, "k").first()
    assert exact == 1000 and abs(approximate - 1000) < 150


def test_grouped_aggregates_combine_before_the_shuffle(spark):
    plan = plan_text(spark.range(10).groupBy((F.col("id") % 2).alias("k")).agg(F.sum("id")))
    assert "partial_sum" in plan or plan.count("HashAggregate") >= 2


def test_exact_sums_beyond_a_long(spark):
    """Ten times 10^16 cents, and sums above 2^53 cents, as a wide DECIMAL gives them."""
    large = spark.range(10).select(F.lit(1e14).alias("v"))
    assert large.agg(exact_sum("v")).first()[0] == 1e15
    huge = spark.range(2000).select(F.lit(9e13).alias("v"))
    assert huge.agg(exact_sum("v")).first()[0] == 1.8e17
    mixed = spark.range(999).select(((F.col("id") - 400) * 987654321.37).alias("v"))
    mixed = mixed.select(F.round("v", 2).alias("v"))
    row = mixed.agg(exact_sum("v"), F.sum(F.col("v").cast("decimal(38,2)")).cast("double")).first()
    assert row[0] == row[1]
