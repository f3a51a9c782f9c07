"""Join operators: toy answers, skewed keys against plain joins, and plans."""

import random

import pytest
from pyspark.sql import functions as F

from brindle.operators import joins
from brindle.operators.layout import plan_text

# Toy rows with known answers.
EMPLOYEES = [(1, "Alice", 1), (2, "Bob", 2), (3, "Charlie", 1), (4, "Diana", 3)]
DEPARTMENTS = [(1, "Engineering"), (2, "Marketing"), (3, "Sales"), (4, "HR")]


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame(EMPLOYEES, "emp_id bigint, name string, dept_id bigint")


@pytest.fixture(scope="module")
def departments(spark):
    return spark.createDataFrame(DEPARTMENTS, "dept_id bigint, dept_name string")


@pytest.mark.parametrize("size", [joins.MAX_GROUP_ROWS, 1])
@pytest.mark.parametrize("how, rows", [("inner", 4), ("left", 4), ("right", 5), ("full", 5)])
def test_join_kinds(employees, departments, how, rows, size):
    joined = joins.skew_join(employees, departments, "dept_id", how, size)
    assert joined.count() == rows
    unmatched = joined.filter("emp_id IS NULL").select("dept_name").collect()
    assert [r[0] for r in unmatched] == (["HR"] if rows == 5 else [])


def test_without_match(employees, departments):
    alone = joins.without_match(departments, employees, "dept_id", "dept_id")
    assert [r["dept_name"] for r in alone.collect()] == ["HR"]


def _sides(spark, seed):
    """Hot keys on both, on one and with no partner, plus null keys and identical rows."""
    draw = random.Random(seed)
    left = [(draw.choice(["both", "left", "alone_l", None, *"abc", "l"]), draw.randrange(6)) for _ in range(300)]
    left += [("both", 1)] * 100
    right = [(draw.choice(["both", "right", "alone_r", None, *"abd", "r"]), draw.randrange(6)) for _ in range(120)]
    right += [("left", 0), ("l", 2)]
    left += [("right", 0), ("r", 3)]
    return (
        spark.createDataFrame(left, "k string, x bigint").repartition(4),
        spark.createDataFrame(right, "k string, y bigint").repartition(3),
    )


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("size", [3, 60])
def test_skewed_join_equals_plain_join(spark, how, size):
    left, right = _sides(spark, 3)
    plain = left.join(right, "k", how)
    salted = joins.skew_join(left, right, "k", how, size)
    assert salted.columns == plain.columns
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_only_the_null_key_is_hot(spark, how):
    left = spark.range(300).selectExpr("IF(id < 100, NULL, id) AS k", "id AS x")
    right = spark.range(50, 150).selectExpr("id AS k", "id AS y")
    plain, split = left.join(right, "k", how), joins.skew_join(left, right, "k", how, 10)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_skewed_toy_join_row_count(spark):
    def rows(n):
        return [(f"user_{i % 7}", i % 5) for i in range(n)]

    big = spark.createDataFrame(rows(1000), "user_id string, score bigint")
    small = spark.createDataFrame(rows(100), "user_id string, other bigint")
    assert joins.skew_join(big, small, "user_id", "inner", 50).count() == 14286


def test_salting_spreads_identical_rows(spark):
    """A hot group of copies must not meet in one cell."""
    copies = spark.range(1000, numPartitions=2).selectExpr("'hot' AS k", "1 AS x")
    cells = spark.createDataFrame([("hot", 10, 1)], "k string, _left_cells bigint, _right_cells bigint")
    salted = joins._in_cells(
        copies, cells, "k", (joins._LEFT_SALT, "_left_cells"), (joins._RIGHT_SALT, "_right_cells")
    )
    sizes = [r["count"] for r in salted.groupBy(joins._LEFT_SALT).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 110


def test_broadcast_only_within_the_bound(spark, employees, departments):
    small = plan_text(joins.lookup_join(employees, departments, "dept_id"))
    assert "BroadcastHashJoin" in small
    large = spark.range(1_100_000).select(F.col("id").alias("dept_id"))
    hinted = joins.lookup_join(employees, large, "dept_id")
    assert "broadcast" not in hinted._jdf.queryExecution().logical().toString().lower()


def test_sort_merge_join_ignores_the_broadcast_threshold(employees, departments):
    plan = plan_text(joins.sort_merge_join(employees, departments, "dept_id"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_bucketed_join_does_not_shuffle(spark):
    users = spark.range(1, 21).selectExpr("id AS user_id", "concat('user_', id) AS username")
    orders = spark.range(1, 31).selectExpr("id % 20 + 1 AS user_id", "id * 10 AS amount")
    joined = joins.bucketed_join(users, orders, "user_id", 4)
    plan = plan_text(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 30
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_bucketed_join_takes_hot_keys_out_of_the_buckets(spark):
    users = spark.range(1, 21).selectExpr("id AS user_id", "concat('user_', id) AS username")
    orders = spark.range(400).selectExpr(
        "CASE WHEN id < 200 THEN 5 WHEN id < 300 THEN NULL ELSE id % 20 + 1 END AS user_id", "id AS amount"
    )
    joined = joins.bucketed_join(users, orders, "user_id", 4, max_group_rows=50)
    plain = users.join(orders, "user_id")
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))


def test_adaptive_execution_splits_a_hot_key_of_an_inner_join(spark):
    """What plain inner joins of the library rely on."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    big = spark.range(0, 400_000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id % 5000) AS k", "id AS x")
    small = spark.range(5000).selectExpr("id AS k", "id AS y")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = joins.sort_merge_join(big, small, "k")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("max_lookup_rows", [100, 10])
def test_join_and_sum(spark, max_lookup_rows):
    """Summed while reading, or per key before the join, by the size of the lookup."""
    facts = spark.range(900).selectExpr("IF(id < 300, 7, id % 50) AS k", "id AS x")
    lookup = spark.range(40).selectExpr("id AS key", "id % 3 AS colour")
    sums = {"n": F.lit(1), "x": F.col("x")}
    result = joins.join_and_sum(facts, lookup, "k", "key", ["colour"], sums, max_lookup_rows)
    plain = facts.join(lookup, F.col("k") == F.col("key")).groupBy("colour")
    plain = plain.agg(F.count("*").alias("n"), F.sum("x").alias("x"))
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, plain.collect()))
    assert ("Exchange hashpartitioning(k" in plan_text(result, "simple")) == (max_lookup_rows == 10)
