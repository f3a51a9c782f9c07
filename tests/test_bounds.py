"""What one task may hold: pairs of a key, bytes of a group; and how many jobs the split forms take."""

import math

import pytest
from pyspark.sql import functions as F

from brindle.operators import joins, windows
from brindle.plans import QUERIES


def cells_of(left, right, bound):
    """Rows of each side per cell of the hot keys."""
    hot = joins._hot_keys(left, right, "k", bound)
    keys = hot.keys.select("k", "_left_cells", "_right_cells")
    args = (keys.where("_left_cells IS NOT NULL"), "k")
    by_left, by_right = ("_left_salt", "_left_cells"), ("_right_salt", "_right_cells")
    sides = joins._in_cells(left, *args, by_left, by_right), joins._in_cells(right, *args, by_right, by_left)
    counts = [side.groupBy("k", "_left_salt", "_right_salt").count().withColumnRenamed("count", n) for side, n in zip(sides, "lr")]
    return counts[0].join(counts[1], ["k", "_left_salt", "_right_salt"]).collect()


@pytest.mark.parametrize("n_left,n_right", [(3000, 3000), (30000, 40), (1, 90000)])
def test_pairs_of_a_cell_are_bounded(spark, n_left, n_right):
    bound = 3000
    left = spark.range(n_left, numPartitions=4).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    right = spark.range(n_right, numPartitions=4).select(F.lit(1).alias("k"), F.col("id").alias("y"))
    cells = cells_of(left, right, bound)
    assert len(cells) > 1 and sum(c["l"] * c["r"] for c in cells) == n_left * n_right
    # salts deal rows out by their place, which is even within a partition only
    assert max(c["l"] * c["r"] for c in cells) <= 1.5 * bound * joins.PAIRS_PER_ROW
    assert max(max(c["l"], c["r"]) for c in cells) <= 1.5 * bound
    joined = joins.skew_join(left, right, "k", "inner", bound)
    got = joined.agg(F.count("*"), F.sum("x"), F.sum("y"), F.sum(F.col("x") * F.col("y"))).first()
    sums = n_left * (n_left - 1) // 2, n_right * (n_right - 1) // 2
    assert tuple(got) == (n_left * n_right, sums[0] * n_right, sums[1] * n_left, sums[0] * sums[1])


def test_few_pairs_are_joined_plainly(spark):
    left = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    assert joins._hot_keys(left, left, "k", 50) is None


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_null_keys_make_no_pairs(spark, how):
    left = spark.createDataFrame([(None, i) for i in range(40)] + [(1, i) for i in range(20)], "k int, x int")
    right = spark.createDataFrame([(None, i) for i in range(40)] + [(1, i) for i in range(20)] + [(2, 0)], "k int, y int")
    out = joins.skew_join(left, right, "k", how, 5)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, left.join(right, "k", how).collect()))


def test_wide_rows_are_split_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(windows, "MAX_GROUP_BYTES", 100_000)
    wide = spark.range(60).select((F.col("id") % 2).alias("k"), "id", F.expr("IF(id % 2 = 0, repeat('x', 20000), 'y')").alias("text"))
    found = windows.split_groups(wide, ["k"], 1000)
    assert (found.small.count(), found.large.count(), found.large_rows) == (30, 30, 30)
    # five rows of 20,000 bytes are what a task may hold
    assert found.bound in (4, 5)
    out = windows.row_number(wide, ["k"], ["id"], max_group_rows=1000).select("k", "id", "row_num").collect()
    assert all(r["row_num"] == r["id"] // 2 + 1 for r in out) and len(out) == 60
    sizes = windows.positions(found.large, ["k"], ["id"], "p", 30, found.bound).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * found.bound


# A third to a half of what counting each bound on its own took.
JOBS = {"win_rank_hot_key": 30, "win_running_total_hot_key": 22, "join_salted_full": 19, "join_salted": 14}


@pytest.mark.parametrize("name", JOBS)
def test_jobs_of_the_split_forms(spark, name):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    QUERIES[name](spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= JOBS[name]


def test_split_sizes():
    assert windows._bound(100, 10, 0) == 100
    assert windows._bound(10**9, 10**9, 20_000 * 10**9) == windows.MAX_GROUP_BYTES // 20_000
    assert math.isclose(windows._bound(5, 10, windows.MAX_GROUP_BYTES * 100), 1)
