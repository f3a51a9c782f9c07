"""Window operators: toy answers, and split groups against brute force."""

import random

import pytest

from pyspark.sql import functions as F

from brindle.operators import windows
from brindle.operators.layout import plan_text
from brindle.plans import QUERIES

# Toy rows with known answers.
SALES = [
    ("2024-01-01", "Alice", 1000),
    ("2024-01-01", "Bob", 1500),
    ("2024-01-02", "Alice", 1200),
    ("2024-01-02", "Bob", 800),
    ("2024-01-03", "Alice", 900),
    ("2024-01-03", "Bob", 1100),
    ("2024-01-04", "Alice", 1300),
    ("2024-01-04", "Bob", 950),
]
SALARIES = [(1, "Alice", 50000), (2, "Bob", 60000), (3, "Charlie", 55000), (4, "David", 70000), (5, "Eve", 45000)]


@pytest.fixture(scope="module", autouse=True)
def several_segments(spark):
    """Few rows would otherwise be gathered into one partition, with nothing to stitch."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, "date string, salesperson string, amount bigint").cache()


def _values(df, by, name):
    """{key: [values in row order]} given rows sorted by ``by``."""
    return [row[name] for row in df.orderBy(*by).collect()]


# Every toy case runs with whole groups and with groups cut into parts of 2 rows.
SIZES = pytest.mark.parametrize("size", [windows.MAX_GROUP_ROWS, 2])
ALICE, BY_DATE = ["salesperson"], ["date"]


@SIZES
def test_running_total(sales, size):
    result = windows.running_sum(sales, ALICE, BY_DATE, "amount", max_group_rows=size)
    alice = result.filter("salesperson = 'Alice'")
    assert _values(alice, BY_DATE, "running_total") == [1000, 2200, 3100, 4400]


@SIZES
def test_running_total_without_keys(spark, size):
    df = spark.createDataFrame(SALARIES, "emp_id bigint, name string, salary bigint")
    result = windows.running_sum(df, [], ["emp_id"], "salary", max_group_rows=size)
    assert _values(result, ["emp_id"], "running_total") == [50000, 110000, 165000, 235000, 280000]


@SIZES
def test_row_number_and_lag_without_keys(spark, size):
    df = spark.createDataFrame(SALARIES, "emp_id bigint, name string, salary bigint")
    numbered = windows.row_number(df, [], ["-salary"], max_group_rows=size)
    assert _values(numbered, ["row_num"], "name") == ["David", "Bob", "Charlie", "Alice", "Eve"]
    previous = windows.lag(df, [], ["-salary"], "salary", "prev", max_group_rows=size)
    assert _values(previous, ["emp_id"], "prev") == [55000, 70000, 60000, None, 50000]


@SIZES
def test_running_count_gives_ties_the_same_value(spark, size):
    rows = [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (1, "a"), (2, "b")]
    df = spark.createDataFrame(rows, "id bigint, value string")
    counted = windows.running_count(df, [], ["id"], "value", max_group_rows=size)
    assert _values(counted, ["id"], "running_count") == [2, 2, 4, 4, 5, 6]


@SIZES
def test_moving_average_and_change(sales, size):
    averaged = windows.moving_avg(sales, ALICE, BY_DATE, "amount", 2, max_group_rows=size)
    alice = averaged.filter("salesperson = 'Alice'")
    assert _values(alice, BY_DATE, "moving_avg") == [1000, 1100, 3100 / 3, 3400 / 3]
    changed = windows.change(sales, ALICE, BY_DATE, "amount", max_group_rows=size)
    alice = changed.filter("salesperson = 'Alice'")
    assert _values(alice, BY_DATE, "change") == [None, 200, -300, 400]


@SIZES
def test_percent_of_total_and_difference(sales, size):
    shares = windows.percent_of_total(sales, ALICE, "amount", max_group_rows=size)
    alice = shares.filter("salesperson = 'Alice'")
    assert _values(alice, BY_DATE, "pct_of_total") == [a / 4400 * 100 for a in (1000, 1200, 900, 1300)]
    compared = windows.difference_from_avg(sales, ALICE, "amount", max_group_rows=size)
    alice = compared.filter("salesperson = 'Alice'")
    assert _values(alice, BY_DATE, "diff_from_avg") == [-100, 100, -200, 200]


def test_top_two_and_second_highest(sales):
    top = windows.top_n(sales, ALICE, ["-amount", "date"], 2)
    assert _values(top, ["salesperson", "rank"], "amount") == [1300, 1200, 1500, 1100]
    for size in (windows.MAX_GROUP_ROWS, 2):
        second = windows.nth_highest(sales, ALICE, "amount", 2, size)
        assert sorted(map(tuple, second.collect())) == [("Alice", 1200), ("Bob", 1100)]


def test_top_n_limits_groups_before_the_shuffle(sales):
    plan = plan_text(windows.top_n(sales, ALICE, ["-amount", "date"], 2))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")


def _skewed_rows(seed):
    """A third of the rows under one key, a null key, many ties and some null values."""
    draw = random.Random(seed)
    rows = []
    for i in range(600):
        key = draw.choice(["hot", None, *"abcdefgh"]) if i % 3 else "hot"
        when = draw.choice([None, 1, 2, 2, 2, 2, 3, 4, 5])
        value = draw.choice([None, *range(1, 50)])
        rows.append((i, key, when, value))
    return rows


OPERATORS = {
    "row_number": lambda df, n: windows.row_number(df, ["k"], ["-t", "id"], "x", n),
    "rank": lambda df, n: windows.rank(df, ["k"], ["-t"], "x", n),
    "dense_rank": lambda df, n: windows.dense_rank(df, ["k"], ["t"], "x", n),
    "lag": lambda df, n: windows.lag(df, ["k"], ["t", "id"], "v", "x", 3, n),
    "lead": lambda df, n: windows.lead(df, ["k"], ["t", "-id"], "v", "x", 2, n),
    "change": lambda df, n: windows.change(df, ["k"], ["t", "id"], "v", "x", n),
    "running_sum": lambda df, n: windows.running_sum(df, ["k"], ["t", "id"], "v", "x", n),
    "running_count": lambda df, n: windows.running_count(df, ["k"], ["t"], "v", "x", n),
    "moving_avg": lambda df, n: windows.moving_avg(df, ["k"], ["t", "id"], "v", 4, "x", 0, n),
    "percent": lambda df, n: windows.percent_of_total(df, ["k"], "v", "x", 0, n),
    "difference": lambda df, n: windows.difference_from_avg(df, ["k"], "v", "x", 0, n),
}


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(_skewed_rows(7), "id bigint, k string, t int, v bigint").repartition(5).cache()


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("size", [7, 100])
def test_split_groups_give_the_same_result(skewed, name, size):
    operator = OPERATORS[name]
    whole = operator(skewed, windows.MAX_GROUP_ROWS)
    split = operator(skewed, size)
    assert split.columns == whole.columns
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("name", ["row_number", "rank", "dense_rank", "lag", "running_sum", "running_count"])
def test_split_table_without_keys(skewed, name):
    # One key for all rows stands in for no key.
    single = skewed.selectExpr("id", "'all' AS k", "t", "v")
    calls = {
        "row_number": lambda df, k, n: windows.row_number(df, k, ["-t", "id"], "x", n),
        "rank": lambda df, k, n: windows.rank(df, k, ["-t"], "x", n),
        "dense_rank": lambda df, k, n: windows.dense_rank(df, k, ["t"], "x", n),
        "lag": lambda df, k, n: windows.lag(df, k, ["t", "id"], "v", "x", 1, n),
        "running_sum": lambda df, k, n: windows.running_sum(df, k, ["t", "id"], "v", "x", n),
        "running_count": lambda df, k, n: windows.running_count(df, k, ["t"], "v", "x", n),
    }
    whole = calls[name](single, ["k"], windows.MAX_GROUP_ROWS)
    split = calls[name](single, [], 37)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))


def test_one_order_value_for_a_whole_group_is_split(spark):
    """All rows tie; positions must still spread over several range partitions."""
    df = spark.range(5000).selectExpr("id", "'hot' AS k", "1 AS t")
    ranked = windows.rank(df, ["k"], ["t"], "x", 100)
    assert ranked.filter("x <> 1").count() == 0 and ranked.count() == 5000
    numbered = windows.row_number(df, ["k"], ["t", "id"], "x", 100)
    assert numbered.filter("x <> id + 1").count() == 0 and numbered.count() == 5000


def test_ties_that_differ_elsewhere_are_spread(spark):
    """Positions in an order that does not tell the rows apart, over several segments."""
    df = spark.range(5000).selectExpr("id", "'hot' AS k", "1 AS t")
    numbered = windows.row_number(df, ["k"], ["t"], "x", 100)
    assert sorted(r["x"] for r in numbered.collect()) == list(range(1, 5001))
    assert len(numbered.inputFiles()) > 2


def test_top_n_beyond_the_limit_of_the_plan(spark):
    df = spark.range(3000).selectExpr("id", "id % 2 AS k")
    top = windows.top_n(df, ["k"], ["-id"], 1200)
    assert top.count() == 2400 and top.agg({"rank": "max"}).first()[0] == 1200


def test_split_size_never_exceeds_the_default():
    assert windows.split_size(10) == 1
    assert windows.split_size(6400) == 100
    assert windows.split_size(10**12) == windows.MAX_GROUP_ROWS


def test_split_windows_get_partitions_for_their_rows(skewed, monkeypatch):
    """The range and the chunk shuffle are sized by the rows, and sort only once each."""
    monkeypatch.setattr("brindle.workspace.ROWS_PER_PARTITION", 20)
    split = windows.running_sum(skewed, [], ["t", "id"], "v", "x", 40)
    whole = windows.running_sum(skewed, [], ["t", "id"], "v", "x")
    plan = plan_text(split)
    assert "hashpartitioning(_chunk" in plan and ", 30)" in plan
    assert plan.count("Exchange hashpartitioning") <= 2
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))


def test_identical_rows_are_spread_over_segments(spark, monkeypatch):
    laid = {}
    written = windows.materialize
    monkeypatch.setattr(windows, "materialize", lambda df, label: laid.setdefault(label, written(df, label)))
    rows = spark.range(40_000).select((F.col("id") % 2).alias("v"))
    done = windows.positions(rows, [], ["v"], "n", 40_000, 5_000)
    assert done.select("n").distinct().count() == 40_000
    segments = [r["count"] for r in laid["positions"].groupBy("_segment").count().collect()]
    assert len(segments) >= 8 and max(segments) <= 10_000


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_forced_windows_have_several_segments(spark, sf, monkeypatch):
    seen = []
    written = windows.materialize

    def watch(df, label):
        done = written(df, label)
        if label == "positions":
            seen.append(done.select("_segment").distinct().count())
        return done

    monkeypatch.setattr(windows, "materialize", watch)
    for name in ("win_row_number_hot_key", "win_rank_hot_key", "win_running_total_hot_key", "win_change_hot_key"):
        QUERIES[name](spark, f"/root/testdata/{sf}")
        assert seen and min(seen) >= 4, name
        seen.clear()
