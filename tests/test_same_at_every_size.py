"""Operators with a split form give the same schema and rows above and below their bound."""

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brindle.functions.categories import band, band_sql
from brindle.operators import aggregates, joins, layout, windows
from brindle.sources.tables import load_dataset, save_dataset

ABOVE, BELOW = 3, 1000

VALUES = {
    "bigint": lambda i: i * 7 % 11,
    "decimal(18,2)": lambda i: Decimal(i * 7 % 11) / 4,
    "double": lambda i: [0.1, 1e15, -1e15, 0.7, 3.3][i % 5],
}


def rows(df):
    return df.dtypes, Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def groups(spark):
    def make(kind):
        data = [(i % 3 if i % 10 else None, i // 2, i, VALUES[kind](i) if i % 7 else None) for i in range(60)]
        return spark.createDataFrame(data, f"k int, t int, id int, v {kind}")

    return make


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("name", ["total", "v", "T"])
def test_running_sum(groups, kind, name):
    df = groups(kind)
    above, below = (rows(windows.running_sum(df, ["k"], ["id"], "v", name, n)) for n in (ABOVE, BELOW))
    assert above == below


@pytest.mark.parametrize("operator", ["row_number", "rank", "dense_rank", "running_count", "lag", "lead", "change"])
@pytest.mark.parametrize("name", ["out", "v"])
def test_windows(groups, operator, name):
    df = groups("bigint")
    value = ["v"] if operator not in ("row_number", "rank", "dense_rank") else []
    above, below = (
        rows(getattr(windows, operator)(df, ["k"], ["t", "id"], *value, name=name, max_group_rows=n)) for n in (ABOVE, BELOW)
    )
    assert above == below


def test_lag_of_dates(spark):
    df = spark.createDataFrame([(i, date(2024, 1, 1 + i)) for i in range(12)], "id int, day date")
    assert rows(windows.lag(df, [], ["id"], "day", "day", max_group_rows=ABOVE)) == rows(windows.lag(df, [], ["id"], "day", "day"))


@pytest.mark.parametrize("how", ["inner", "left", "leftouter", "left_outer", "right", "right_outer", "outer", "full", "full_outer", "semi", "left_semi", "anti", "leftanti"])
def test_joins_with_shared_names(spark, how):
    left = spark.createDataFrame([(i, i % 4 if i % 9 else None, "l") for i in range(30)], "score int, id int, side string")
    right = spark.createDataFrame([(i % 6 if i % 8 else None, "r", i) for i in range(20)], "id int, side string, score int")
    plain = left.join(right, "id", how)
    above, below = (joins.skew_join(left, right, "id", how, n) for n in (ABOVE, BELOW))
    assert above.columns == below.columns == plain.columns
    assert rows(above) == rows(below) == rows(plain)


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -5.0), (2, 2.0)], "k int, v double")
    out = windows.percent_of_total(df, ["k"], "v").collect()
    assert Counter(r["pct_of_total"] for r in out) == Counter([None, None, 100.0])


def test_pivot_loses_nothing(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", None, 3)], "k string, c string, v int")
    assert aggregates.pivot(df, ["k"], "c", None, F.sum("v")).columns == ["k", "null", "x", "y"]
    with pytest.raises(Exception, match="not named: y"):
        aggregates.pivot(df, ["k"], "c", ["x"], F.sum("v")).collect()


def test_quoted_bands(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "`a price` double")
    labels = ["child's \\ fare", "adult"]
    for form in (band_sql("a price", [5], labels), band(F.col("`a price`"), [5], labels)):
        assert [r[0] for r in df.select(form).collect()] == [labels[0], labels[1], None]


def test_csv_keeps_texts(spark, tmp_path):
    texts = ["a\nb", "", " x ", 'say "hi"', "a,b", None, "\\", "tab\t", "\r\n", "é", '"', "\\\"", "a\rb"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    save_dataset(df, str(tmp_path / "csv"), "csv")
    assert rows(load_dataset(spark, str(tmp_path / "csv"), "csv", df.schema)) == rows(df)


def test_codes_stay_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, "007"), (2, "07"), (3, "7")], "id int, code string")
    path = str(tmp_path / "codes")
    layout.write_partitioned(df, path, ["code"])
    listed = layout.list_partitions(spark, path, ["code"], df.schema).collect()
    assert {(r["code"], r["rows"]) for r in listed} == {("007", 1), ("07", 1), ("7", 1)}


def test_partition_skew(spark):
    skew = layout.partition_skew(spark.range(0, 90, 1, 3).where("id < 40")).collect()
    assert [(r["rows"], r["ratio_to_mean"]) for r in skew] == [(30, 1.5), (10, 0.5)]


def test_one_csv_file_feeds_many_tasks(spark, tmp_path):
    texts = [f"{i}\n\\n\r\\r\\\\b,\"{i}\"" * 20 for i in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, `a text` string")
    save_dataset(df, str(tmp_path / "csv"), "csv", single_file=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = load_dataset(spark, str(tmp_path / "csv"), "csv", df.schema)
        assert len(read.inputFiles()) == 1 and read.rdd.getNumPartitions() > 4
        assert rows(read) == rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_from_elsewhere(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('id,text\n1,C:\\new\n2,"a ""b"""\n')
    read = load_dataset(spark, str(tmp_path / "plain.csv"), "csv", "id int, text string", line_breaks="none")
    assert sorted(map(tuple, read.collect())) == [(1, "C:\\new"), (2, 'a "b"')]
    (tmp_path / "broken.csv").write_text('id,text\n1,"a\nb"\n')
    read = load_dataset(spark, str(tmp_path / "broken.csv"), "csv", "id int, text string", line_breaks="quoted")
    assert list(map(tuple, read.collect())) == [(1, "a\nb")]
    with pytest.raises(ValueError, match="line breaks"):
        load_dataset(spark, str(tmp_path), "csv", "id int", line_breaks="some")


def test_kept_buckets(spark):
    left = spark.range(1, 200).selectExpr("id % 40 AS k", "id AS x")
    right = spark.range(900).selectExpr("CASE WHEN id < 300 THEN 5 WHEN id < 400 THEN NULL ELSE id % 60 END AS k", "id AS y")
    plain = left.join(right, "k")
    cold = joins.save_buckets(left, "kept_left", "k", 4)
    other = joins.save_buckets(right.filter("k <> 5"), "kept_cold", "k", 4)
    for _ in range(2):
        again = joins.join_buckets(joins.load_buckets(spark, "kept_left", "k"), joins.load_buckets(spark, "kept_cold", "k"))
        plan = layout.plan_text(again)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(again) == rows(plain.filter("k <> 5"))
    assert cold.hot is None and other.hot is None
    assert "SelectedBucketsCount: 1 out of 4" in layout.plan_text(again.filter("k = 7"))
    hot = joins.save_buckets(right, "kept_right", "k", 4, max_group_rows=50)
    assert hot.hot.count() >= 400
    assert rows(joins.join_buckets(cold, hot, 50)) == rows(plain)
    # a key that is hot on one side only, on the left
    swapped = joins.join_buckets(hot, cold, 50)
    assert rows(swapped.select("k", "x", "y")) == rows(plain)
    for name in ("kept_left", "kept_cold", "kept_right", "kept_right_hot"):
        spark.sql(f"DROP TABLE {name}")


def test_distinct_ids_and_sketches(spark):
    df = spark.range(5000).selectExpr("id % 3 AS k", "IF(id % 11 = 0, NULL, (id * 7919) % 100003) AS v").unionByName(
        spark.createDataFrame([(9, None), (2, 1 << 40)], "k bigint, v bigint")
    )
    exact = {r[0]: r[1] for r in df.groupBy("k").agg(F.count_distinct("v")).collect()}
    got = {r["k"]: r["distinct"] for r in aggregates.distinct_ids(df, ["k"], "v").collect()}
    assert got == {k: n for k, n in exact.items() if n}
    daily = aggregates.distinct_sketches(df.withColumn("d", F.col("v") % 5), ["k", "d"], "v")
    merged = {r["k"]: r["distinct"] for r in aggregates.merged_distinct(daily, ["k"]).collect()}
    assert all(abs(merged[k] - n) <= 0.07 * n + 1 for k, n in exact.items())
