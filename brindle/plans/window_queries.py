"""Window functions over the orders of a customer, and over keys that hold most rows.

The ``*_hot_key`` queries group by columns with a handful of values, so that every
group is split; the others split a group only above the default size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.numbers import major_units, minor_units
from brindle.operators import windows
from brindle.plans.registry import query
from brindle.sources.tables import table

CUSTOMER, BY_DATE = ["o_custkey"], ["o_orderdate", "o_orderkey"]


def _orders(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", *columns)


def _over_customer(expression: str, name: str, order: str = "o_orderdate, o_orderkey") -> str:
    return f"""
    SELECT o_custkey, o_orderkey,
           {expression} OVER (PARTITION BY o_custkey ORDER BY {order}) AS {name}
    FROM orders"""


@query("""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_num
    FROM orders""")
def win_row_number_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_totalprice")
    numbered = windows.row_number(orders, [], ["-o_totalprice", "o_orderkey"])
    return numbered.select("o_orderkey", "row_num")


@query(_over_customer("row_number()", "row_num"))
def win_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate")
    numbered = windows.row_number(orders, CUSTOMER, BY_DATE)
    return numbered.select("o_custkey", "o_orderkey", "row_num")


@query(_over_customer("rank()", "rank", "o_orderpriority DESC"))
def win_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderpriority")
    ranked = windows.rank(orders, CUSTOMER, ["-o_orderpriority"])
    return ranked.select("o_custkey", "o_orderkey", "rank")


@query(_over_customer("dense_rank()", "dense_rank", "o_orderpriority DESC"))
def win_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderpriority")
    ranked = windows.dense_rank(orders, CUSTOMER, ["-o_orderpriority"])
    return ranked.select("o_custkey", "o_orderkey", "dense_rank")


@query(_over_customer("lag(o_totalprice)", "prev_price"))
def win_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate", "o_totalprice")
    shifted = windows.lag(orders, CUSTOMER, BY_DATE, "o_totalprice", "prev_price")
    return shifted.select("o_custkey", "o_orderkey", "prev_price")


@query("""
    SELECT o_orderkey, lag(o_totalprice) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS prev_price
    FROM orders""")
def win_lag_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_totalprice")
    shifted = windows.lag(
        orders, [], ["-o_totalprice", "o_orderkey"], "o_totalprice", "prev_price"
    )
    return shifted.select("o_orderkey", "prev_price")


@query(_over_customer("lead(o_totalprice)", "next_price"))
def win_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate", "o_totalprice")
    shifted = windows.lead(orders, CUSTOMER, BY_DATE, "o_totalprice", "next_price")
    return shifted.select("o_custkey", "o_orderkey", "next_price")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice - lag(o_totalprice) OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS change FROM orders""")
def win_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate", "o_totalprice")
    changed = windows.change(orders, CUSTOMER, BY_DATE, "o_totalprice")
    return changed.select("o_custkey", "o_orderkey", "change")


RUNNING_TOTAL = """
    SELECT o_custkey, o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
    FROM orders"""


def _running_total(df: DataFrame, keys: list[str], **options: int) -> DataFrame:
    cents = df.withColumn("cents", minor_units("o_totalprice").cast("decimal(19,0)"))
    summed = windows.running_sum(cents, keys, BY_DATE, "cents", "total", **options)
    return summed.select(*keys, "o_orderkey", major_units(F.col("total")).alias("running_total"))


@query(RUNNING_TOTAL)
def win_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate", "o_totalprice")
    return _running_total(orders, CUSTOMER)


@query(RUNNING_TOTAL.replace("PARTITION BY o_custkey ", "").replace("o_custkey, ", "", 1))
def win_running_total_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running_total(_orders(spark, sf_dir, "o_orderdate", "o_totalprice"), [])


@query("""
    SELECT o_custkey, o_orderkey,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(*) OVER w AS moving_avg
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def win_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate", "o_totalprice")
    averaged = windows.moving_avg(orders, CUSTOMER, BY_DATE, "o_totalprice", preceding=2, scale=2)
    return averaged.select("o_custkey", "o_orderkey", "moving_avg")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice / CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)))
        OVER (PARTITION BY o_custkey) AS DOUBLE) * 100 AS pct_of_total FROM orders""")
def win_pct_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_totalprice")
    shares = windows.percent_of_total(orders, CUSTOMER, "o_totalprice", scale=2)
    return shares.select("o_custkey", "o_orderkey", "pct_of_total")


@query("""
    SELECT o_orderkey, COUNT(o_orderkey) OVER (ORDER BY o_orderdate) AS running_count FROM orders""")
def win_running_count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderdate")
    counted = windows.running_count(orders, [], ["o_orderdate"], "o_orderkey")
    return counted.select("o_orderkey", "running_count")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
    WHERE rank <= 3""")
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_totalprice")
    return windows.top_n(orders, CUSTOMER, ["-o_totalprice", "o_orderkey"], 3).select(
        "o_custkey", "o_orderkey", "o_totalprice", "rank"
    )


@query("""
    SELECT o_custkey, o_orderkey, COUNT(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS orders_so_far FROM orders""")
def user_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders a customer has placed up to each one."""
    orders = _orders(spark, sf_dir, "o_custkey", "o_orderdate").withColumn("one", F.lit(1))
    counted = windows.running_sum(orders, CUSTOMER, BY_DATE, "one", "orders_so_far")
    return counted.select("o_custkey", "o_orderkey", "orders_so_far")


@query("""
    SELECT DISTINCT o_custkey, o_totalprice FROM (
        SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS place
        FROM orders) WHERE place = 2""")
def second_highest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.nth_highest(table(spark, sf_dir, "orders"), CUSTOMER, "o_totalprice", 2)


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice - CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)))
        OVER (PARTITION BY o_custkey) AS DOUBLE) / COUNT(*) OVER (PARTITION BY o_custkey) AS diff_from_avg
    FROM orders""")
def diff_from_user_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_custkey", "o_totalprice")
    compared = windows.difference_from_avg(orders, CUSTOMER, "o_totalprice", scale=2)
    return compared.select("o_custkey", "o_orderkey", "diff_from_avg")


STATUS = ["o_orderstatus"]


@query("""
    SELECT o_orderstatus, o_orderkey, row_number() OVER (
        PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders""")
def win_row_number_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus", "o_orderdate")
    size = windows.split_size(orders.count())
    numbered = windows.row_number(orders, STATUS, BY_DATE, max_group_rows=size)
    return numbered.select("o_orderstatus", "o_orderkey", "row_num")


@query("""
    SELECT o_orderstatus, o_orderkey, rank() OVER (
        PARTITION BY o_orderstatus ORDER BY o_orderdate DESC) AS rank FROM orders""")
def win_rank_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus", "o_orderdate")
    size = windows.split_size(orders.count())
    ranked = windows.rank(orders, STATUS, ["-o_orderdate"], max_group_rows=size)
    return ranked.select("o_orderstatus", "o_orderkey", "rank")


@query(RUNNING_TOTAL.replace("o_custkey", "o_orderstatus"))
def win_running_total_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus", "o_orderdate", "o_totalprice")
    return _running_total(orders, STATUS, max_group_rows=windows.split_size(orders.count()))


@query("""
    SELECT o_orderstatus, o_orderkey, o_totalprice - lag(o_totalprice) OVER (
        PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS change FROM orders""")
def win_change_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus", "o_orderdate", "o_totalprice")
    size = windows.split_size(orders.count())
    changed = windows.change(orders, STATUS, BY_DATE, "o_totalprice", max_group_rows=size)
    return changed.select("o_orderstatus", "o_orderkey", "change")


@query("""
    SELECT o_orderstatus, o_orderkey, o_totalprice / CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)))
        OVER (PARTITION BY o_orderstatus) AS DOUBLE) * 100 AS pct_of_total FROM orders""")
def win_pct_of_total_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus", "o_totalprice")
    size = windows.split_size(orders.count())
    shares = windows.percent_of_total(orders, STATUS, "o_totalprice", scale=2, max_group_rows=size)
    return shares.select("o_orderstatus", "o_orderkey", "pct_of_total")


# A seventh of a price has no last decimal; its multiples of 2^-60 are exact integers here.
SEVENTHS = "SELECT o_orderstatus, o_orderkey, o_orderdate, o_totalprice / 7.0::DOUBLE AS seventh FROM orders"
IN_UNITS = f"SELECT *, (seventh * 1152921504606846976.0)::HUGEINT AS units FROM ({SEVENTHS})"


def _sevenths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "o_orderstatus", "o_orderdate", (F.col("o_totalprice") / 7).alias("seventh"))


@query(f"""
    SELECT o_orderstatus, o_orderkey, round((SUM(units) OVER w)::DOUBLE / 1152921504606846976, 3) AS running_total,
           round((SUM(units) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))::DOUBLE / 1152921504606846976
                 / COUNT(*) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS moving_avg
    FROM ({IN_UNITS}) WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey)""")
def win_exact_doubles_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and means of numbers that are no decimals, over split groups."""
    rows = _sevenths(spark, sf_dir)
    size = windows.split_size(rows.count(), 16)
    summed = windows.running_sum(rows, STATUS, BY_DATE, "seventh", max_group_rows=size)
    out = windows.moving_avg(summed, STATUS, BY_DATE, "seventh", 4, max_group_rows=size)
    rounded = [F.round("running_total", 3).alias("running_total"), F.round("moving_avg", 6).alias("moving_avg")]
    return out.select("o_orderstatus", "o_orderkey", *rounded)


@query(f"""
    SELECT o_orderstatus, o_orderkey,
           round(seventh - (SUM(units) OVER g)::DOUBLE / 1152921504606846976 / COUNT(*) OVER g, 6) AS diff_from_avg
    FROM ({IN_UNITS}) WINDOW g AS (PARTITION BY o_orderstatus)""")
def win_exact_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = windows.difference_from_avg(_sevenths(spark, sf_dir), STATUS, "seventh")
    return compared.select("o_orderstatus", "o_orderkey", F.round("diff_from_avg", 6).alias("diff_from_avg"))
