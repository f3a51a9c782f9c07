"""Global, grouped, distinct, approximate and pivoted aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.numbers import count_rows, exact_avg, exact_sum, from_parts, unit_parts
from brindle.operators import aggregates
from brindle.operators.layout import cached
from brindle.plans.registry import query
from brindle.sources.tables import table
from brindle.workspace import materialize


@query("""
    SELECT COUNT(*) AS total_transactions,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_revenue,
           MAX(o_totalprice) AS max_revenue, MIN(o_totalprice) AS min_revenue
    FROM orders""")
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        count_rows().alias("total_transactions"),
        exact_sum("o_totalprice").alias("total_revenue"),
        exact_avg("o_totalprice").alias("avg_revenue"),
        F.max("o_totalprice").alias("max_revenue"),
        F.min("o_totalprice").alias("min_revenue"),
    )


@query("SELECT AVG(p_size) AS avg_size FROM part")
def agg_empty_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy().agg(F.avg("p_size").alias("avg_size"))


@query("SELECT AVG(l_linenumber) AS avg_line FROM lineitem")
def sql_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT AVG(l_linenumber) AS avg_line FROM {lineitem}",
        lineitem=table(spark, sf_dir, "lineitem"),
    )


@query("""
    SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderstatus ORDER BY total DESC""")
def agg_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dict form names its results ``sum(<column>)``; they are used under that name, then renamed."""
    total = from_parts(F.col("sum(cents_high)"), F.col("sum(cents_low)"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderstatus", *[part.alias(name) for name, part in unit_parts("o_totalprice", "cents").items()])
        .groupBy("o_orderstatus")
        .agg({"cents_high": "sum", "cents_low": "sum"})
        .select("o_orderstatus", total.alias("total"))
        .orderBy(F.col("total").desc())
    )


@query("SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY o_orderpriority")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").count()


@query("""
    SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS average,
           COUNT(*) AS lines, MAX(l_extendedprice) AS highest, MIN(l_extendedprice) AS lowest
    FROM lineitem GROUP BY l_returnflag""")
def group_multi_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            exact_sum("l_extendedprice").alias("total"),
            exact_avg("l_extendedprice").alias("average"),
            count_rows().alias("lines"),
            F.max("l_extendedprice").alias("highest"),
            F.min("l_extendedprice").alias("lowest"),
        )
    )


@query("""
    SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities are whole numbers, so their sums are exact as doubles."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .sum("l_quantity")
        .withColumnRenamed("sum(l_quantity)", "quantity")
    )


@query("""
    SELECT COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem""")
def count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each column is reduced to its distinct values on the map side before it shuffles."""
    return table(spark, sf_dir, "lineitem").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
    )


@query("SELECT COUNT(DISTINCT l_partkey) AS exact, true AS within_bound FROM lineitem")
def approx_distinct_within_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch is held to three times its standard error; its own value is engine-specific."""
    rsd = 0.05
    counts = aggregates.approximate_distinct(table(spark, sf_dir, "lineitem"), "l_partkey", rsd)
    error = F.try_divide(F.abs(F.col("approximate") - F.col("exact")), F.col("exact"))
    return counts.select("exact", (error <= 3 * rsd).alias("within_bound"))


@query("""
    SELECT l_returnflag, SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS F,
           SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS O
    FROM lineitem GROUP BY l_returnflag""")
def pivot_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return aggregates.pivot(
        lineitem, ["l_returnflag"], "l_linestatus", ["F", "O"], F.sum("l_quantity")
    )


@query("""
    SELECT o_orderstatus,
           SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END)::BIGINT AS "1-URGENT",
           SUM(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END)::BIGINT AS "2-HIGH",
           SUM(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 END)::BIGINT AS "3-MEDIUM",
           SUM(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 END)::BIGINT AS "4-NOT SPECIFIED",
           SUM(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END)::BIGINT AS "5-LOW"
    FROM orders GROUP BY o_orderstatus""")
def pivot_found_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values become columns as they are found, in their order."""
    orders = table(spark, sf_dir, "orders")
    return aggregates.pivot(orders, ["o_orderstatus"], "o_orderpriority", None, count_rows())


@query("""
    SELECT o_orderstatus, COUNT(*) AS order_count,
           CAST(ROUND(AVG(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE, 2) AS DOUBLE) AS avg_price
    FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus
    HAVING COUNT(*) > 1 ORDER BY avg_price DESC""")
def sql_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT o_orderstatus, COUNT(*) AS order_count,
                  ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS avg_price
           FROM {orders} WHERE o_totalprice > 1000
           GROUP BY o_orderstatus HAVING COUNT(*) > 1 ORDER BY avg_price DESC""",
        orders=table(spark, sf_dir, "orders"),
    )


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderpriority").distinct()


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
        FROM orders) WHERE place = 1""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return aggregates.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


LARGE_ORDERS = """
    SELECT COUNT(*) AS orders,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price,
           MAX(o_totalprice) AS max_price
    FROM orders WHERE o_totalprice > 300000"""


@query(LARGE_ORDERS)
def large_order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three figures in one pass."""
    large = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 300000)
    return large.agg(
        count_rows().alias("orders"),
        exact_avg("o_totalprice").alias("avg_price"),
        F.max("o_totalprice").alias("max_price"),
    )


@query("""
    SELECT 'by_priority' AS report, o_orderpriority AS label, COUNT(*) AS orders
    FROM orders WHERE o_totalprice > 300000 GROUP BY o_orderpriority
    UNION ALL
    SELECT 'by_status', o_orderstatus, COUNT(*)
    FROM orders WHERE o_totalprice > 300000 GROUP BY o_orderstatus""")
def cached_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports from one cached subset; the cache is released when they are written."""
    large = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 300000)
    with cached(large.select("o_orderpriority", "o_orderstatus")) as subset:
        reports = [
            subset.groupBy(F.lit(name).alias("report"), F.col(column).alias("label")).agg(
                count_rows().alias("orders")
            )
            for name, column in (("by_priority", "o_orderpriority"), ("by_status", "o_orderstatus"))
        ]
        return materialize(reports[0].unionByName(reports[1]), "reports")


@query("""
    SELECT p_type, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price
    FROM part GROUP BY p_type""")
def avg_price_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.groupBy("p_type").agg(exact_avg("p_retailprice").alias("avg_price"))


@query("""
    SELECT l_partkey, p_name, SUM(l_quantity) AS quantity FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY l_partkey, p_name ORDER BY quantity DESC, l_partkey LIMIT 5""")
def top5_products_by_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are looked up per product sold, not per line."""
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (
        sold.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_partkey", "p_name", "quantity")
        .orderBy(F.col("quantity").desc(), "l_partkey")
        .limit(5)
    )


@query("""
    SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_value
    FROM orders GROUP BY o_custkey""")
def avg_order_value_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(exact_avg("o_totalprice").alias("avg_value"))


@query("""
    SELECT o_custkey, COUNT(*) AS order_count FROM orders GROUP BY o_custkey
    ORDER BY order_count DESC, o_custkey LIMIT 3""")
def top3_users_by_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(count_rows().alias("order_count"))
    return counts.orderBy(F.col("order_count").desc(), "o_custkey").limit(3)


@query("""
    SELECT user_id, COUNT(*) AS count, COUNT(*) / AVG(COUNT(*)) OVER () AS ratio_to_mean
    FROM events GROUP BY user_id""")
def skew_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.skew_profile(table(spark, sf_dir, "events"), "user_id")


@query("""
    SELECT label, round(SUM((x::DOUBLE * 1208925819614629174706176.0)::HUGEINT)::DOUBLE / 1208925819614629174706176.0, 9) AS total
    FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY label""")
def sum_any_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors have no last decimal; the oracle sums multiples of 2^-80."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x"))
    return aggregates.sum_doubles(rows, ["label"], "x").select("label", F.round("total", 9).alias("total"))


@query("SELECT o_orderstatus, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus")
def distinct_orders_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys are dense: a bit each."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").join(orders, "l_orderkey")
    return aggregates.distinct_ids(lines, ["o_orderstatus"], "l_orderkey", "orders")


@query("SELECT event_type, true AS within_bound FROM events GROUP BY event_type")
def rolled_up_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by type and day as stored sketches; the days are merged without looking at an event again."""
    events = table(spark, sf_dir, "events")
    daily = aggregates.distinct_sketches(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")
    rolled = aggregates.merged_distinct(materialize(daily, "daily-sketches"), ["event_type"], "estimate")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    # four standard errors at 2^12 registers
    within = F.abs(F.col("estimate") - F.col("exact")) <= 4 * 1.04 / 64 * F.col("exact") + 1
    return exact.join(rolled, "event_type").select("event_type", within.alias("within_bound"))
