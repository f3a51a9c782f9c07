"""Projections, filters, CASE, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.categories import band, band_sql, band_udf
from brindle.operators.aggregates import late_cutoff
from brindle.plans.registry import query
from brindle.sources.tables import table

PRICE_BOUNDS, PRICE_LABELS = [905.0, 915.0], ["Low", "Medium", "High"]

PRICE_BANDS = """
    SELECT p_partkey, CASE WHEN p_retailprice < 905 THEN 'Low'
                           WHEN p_retailprice < 915 THEN 'Medium' ELSE 'High' END AS price_band
    FROM part"""


@query("SELECT c_custkey, c_name FROM customer")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_extendedprice * (1 + l_tax) AS price_with_tax,
           l_extendedprice * CAST(0.9 AS DOUBLE) AS discounted_price
    FROM lineitem""")
def computed_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (price * (1 + F.col("l_tax"))).alias("price_with_tax"),
        (price * 0.9).alias("discounted_price"),
    )


@query("""
    SELECT id, id % 5 AS key, id * 2 AS double_id, id % 2 = 0 AS is_even
    FROM (SELECT o_orderkey AS id FROM orders)""")
def range_mod_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders keyed by the remainder of their key."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).select(
        "id",
        (F.col("id") % 5).alias("key"),
        (F.col("id") * 2).alias("double_id"),
        (F.col("id") % 2 == 0).alias("is_even"),
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.filter(F.col("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000 AND (o_orderpriority = '1-URGENT') = true""")
def filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_urgent = F.col("o_orderpriority") == "1-URGENT"
    return (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000) & is_urgent)
        .select("o_orderkey", "o_totalprice")
    )


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 400000""")
def filter_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_totalprice") > 400000))
        .select("o_orderkey", "o_totalprice")
    )


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 300000 AND o_orderkey < o_custkey * 10""")
def filter_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter("o_totalprice > 300000 AND o_orderkey < o_custkey * 10")
        .select("o_orderkey", "o_totalprice")
    )


@query("SELECT * FROM orders WHERE o_totalprice > 450000")
def sql_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT * FROM {orders} WHERE o_totalprice > 450000",
        orders=table(spark, sf_dir, "orders"),
    )


@query("""
    SELECT o_orderstatus, COUNT(*) AS count FROM orders
    WHERE o_totalprice > 200000 GROUP BY o_orderstatus""")
def filter_project_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > 200000)
        .select("o_orderkey", "o_orderstatus")
        .groupBy("o_orderstatus")
        .count()
    )


@query(PRICE_BANDS)
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = band("p_retailprice", PRICE_BOUNDS, PRICE_LABELS)
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("price_band"))


@query(PRICE_BANDS)
def case_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = band_sql("p_retailprice", PRICE_BOUNDS, PRICE_LABELS)
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("price_band"))


@query(PRICE_BANDS)
def udf_price_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = band_udf(PRICE_BOUNDS, PRICE_LABELS)("p_retailprice")
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("price_band"))


@query("""
    SELECT event_id, ts, event_type, 'recent' AS freshness FROM events
    WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAYS""")
def late_cutoff_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return late_cutoff(events, "ts", "7 DAYS").select(
        "event_id", "ts", "event_type", F.lit("recent").alias("freshness")
    )


@query("""
    SELECT c_mktsegment, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_balance
    FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment
    HAVING CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) > 4500""")
def mixed_api_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API filter, SQL aggregate, API filter: one plan."""
    active = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    averages = spark.sql(
        """SELECT c_mktsegment,
                  CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_balance
           FROM {active} GROUP BY c_mktsegment""",
        active=active,
    )
    return averages.filter(F.col("avg_balance") > 4500)


NESTED_FIELDS = """
    SELECT c_custkey, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
           c_acctbal
    FROM customer"""


def _nested_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("c_name", "#")
    name = F.struct(parts[0].alias("first"), parts[1].alias("last"))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), "c_acctbal")


@query(NESTED_FIELDS)
def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_customers(spark, sf_dir).select(
        "c_custkey",
        F.col("name.first").alias("first_name"),
        F.col("name.last").alias("last_name"),
        "c_acctbal",
    )


@query(NESTED_FIELDS)
def sql_nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT c_custkey, name.first AS first_name, name.last AS last_name, c_acctbal
           FROM {customers}""",
        customers=_nested_customers(spark, sf_dir),
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return orders.orderBy("o_orderdate", "o_orderkey")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("""
    SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice > 905
    ORDER BY p_retailprice DESC, p_partkey""")
def filter_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_retailprice") > 905)
        .select("p_partkey", "p_name", "p_retailprice")
        .orderBy(F.col("p_retailprice").desc(), "p_partkey")
    )
