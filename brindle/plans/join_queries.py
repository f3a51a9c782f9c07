"""Equi-joins of all kinds, and joins that feed an aggregate.

Where an aggregate follows a join on the same key, the rows are summed per key
first: the join then sees one row per key, and a frequent key is combined on the
map side instead of meeting in one join task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.numbers import count_rows, exact_sum, from_parts, unit_parts
from brindle.operators import joins
from brindle.operators.windows import split_size
from brindle.plans.registry import query
from brindle.sources.tables import table
from brindle.workspace import ROWS_PER_PARTITION

@query("""
    SELECT n_name AS country, COUNT(DISTINCT o_orderkey) AS order_count,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY total_revenue DESC, country LIMIT 10""")
def sql_revenue_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT n.n_name AS country,
                  COUNT(DISTINCT o.o_orderkey) AS order_count,
                  CAST(SUM(CAST(RINT(o.o_totalprice * 100) AS DECIMAL(19,0))) / 100 AS DOUBLE) AS total_revenue
           FROM {customer} c
           JOIN {orders} o ON c.c_custkey = o.o_custkey
           JOIN {nation} n ON c.c_nationkey = n.n_nationkey
           GROUP BY n.n_name
           ORDER BY total_revenue DESC, country
           LIMIT 10""",
        customer=table(spark, sf_dir, "customer"),
        orders=table(spark, sf_dir, "orders"),
        nation=table(spark, sf_dir, "nation"),
    )


CUSTOMER_NATION = "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"


@query(CUSTOMER_NATION)
def join_inner_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nationkey")
    return customer.join(nation, "nationkey").select("c_custkey", "n_name")


@query("""
    SELECT c_custkey, c_nationkey, n_nationkey, n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def join_inner_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select(
        "c_custkey", "c_nationkey", "n_nationkey", "n_name"
    )


def _outer_join(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    """Dear orders against customers in credit: both sides have rows without a partner."""
    orders = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > 400000)
        .select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    )
    customer = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select(F.col("c_custkey").alias("custkey"), "c_name")
    )
    return joins.skew_join(orders, customer, "custkey", how).select(
        "custkey", "o_orderkey", "c_name"
    )


def _outer_oracle(how: str) -> str:
    return f"""
    SELECT custkey, o_orderkey, c_name
    FROM (SELECT o_custkey AS custkey, o_orderkey FROM orders WHERE o_totalprice > 400000)
    {how} JOIN (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 0) USING (custkey)"""


@query(_outer_oracle("LEFT"))
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outer_join(spark, sf_dir, "left")


@query(_outer_oracle("RIGHT"))
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outer_join(spark, sf_dir, "right")


@query(_outer_oracle("FULL"))
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outer_join(spark, sf_dir, "full")


LINES_WITH_BRAND = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _lines_and_brands(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), "l_suppkey"
    )
    return lines, table(spark, sf_dir, "part").select("p_partkey", "p_brand")


def _with_brand(joined: DataFrame) -> DataFrame:
    return joined.select(
        "l_orderkey", "l_linenumber", F.col("p_partkey").alias("l_partkey"), "l_suppkey", "p_brand"
    )


@query(LINES_WITH_BRAND)
def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, brands = _lines_and_brands(spark, sf_dir)
    return _with_brand(joins.lookup_join(lines, brands, "p_partkey"))


@query(LINES_WITH_BRAND)
def join_sort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, brands = _lines_and_brands(spark, sf_dir)
    return _with_brand(joins.sort_merge_join(lines, brands, "p_partkey"))


@query("""
    SELECT c_custkey, n_name, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_lookup_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    places = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joins.lookup_join(
        table(spark, sf_dir, "customer"), places, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "n_name", "r_name")


@query("""
    SELECT e.event_id, e.event_type, t.type_events FROM events e
    JOIN (SELECT event_type, COUNT(*) AS type_events FROM events GROUP BY event_type) t
    ON e.event_type = t.event_type""")
def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key is hot here: each event type holds a fifth of the events."""
    events = table(spark, sf_dir, "events")
    types = events.groupBy("event_type").agg(count_rows().alias("type_events"))
    max_group_rows = split_size(events.count())
    return joins.skew_join(
        events.select("event_id", "event_type"), types, "event_type", "inner", max_group_rows
    ).select("event_id", "event_type", "type_events")


@query("""
    SELECT event_id, event_type, weight
    FROM (SELECT event_id, event_type FROM events WHERE event_type <> 'click')
    FULL JOIN (SELECT event_type, COUNT(*) AS weight FROM events
               WHERE event_type <> 'view' GROUP BY event_type) USING (event_type)""")
def join_salted_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full join on hot keys, some without a partner on either side."""
    events = table(spark, sf_dir, "events")
    types = events.filter("event_type <> 'view'").groupBy("event_type").agg(count_rows().alias("weight"))
    max_group_rows = split_size(events.count())
    rows = events.filter("event_type <> 'click'").select("event_id", "event_type")
    return joins.skew_join(rows, types, "event_type", "full", max_group_rows).select(
        "event_id", "event_type", "weight"
    )


@query("""
    SELECT user_id, COUNT(*) AS pairs, CAST(SUM(day_events) AS BIGINT) AS day_events
    FROM events JOIN (SELECT user_id, date_trunc('day', ts) AS day, COUNT(*) AS day_events
                      FROM events GROUP BY user_id, day) USING (user_id)
    GROUP BY user_id""")
def join_skew_many_to_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a user with each of the user's days; summed as the pairs are made."""
    events = table(spark, sf_dir, "events")
    days = events.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(count_rows().alias("day_events"))
    small = split_size(events.count(), 1024)
    pairs = joins.skew_join(events.select("user_id", "event_id"), days, "user_id", "inner", small)
    return pairs.groupBy("user_id").agg(count_rows().alias("pairs"), F.sum("day_events").alias("day_events"))


@query("""
    SELECT c_custkey, COUNT(*) AS order_count
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables are kept in buckets of the customer; the join reads them as they lie."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey"
    )
    left, right = (_in_buckets(df, f"{name}_{_folder_key(sf_dir)}", "c_custkey") for name, df in (("customer", customer), ("orders", orders)))
    return joins.join_buckets(left, right).groupBy("c_custkey").agg(count_rows().alias("order_count"))


BUCKETS = 8


def _folder_key(sf_dir: str) -> str:
    return hashlib.md5(sf_dir.encode()).hexdigest()


def _in_buckets(df: DataFrame, name: str, key: str) -> joins.Buckets:
    """The table of that name, written if this session has not yet."""
    buckets = max(BUCKETS, -(-df.count() // ROWS_PER_PARTITION))
    name = f"buckets_{buckets}_{name}"
    if joins.has_buckets(df.sparkSession, name):
        return joins.load_buckets(df.sparkSession, name, key)
    return joins.save_buckets(df, name, key, buckets)


@query("""
    SELECT c_custkey, c_mktsegment, COUNT(*) AS urgent
    FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'
    GROUP BY c_custkey, c_mktsegment""")
def bucketed_join_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two joins of the same kept buckets: the second writes nothing and shuffles nothing."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    kept = [
        _in_buckets(df, f"{name}_{_folder_key(sf_dir)}", "c_custkey")
        for name, df in (("segments", customer), ("priorities", orders))
    ]
    with_orders = joins.join_buckets(*kept)
    urgent = with_orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return urgent.groupBy("c_custkey", "c_mktsegment").agg(count_rows().alias("urgent"))


@query("""
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def users_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.without_match(customer, urgent, "c_custkey", "o_custkey")


@query("""
    SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (
        SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49)""")
def products_never_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    bulk = table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") >= 49)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return joins.without_match(part, bulk, "p_partkey", "l_partkey")


@query("""
    SELECT p_type, COUNT(*) AS lines,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    sums = {"lines": F.lit(1), **unit_parts("l_extendedprice", "cents")}
    lineitem = table(spark, sf_dir, "lineitem")
    summed = joins.join_and_sum(lineitem, part, "l_partkey", "p_partkey", ["p_type"], sums)
    return summed.select("p_type", "lines", from_parts(F.col("cents_high"), F.col("cents_low")).alias("revenue"))


@query("""
    SELECT c_custkey, c_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
           COUNT(o_orderkey) AS order_count
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
    ORDER BY total_spent DESC, c_custkey LIMIT 10""")
def user_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order sums per customer first; the names join only what is left."""
    spending = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            exact_sum("o_totalprice").alias("total_spent"),
            F.count("o_orderkey").alias("order_count"),
        )
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (
        customer.join(spending, F.col("c_custkey") == F.col("o_custkey"))
        .select("c_custkey", "c_name", "total_spent", "order_count")
        .orderBy(F.col("total_spent").desc(), "c_custkey")
        .limit(10)
    )


@query("""
    SELECT n_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name""")
def avg_order_value_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sums = {"n": F.lit(1), **unit_parts("o_totalprice", "cents")}
    orders = table(spark, sf_dir, "orders")
    per_nation = joins.join_and_sum(
        orders, customer, "o_custkey", "c_custkey", ["c_nationkey"], sums
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg((from_parts(F.sum("cents_high"), F.sum("cents_low")) / F.sum("n")).alias("avg_value"))
    )


@query("""
    SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; most have no label."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.skew_join(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left_outer")


@query("""
    SELECT id, quality, label FROM (SELECT doc_id AS id, quality FROM labels)
    FULL JOIN (SELECT vec_id AS id, label FROM embeddings) USING (id)""")
def join_outer_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and embeddings: rows without a partner on both sides, every key split."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), "quality")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label")
    doubled = vectors.unionByName(vectors)
    return joins.skew_join(labels, doubled, "id", "outer", 1).distinct()


@query("""
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""")
def customers_without_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.without_match(customer, table(spark, sf_dir, "events"), "c_custkey", "user_id")


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.without_match(orders, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
