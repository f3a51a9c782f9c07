"""Synthetic tables under the keys of the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.numbers import count_rows
from brindle.operators.joins import without_match
from brindle.plans.registry import query
from brindle.sources import generate
from brindle.sources.tables import table


def _generated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A user per customer, a product per part and an order per line, under the keys they have."""
    customer, part, orders, lines = (table(spark, sf_dir, t) for t in ("customer", "part", "orders", "lineitem"))
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
    )
    return {
        "users": generate.users_of(customer.select(F.col("c_custkey").alias("id"))),
        "products": generate.products_of(part.select(F.col("p_partkey").alias("id"))),
        "orders": generate.orders_of(sold),
    }


@query("""
    SELECT COUNT(*) AS users, COUNT(DISTINCT c_custkey) AS distinct_ids, MAX(c_custkey) AS last_id,
           true AS ages_ok, true AS dates_ok, CAST(8 AS BIGINT) AS countries, true AS emails_ok
    FROM customer""")
def gen_users_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _generated(spark, sf_dir)["users"]
    return users.agg(
        count_rows().alias("users"),
        F.count_distinct("user_id").alias("distinct_ids"),
        F.max("user_id").alias("last_id"),
        ((F.min("age") >= 18) & (F.max("age") <= 75)).alias("ages_ok"),
        F.every(F.col("registration_date").between("2020-01-01", "2024-12-31")).alias("dates_ok"),
        F.count_distinct("country").alias("countries"),
        F.every(F.col("email") == F.concat("username", F.lit("@example.com"))).alias("emails_ok"),
    )


@query("""
    SELECT COUNT(*) AS products, MAX(p_partkey) AS last_id, true AS prices_ok, true AS stock_ok, true AS ratings_ok,
           CAST(7 AS BIGINT) AS categories, CAST(5 AS BIGINT) AS brands
    FROM part""")
def gen_products_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _generated(spark, sf_dir)["products"]
    return products.agg(
        count_rows().alias("products"),
        F.max("product_id").alias("last_id"),
        F.every(F.col("price").between(10, 1000)).alias("prices_ok"),
        F.every(F.col("stock_quantity").between(0, 1000)).alias("stock_ok"),
        F.every(F.col("rating").between(1, 5)).alias("ratings_ok"),
        F.count_distinct("category").alias("categories"),
        F.count_distinct("brand").alias("brands"),
    )


HOT_SHARE = 0.3


@query("""
    SELECT COUNT(*) AS orders, COUNT(DISTINCT l_orderkey * 16 + l_linenumber) AS order_ids, CAST(0 AS BIGINT) AS without_user,
           CAST(0 AS BIGINT) AS without_product, true AS hot_share_ok, true AS others_even
    FROM lineitem""")
def gen_orders_fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with drawn keys: all exist, one customer has the share it was given, the others are about even."""
    customer, part, lines = (table(spark, sf_dir, t) for t in ("customer", "part", "lineitem"))
    ids = lines.select((F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("id"))
    hot = customer.agg(F.max("c_custkey")).first()[0]
    keyed = generate.draw_keys(ids, customer, "c_custkey", "user_id", {hot: HOT_SHARE})
    orders = generate.orders_of(generate.draw_keys(keyed, part, "p_partkey", "product_id"))
    no_user = without_match(orders.select("user_id").distinct(), customer, "user_id", "c_custkey")
    no_product = without_match(orders.select("product_id").distinct(), part, "product_id", "p_partkey")
    per_user = orders.groupBy("user_id").agg(count_rows().alias("n"))
    is_hot, mean = F.col("user_id") == hot, F.avg(F.when(F.col("user_id") != hot, F.col("n")))
    # five deviations of a share and ten of a count
    tolerance = 5 * F.sqrt(F.lit(HOT_SHARE * (1 - HOT_SHARE)) / F.sum("n"))
    shares = per_user.agg(
        (F.abs(F.sum(F.when(is_hot, F.col("n"))) / F.sum("n") - HOT_SHARE) < tolerance).alias("hot_share_ok"),
        (F.max(F.when(~is_hot, F.col("n"))) < mean + 10 * F.sqrt(mean) + 10).alias("others_even"),
    )
    return orders.agg(count_rows().alias("orders"), F.count_distinct("order_id").alias("order_ids")).withColumns(
        {
            "without_user": no_user.select(count_rows()).scalar(),
            "without_product": no_product.select(count_rows()).scalar(),
            **{name: shares.select(name).scalar() for name in shares.columns},
        }
    )


@query("""
    SELECT 'users' AS name, COUNT(*) AS rows FROM customer
    UNION ALL SELECT 'products', COUNT(*) FROM part
    UNION ALL SELECT 'orders', COUNT(*) FROM lineitem""")
def gen_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed rows of the three tables that are made for the sizes of the given ones."""
    rows = {"users": "customer", "products": "part", "orders": "lineitem"}
    made = generate.generate(spark, **{name: table(spark, sf_dir, given).count() for name, given in rows.items()})
    well_formed = {
        "users": F.col("email").rlike("^user_[0-9A-Z]{8}@example.com$") & F.col("country").isin(generate.COUNTRIES),
        "products": F.col("product_name").rlike("^Product_[0-9A-Z]{6}$") & F.col("price").between(10, 1000),
        "orders": F.col("order_id").rlike("^ORD-[0-9A-Z]{10}$") & F.col("status").isin(generate.STATUSES),
    }
    sizes = [made[name].agg(F.lit(name).alias("name"), F.count_if(ok).alias("rows")) for name, ok in well_formed.items()]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])
