"""File round trips, write modes, partitioned layouts and partition counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators import layout
from brindle.plans.registry import query
from brindle.sources.tables import load_dataset, save_dataset, table
from brindle.workspace import ROWS_PER_PARTITION, scratch_path

ALL_CUSTOMERS = "SELECT * FROM customer"


def _round_trip(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, f"round-trip-{file_format}")
    save_dataset(customer, path, file_format)
    return load_dataset(spark, path, file_format, customer.schema)


@query(ALL_CUSTOMERS)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "parquet")


@query(ALL_CUSTOMERS)
def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "orc")


@query(ALL_CUSTOMERS)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "csv")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and blanks come back as they were."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "round-trip-texts")
    save_dataset(documents, path, "csv")
    return load_dataset(spark, path, "csv", documents.schema)


@query(ALL_CUSTOMERS)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


@query("""
    SELECT s_suppkey, s_name, count(*) AS copies
    FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier) GROUP BY s_suppkey, s_name""")
def write_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite, append and ignore in turn: two copies remain."""
    supplier = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "write-modes")
    for mode in ("overwrite", "append", "ignore"):
        save_dataset(supplier, path, mode=mode)
    copies = load_dataset(spark, path).groupBy("s_suppkey", "s_name")
    return copies.agg(F.count(F.lit(1)).alias("copies"))


def _by_status(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders-by-status")
    layout.write_partitioned(table(spark, sf_dir, "orders"), path, ["o_orderstatus"])
    return path


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def partition_prune_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_dataset(spark, _by_status(spark, sf_dir))
    return orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997""")
def partition_prune_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders-by-year-status")
    layout.write_partitioned(orders, path, ["o_year", "o_orderstatus"])
    pruned = load_dataset(spark, path).filter((F.col("o_year") == 1997) & (F.col("o_orderstatus") == "F"))
    return pruned.select("o_orderkey", "o_totalprice")


@query("""
    SELECT lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS code, COUNT(*) AS rows
    FROM supplier GROUP BY s_nationkey""")
def partition_listing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes with leading zeros stay texts when the written schema is given."""
    code = F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("code")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", code)
    path = scratch_path(spark, "suppliers-by-code")
    layout.write_partitioned(supplier, path, ["code"])
    return layout.list_partitions(spark, path, ["code"], supplier.schema)


@query("SELECT o_orderstatus, COUNT(*) AS rows FROM orders GROUP BY o_orderstatus")
def partition_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.list_partitions(spark, _by_status(spark, sf_dir), ["o_orderstatus"])


@query("""
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice
    FROM orders""")
def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are loaded, then only the pending ones are replaced by a corrected load."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "orders-dynamic")
    layout.overwrite_partitions(orders, path, ["o_orderstatus"])
    pending = orders.filter(F.col("o_orderstatus") == "P")
    corrected = pending.withColumn("o_totalprice", F.lit(0.0))
    layout.overwrite_partitions(corrected, path, ["o_orderstatus"])
    return load_dataset(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT COUNT(*) AS rows, true AS counted_once, true AS even FROM lineitem")
def partition_skew_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition against their mean: dealt in turn, no partition has far more than another."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    n = max(8, lines.count() // ROWS_PER_PARTITION)
    skew = layout.partition_skew(lines.repartition(n))
    return skew.agg(
        F.sum("rows").alias("rows"),
        (F.count_distinct("partition") == F.count(F.lit(1))).alias("counted_once"),
        (F.max("ratio_to_mean") < 1.5).alias("even"),
    )


@query("""
    SELECT layout, COUNT(*) AS rows, true AS as_asked
    FROM lineitem, (VALUES ('repartition'), ('coalesce'), ('by_column'), ('rebalance')) AS v(layout)
    GROUP BY layout""")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round robin fills every partition; coalesce and hashing fill at most those asked for.

    The partitions grow with the table. Rebalancing by a column with few values also
    splits those that are too large, so it has no count to ask for.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    n = max(8, lines.count() // ROWS_PER_PARTITION)
    partitions = F.col("partitions")
    layouts = {
        "repartition": (lines.repartition(n), partitions == n),
        "coalesce": (lines.repartition(n).coalesce(n // 2), partitions == n // 2),
        "by_column": (lines.repartition(n, "l_orderkey"), partitions <= n),
        "rebalance": (lines.hint("rebalance", "l_returnflag"), partitions >= 1),
    }
    counts = [
        layout.partition_count(df).select(F.lit(name).alias("layout"), "rows", asked.alias("as_asked"))
        for name, (df, asked) in layouts.items()
    ]
    return reduce(DataFrame.unionByName, counts)
