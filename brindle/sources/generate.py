"""Synthetic users, products and orders, generated by Spark from ids alone.

Every value is a hash of (id, seed, field), so a row does not depend on
partitioning, repeated tasks give the same rows, and foreign keys are drawn from
the id ranges without looking at the other tables.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.windows import row_number
from brindle.sources.tables import save_dataset
from brindle.workspace import broadcast_within, materialize, partitions_for

# The vocabularies and row counts of the data model.
COUNTRIES = ["USA", "UK", "Germany", "France", "Japan", "Australia", "Canada", "Brazil"]
CATEGORIES = ["Electronics", "Clothing", "Books", "Home", "Sports", "Beauty", "Food"]
BRANDS = ["BrandA", "BrandB", "BrandC", "BrandD", "BrandE"]
STATUSES = ["PENDING", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"]
SIZES = {
    "very_small": {"users": 100, "products": 50, "orders": 100},
    "small": {"users": 1_000, "products": 500, "orders": 1_000},
    "medium": {"users": 10_000, "products": 5_000, "orders": 10_000},
    "large": {"users": 100_000, "products": 50_000, "orders": 1_000_000},
    "very_large": {"users": 1_000_000, "products": 500_000, "orders": 10_000_000},
}


class _Fields:
    """Draws for one table: ``field`` keeps the columns of a row independent."""

    def __init__(self, seed: int, table: str):
        self._seed, self._table = seed, table

    def number(self, field: str, low: int, high: int) -> Column:
        """Whole number from ``low`` to ``high``, both included."""
        drawn = F.xxhash64("id", F.lit(self._seed), F.lit(f"{self._table}.{field}"))
        return F.pmod(drawn, F.lit(high - low + 1).cast("bigint")) + F.lit(low)

    def integer(self, field: str, low: int, high: int) -> Column:
        return self.number(field, low, high).cast("int")

    def decimal(self, field: str, low: int, high: int, scale: int) -> Column:
        unit = 10**scale
        return self.number(field, low * unit, high * unit) / F.lit(float(unit))

    def choice(self, field: str, values: Sequence[str]) -> Column:
        options = F.array(*[F.lit(v) for v in values])
        return F.element_at(options, self.integer(field, 1, len(values)))

    def date(self, field: str, first: str, last: str) -> Column:
        days = (date.fromisoformat(last) - date.fromisoformat(first)).days
        return F.date_add(F.to_date(F.lit(first)), self.integer(field, 0, days))

    def text(self, field: str, length: int) -> Column:
        """Letters and digits in base 36."""
        top = F.conv(self.number(field, 0, 36**length - 1).cast("string"), 10, 36)
        return F.lpad(top, length, "0")


def _ids(spark: SparkSession, count: int) -> DataFrame:
    partitions = partitions_for(spark, count)
    return spark.range(1, count + 1, 1, *partitions)


def users(spark: SparkSession, count: int, seed: int = 42) -> DataFrame:
    """user_id, username, email, age, country, registration_date, is_active."""
    return users_of(_ids(spark, count), seed)


def users_of(ids: DataFrame, seed: int = 42) -> DataFrame:
    """A user for each value of the column ``id``."""
    draw = _Fields(seed, "users")
    username = F.concat(F.lit("user_"), draw.text("name", 8))
    return ids.select(
        F.col("id").alias("user_id"),
        username.alias("username"),
        F.concat(username, F.lit("@example.com")).alias("email"),
        draw.integer("age", 18, 75).alias("age"),
        draw.choice("country", COUNTRIES).alias("country"),
        draw.date("registered", "2020-01-01", "2024-12-31").alias("registration_date"),
        (draw.number("active", 0, 1) == 1).alias("is_active"),
    )


def products(spark: SparkSession, count: int, seed: int = 42) -> DataFrame:
    """product_id, product_name, category, price, stock_quantity, rating, brand."""
    return products_of(_ids(spark, count), seed)


def products_of(ids: DataFrame, seed: int = 42) -> DataFrame:
    """A product for each value of the column ``id``."""
    draw = _Fields(seed, "products")
    return ids.select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("Product_"), draw.text("name", 6)).alias("product_name"),
        draw.choice("category", CATEGORIES).alias("category"),
        draw.decimal("price", 10, 1000, 2).alias("price"),
        draw.integer("stock", 0, 1000).alias("stock_quantity"),
        draw.decimal("rating", 1, 5, 1).alias("rating"),
        draw.choice("brand", BRANDS).alias("brand"),
    )


def orders(
    spark: SparkSession, count: int, user_count: int, product_count: int, seed: int = 42
) -> DataFrame:
    """order_id (unique), user_id, product_id, quantity, total_amount, order_date, status."""
    draw = _Fields(seed, "orders")
    ids = _ids(spark, count)
    keyed = ids.withColumns(
        {"user_id": draw.number("user", 1, user_count), "product_id": draw.number("product", 1, product_count)}
    )
    return orders_of(keyed, seed)


def alias_table(shares: Sequence[float]) -> list[tuple[float, int]]:
    """(chance of staying, other class) per class: a class drawn evenly, then kept or swapped, has its share."""
    n = len(shares)
    scaled = [share * n for share in shares]
    table = [(1.0, i) for i in range(n)]
    small, large = ([i for i in range(n) if (scaled[i] < 1) == low] for low in (True, False))
    while small and large:
        i, j = small.pop(), large.pop()
        table[i] = (scaled[i], j)
        scaled[j] += scaled[i] - 1
        (small if scaled[j] < 1 else large).append(j)
    return table


def draw_keys(
    ids: DataFrame, keys: DataFrame, key: str, name: str, shares: dict[int, float] | None = None, seed: int = 42
) -> DataFrame:
    """``ids`` with a key of the table ``keys`` drawn for each value of the column ``id``, in the column ``name``.

    ``shares`` gives the share of rows that a key is to have; the other rows are spread
    evenly over the other keys. Keys may have gaps: a row draws a rank, and the ranked
    keys are joined, which no frequent key takes part in. Draws are hashes of the id.
    """
    shares = shares or {}
    rest = 1 - sum(shares.values())
    if rest < -1e-9 or min([*shares.values(), 0]) < 0:
        raise ValueError("shares have to lie between 0 and 1 and add up to 1 at most")
    fields = _Fields(seed, f"keys.{name}")
    stated = list(shares)
    others = keys.select(F.col(key).alias(name)).distinct()
    ranked = row_number(others.filter(~F.col(name).isin(stated)) if stated else others, [], [name], "_rank")
    ranked = materialize(ranked, "ranked-keys")
    n = ranked.count()
    table = alias_table([*shares.values(), max(rest, 0.0)])
    drawn = fields.integer("class", 0, len(table) - 1)
    stays = fields.number("stay", 0, (1 << 53) - 1) < F.element_at(F.array(*[F.lit(p * 2.0**53) for p, _ in table]), drawn + 1)
    other = F.element_at(F.array(*[F.lit(j) for _, j in table]), drawn + 1)
    classed = ids.withColumn("_class", F.when(stays, drawn).otherwise(other))
    is_stated = F.col("_class") < len(stated)
    if n == 0 and not classed.filter(~is_stated).isEmpty():
        raise ValueError("no key is left to draw from")
    cold = classed.filter(~is_stated).withColumn("_rank", fields.number("rank", 1, max(n, 1)))
    cold = cold.join(broadcast_within(ranked), "_rank").drop("_rank", "_class")
    if not stated:
        return cold
    values = F.array(*[F.lit(k).cast(keys.schema[key].dataType) for k in stated])
    hot = classed.filter(is_stated).withColumn(name, F.element_at(values, F.col("_class") + 1)).drop("_class")
    return hot.unionByName(cold)


def orders_of(ids: DataFrame, seed: int = 42) -> DataFrame:
    """An order for each value of the column ``id``, with the ``user_id`` and ``product_id`` beside it."""
    draw = _Fields(seed, "orders")
    number = F.lpad(F.conv(F.col("id").cast("string"), 10, 36), 10, "0")
    return ids.select(
        F.concat(F.lit("ORD-"), number).alias("order_id"),
        "user_id",
        "product_id",
        draw.integer("quantity", 1, 10).alias("quantity"),
        draw.decimal("amount", 20, 5000, 2).alias("total_amount"),
        draw.date("ordered", "2022-01-01", "2024-12-31").alias("order_date"),
        draw.choice("status", STATUSES).alias("status"),
    )


def generate(
    spark: SparkSession,
    size: str = "small",
    seed: int = 42,
    **counts: int,
) -> dict[str, DataFrame]:
    """The three tables at a preset size; ``users=``, ``products=``, ``orders=`` override it."""
    if size not in SIZES:
        raise ValueError(f"unknown size {size!r}, expected one of {', '.join(SIZES)}")
    unknown = counts.keys() - SIZES[size].keys()
    if unknown:
        raise ValueError(f"no such table: {', '.join(sorted(unknown))}")
    n = {**SIZES[size], **counts}
    return {
        "users": users(spark, n["users"], seed),
        "products": products(spark, n["products"], seed),
        "orders": orders(spark, n["orders"], n["users"], n["products"], seed),
    }


def generate_and_save(
    spark: SparkSession,
    base_path: str,
    size: str = "small",
    seed: int = 42,
    single_file: bool = False,
    **counts: int,
) -> None:
    """Write the three tables as ``<base>/<table>/<size>`` (Parquet), ``.csv`` and ``.json``."""
    for name, df in generate(spark, size, seed, **counts).items():
        target = f"{base_path}/{name}/{size}"
        save_dataset(df, target)
        save_dataset(df, f"{target}.csv", "csv", single_file=single_file)
        save_dataset(df, f"{target}.json", "json", single_file=single_file)


def main(arguments: Sequence[str] | None = None) -> None:
    """``python -m brindle.sources.generate --base-path PATH [--size SIZE] [--users N] ...``"""
    parser = argparse.ArgumentParser(description="Write synthetic users, products and orders.")
    parser.add_argument("--base-path", required=True)
    parser.add_argument("--size", choices=SIZES, default="small")
    parser.add_argument("--seed", type=int, default=42)
    for name in SIZES["small"]:
        parser.add_argument(f"--{name}", type=int, help="rows, instead of the preset")
    options = vars(parser.parse_args(arguments))
    counts = {n: options[n] for n in SIZES["small"] if options[n] is not None}
    spark = SparkSession.builder.getOrCreate()
    generate_and_save(spark, options["base_path"], options["size"], options["seed"], **counts)


if __name__ == "__main__":
    main()
