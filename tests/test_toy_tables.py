"""Hand-computed answers on small in-memory tables, through the API and through SQL."""

import datetime

import pytest
from pyspark.sql import functions as F

from brindle.functions.categories import band
from brindle.functions.text import word_count
from brindle.operators.joins import lookup_join

# Toy rows with known answers.
EMPLOYEES = [
    (1, ("John", "Doe"), "Engineering", 85000.0, datetime.date(2020, 1, 15), True),
    (2, ("Jane", "Smith"), "Marketing", 75000.0, datetime.date(2019, 6, 1), True),
    (3, ("Bob", "Johnson"), "Engineering", 95000.0, datetime.date(2018, 3, 20), True),
    (4, ("Alice", "Williams"), "Sales", 70000.0, datetime.date(2021, 9, 10), False),
    (5, ("Charlie", "Brown"), "Engineering", 90000.0, datetime.date(2020, 7, 5), True),
]
EMPLOYEE_SCHEMA = (
    "employee_id int NOT NULL, name struct<first: string, last: string>, department string, "
    "salary double, hire_date date, is_active boolean"
)


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame(EMPLOYEES, EMPLOYEE_SCHEMA)


def test_people(spark):
    people = spark.createDataFrame([(1, "Alice", 25), (2, "Bob", 30), (3, "Charlie", 35)], ["id", "name", "age"])
    assert dict(people.dtypes)["id"] == "bigint"
    assert people.filter(people.age > 25).count() == 2
    assert people.groupBy().agg(F.avg("age")).first()[0] == 30.0


def test_many_rows(spark):
    rows = [(i, f"user_{i}") for i in range(10_000)]
    assert spark.createDataFrame(rows, ["id", "name"]).count() == 10_000


def test_pairs(spark):
    pairs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], ["n", "s"])
    got = pairs.select(F.col("n") * 2, F.upper("s")).collect()
    assert sorted(map(tuple, got)) == [(2, "A"), (4, "B"), (6, "C")]


def test_numbers(spark):
    numbers = spark.range(1, 6).withColumnRenamed("id", "value")
    assert [r[0] for r in numbers.select(F.col("value") * 2).collect()] == [2, 4, 6, 8, 10]
    assert [r[0] for r in numbers.filter("value > 2").collect()] == [3, 4, 5]
    assert numbers.agg(F.sum("value")).first()[0] == 15


def test_nested_and_combined_filters(employees):
    names = employees.select("employee_id", F.col("name.first").alias("first_name"))
    assert names.orderBy("employee_id").first() == (1, "John")
    well_paid = employees.filter(
        (F.col("department") == "Engineering") & (F.col("salary") > 80000) & (F.col("is_active") == True)  # noqa: E712
    )
    assert well_paid.count() == 3
    levels = employees.select(band("salary", [75000, 90000], ["Junior", "Mid", "Senior"]).alias("level"))
    assert {r["level"]: r["count"] for r in levels.groupBy("level").count().collect()} == {
        "Senior": 2, "Mid": 2, "Junior": 1,
    }


def test_sql_having(spark, employees):
    rows = spark.sql(
        """SELECT department, COUNT(*) AS n, ROUND(AVG(salary), 2) AS avg_salary FROM {employees}
           WHERE is_active = true GROUP BY department HAVING COUNT(*) > 1 ORDER BY avg_salary DESC""",
        employees=employees,
    ).collect()
    assert list(map(tuple, rows)) == [("Engineering", 3, 90000.0)]


def test_grouped_aggregates(employees):
    rows = employees.groupBy("department").agg(F.count("*"), F.avg("salary"), F.max("salary"), F.min("salary"))
    assert sorted(map(tuple, rows.collect()))[0] == ("Engineering", 3, 90000.0, 95000.0, 85000.0)


def test_fruit_bands(spark):
    fruit = spark.createDataFrame([(f"fruit_{p}", p) for p in (10, 20, 30, 40, 50)], ["fruit", "price"])
    assert fruit.filter("price > 20").count() == 3
    label = F.when(F.col("price") > 30, "Premium").when(F.col("price") > 20, "Standard").otherwise("Basic")
    counts = fruit.filter("price > 15").groupBy(label.alias("band")).count().collect()
    assert {r["band"]: r["count"] for r in counts} == {"Basic": 1, "Standard": 1, "Premium": 2}


def test_sales_per_product(spark):
    sales = spark.range(100).selectExpr(
        "id", "concat('Product_', id % 10) AS product", "id % 5 + 1 AS quantity", "id * 10.0D AS revenue"
    )
    totals = sales.agg(F.count("*"), F.sum("revenue"), F.avg("revenue"), F.max("revenue"), F.min("revenue"))
    assert tuple(totals.first()) == (100, 49500.0, 495.0, 990.0, 0.0)
    assert sales.agg(F.count_distinct("product")).first()[0] == 10


def test_items_and_countries(spark):
    items = spark.range(10_000).selectExpr("id", "id % 3 + 101 AS category_id")
    categories = spark.createDataFrame([(101, "Premium"), (102, "Standard"), (103, "Basic")], ["category_id", "category"])
    assert lookup_join(items, categories, "category_id", "left").filter("category IS NOT NULL").count() == 10_000


def test_word_frequencies(spark):
    phrases = spark.createDataFrame([("hello world",), ("big data",), ("spark sql",)], ["text"])
    counts = word_count(phrases, "text").collect()
    assert len(counts) == 6 and all(r["count"] == 1 for r in counts)


def test_doubled_ids(spark):
    doubled = spark.range(5).withColumn("double_id", F.col("id") * 2)
    assert [r["double_id"] for r in doubled.collect()] == [0, 2, 4, 6, 8]
