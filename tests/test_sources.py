"""File datasets, write modes and the synthetic tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from brindle.operators.layout import plan_text
from brindle.sources import generate
from brindle.sources.tables import TABLE_SCHEMAS, load_dataset, save_dataset, table
from brindle.workspace import (
    application_dir,
    fits_broadcast,
    materialize,
    partitions_for,
    remove,
    scratch_path,
    shared_dir,
    summary,
)

ROWS = [
    (1, "a,b", 1.5, True, datetime.date(2024, 1, 31), datetime.datetime(2024, 1, 31, 10, 20, 30, 123456)),
    (2, 'quo"te', None, False, None, None),
    (3, None, -0.25, None, datetime.date(1999, 12, 31), datetime.datetime(1999, 12, 31, 23, 59, 59)),
]
SCHEMA = "id int, name string, x double, ok boolean, d date, t timestamp_ntz"


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
@pytest.mark.parametrize("single_file", [False, True])
def test_round_trip(spark, mixed, file_format, single_file):
    path = scratch_path(spark, "trip")
    save_dataset(mixed, path, file_format, single_file=single_file)
    back = load_dataset(spark, path, file_format, mixed.schema)
    assert mixed.exceptAll(back).count() == back.exceptAll(mixed).count() == 0


def test_instants_keep_microseconds_in_row_formats(spark):
    df = spark.sql("SELECT TIMESTAMP_LTZ'2024-01-31 10:20:30.123456' AS t")
    for file_format in ("csv", "json"):
        path = scratch_path(spark, "instants")
        save_dataset(df, path, file_format)
        assert load_dataset(spark, path, file_format, df.schema).collect() == df.collect()


def test_row_formats_need_a_schema(spark):
    for file_format in ("csv", "json"):
        with pytest.raises(ValueError, match="needs a schema"):
            load_dataset(spark, "/nowhere", file_format)


def test_write_modes(spark, mixed):
    path = scratch_path(spark, "modes")
    for mode, rows in (("overwrite", 3), ("append", 6), ("ignore", 6), ("overwrite", 3)):
        save_dataset(mixed, path, mode=mode)
        assert load_dataset(spark, path).count() == rows
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        save_dataset(mixed, path, mode="error")


def test_rows_with_nested_and_required_fields(spark):
    schema = "employee_id int NOT NULL, name struct<first: string, last: string>, salary double"
    df = spark.createDataFrame([(1, ("John", "Doe"), 85000.0)], schema)
    assert not df.schema["employee_id"].nullable
    assert df.select("name.first", F.col("name.last").alias("l")).first() == ("John", "Doe")


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialize(spark.range(3), "x").inputFiles()[0].startswith(
        "file://" + spark.conf.get("spark.checkpoint.dir")
    )


def test_summary_beyond_its_bound_is_a_table(spark):
    small, large = summary(spark.range(5), "s", 5), summary(spark.range(6), "s", 5)
    joined = [plan_text(spark.range(9).hint("merge").join(s, "id")) for s in (small, large)]
    assert "BroadcastHashJoin" in joined[0] and "SortMergeJoin" in joined[1]
    assert small.count() == 5 and large.count() == 6


def test_broadcast_needs_few_rows_and_few_bytes(spark, monkeypatch):
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) AS text", "array(id) AS ids")
    assert fits_broadcast(df) and not fits_broadcast(df, 99)
    monkeypatch.setattr("brindle.workspace.MAX_BROADCAST_BYTES", 50_000)
    assert fits_broadcast(df.select("id")) and not fits_broadcast(df)


def test_remove(spark):
    path = scratch_path(spark, "gone")
    assert path.startswith(application_dir(spark))
    spark.range(3).write.parquet(path)
    remove(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


@pytest.mark.parametrize("name", TABLE_SCHEMAS)
@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_table_schemas_are_those_of_the_files(spark, name, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert table(spark, sf_dir, name).schema == spark.read.parquet(f"{sf_dir}/{name}.parquet").schema


def test_generated_values(spark):
    tables = generate.generate(spark, "medium")
    users, products, orders = tables["users"], tables["products"], tables["orders"]
    assert [users.count(), products.count(), orders.count()] == [10_000, 5_000, 10_000]
    low = users.agg(F.min("age"), F.max("age"), F.count_distinct("user_id"), F.min("registration_date"), F.max("registration_date")).first()
    assert tuple(low) == (18, 75, 10_000, datetime.date(2020, 1, 1), datetime.date(2024, 12, 31))
    assert {r[0] for r in users.select("country").distinct().collect()} == set(generate.COUNTRIES)
    assert {r[0] for r in products.select("category").distinct().collect()} == set(generate.CATEGORIES)
    assert {r[0] for r in products.select("brand").distinct().collect()} == set(generate.BRANDS)
    assert {r[0] for r in orders.select("status").distinct().collect()} == set(generate.STATUSES)
    assert products.filter("price NOT BETWEEN 10 AND 1000 OR rating NOT BETWEEN 1 AND 5").isEmpty()
    assert orders.select("order_id").distinct().count() == 10_000
    assert orders.filter("NOT order_id RLIKE '^ORD-[0-9A-Z]{10}$'").isEmpty()
    assert users.filter("NOT username RLIKE '^user_[0-9A-Z]{8}$'").isEmpty()
    assert orders.filter("user_id NOT BETWEEN 1 AND 10000 OR product_id NOT BETWEEN 1 AND 5000").isEmpty()
    shares = users.groupBy("is_active").count().collect()
    assert len(shares) == 2 and all(4500 < r["count"] < 5500 for r in shares)


def test_generated_schemas(spark):
    tables = generate.generate(spark, "very_small")
    assert dict(tables["users"].dtypes)["user_id"] == "bigint"
    assert [f.dataType.simpleString() for f in tables["orders"].schema] == [
        "string", "bigint", "bigint", "int", "double", "date", "string",
    ]
    assert [f.dataType.simpleString() for f in tables["products"].schema] == [
        "bigint", "string", "string", "double", "int", "double", "string",
    ]


def test_generation_does_not_depend_on_partitioning(spark):
    for name, df in generate.generate(spark, "very_small").items():
        again = generate.generate(spark, "very_small")[name].repartition(7)
        assert df.exceptAll(again).isEmpty(), name
        other = generate.generate(spark, "very_small", seed=1)[name]
        assert not df.exceptAll(other).isEmpty(), name


def test_unknown_size_and_table_are_refused(spark):
    with pytest.raises(ValueError, match="unknown size"):
        generate.generate(spark, "huge")
    with pytest.raises(ValueError, match="no such table"):
        generate.generate(spark, "small", customers=3)


def test_generate_and_save(spark):
    base = scratch_path(spark, "generated")
    generate.generate_and_save(spark, base, "very_small", single_file=True, orders=30)
    for name, rows in (("users", 100), ("products", 50), ("orders", 30)):
        df = load_dataset(spark, f"{base}/{name}/very_small")
        csv = load_dataset(spark, f"{base}/{name}/very_small.csv", "csv", df.schema)
        json = load_dataset(spark, f"{base}/{name}/very_small.json", "json", df.schema)
        assert df.count() == rows
        assert df.exceptAll(csv).isEmpty() and df.exceptAll(json).isEmpty()
        assert len(csv.inputFiles()) == 1


def test_command_line(spark):
    base = scratch_path(spark, "command")
    generate.main(["--base-path", base, "--size", "very_small", "--users", "12"])
    assert load_dataset(spark, f"{base}/users/very_small").count() == 12
    assert load_dataset(spark, f"{base}/products/very_small").count() == 50


def test_a_cluster_must_name_the_shared_folder():
    class Session:
        conf = {"spark.master": "spark://host:7077"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_large_inputs_get_more_partitions(spark):
    session_default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(spark, session_default * 5_000_000) == []
    assert partitions_for(spark, 10**9) == [200]
    assert generate.users(spark, 10**9).rdd.getNumPartitions() == 200
    assert dict(generate.users(spark, 2**31).dtypes)["user_id"] == "bigint"
