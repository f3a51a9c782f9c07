"""Text, array and higher-order functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import text
from brindle.plans.registry import query
from brindle.sources.tables import table


@query("""
    SELECT c_custkey, substr(c_mktsegment, 1, 1) AS initial, length(c_mktsegment) AS segment_length,
           concat(c_name, '_', c_mktsegment) AS label, upper(c_name) AS shout,
           CAST(split_part(c_name, '#', 2) AS BIGINT) AS number, c_custkey * 2 AS double_key,
           round(c_acctbal, 1) AS balance
    FROM customer""")
def string_fns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_mktsegment").substr(1, 1).alias("initial"),
        F.length("c_mktsegment").cast("bigint").alias("segment_length"),
        F.concat("c_name", F.lit("_"), "c_mktsegment").alias("label"),
        F.upper("c_name").alias("shout"),
        F.split("c_name", "#")[1].try_cast("bigint").alias("number"),
        (F.col("c_custkey") * 2).alias("double_key"),
        F.round("c_acctbal", 1).alias("balance"),
    )


@query("""
    SELECT word, COUNT(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY word ORDER BY count DESC, word""")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = text.word_count(table(spark, sf_dir, "documents"), "text")
    return counts.orderBy(F.col("count").desc(), "word")


@query("SELECT vec_id, unnest(embedding) AS value FROM embeddings")
def array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.explode("embedding").alias("value"))


@query("""
    SELECT vec_id, len(embedding) AS size, embedding[1] AS first, embedding[1000] AS beyond
    FROM embeddings""")
def array_fns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        text.array_size("embedding").alias("size"),
        text.element("embedding", 1).alias("first"),
        text.element("embedding", 1000).alias("beyond"),
    )


@query("""
    SELECT p_partkey, CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS json FROM part""")
def array_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.to_json(text.words("p_name")).alias("json")
    )


@query("""
    SELECT p_partkey, array_to_string([upper(w) FOR w IN string_split(p_name, ' ')], ',') AS words
    FROM part""")
def hof_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = F.transform(text.words("p_name"), lambda word: F.upper(word))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(upper, ",").alias("words"))


@query("""
    SELECT p_partkey, array_to_string([w FOR w IN string_split(p_name, ' ') IF length(w) > 4], ',') AS words
    FROM part""")
def hof_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_words = F.filter(text.words("p_name"), lambda word: F.length(word) > 4)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(long_words, ",").alias("words")
    )


@query("""
    SELECT p_partkey, p_size * factor AS scaled FROM part, (VALUES (1), (10), (100)) AS f(factor)""")
def flat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return text.flat_map(part, "p_size", [1, 10, 100], "scaled").select("p_partkey", "scaled")
