"""From raw documents to tokens: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import workspace
from brindle.llm import bpe, decontaminate, langid, secret_scan, simhash
from brindle.llm.tasks import row_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those that are ``und`` go."""
    model = langid.fit(docs.where(~langid.is_held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    return langid.predict(docs, model).where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id."""
    return simhash.keep_one(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage alike to a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = row_key("doc_id", "text")
    keyed = docs.select(key.alias("row_key"), "text")
    found = decontaminate.contaminated(keyed, benchmark, "row_key").select(F.col("row_key").alias("leaking")).distinct()
    found = workspace.broadcast_within(workspace.materialize(found, "leaking"))
    return docs.join(found, key == F.col("leaking"), "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    found = secret_scan.scan(docs.select(*COLUMNS), name="secrets")
    clean = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col("secrets")))
    changed = F.size("secrets") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    done = bpe.roundtrip_digests(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    return done.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode),
]

# Neither the hashes nor the tokenizer have a form in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
