"""Queries over the texts of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import bpe, decontaminate, langid, secret_scan, shards, simhash, tokencount
from brindle.llm.registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    out = bpe.roundtrip_digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("secrets")
    return found.select(
        "doc_id",
        *(secret_scan.counted(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.listed(secret_scan.base_only(spans)), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage alike to a benchmark item, with the item and the window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    rows = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.fit(rows.where(~held_out), "text", "lang", "doc_id")
    found = langid.predict(rows.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and after three edits of each: a cut, an insertion and a rewritten end."""
    ranks, pattern = RANKS, public_tokenizers.PATTERN
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    n = F.length(F.coalesce("text", F.lit("")))
    at = lambda x: F.floor(x).cast("int")
    edits = F.array(
        F.struct(at(n / 4).alias("start"), (at(n / 4) + 20).alias("end"), F.lit("").alias("text")),
        F.struct(at(n / 2).alias("start"), at(n / 2).alias("end"), F.concat_ws("", F.lit(" ["), "source", F.lit("] ")).alias("text")),
        F.struct((n - 30).alias("start"), n.alias("end"), F.substring("text", 1, 10).alias("text")),
    )
    after = tokencount.apply_edits(docs.select("doc_id", "text", edits.alias("edits")), ranks, pattern, before="n_tokens_before")
    return after.select(
        "doc_id",
        F.col("n_tokens_before").alias("n_tokens"),
        F.col("n_tokens").alias("n_tokens_edited"),
        "encoded_chars",
        F.sha2(F.col("text"), 256).alias("edited_sha256"),
    )


@query()
def op8_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return shards.assign(documents(spark, sf_dir))
