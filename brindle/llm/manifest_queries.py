"""Queries that pack, mine and certify whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import merkle, negatives, packing
from brindle.llm.registry import query

HARD_NEGATIVES = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
           list_inner_product(a.vector, c.vector)::BIGINT AS score
    FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER best::INTEGER AS rank, n.other_id AS negative_id,
       p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER best <= 3
"""

MANIFEST = """
WITH RECURSIVE fields AS (
    SELECT row_number() OVER () AS row_id, *,
           list_reduce(
               list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, b: list_reduce(
                   list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda r, s: xor(r >> 1, 3988292384 * (r & 1)))) AS crc
    FROM documents
),
heads AS (
    SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
           coalesce(xor(crc, 4294967295) % 3 = 0, false) AS tampered
    FROM fields
),
leaves AS (
    SELECT row_id, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || CASE WHEN tampered THEN coalesce(strlen(lowered) || ':' || lowered, '-')
                               ELSE coalesce(strlen(text) || ':' || text, '-') END) AS given
    FROM heads
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS idx,
           count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
    FROM leaves
),
nodes(g, level, idx, n, h) AS (
    SELECT g, 0, idx, n, leaf FROM placed
    UNION ALL
    SELECT g, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY g, level, idx // 8, n
),
groups AS (SELECT g, h AS subroot, level AS depth, count(*) OVER () AS n_groups FROM nodes WHERE n = 1),
tops(level, idx, n, h) AS (
    SELECT 0, g, n_groups, subroot FROM groups
    UNION ALL
    SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
    FROM tops WHERE n > 1 GROUP BY level, idx // 8, n
),
steps AS (
    SELECT p.row_id, s.level, s.idx, s.h, s.idx = p.idx // (8 ** s.level)::BIGINT AS own
    FROM placed p JOIN nodes s ON s.g = p.g AND s.n > 1 AND s.idx // 8 = p.idx // (8 ** (s.level + 1))::BIGINT
    UNION ALL
    SELECT p.row_id, 1000 + t.level, t.idx, t.h, t.idx = p.g // (8 ** t.level)::BIGINT
    FROM placed p JOIN tops t ON t.n > 1 AND t.idx // 8 = p.g // (8 ** (t.level + 1))::BIGINT
),
proofs AS (SELECT row_id, sha256(coalesce(string_agg(h, '' ORDER BY level, idx) FILTER (NOT own), '')) AS proof_sha256 FROM steps GROUP BY row_id),
sides AS (
    SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY level) AS step,
           coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < mine), '') AS before,
           coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > mine), '') AS after
    FROM (SELECT *, max(idx) FILTER (own) OVER (PARTITION BY row_id, level) AS mine FROM steps)
    GROUP BY row_id, level
),
folds(row_id, step, h) AS (
    SELECT row_id, 0::BIGINT, given FROM placed
    UNION ALL
    SELECT f.row_id, f.step + 1, sha256(s.before || f.h || s.after)
    FROM folds f JOIN sides s ON s.row_id = f.row_id AND s.step = f.step + 1
)
SELECT p.doc_id, p.leaf, g.subroot, (SELECT h FROM tops WHERE n = 1) AS root,
       coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
       f.folded_root = (SELECT h FROM tops WHERE n = 1) AS verified
FROM placed p JOIN groups g ON g.g = p.g
     JOIN (SELECT row_id, arg_max(h, step) AS folded_root FROM folds GROUP BY row_id) f ON f.row_id = p.row_id
     LEFT JOIN proofs q ON q.row_id = p.row_id
"""


@query()
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 2048."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query(HARD_NEGATIVES)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five best positives of every fiftieth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", shifted), F.col("vec_id") % 50 == 0)


@query(MANIFEST)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; a third of them are checked against tampered texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    given = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest([*fields, F.col("text")]).alias("leaf"), merkle.leaf_digest([*fields, given]).alias("given"))
    proved = merkle.prove(leaves, "lang", "doc_id")
    folded = merkle.folded(F.col("given"), F.col("path"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
