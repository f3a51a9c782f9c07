"""Queries over ``pages`` and ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import page_text, topk, urlfilter
from brindle.llm.registry import query
from brindle.llm.urlfilter import ALLOW, BLOCK, Rule

SITES = [
    Rule.site("org", "/", ALLOW),
    Rule.site("example.org", "/es/", BLOCK),
    Rule.site("example.org", "/en/1", BLOCK),
    Rule.site("com", "/fr/", ALLOW),
    Rule.site("com", "/de/", BLOCK),
]

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vector
    FROM embeddings
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector::DOUBLE[], c.vector::DOUBLE[])::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 10
"""

URL_VERDICTS = r"""
WITH parts AS (
    SELECT page_id, regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's') AS raw_host,
           coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
    FROM pages
),
hosts AS (
    SELECT page_id, coalesce(translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, path
    FROM parts
),
rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
SELECT h.page_id, h.host, h.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(max_by(r.verdict, length(r.host || r.path)),
                CASE WHEN regexp_matches(h.path, '\.(jpg|jpeg|png|gif|webp|mp3|mp4|avi|zip|gz|exe|dmg|iso)$')
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM hosts h LEFT JOIN rules r ON ('.' || h.host) LIKE ('%.' || r.host) AND starts_with(h.path, r.path)
GROUP BY h.page_id, h.host, h.path
"""


@query(TOP_K)
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector among all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


@query(URL_VERDICTS)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of every page's address."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = urlfilter.judge(pages, [*SITES, *urlfilter.GENERAL])
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return page_text.extract(pages).select("page_id", "url", "text", "n_chars")
