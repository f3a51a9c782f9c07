"""The pipeline against brute force over the small documents."""

import hashlib
import re
import struct

import duckdb
import public_tokenizers
import tiktoken

import corpus_pipeline
from brindle.llm import bpe, secret_scan

from test_llm_tables import SF, brute_components, brute_leaks, brute_print
from test_llm_text import brute_bases


def test_pipeline_against_brute_force(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = [(i, t) for i, t in rows if t is not None and any(c.isalpha() for c in t)]
    least = brute_components([(i, brute_print(t)) for i, t in docs])
    docs = [(i, t) for (i, t), c in zip(docs, least) if i == c]
    # a leak shares five words in a row with an item
    fives = {tuple(w[k : k + 5]) for _, t in items for w in [re.findall(r"[^\W_]+", t.lower())] for k in range(len(w) - 4)}
    suspects = [
        (i, t) for i, t in docs if (w := re.findall(r"[^\W_]+", t.lower())) and any(tuple(w[k : k + 5]) in fives for k in range(len(w) - 4))
    ]
    leaking = {i for i, _ in brute_leaks(suspects, items)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={})
    expected = {}
    for i, t in docs:
        if i in leaking:
            continue
        for a, _, b in reversed(merged(brute_bases(t))):
            t = t[:a] + secret_scan.REDACTED + t[b:]
        ids = coder.encode_ordinary(t)
        expected[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == len(expected)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == expected


def merged(spans):
    out = []
    for a, k, b in spans:
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((a, k, b))
    return out


def test_a_leak_takes_no_other_row_of_its_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").first()["text"]
    rows = [(i, t, "en", "s", 1) for i, t in [(None, item), (None, "a clean text"), (1, item), (1, "another"), (None, None)]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.decontaminated(spark, docs, SF).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {(None, "a clean text"), (1, "another"), (None, None)} and len(kept) == 3


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
