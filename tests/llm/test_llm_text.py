"""Tokens, language, secrets: against other libraries and brute force, with odd rows."""

import hashlib
import math
import random
import re
import time
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from brindle.llm import bpe, chunks, langid, secret_scan, tasks, tokencount

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def mixed(n, seed):
    letters = "abcdetnABß中文\n\t 09's\U0001f600ñ.,\x1c\xa0  -=/_"
    return "".join(random.Random(seed).choices(letters, k=n))


ODD = [
    None, "", " ", "\n\n x\t\ty  ", "it's I'LL dogs'  end", "a" * 3000, "=-" * 300 + " " * 500 + "q", mixed(4000, 1),
    "".join(random.Random(2).choices("abcdetn", k=5000)), "<|endoftext|>", "same", "same", "\x00\x1f\x1e a",
]


def odd_rows(spark):
    """Ids (one null), texts, and columns that have the names of outputs."""
    rows = [(None if i == 4 else i, t, "x", 7, "y") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, Ids int, `odd.name` string")


def test_ids_and_bytes_are_those_of_tiktoken(spark, reference):
    out = bpe.decode(bpe.encode(odd_rows(spark), RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(out) == len(ODD) and out[0]["odd.name"] == "y" and out[0]["n_tokens"] == "x"
    by_text = {r["text"]: r for r in out}
    for text in ODD:
        assert list(by_text[text]["ids"]) == reference.encode_ordinary(text or "")
        assert bytes(by_text[text]["decoded"]) == (text or "").encode()


def test_digests(spark, reference):
    out = bpe.roundtrip_digests(odd_rows(spark), RANKS, PATTERN)
    assert out.schema["n_tokens"].dataType.typeName() == "long"
    for r in out.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_unknown_ids_and_empty_tables(spark):
    ids = spark.createDataFrame([([1, 99_999_999],), ([None],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(ids, RANKS, PATTERN).collect()] == [None, None, None, b""]
    none = odd_rows(spark).limit(0)
    assert bpe.roundtrip_digests(none, RANKS, PATTERN).collect() == []
    assert tokencount.build(none, RANKS, PATTERN).collect() == []
    assert secret_scan.scan(none).collect() == []


def test_the_cache_forgets_without_losing_what_is_asked(reference):
    coder = bpe.Encoder(bpe.read_ranks(RANKS), PATTERN)
    coder.known.limit = 10_000
    for seed in range(20):
        text = mixed(300, seed)
        assert coder.known.held <= 10_000
        assert coder.encode([text])[0] == struct.pack(f"<{len(reference.encode_ordinary(text))}I", *reference.encode_ordinary(text))


@pytest.mark.parametrize("section", [40, 1 << 19])
def test_chunks_of_one_hash_stay_apart(reference, monkeypatch, section):
    text = " ".join(random.Random(5).choices(["be", "alpha", "gamma", "delta", "xyzzy" * 30], k=300))
    expected = struct.pack(f"<{len(reference.encode_ordinary(text))}I", *reference.encode_ordinary(text))
    monkeypatch.setattr(chunks, "hashes", lambda flat, bounds: np.diff(bounds).astype(np.uint64) // 100)
    coder = bpe.Encoder(bpe.read_ranks(RANKS), PATTERN)
    flat, offsets = chunks.flat_bytes(pa.array([text, None, text]))
    assert coder.known.encode(flat, offsets, chunks.cuts(flat, offsets), section) == [expected, b"", expected]


def test_what_is_held_of_chunks_is_small():
    """A worker's memory of 100,000 chunks takes a third of what it took as objects."""
    known = chunks.KnownIds(lambda values: [v[-4:] for v in values])
    texts = pa.array([" ".join(f"{i:07}" for i in range(100_000))])
    flat, offsets = chunks.flat_bytes(texts)
    for _ in range(2):
        assert len(known.encode(flat, offsets, chunks.cuts(flat, offsets))[0]) == 400_000
    arrays = [known.raw.values, known.raw.starts, known.ids.values, known.ids.starts, *(x for level in known.index for x in level)]
    assert known.raw.n == 100_000 and sum(x.nbytes for x in arrays) < 100_000 * 80


def test_texts_go_to_a_task_once_and_back_only_if_they_stay(spark):
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id int, text string, lang string")
    seen = bpe.roundtrip_digests(df, RANKS, PATTERN, keep=["lang", "doc_id"])
    assert seen.columns == ["doc_id", "lang", "n_tokens", "ids_sha256", "decoded_sha256"]
    batch = pa.RecordBatch.from_pydict({"in_0": ["a b"], "kept_0": [1]})
    options = {"module": __name__, "name": "lengths", "n_inputs": 1, "slice_bytes": 10, "options": {}}
    out = list(tasks._append([batch], kept=[1, 0], names=["doc_id", "text", "n"], **options))
    assert [b.to_pydict() for b in out] == [{"doc_id": [1], "text": ["a b"], "n": [3]}]
    plan = bpe.roundtrip_digests(df, RANKS, PATTERN)._jdf.queryExecution().analyzed().toString()
    assert plan.count("text#") and " AS kept_2" not in plan


def test_a_worker_keeps_the_caches_of_one_operator(monkeypatch):
    monkeypatch.setattr(tasks, "_kept", {})
    one, other = tasks.worker_cache("one"), tasks.worker_cache("other")
    one["x"], other["y"] = 1, 2
    tasks.keep_only("one")
    assert one == {"x": 1} and other == {} and tasks.worker_cache("other") is other


def lengths(part):
    return [pa.array([len(t) for t in part.column(0).to_pylist()])]


def test_counts_follow_edits(reference):
    count = tokencount.Counter(bpe.read_ranks(RANKS), PATTERN)
    for seed in range(60):
        draw = random.Random(seed)
        text = mixed(draw.choice([0, 1, 30, 3000]), seed)
        tree = tokencount.Tree(*count(text))
        for _ in range(12):
            start, width = draw.randint(0, len(text) + 3), draw.choice([0, 1, 5, 200])
            new = mixed(draw.choice([0, 1, 8, 1500]), draw.random())
            expected = text[:start] + new + text[start + width :]
            text, tree, _ = tokencount.edit(text, tree, start, start + width, new, count)
            assert text == expected
            assert tree.tokens() == len(reference.encode_ordinary(text))
            tree = tokencount.Tree.unpack(tree.pack())


def test_edits_touch_little_of_a_long_text():
    count = tokencount.Counter(bpe.read_ranks(RANKS), PATTERN)
    text = "some words here " * 5000
    _, _, encoded = tokencount.edit(text, tokencount.Tree(*count(text)), 40_000, 40_003, "new", count)
    assert encoded < 40


def test_edits_of_a_text_without_blanks(reference):
    count = tokencount.Counter(bpe.read_ranks(RANKS), PATTERN)
    text = "".join("這是一個句子，它說了些什麼。'引號'x9%" for _ in range(1000))
    tree = tokencount.Tree(*count(text))
    for at in range(5000, 5023):
        after, tree, encoded = tokencount.edit(text, tree, at, at + 3, "改's", count)
        assert encoded < 50 and tree.tokens() == len(reference.encode_ordinary(after))
        text = after


def test_another_pattern_is_not_cut_before_it_is_applied():
    """Pieces of this one end at capitals and keep blanks behind them."""
    pattern = r"\p{Lu}?\p{Ll}+\s*|[^\p{L}]+|\p{L}"
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.Encoder(ranks, pattern)
    for text in ("CamelCase words, with  Blanks. behind Them\n", "", "ABC déf 12 x"):
        ids = own.encode_ordinary(text)
        assert coder.encode([text])[0] == struct.pack(f"<{len(ids)}I", *ids)


def test_tree_keeps_its_sums(reference):
    count = tokencount.Counter(bpe.read_ranks(RANKS), PATTERN)
    tree = tokencount.Tree(*count(mixed(2000, 3)))
    again = tokencount.Tree.unpack(tree.pack())
    assert (again.sums == tree.sums).all() and again.tokens() == tree.tokens()


def test_long_texts(spark, reference):
    """A section holds a part of the text only."""
    words = " ".join(f"word{i % 977} çà, 漢字" for i in range(400_000))
    df = spark.createDataFrame([(1, words), (2, words), (3, None)], "doc_id int, text string")
    n = len(reference.encode_ordinary(words))
    out = bpe.roundtrip_digests(df, RANKS, PATTERN).orderBy("doc_id").collect()
    digest = hashlib.sha256(words.encode()).hexdigest()
    assert [(r["n_tokens"], r["decoded_sha256"]) for r in out[:2]] == [(n, digest)] * 2 and out[2]["n_tokens"] == 0
    edits = F.expr("array(named_struct('start', 5000000, 'end', 5000003, 'text', '!'))").alias("edits")
    after = tokencount.apply_edits(df.select("doc_id", "text", edits), RANKS, PATTERN, before="n_before").orderBy("doc_id").collect()
    changed = words[:5000000] + "!" + words[5000003:]
    assert [(r["n_before"], r["n_tokens"]) for r in after] == [(n, len(reference.encode_ordinary(changed)))] * 2 + [(0, 1)]
    assert tokencount.apply_edits(df.select("doc_id", "text", edits).limit(0), RANKS, PATTERN).collect() == []


def test_edits_of_rows(spark, reference):
    edits = "array<struct<start:int,end:int,text:string>>"
    rows = [(1, "one two three", [(0, 3, "1"), (2, 5, "zwei")]), (2, None, [(5, 9, "late")]), (3, "kept", None), (3, "kept", [None])]
    built = tokencount.build(spark.createDataFrame(rows, f"id int, text string, edits {edits}"), RANKS, PATTERN)
    out = tokencount.apply_edits(built, RANKS, PATTERN).orderBy("id").collect()
    assert [r["text"] for r in out] == ["1 zwei three", "late", "kept", "kept"]
    assert [r["n_tokens"] for r in out] == [len(reference.encode_ordinary(r["text"])) for r in out]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.is_held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held), "text", "lang", "doc_id")
    right = langid.predict(docs, model).where(held).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    odd = langid.predict(odd_rows(spark).withColumn("score", F.lit("clash")), model).collect()
    assert len(odd) == len(ODD)
    for r in odd:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not has_letter) and 0 <= r["score"] <= 1
        assert has_letter or r["score"] == 0


def test_grams_are_of_one_text_alone():
    texts = ["the", "", "a", "der Hund", "?", "x y", "the"]
    buckets, owners, has_letter = langid.grams(texts)
    for i, text in enumerate(texts):
        alone, _, letter = langid.grams([text])
        assert buckets[owners == i].tolist() == alone.tolist() and has_letter[i] == letter[0]
    # " t", "th", "he", "e " and "  t", " th", "the", "he ", "e  "
    assert len(langid.grams(["the"])[0]) == 9 and len(set(langid.grams(["the"])[0])) == 9


def test_language_does_not_depend_on_other_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs, "text", "lang", "doc_id")
    words = [w for r in docs.orderBy("doc_id").limit(40).collect() for w in (r["text"] or "").split()[:3]]
    held = type("Held", (), {"value": model})
    predict = lambda texts: [c.to_pylist() for c in langid.predict_slice(pa.record_batch([pa.array(texts)], ["text"]), held)]
    together = predict(words)
    assert together == [sum(x, []) for x in zip(*(predict([w]) for w in words))]
    assert together == [x[::-1] for x in predict(words[::-1])]


def test_language_without_labels(spark):
    rows = odd_rows(spark).withColumn("lang", F.lit(None).cast("string"))
    model = langid.fit(rows, "text", "lang", "doc_id")
    assert {r["lang_pred"] for r in langid.predict(rows, model).collect()} == {"und"}


def brute_bases(text):
    text = text or ""
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def brute_entropy(candidate):
    """What high windows cover: a threshold per window's class, none on a placeholder, stretches merged where they touch."""
    hexadecimal = re.fullmatch("[0-9a-fA-F]+", candidate)
    hidden = {i for word in ("0123456789", "abcdefghij", "example", "sample", "placeholder", "changeme", "xxxx")
              for m in re.finditer(f"(?i)(?={word})", candidate) for i in range(m.start(), m.start() + len(word))}
    out = []
    for i in range(len(candidate) - 19):
        window = candidate[i : i + 20]
        single = re.fullmatch("[a-z0-9]+|[A-Z0-9]+", window)
        limit = 3.0 if hexadecimal else 3.4 if single else 3.75
        bits = -sum(window.count(c) / 20 * math.log2(window.count(c) / 20) for c in set(window))
        if bits > limit and not hidden & set(range(i, i + 20)):
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], i + 20)
            else:
                out.append((i, i + 20))
    return out


SECRETS = [
    "x PASSWORD = 'hunter2hunter2' y", "secret: token: abcdefghijklmnop1", "token==abc.def-ghi_jkl+m token=short",
    "AKIAAKIA1234 AKIAABCDEFGHIJKLMN", "\U0001f600é deadbeefdeadbeef 4111111111111111", "api_key:\"0123456789abcdef0123\"",
    "id 123e4567-e89b-12d3-a456-426614174000 ok", "key aG9zdF9rZXk6UjNhbGx5U2VjcmV0VmFsdWU5 end", "B4F2C7A9D1E8036A5C9F7E2B1D4A8C3E60F7",
    "path/to/some/file2/here/and/there a-slug-with-2-words-in-it", "a" * 5000 + "1", " ".join(f"{i:016x}" for i in range(1500)),
    "token=" + "Zx9Qw2Er4Ty6Ui8Op0As" + "b" * 300 + "1Lk3Jh5Gf7Ds9Aq2Wx4Cv", "k " + "p9x2m4q7v1z8w3n6b5c0r" + "Q" * 60 + "Hq3x7Lm9Zt2Vb5Nc8Kd1",
    "﻿key﻿ " + "q7RzL2pXv9KdM4tYc8WnB3" + "EXAMPLEkey" + "J5hGs1FqZ6uVe0TxA7oIp2" + " é﻿😀 " + "MZXW6YTBOI2GK3TFNZSA4Q3P",
    "Tr0ub4dor&3 aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1aaaaaQ7w2E9r4T6y8U1i3O5p0Zx", None, "", "clean words only",
]


def test_secret_spans(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(SECRETS * 2)], "doc_id int, text string, Secrets string")
    out = secret_scan.scan(df).orderBy("doc_id").collect()
    assert len(out) == 2 * len(SECRETS)
    for r in out:
        text = r["text"] or ""
        spans = [(s["start"], s["kind"], s["end"]) for s in r["secrets"]]
        assert [s for s in spans if s[1] < 3] == brute_bases(text)
        assert spans == sorted(spans)
        candidate = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
        expected = set()
        for m in re.finditer(candidate, text):
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not any(re.search(a, m[0]) for a in secret_scan.ALLOWED[:3]):
                for first, end in brute_entropy(m[0]):
                    a, b = m.start() + first, m.start() + end
                    if not any(s <= a and e >= b for s, _, e in brute_bases(text)):
                        expected.add((a, b))
        assert {(a, b) for a, kind, b in spans if kind >= 3} == expected
    assert any(s["kind"] == 4 for r in out for s in r["secrets"]) and any(s["kind"] == 3 for r in out for s in r["secrets"])


def test_random_strings_of_each_class_are_found(spark):
    draw = random.Random(8)
    base32, base36 = "abcdefghijklmnopqrstuvwxyz234567", "0123456789abcdefghijklmnopqrstuvwxyz"
    classes = {"hex": base36[:16], "base32": base32.upper(), "base36": base36, "base62": base36 + base32[:26].upper(), "key": base36}
    rows = []
    for name, letters in classes.items():
        for width in (20, 24, 32):
            made = ("".join(draw.choices(letters, k=width)) for _ in range(700))
            made = [m for m in made if re.search("[0-9]", m) and re.search("[A-Za-z]", m) and not re.search(secret_scan.ALLOWED[3], m)][:600]
            rows += [(name, width, f"see {'A-key_of=' if name == 'key' else ''}{m} there") for m in made]
    found = secret_scan.scan(spark.createDataFrame(rows, "name string, width int, text string"))
    missed = found.groupBy("name", "width").agg(F.avg((F.size("secrets") == 0).cast("int")).alias("share")).collect()
    assert len(missed) == 3 * len(classes) and max(r["share"] for r in missed) < 0.06, missed
    assert {r["name"] for r in found.where(F.exists("secrets", lambda s: s["kind"] == 5)).select("name").collect()} == {"base32", "base36"}


def test_a_placeholder_hides_only_the_windows_on_it(spark):
    token = "aG9zdF9rZXk6UjNhbGx5U2VjcmV0VmFsdWU5Qk1p"
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    cases = {
        f"EXAMPLE_KEY={token}": (0, 52), f"/samples/{token}": (0, 49), f"{token}xXxXx{token}": (45, 85), f"{token}Example": (0, 40),
        alphabet: None, "your-placeholder-key-goes-here-xxxx1xxxxxx2xxxx": None, "a1example9Zq7Rb3Lk8Wd": None,
    }
    out = secret_scan.scan(spark.createDataFrame([(t,) for t in cases], "text string")).collect()
    for r in out:
        spans = [(s["start"], s["end"]) for s in r["secrets"] if s["kind"] >= 3]
        if cases[r["text"]] is None:
            assert spans == [], r
        else:
            assert spans[-1][1] == cases[r["text"]][1], r
            # no span reaches into the placeholder
            where = re.search(secret_scan.ALLOWED[3], r["text"])
            assert not any(a < where.end() and b > where.start() for a, b in spans), r


def test_spans_cover_only_high_windows_and_long_lists_take_time_in_proportion(spark):
    keys = ["Zx9Qw2Er4Ty6Ui8Op0As", "1Lk3Jh5Gf7Ds9Aq2Wx4Cv"]
    df = spark.createDataFrame([(("m" * 3000).join(keys),)], "text string")
    found = secret_scan.scan(df).first()["secrets"]
    assert sum(s["end"] - s["start"] for s in found) < 120 and len(found) == 2
    seconds = {}
    for n in (2000, 8000):
        lines = "\n".join(f"{hashlib.md5(str(i).encode()).hexdigest()}  f{i} {hashlib.md5(str(i).encode()).hexdigest().upper()}" for i in range(n))
        big = spark.createDataFrame([(lines,)], "text string")
        out = secret_scan.scan(big)
        start = time.perf_counter()
        r = out.select(F.size("secrets").alias("n"), secret_scan.redacted(F.col("text"), F.col("secrets")).alias("clean")).first()
        seconds[n] = time.perf_counter() - start
        assert r["n"] >= 1.9 * n and len(r["clean"]) < 0.5 * len(lines)
    assert seconds[8000] < 8 * seconds[2000], seconds


def test_redaction(spark):
    df = secret_scan.scan(spark.createDataFrame([(t,) for t in SECRETS], "text string"))
    for r in df.select("text", "secrets", secret_scan.redacted(F.col("text"), F.col("secrets")).alias("clean")).collect():
        out, at = [], 0
        for s in r["secrets"]:
            if s["start"] >= at:
                out.append(r["text"][at : s["start"]] + secret_scan.REDACTED)
            at = max(at, s["end"])
        assert r["clean"] == ("".join(out) + r["text"][at:] if r["secrets"] else r["text"])
