"""Packing, hard negatives and the Merkle manifest: brute force, SQL and odd rows."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm import merkle, negatives, packing
from brindle.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_merkle_manifest"])
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    rows = QUERIES[name](spark, SF)
    assert sorted(rows.columns) == sorted(names)
    got = Counter(tuple(r[n] for n in names) for r in rows.collect())
    assert got and got == Counter(expected.fetchall())


# packing


def brute_ids(texts):
    coder = Tokenizer.from_file(PATH)
    return [[*coder.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check_pieces(pieces, ids_by_doc, window):
    """Pieces cover every id once, lie gaplessly in sequences, and carry the right checksums."""
    at, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        at[p["doc_id"]].append((p["start"], p["length"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        ids = ids_by_doc[p["doc_id"]]
        cut = ids[p["start"] : p["start"] + p["length"]]
        assert p["length"] == len(cut) > 0 and p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))
    assert set(at) == set(ids_by_doc)
    for doc, found in at.items():
        ends = [a + b for a, b in sorted(found)]
        assert [a for a, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] == len(ids_by_doc[doc])
    padding = 0
    for found in sequences.values():
        ends = [a + b for a, b in sorted(found)]
        assert [a for a, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] <= window
        padding += 0 if ends[-1].bit_count() == 1 else window - ends[-1]
    assert sorted(sequences) == list(range(len(sequences)))
    return padding


def test_packing_of_documents(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    ids = dict(zip([i for i, _ in rows], brute_ids([t for _, t in rows])))
    pieces = QUERIES["op11_packing"](spark, SF).collect()
    assert check_pieces(pieces, ids, packing.WINDOW) == 0


def test_packing_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "SECTION", 500)
    draw = random.Random(3)
    texts = [
        None, "", " ", "\n\n", "<|endoftext|>", "a <|endoftext|>\n b", "-x - y", "日本語のテキスト" * 50, " nbsp x", "x" * 5000,
        "word " * 3000, "\x1c\x1f a\x85b", "it's we'll  don't\t\tgo ", "🙂🙂 é̂ ﻿",
    ]
    texts += [" ".join(draw.choices(["alpha", "be", "gamma-delta", "1234", "(x)", "é"], k=draw.randrange(1, 60))) for _ in range(40)]
    texts += [texts[20]] * 30
    schema = "doc_id bigint, text string, length string, kept_0 int, text_key int"
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], schema)
    ids = dict(enumerate(brute_ids(texts)))
    for window in (64, 2048):
        packed = packing.pack(df, PATH, window=window)
        assert packed.columns == ["doc_id", "kept_0", *packing.OUTPUTS]
        assert check_pieces(packed.collect(), ids, window) == 0
    # the ids themselves
    packed = packing.pack(df, PATH, window=64, keep=["doc_id"])
    pieces = packed.join(packing.piece_ids(df, packed, PATH, 1), ["text_key", "start", "length"]).collect()
    assert len(pieces) == packed.count()
    for p in pieces:
        cut = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert bytes(p["ids"]) == struct.pack(f"<{len(cut)}I", *cut)


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []


@pytest.mark.parametrize("shape", ["even", "hot", "short", "one"])
def test_plan_places_every_rest_once(shape):
    draw = np.random.default_rng(4)
    n = {"even": draw.integers(1, 256, 4000), "hot": np.r_[np.full(2000, 190), draw.integers(1, 256, 4000)],
         "short": draw.integers(1, 20, 3000), "one": np.full(500, 200)}[shape]
    histogram = np.bincount(n, minlength=256)
    found = packing.plan(histogram, 256)
    ranks = defaultdict(list)
    used = Counter()
    for length, a, b, first, offset in found.fills:
        ranks[length].append((a, b))
        for k in range(b - a):
            used[first + k] += length
    assert all(total == 256 for total in used.values()) and len(used) == found.n_fills
    tokens = 0
    for length, a, b, start in found.line:
        ranks[length].append((a, b))
        assert start == tokens
        tokens += length * (b - a)
    assert found.bounds[-1] == tokens
    for length in np.flatnonzero(histogram):
        ends = [b for _, b in sorted(ranks[length])]
        assert [a for a, _ in sorted(ranks[length])] == [0, *ends[:-1]] and ends[-1] == histogram[length]
    if shape == "even":
        # least squares leave little for the line
        assert sum(b - a for _, a, b, _ in found.line) < 0.2 * len(n)


# hard negatives


def brute_negatives(rows, every=50, scale=256):
    least = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        least[i] = min(least.get(i, (label, vector)), (label, vector))
    whole = {i: (label, [int(np.floor(scale * x)) for x in v]) for i, (label, v) in least.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (label, vector) in whole.items():
        if a % every:
            continue
        scored = sorted((-dot(vector, v), i, other) for i, (other, v) in whole.items() if i != a)
        for s, p in [(-s, i) for s, i, other in scored if other == label][:5]:
            inside = [(-n, i) for n, i, other in scored if other != label and 50 * s <= -100 * n <= 95 * s][:3]
            out |= {(a, p, k + 1, i, s, n) for k, (n, i) in enumerate(inside)}
    return out


def vectors(n, seed=0, width=6):
    draw = random.Random(seed)
    return [(i, draw.randrange(3), [draw.choice([0.0, 0.25, 0.5, -0.1, 1.0, 0.7]) for _ in range(width)]) for i in range(n)]


SCHEMA = "vec_id bigint, label int, embedding array<double>"


def test_negatives_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "CANDIDATES", 40)
    monkeypatch.setattr(negatives, "SCORES", 50)
    rows = vectors(400)
    inf, nan = float("inf"), float("nan")
    rows += [(None, 1, [1.0] * 6), (1000, None, [1.0] * 6), (1050, 1, None), (1100, 1, [None] + [1.0] * 5), (1150, 1, [nan] * 6), (1200, 1, [inf] * 6)]
    rows += [(1250, 1, []), (1300, 2, [1.0]), (1350, 2, [1.0] * 9), rows[50], rows[50], (100, 2, [0.3] * 6), (-50, 0, [1.0] * 6), (-3, 1, [0.5] * 6)]
    rows += [(2000 + i, i % 2, [0.5] * 6) for i in range(60)] + [(3000, 0, [0.0] * 6), (3050, 1, [0.0] * 6)]
    rows += [(3100, 0, [float(1 << 21)] * 6), (3101, 0, [float(1 << 21)] * 6), (3102, 1, [float(1 << 20)] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", row string, chunk int")
    got = [tuple(r) for r in negatives.mine(df, F.col("vec_id") % 50 == 0).collect()]
    expected = brute_negatives(rows)
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 100


def test_negatives_of_nothing_and_too_much(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    assert negatives.mine(spark.createDataFrame([(0, 1, [1.0])], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    large = spark.createDataFrame([(i, i % 2, [1e10] * 4) for i in range(4)], SCHEMA)
    with pytest.raises(Exception, match="64-bit"):
        negatives.mine(large, F.col("vec_id") % 50 == 0).collect()


def test_keys_sort_by_anchor_score_kind_and_id():
    draw = random.Random(1)
    ends = [-(1 << 63) + 1, -5, -1, 0, 1, 7, (1 << 63) - 1]
    keys = [(draw.choice(ends), draw.choice(ends), draw.random() < 0.5, draw.choice(ends)) for _ in range(300)]
    assert [negatives.unpack(negatives.pack(*k)) for k in keys] == keys
    assert sorted(keys, key=lambda k: negatives.pack(*k)) == sorted(keys, key=lambda k: (k[0], -k[1], k[2], k[3]))


# manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(leaves, arity):
    """Root, and per leaf the siblings level by level."""
    proofs, above = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for i, node in enumerate(above):
            run = node - node % arity
            proofs[i] += [h for j, h in enumerate(leaves[run : run + arity], run) if j != node]
            above[i] = node // arity
        leaves = [sha("".join(leaves[i : i + arity])) for i in range(0, len(leaves), arity)]
    return leaves[0], proofs


def brute_manifest(rows, arity):
    """(order, leaf, position, subroot, root, proof) of rows (group, order, leaf)."""
    groups = defaultdict(list)
    for group, order, leaf in rows:
        groups[group].append((order is not None, order or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[g])], arity) for g in names]
    root, upper = brute_tree([t[0] for t in trees], arity)
    return Counter(
        (order if there else None, leaf, i, trees[k][0], root, sha("".join(trees[k][1][i] + upper[k])))
        for k, g in enumerate(names)
        for i, (there, order, leaf) in enumerate(sorted(groups[g]))
    )


@pytest.mark.parametrize("arity,n_groups", [(2, 3), (4, 1), (8, 20)])
def test_manifest_against_brute_force(spark, arity, n_groups):
    draw = random.Random(arity)
    names = [None, "", "a", "B", "é", "zz", *(f"g{i}" for i in range(20))][:n_groups]
    rows = [(draw.choice(names[: 1 + i % n_groups]), draw.randrange(300), sha(str(draw.randrange(200)))) for i in range(700)]
    rows += [(names[0], None, sha("x")), (names[0], None, sha("y")), ("alone", 5, sha("z")), *[("same", 7, sha("copy"))] * 17]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "lang string, doc_id bigint, leaf string, path string, g int")
    proved = merkle.prove(df, "lang", "doc_id", arity=arity)
    assert proved.columns == ["lang", "doc_id", "leaf", "g", "position", "group_rows", "subroot", "root", "path"]
    found = proved.select(
        "doc_id", "leaf", "position", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof"),
        merkle.folded(F.col("leaf"), F.col("path")).alias("again"), merkle.folded(F.sha2(F.lit("other"), 256), F.col("path")).alias("wrong"),
    ).collect()
    assert Counter(tuple(r)[:6] for r in found) == brute_manifest(rows, arity)
    assert all(r["again"] == r["root"] != r["wrong"] for r in found)


def test_manifest_of_few(spark):
    schema = "lang string, doc_id bigint, leaf string"
    assert merkle.prove(spark.createDataFrame([], schema), "lang", "doc_id").collect() == []
    one = merkle.prove(spark.createDataFrame([(None, None, sha("a"))], schema), "lang", "doc_id").collect()
    assert [(r["subroot"], r["root"], r["path"]) for r in one] == [(sha("a"), sha("a"), [])]


def test_leaves_tell_null_from_empty_and_borders_apart(spark):
    rows = [(1, "ab", "c"), (1, "a", "bc"), (None, "", None), (None, None, ""), (12, "é" * 100_000, "x")]
    df = spark.createDataFrame(rows, "n bigint, a string, b string")
    got = {tuple(r)[:3]: r["leaf"] for r in df.withColumn("leaf", merkle.leaf_digest([F.col("n"), F.col("a"), F.col("b")])).collect()}
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    assert got == {r: sha("".join(map(field, r))) for r in rows} and len(set(got.values())) == len(rows)
