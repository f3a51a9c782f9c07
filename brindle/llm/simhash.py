"""Near-duplicates by SimHash: fingerprints of word shingles, linked at few differing bits.

Fingerprints are computed in the tasks that read the texts. What follows works on
distinct fingerprints: copies collapse before anything is compared. Two
fingerprints within ``MAX_BITS`` bits agree wholly on some choice of blocks, as
each differing bit spoils one block only; so they meet in a bucket of that
choice. The buckets are dealt to cells of bounded size, large ones as pairs of
chunks. In a cell a table of Hamming distances to many reference fingerprints
is computed first. A pair whose distances to any reference differ by more than
``MAX_BITS`` cannot be linked (triangle inequality) and is discarded; the
survivors are compared bit by bit. A cell returns a star per component, not its
pairs, and the stars are joined to components of the whole table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brindle import workspace
from brindle.llm.components import least_reachable
from brindle.llm.tasks import append_columns, col, in_tasks, row_key

WORDS = 4
SEED = 42
MAX_BITS = 4

# Reference fingerprints: any fixed, well spread values do.
REFERENCES = np.random.default_rng(9).integers(0, 1 << 64, 24, np.uint64)

# A cell holds at most two chunks of a bucket.
CHUNK = 1_024

# Buckets should hold about so many unrelated fingerprints at most.
BUCKET = 64

# Shingles hashed at a time, and the rows that eight-bit counters can add up.
HASHES = 1 << 18
LANE = 255


def _hashes(text: str, words: int) -> np.ndarray:
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = [0, *ends[: len(tokens) - words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))


def fingerprints(texts: list[str], words: int = WORDS) -> np.ndarray:
    """The SimHash of each text: a bit is 1 if set in over half the shingles' hashes."""
    sums = np.zeros((len(texts), 64), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def add() -> None:
        if not held:
            return
        flat = np.concatenate([h for _, h in held])
        bits = np.unpackbits(flat.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
        starts = np.cumsum([0, *(len(h) for _, h in held)])
        runs = [np.arange(a, b, LANE) for a, b in zip(starts[:-1], starts[1:])]
        lanes = np.add.reduceat(bits, np.concatenate(runs), axis=0).view(np.uint8).astype(np.int64)
        firsts = np.cumsum([0, *(len(r) for r in runs[:-1])])
        np.add.at(sums, [i for i, _ in held], np.add.reduceat(lanes, firsts, axis=0))
        held.clear()

    for i, text in enumerate(texts):
        hashes = _hashes(text, words)
        sizes[i] = len(hashes)
        for a in range(0, len(hashes), HASHES):
            held.append((i, hashes[a : a + HASHES]))
            if sum(len(h) for _, h in held) >= HASHES:
                add()
    add()
    return np.packbits(2 * sums > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint_slice(part: pa.RecordBatch, words: int) -> list[pa.Array]:
    return [pa.array(fingerprints([t or "" for t in part.column(0).to_pylist()], words).view(np.int64))]


def fingerprint(df: DataFrame, text: str = "text", words: int = WORDS, name: str = "simhash") -> DataFrame:
    """``df`` with the fingerprint of ``text`` as a long; a null or wordless text has 0."""
    return append_columns(df, fingerprint_slice, [text], [StructField(name, LongType())], words=words)


def _masks(n: int, max_bits: int) -> list[int]:
    """Bit masks of which any two fingerprints within ``max_bits`` agree on one at least.

    64 bits in ``max_bits`` + k blocks leave k blocks untouched; k grows until
    unrelated fingerprints seldom share the bits of a mask.
    """
    for kept in range(1, 5):
        blocks = max_bits + kept
        edges = [64 * i // blocks for i in range(blocks + 1)]
        parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
        if kept == 4 or n / BUCKET <= 1 << (64 * kept // blocks):
            return [sum(chosen) for chosen in combinations(parts, kept)]
    raise AssertionError


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cells(prints: DataFrame, masks: list[int]) -> DataFrame:
    """Rows (mask, bucket, cell, simhash): every pair of a bucket meets in one cell at least."""
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("mask"), F.col("simhash").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
            for i, m in enumerate(masks)
        )
    )
    dealt = prints.select("simhash", F.explode(keys).alias("key")).select("simhash", "key.*")
    counts = dealt.groupBy("mask", "bucket").agg(F.count("*").alias("n"))
    large = counts.where(F.col("n") > CHUNK).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    large = workspace.summary(large.select("mask", "bucket", "chunks"), "large-buckets")
    # a chunk of a large bucket meets itself and each other chunk
    chunk = F.pmod(F.xxhash64("simhash"), F.col("chunks").cast("bigint")).cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    cell = F.transform(others, lambda o: F.least(o, F.col("chunk")) * F.col("chunks") + F.greatest(o, F.col("chunk")))
    split = (
        dealt.join(large, ["mask", "bucket"], "left")
        .withColumn("chunk", F.coalesce(chunk, F.lit(0)))
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    )
    return split.select("mask", "bucket", F.explode(cell).alias("cell"), "simhash")


def link_cells(batches, max_bits: int):
    """Stars (high, low) of the linked fingerprints in each cell of sorted rows."""
    rest = None
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
        rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
        if not rows.shape[1]:
            continue
        # the last cell may go on in the next batch
        last = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0))
        cut = last[-1] + 1 if len(last) else 0
        rest = rows[:, cut:]
        yield from _stars(rows[:, :cut], max_bits)
    if rest is not None:
        yield from _stars(rest, max_bits)


def _stars(rows: np.ndarray, max_bits: int):
    if rows.shape[1] < 2:
        return
    group = np.concatenate([[0], np.cumsum((rows[:3, 1:] != rows[:3, :-1]).any(axis=0))])
    prints = rows[3].view(np.uint64) if rows[3].flags.c_contiguous else np.ascontiguousarray(rows[3]).view(np.uint64)
    table = np.stack([np.bitwise_count(prints ^ r) for r in REFERENCES]).astype(np.int8)
    order = np.lexsort((table[0], group))
    group, prints, table = group[order], prints[order], np.ascontiguousarray(table[:, order])
    label = np.arange(len(prints))
    left, step = np.arange(len(prints)), 1
    links: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        # rows of a group stand by their first coordinate: once it is too far off, all later rows are
        left = left[left + step < len(prints)]
        left = left[(group[left] == group[left + step]) & (table[0][left + step] - table[0][left] <= max_bits)]
        if not len(left):
            break
        a = left
        for coordinate in table[1:]:
            a = a[np.abs(coordinate[a] - coordinate[a + step]) <= max_bits]
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= max_bits]
        if len(a):
            links.append((a, a + step))
        step += 1
    if not links:
        return
    a, b = np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    hung = np.flatnonzero(label != np.arange(len(label)))
    high, low = prints[hung].view(np.int64), prints[label[hung]].view(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], names=["high", "low"])


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row of ``df``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Rows whose fingerprints differ in ``max_bits`` or fewer bits are linked; the
    component of a row is the least id it reaches over links, its own included.
    Null, empty and wordless texts have fingerprint zero and are linked like any
    other. Repeated rows are returned as often as they occur. A null id is no
    candidate for the least; a component of null ids only has a null id.
    """
    rows = fingerprint(df.select(col(doc_id).alias("doc_id"), col(text).alias("text")), "text", words)
    rows = workspace.materialize(rows.select("doc_id", "simhash"), "simhash")
    component = _components(rows, max_bits).select("simhash", F.col("least").alias("component_id"))
    return rows.join(component, "simhash").select(
        F.col("doc_id").alias(doc_id),
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _components(rows: DataFrame, max_bits: int) -> DataFrame:
    """Rows (simhash, least): each fingerprint of ``rows`` with the least ``doc_id`` of its component."""
    spark = rows.sparkSession
    prints = workspace.materialize(rows.groupBy("simhash").agg(F.min("doc_id").alias("least")), "prints")
    masks = _masks(prints.count(), max_bits)
    cells = _cells(prints, masks)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([StructField("high", LongType()), StructField("low", LongType())])
    links = (
        cells.repartition(parts, "mask", "bucket", "cell")
        .sortWithinPartitions("mask", "bucket", "cell")
        .mapInArrow(in_tasks(link_cells, max_bits=max_bits), schema)
    )
    roots = least_reachable(links, "high", "low")
    grouped = prints.join(roots, prints["simhash"] == roots["node"], "left").select(
        "simhash", "least", F.coalesce("root", "simhash").alias("root")
    )
    grouped = workspace.materialize(grouped, "rooted")
    least = grouped.groupBy("root").agg(F.min("least").alias("least"))
    return workspace.materialize(grouped.select("simhash", "root").join(least, "root").select("simhash", "least"), "components")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one row of each component: that of the least id, and of its texts the least by a hash.

    Rows that share an id, or have none, are told apart by their text; of rows
    alike in both one stays. A row with a null id stays only if its component
    has no other.
    """
    # ids in their order, null ones last, and the keys of the rows
    known = F.struct(col(doc_id).isNull().alias("unknown"), col(doc_id).alias("id"), row_key(doc_id, text).alias("key"))
    rows = fingerprint(df.select(known.alias("doc_id"), col(text).alias("text")), "text", words)
    rows = workspace.materialize(rows.select("doc_id", "simhash"), "simhash")
    found = rows.join(_components(rows, max_bits), "simhash")
    found = workspace.materialize(found.select(F.col("doc_id.key").alias("key"), F.col("least.key").alias("stays")), "near-duplicates")
    gone = workspace.materialize(found.where("key <> stays").select("key").distinct(), "gone")
    gone = workspace.broadcast_within(gone)
    kept = df.join(gone, row_key(doc_id, text) == gone["key"], "left_anti")
    twice = found.where("key = stays").groupBy("key").count().where("count > 1").select("key")
    twice = workspace.materialize(twice, "repeated-rows")
    if twice.isEmpty():
        return kept
    shared = workspace.broadcast_within(twice)
    once = kept.join(shared, row_key(doc_id, text) == shared["key"], "left_anti")
    one = kept.join(shared, row_key(doc_id, text) == shared["key"], "left_semi")
    return once.unionByName(one.dropDuplicates([doc_id, text]))
