"""Hard negatives by a secondary-sort shuffle.

Anchors and all other rows meet in cells, a block of each, where numpy computes
their scores. A pair becomes a packed key of (anchor, descending score, positives
first, id), whose bytes sort in that order. The pairs are repartitioned by anchor
and sorted within the partitions by key, and a streaming iterator runs over them:
each of an anchor's first positives opens a window of scores, and a negative is
emitted for every open window it lies in. The iterator holds the open windows and
nothing else of an anchor.

What a cell sends is combined there, as before any shuffle: of an anchor's rows in
the cell only its best positives can be among its best of all, and only the first
negatives of a window can be the first of all. The windows are known once the
positives are, so cells are run twice: for positives, then for negatives.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle import workspace
from brindle.llm.tasks import col, in_tasks

SCALE = 256

# Rows of a cell at most, and the least candidates that are worth a task.
ANCHORS, CANDIDATES, LEAST_CANDIDATES = 4_096, 16_384, 2_048

# Scores of a cell that are held at a time.
SCORES = 1 << 22

KEY = struct.Struct(">QQBQ")
SIGN = 1 << 63
LOWEST = np.iinfo(np.int64).min
PAIRS = "anchor bigint, score bigint, key binary"
FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def pack(anchor: int, score: int, negative: bool, other: int) -> bytes:
    """A key whose bytes sort by anchor, then descending score, positives first, then id.

    Ids and scores are signed 64-bit numbers; shifted, their unsigned order is the same.
    """
    return KEY.pack(anchor + SIGN, SIGN - 1 - score, negative, other + SIGN)


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    """Anchor, score, whether it is a negative, and the other row's id."""
    anchor, falling, negative, other = KEY.unpack(key)
    return anchor - SIGN, SIGN - 1 - falling, bool(negative), other - SIGN


def takes_part(label: Column, vector: Column) -> Column:
    """Whether a row has a label and a vector of finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite, F.lit(False))


def _whole(values, width: int, scale: int) -> np.ndarray:
    """Vectors as rows of whole doubles, floor(scale * x), filled up with zeros."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    lengths = np.diff(values.offsets.to_numpy())
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = np.floor(values.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows, as longs.

    In doubles where every partial sum is a whole double, in longs where none can
    overflow, else in Python's integers. A score beyond a long raises OverflowError.
    """
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if largest < 1 << 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    exact = [[sum(x * y for x, y in zip(p, q)) for q in whole[1]] for p in whole[0]]
    if any(not -(1 << 63) < x < 1 << 63 for row in exact for x in row):
        raise OverflowError("a score does not fit a 64-bit integer")
    return np.array(exact, np.int64).reshape(len(a), len(b))


def _best(scores: np.ndarray, k: int):
    """Row and column of the k highest values above LOWEST of each row, the first columns of ties first."""
    scores = scores.copy()
    rows = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        there = scores[rows, at] > LOWEST
        if not there.any():
            return
        yield rows[there], at[there]
        scores[rows[there], at[there]] = LOWEST


def _cell(table: pa.Table, scale: int):
    """Blocks of (anchor rows, candidates' ids, scores, whether it is another row, whether the labels are the same)."""
    asks = table["asks"].to_numpy()
    asking, others = table.filter(pa.array(asks)), table.filter(pa.array(~asks)).sort_by("id")
    if not asking.num_rows or not others.num_rows:
        return
    asking, others = asking.combine_chunks(), others.combine_chunks()
    lists = [t["vector"].combine_chunks() for t in (asking, others)]
    width = max(1, *(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in lists))
    candidates = _whole(lists[1], width, scale)
    ids, labels = others["id"].to_numpy(), others["label"].to_numpy()
    step = max(1, SCORES // len(ids))
    for start in range(0, asking.num_rows, step):
        part = asking.slice(start, step)
        scores = products(_whole(part["vector"], width, scale), candidates)
        own, own_labels = part["id"].to_numpy(), part["label"].to_numpy()
        yield part, ids, scores, own[:, None] != ids[None, :], own_labels[:, None] == labels[None, :]


def _pairs(found: list[tuple[int, int, bool, int]]) -> pa.Table:
    """Pairs of (anchor, score, whether it is a negative, id) with their keys."""
    anchors, scores = [x[0] for x in found], [x[1] for x in found]
    keys = [pack(*x) for x in found]
    return pa.table({"anchor": pa.array(anchors, pa.int64()), "score": pa.array(scores, pa.int64()), "key": pa.array(keys, pa.binary())})


def positives_of_cell(table: pa.Table, n_positives: int, scale: int) -> pa.Table:
    """The best positives of every anchor in a cell."""
    found = []
    for part, ids, scores, others, same in _cell(table, scale):
        own = part["id"].to_numpy()
        for q, c in _best(np.where(others & same, scores, LOWEST), n_positives):
            found += [(a, s, False, i) for a, s, i in zip(own[q].tolist(), scores[q, c].tolist(), ids[c].tolist())]
    return _pairs(found)


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the highest negative score s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive_score // 100), high * positive_score // 100


def negatives_of_cell(table: pa.Table, n_negatives: int, low: int, high: int, scale: int) -> pa.Table:
    """The first negatives of every open window of every anchor in a cell."""
    found = []
    for part, ids, scores, others, same in _cell(table, scale):
        own = part["id"].to_numpy()
        windows = [sorted({window(s, low, high) for s in row or []}) for row in part["positives"].to_pylist()]
        for i in range(max(map(len, windows), default=0)):
            has = [len(w) > i for w in windows]
            least = np.array([w[i][0] if h else 1 for w, h in zip(windows, has)], np.int64)[:, None]
            most = np.array([w[i][1] if h else 0 for w, h in zip(windows, has)], np.int64)[:, None]
            inside = others & ~same & (scores >= least) & (scores <= most)
            for q, c in _best(np.where(inside, scores, LOWEST), n_negatives):
                found += [(a, s, True, i) for a, s, i in zip(own[q].tolist(), scores[q, c].tolist(), ids[c].tolist())]
    return _pairs(found)


def emit(batches, n_positives: int, n_negatives: int, low: int, high: int):
    """Negatives of sorted keys: positives open windows, negatives are emitted for each that is open.

    Keys that several windows of a cell sent come side by side and count once.
    """
    anchor, last, opened, out = None, None, [], []

    def table():
        columns = list(zip(*out)) or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for key in batch.column(batch.schema.get_field_index("key")).to_pylist():
            if key == last:
                continue
            last = key
            a, score, negative, other = unpack(key)
            if a != anchor:
                anchor, opened, count = a, [], 0
            if not negative:
                if count < n_positives:
                    opened.append([other, score, *window(score, low, high), 0])
                    count += 1
                continue
            # scores only fall: what they fell below, or what is full, stays closed
            opened = [w for w in opened if score >= w[2] and w[4] < n_negatives]
            for w in opened:
                if score <= w[3]:
                    w[4] += 1
                    out.append((a, w[0], w[4], other, w[1], score))
        if out:
            yield table()
            out = []


def _sorted_keys(pairs: DataFrame, partitions: int) -> DataFrame:
    """The secondary sort: dealt by anchor, sorted within the partitions by the packed key."""
    return pairs.repartition(partitions, "anchor").sortWithinPartitions("key")


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def mine(
    df: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = SCALE,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``. A score is the inner product of the
    vectors with each component as floor(scale * x). The positives of an anchor are
    the ``n_positives`` highest other rows of its label, ties to smaller ids; for
    each, the ``n_negatives`` highest rows of other labels whose score lies between
    ``low`` and ``high`` percent of the positive's are returned, ties to smaller ids,
    fewer where there are fewer. A negative may serve several positives.

    Rows without id or label, without a vector, or with a component that is null or
    not finite take no part. Of rows that share an id the least (label, vector)
    counts, so repeated rows count once. A vector shorter than another goes on with
    zeros. An anchor without positives, and an empty table, give no rows. Other
    columns play no part. A score beyond a 64-bit integer raises OverflowError.
    """
    spark = df.sparkSession
    rows = df.where(col(vec_id).isNotNull() & takes_part(col(label), col(embedding))).select(
        col(vec_id).cast("long").alias("id"), F.struct(col(label).cast("long").alias("label"), col(embedding).alias("vector")).alias("row")
    )
    rows = workspace.materialize(rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*"), "labelled-vectors")
    anchors = rows.select(F.col("id").alias(vec_id), "label", "vector").where(is_anchor)
    anchors = workspace.materialize(anchors.select(col(vec_id).alias("id"), "label", "vector"), "anchors")
    n_anchors, n_rows = anchors.count(), rows.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_anchors // ANCHORS))
    chunks = max(1, -(-n_rows // CANDIDATES), min(partitions, n_rows // LEAST_CANDIDATES))
    none = F.lit(None).cast("array<bigint>")
    dealt = rows.select(
        F.lit(False).alias("asks"), "id", "label", "vector", none.alias("positives"),
        F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"), F.explode(_numbers(blocks)).alias("block"),
    )

    def cells(asking: DataFrame):
        asked = asking.select(
            F.lit(True).alias("asks"), "id", "label", "vector", "positives",
            F.explode(_numbers(chunks)).alias("chunk"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        )
        return dealt.unionByName(asked).groupBy("chunk", "block")

    found = cells(anchors.withColumn("positives", none)).applyInArrow(
        in_tasks(positives_of_cell, n_positives=n_positives, scale=scale), PAIRS
    )
    first = Window.partitionBy("anchor").orderBy("key")
    positives = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n_positives).drop("place")
    positives = workspace.materialize(positives, "positives")
    scores = positives.groupBy(F.col("anchor").alias("id")).agg(F.collect_set("score").alias("positives"))
    negatives = cells(anchors.join(scores, "id")).applyInArrow(
        in_tasks(negatives_of_cell, n_negatives=n_negatives, low=low, high=high, scale=scale), PAIRS
    )
    pairs = _sorted_keys(positives.unionByName(negatives).select("anchor", "key"), partitions)
    run = in_tasks(emit, n_positives=n_positives, n_negatives=n_negatives, low=low, high=high)
    return pairs.select("key").mapInArrow(run, FOUND)
