"""Exact top-k by inner product: a three-phase uniform threshold over lists of partial scores.

A vector's components are dealt to ``LISTS`` lists; a score is the sum of one
partial score per list. Queries and candidates meet in cells, a chunk of each,
which bounds what a task holds.

1. Every cell gathers, for each query and list, the ``DEPTH`` entries with the highest
   partial scores, and returns the best of them with their whole scores. The k-th highest
   whole score among what was gathered is a safe cutoff t of the query: k candidates reach it.
   What was not gathered in a cell is no higher, in any list, than the least that was; where
   these bounds sum up to less than t the cell has nothing more for the query.
2. The cutoffs go back to the other cells, and to no more of them. A candidate with all partial
   scores below t / LISTS has a score below t, so only entries of at least that are collected.
3. Of the collected candidates those whose upper bound reaches t (known partial
   scores, and t / LISTS for each unknown one) are resolved exactly.

Copies of a vector tie, and ties go to the smaller id, so of each distinct vector
only the k + 1 smallest ids can be among the results of any query; the rest of
a large group of copies is left out before anything is exchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle import workspace
from brindle.llm.tasks import ROOT, col

LISTS = 2
SCALE = 1024

# Rows of a cell.
QUERIES, CANDIDATES = 512, 8_192

# Entries of a list that a cell gathers; more leave fewer cells to the second phase.
DEPTH = 64

FOUND = "query_id bigint, vec_id bigint, score bigint"
GATHERED = f"{FOUND}, chunk bigint, bound bigint"
LONGEST = (1 << 63) - 1


def quantized(vector: Column) -> Column:
    """Each component x as floor(1024 x), a whole double, or null if the vector takes no part.

    That is a null vector and one with a component that is null or not finite.
    """
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    # beyond 2^52 a double is whole already, and the product with a power of two is exact
    whole = F.transform(vector, lambda x: _floor(x.cast("double") * SCALE))
    return F.when(vector.isNotNull() & finite, whole)


def _floor(x: Column) -> Column:
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    lengths = np.diff(values.offsets.to_numpy())
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = values.flatten().to_numpy()
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows: in doubles where these are exact, else in longs, else in Python's integers."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if largest < 1 << 60:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return (whole(a) if a.size else a.astype(object)) @ (whole(b) if b.size else b.astype(object)).T


def _total(partial: list[np.ndarray], counts: np.ndarray) -> np.ndarray:
    """Whole scores; one that no long holds is an error, as is none left out."""
    total = sum(partial)
    if total.dtype == object and any(not -(1 << 63) < x < 1 << 63 for x in total[counts]):
        raise OverflowError("a score does not fit a 64-bit integer")
    return np.where(counts, total, 0).astype(np.int64)


def _cell(table: pa.Table):
    """Ids, partial scores by list and whether a pair counts, for the queries and candidates of a cell."""
    table = table.combine_chunks()
    asks = table["asks"].to_numpy()
    parts = [table.filter(pa.array(asks)), table.filter(pa.array(~asks))]
    width = max([1, *(int(np.diff(p["vector"].combine_chunks().offsets.to_numpy()).max(initial=0)) for p in parts if p.num_rows)])
    queries, candidates = (_matrix(p["vector"], width) if p.num_rows else np.zeros((0, width)) for p in parts)
    ids, others = parts[0]["id"].to_numpy(), parts[1]["id"].to_numpy()
    partial = [_product(queries[:, j::LISTS], candidates[:, j::LISTS]) for j in range(LISTS)]
    return ids, others, partial, ids[:, None] != others[None, :], parts[0]["cutoff"]


def _rows(ids, others, total, chosen) -> pa.Table:
    q, c = np.nonzero(chosen)
    return pa.table({"query_id": pa.array(ids[q], pa.int64()), "vec_id": pa.array(others[c], pa.int64()), "score": pa.array(total[q, c], pa.int64())})


def _highest(values: np.ndarray, others: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Marks the k highest valid values of each row, ties to smaller ids."""
    order = np.argsort(others, kind="stable")
    least = min(int(values.min(initial=0)), 0) - 1
    # in the order of ids the first of equal values has the smallest
    masked = np.where(valid, values, least)[:, order]
    chosen, rows = np.zeros(values.shape, bool), np.arange(len(values))
    for _ in range(min(k, values.shape[1])):
        best = masked.argmax(axis=1)
        chosen[rows, order[best]] = True
        masked[rows, best] = least
    return chosen & valid


def _gathered(values: np.ndarray, valid: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries of each row that are among its ``depth`` highest, and the least of these."""
    masked = np.where(valid, values, min(int(values.min(initial=0)), 0) - 1)
    at = masked.shape[1] - depth
    least = np.partition(masked, at, axis=1)[:, at]
    return valid & (values >= least[:, None]), least


def gather(table: pa.Table, k: int, depth: int) -> pa.Table:
    """Phase 1 in a cell: the best of the highest entries of the lists, and for each query a row with
    the bound of what was not gathered, null if nothing was left."""
    ids, others, partial, valid, _ = _cell(table)
    chunk = table["chunk"][0].as_py()
    chosen, bounds = valid, None
    if len(ids) and valid.shape[1] > depth:
        chosen, least = zip(*(_gathered(values, valid, depth) for values in partial))
        chosen = np.logical_or.reduce(chosen)
        bounds = [min(max(int(x), -LONGEST), LONGEST) for x in sum(b.astype(object) for b in least)]
    total = _total(partial, valid)
    found = _rows(ids, others, total, _highest(total, others, chosen, k))
    nulls = pa.nulls(found.num_rows, pa.int64())
    found = found.append_column("chunk", pa.array([chunk] * found.num_rows, pa.int64())).append_column("bound", nulls)
    if bounds is None:
        return found
    none = pa.nulls(len(ids), pa.int64())
    columns = [pa.array(ids, pa.int64()), none, none, pa.array([chunk] * len(ids), pa.int64()), pa.array(bounds, pa.int64())]
    return pa.concat_tables([found, pa.table(columns, names=found.column_names)])


def resolve(table: pa.Table, k: int) -> pa.Table:
    """Phases 2 and 3 in a cell: the best of what can reach the cutoff."""
    ids, others, partial, valid, cutoffs = _cell(table)
    if not len(ids) or not len(others):
        return _rows(ids, others, np.zeros((len(ids), len(others)), np.int64), np.zeros(valid.shape, bool))
    known = np.array([c is not None for c in cutoffs.to_pylist()])
    cutoff = np.array([c or 0 for c in cutoffs.to_pylist()], np.int64)[:, None]
    # in units of 1 / LISTS all comparisons are of whole numbers
    collected = [values * LISTS >= cutoff for values in partial]
    some = valid & (np.logical_or.reduce(collected) | ~known[:, None])
    upper = sum(np.where(seen, values * LISTS, cutoff) for seen, values in zip(collected, partial))
    q, c = np.nonzero(some & ((upper >= cutoff * LISTS) | ~known[:, None]))
    total = np.zeros(valid.shape, np.int64)
    found = np.zeros(valid.shape, bool)
    found[q, c] = True
    total[q, c] = _total(partial, found)[q, c]
    reaching = np.zeros(valid.shape, bool)
    reaching[q, c] = (total[q, c] >= cutoff[q, 0]) | ~known[q]
    return _rows(ids, others, total, _highest(total, others, reaching, k))


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _in_cells(function, **options):
    module, name, root = function.__module__, function.__name__, ROOT

    def run(table):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(table, **options)

    return run


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k highest scores of each query among all other rows.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id; with
    fewer than k other rows all are returned. Rows without an id, and vectors that
    ``quantized`` turns down, take no part. Of rows that share an id the least
    vector counts, so repeated rows count once. A vector shorter than
    another is taken to go on with zeros. A score that a long does not hold raises
    OverflowError.
    """
    rows = df.where(col(vec_id).isNotNull()).select(col(vec_id).cast("long").alias("id"), quantized(col(embedding)).alias("vector"))
    rows = rows.where("vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    rows = workspace.materialize(rows, "vectors")
    copies = Window.partitionBy("vector").orderBy("id")
    candidates = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    candidates = workspace.materialize(candidates, "candidates")
    queries = rows.select(F.col("id").alias(vec_id), "vector").where(is_query).select(col(vec_id).alias("id"), "vector")
    queries = workspace.materialize(queries, "queries")
    n_queries, n_candidates = queries.count(), candidates.count()
    blocks, chunks = max(1, -(-n_queries // QUERIES)), max(1, -(-n_candidates // CANDIDATES))
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("long").alias("chunk")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long").alias("block")
    unknown = F.lit(None).cast("long").alias("cutoff")
    asked = candidates.select(F.lit(False).alias("asks"), "id", "vector", unknown, chunk, F.explode(_numbers(blocks)).alias("block"))
    asking = queries.select(F.lit(True).alias("asks"), "id", "vector", unknown, F.explode(_numbers(chunks)).alias("chunk"), block)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = asked.unionByName(asking).groupBy("chunk", "block").applyInArrow(_in_cells(gather, k=k, depth=max(k, DEPTH)), GATHERED)
    first = workspace.materialize(first, "gathered")
    entries = first.where("bound IS NULL").select("query_id", "vec_id", "score", "chunk")
    cutoffs = ranked(entries).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff"))
    # a cell that left something out has returned k entries, so its queries have a cutoff
    bounds = first.where("bound IS NOT NULL").select(F.col("query_id").alias("id"), "chunk", "bound")
    opened = bounds.join(cutoffs, "id").where("bound >= cutoff").select("id", "chunk", "cutoff", block)
    opened = workspace.materialize(opened, "open-cells")
    cells = workspace.broadcast_within(workspace.materialize(opened.select("chunk", "block").distinct(), "open-blocks"))
    again = opened.join(queries, "id").select(F.lit(True).alias("asks"), "id", "vector", "cutoff", "chunk", "block")
    again = asked.join(cells, ["chunk", "block"], "left_semi").unionByName(again)
    second = again.groupBy("chunk", "block").applyInArrow(_in_cells(resolve, k=k), FOUND)
    # an opened cell returns what it returned before if that reaches the cutoff
    whole = entries.drop("chunk").unionByName(second).distinct()
    return ranked(whole).select("query_id", "rank", "vec_id", "score")
