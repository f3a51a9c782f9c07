"""Packing of token sequences by non-negative least squares over a histogram of lengths.

A document of q * window + r tokens gives q full windows and a rest of r. The
rests' lengths make a histogram of less than ``window`` bins, whatever the data.
Shallow combinations of two or three lengths that fill a window are enumerated
over the bins in use, and non-negative least squares solve how often each is to
be repeated, column generation bringing in the triples that lower the residual
most. The counts are rounded so that no bin is overdrawn. What is left is packed
greedily, the longest first, one after the other: a rest that does not fit into
what is left of a window is cut there, so that only the last window stays open,
and that is cut into powers of two.

Spark does the rest: tokenizing numbers each task's rests per length as it
streams by, counts per task and length are summed up to ranks, and a rest's
length and rank name its place in the plan. Only the histogram and the plan pass
through the driver; both are bounded by the window.
"""

from __future__ import annotations

import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField
from tokenizers import Tokenizer

from brindle import workspace
from brindle.llm.chunks import ASCII_WHITE, LOOKED_UP, KnownIds, cuts, flat_bytes
from brindle.llm.tasks import append_columns, col, in_tasks, slices, without, worker_cache

WINDOW = 2_048

# Text that is tokenized at a time, and what the tokenizer gets of it in one call.
SLICE_BYTES, CALL_BYTES = 4 << 20, 1 << 18

# Bytes of texts whose chunks are looked up at a time.
SECTION = LOOKED_UP

ROUNDS, STEPS = 6, 300

OUTPUTS = ["text_key", "doc_tokens", "start", "length", "sequence_id", "offset", "ids_crc32"]


class Chunks:
    """A tokenizer that encodes each distinct chunk of texts once; their ids are those of their chunks."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        sizes = {i: len(t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        # byte-level tokens spell each byte as one character; added tokens are spelt in UTF-8
        sizes |= {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.sizes = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)])
        self.known = KnownIds(self._learn)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _meeting(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks that begin with white space and do not end with it, many to a call: they meet at boundaries."""
        out, start, held = [], 0, 0
        for i, chunk in enumerate(chunks):
            held += len(chunk)
            if held < CALL_BYTES and i + 1 < len(chunks):
                continue
            part = chunks[start : i + 1]
            raw = self._encode([b"".join(part).decode()])[0]
            ends = np.cumsum(self.sizes[np.frombuffer(raw, "<u4")])
            bounds = [0, *((np.searchsorted(ends, np.cumsum(list(map(len, part)))) + 1) * 4).tolist()]
            out += [raw[a:b] for a, b in zip(bounds, bounds[1:])]
            start, held = i + 1, 0
        return out

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks."""
        inner, outer = [], []
        for i, c in enumerate(chunks):
            last = c[-1:] if c[-1] < 128 else c.decode()[-1]
            (inner if ASCII_WHITE[c[0]] and not last.isspace() else outer).append(i)
        out: list[bytes] = [b""] * len(chunks)
        for group, ids in ((inner, self._meeting([chunks[i] for i in inner])), (outer, self._encode([chunks[i].decode() for i in outer]))):
            for i, x in zip(group, ids):
                out[i] = x
        return out

    def encode(self, column: pa.Array, section: int = SECTION) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers, without special tokens around it."""
        flat, offsets = flat_bytes(column)
        return self.known.encode(flat, offsets, cuts(flat, offsets), section)


_chunks: dict[str, Chunks] = worker_cache(__name__)


def tokenizer(path: str) -> Chunks:
    """This worker's tokenizer of a file that is part of the installation."""
    if path not in _chunks:
        _chunks.clear()
        _chunks[path] = Chunks(path)
    return _chunks[path]


def token_ids(texts: pa.Array, path: str, end_id: int, section: int) -> list[bytes]:
    """The ids of each text and the end mark."""
    end = end_id.to_bytes(4, "little")
    return [ids + end for ids in tokenizer(path).encode(texts, section)]


def measure(batches, path: str, end_id: int, window: int, section: int = SECTION):
    """Per text its tokens, the checksums of its full windows and of its rest, and its numbers in this task.

    ``rank`` counts the task's rests of the same length before it, ``full_before``
    the full windows.
    """
    seen: Counter[int] = Counter()
    full = 0
    width = window * 4
    for batch in batches:
        for part in slices(batch, 1, SLICE_BYTES):
            ids = token_ids(part.column(0), path, end_id, section)
            tokens = [len(x) // 4 for x in ids]
            checks = [[zlib.crc32(x[a : a + width]) for a in range(0, len(x) - width + 1, width)] for x in ids]
            rests = [n % window for n in tokens]
            rest_checks = [zlib.crc32(x[len(x) - r * 4 :]) for x, r in zip(ids, rests)]
            ranks, before = [], []
            for r, c in zip(rests, checks):
                ranks.append(seen[r])
                before.append(full)
                seen[r] += 1
                full += len(c)
            columns = [
                *part.columns[1:],
                pa.array(tokens, pa.int64()), pa.array(checks, pa.list_(pa.int64())), pa.array(rests, pa.int32()),
                pa.array(rest_checks, pa.int64()), pa.array(ranks, pa.int64()), pa.array(before, pa.int64()),
            ]
            names = [*part.schema.names[1:], "doc_tokens", "checks", "rest", "rest_check", "rank", "full_before"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        pa.default_memory_pool().release_unused()


class Plan(NamedTuple):
    """Where the rests go.

    ``fills``: (length, first rank, end rank, first sequence, offset): a rest of that
    length and rank is the piece at ``offset`` of sequence ``first sequence`` + its
    rank among these. ``line``: (length, first rank, end rank, start): rests that lie
    one after the other from token ``start`` of a line, which is cut into sequences
    at ``bounds`` (in full windows up to ``bounds[0]``).
    """

    fills: list[tuple[int, int, int, int, int]]
    line: list[tuple[int, int, int, int]]
    bounds: list[int]
    n_fills: int


def combinations(used: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of used lengths that fill a window, ascending, as rows of three (0: no third)."""
    low = np.arange(1, window // 2 + 1)
    low = low[used[low] & used[window - low]]
    pairs = np.stack([low, window - low, np.zeros_like(low)], axis=1)
    found = [pairs]
    lengths = 1 + np.flatnonzero(used[1:])
    for a in lengths[lengths <= window // 3]:
        b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
        b = b[used[window - a - b]]
        found.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(found)


def solve(columns: np.ndarray, counts: np.ndarray, start: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared difference of the lengths used and ``counts``.

    Accelerated projected gradient; a column is the lengths of one combination.
    """
    weight = (columns > 0).astype(np.float64)
    n = len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(columns.ravel(), (weight * x[:, None]).ravel(), n)

    # a bound of the largest eigenvalue: no row of A^T A sums to more
    degree = used(np.ones(len(columns)))
    step = 1 / max(1.0, (weight * degree[columns]).sum(axis=1).max(initial=1.0))
    x, ahead, t = start, start, 1.0
    for _ in range(steps):
        gradient = (weight * (used(ahead) - counts)[columns]).sum(axis=1)
        moved = np.maximum(ahead - step * gradient, 0)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead = moved + (before - 1) / t * (moved - x)
        x = moved
    return x


def repeats(histogram: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and how often each is repeated, so that no length is used more often than there is of it."""
    counts = histogram.astype(np.float64).copy()
    counts[0] = 0
    every = combinations(histogram > 0, window)
    if not len(every):
        return every, np.zeros(0, np.int64)
    parts = np.where(every > 0, 1 / np.maximum((every > 0).sum(axis=1, keepdims=True), 1), 0)
    chosen = np.flatnonzero(every[:, 2] == 0)
    x = np.minimum(counts[every[chosen, 0]], counts[every[chosen, 1]])
    for _ in range(ROUNDS):
        taken = every[chosen]
        x = solve(taken, counts, x) if len(chosen) else x
        left = counts - np.bincount(taken.ravel(), ((taken > 0) * x[:, None]).ravel(), len(counts))
        # for each length that is left, the combination whose lengths are left most
        gain = (parts * left[every]).sum(axis=1)
        order = np.argsort(-gain, kind="stable")
        order = order[gain[order] > 0.5]
        _, firsts = np.unique(every[order][:, 2], return_index=True)
        by_third = order[firsts]
        _, firsts = np.unique(every[order][:, 0], return_index=True)
        new = np.setdiff1d(np.concatenate([by_third, order[firsts]]), chosen)
        if not len(new):
            break
        chosen = np.concatenate([chosen, new])
        x = np.concatenate([x, np.zeros(len(new))])
    x = solve(every[chosen], counts, x)
    return _rounded(every[chosen], x, every, histogram)


def _rounded(columns: np.ndarray, x: np.ndarray, every: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeat counts: rounded down, cut to what there is, then raised by the largest fractions first.

    What still fills a window without a cut goes on top.
    """
    left = histogram.tolist()
    taken: Counter[tuple[int, ...]] = Counter()

    def take(row: list[int], most: int) -> None:
        if most < 1 or not all(left[c] for c in row if c):
            return
        need = Counter(c for c in row if c)
        n = min(most, *(left[c] // m for c, m in need.items()))
        if n > 0:
            taken[tuple(row)] += n
            for c, m in need.items():
                left[c] -= n * m

    rows = columns.tolist()
    for i in np.argsort(-x, kind="stable").tolist():
        take(rows[i], int(x[i] + 1e-6))
    for i in np.argsort(np.floor(x) - x, kind="stable").tolist():
        take(rows[i], 1)
    for row in every[np.where(every > 0, np.array(left)[every], 1).min(axis=1) > 0].tolist():
        take(row, max(left))
    return np.array(list(taken), np.int64).reshape(-1, 3), np.array(list(taken.values()), np.int64)


def plan(histogram: np.ndarray, window: int) -> Plan:
    """The places of all rests: ``histogram[r]`` is how many have the length r."""
    columns, whole = repeats(histogram, window)
    next_rank = np.zeros(len(histogram), np.int64)
    fills, sequence = [], 0
    for row, n in zip(columns.tolist(), whole.tolist()):
        offset = 0
        for length in (c for c in sorted(row, reverse=True) if c and n):
            first = int(next_rank[length])
            fills.append((length, first, first + n, sequence, offset))
            next_rank[length] += n
            offset += length
        sequence += n
    line, at = [], 0
    for length in range(len(histogram) - 1, 0, -1):
        first, end = int(next_rank[length]), int(histogram[length])
        if first < end:
            line.append((length, first, end, at))
            at += length * (end - first)
    bounds = [at - at % window]
    while bounds[-1] < at:
        # the open window, in the powers of two that it is the sum of
        bounds.append(bounds[-1] + (1 << ((at - bounds[-1]).bit_length() - 1)))
    return Plan(fills, line, bounds, sequence)


def _sequence_at(position: Column, bounds: list[int], window: int) -> Column:
    """The number of the line's sequence that a token lies in."""
    tail = F.array(*[F.lit(b).cast("long") for b in bounds])
    after = F.size(F.filter(tail, lambda b: b <= position)).cast("long")
    return F.when(position < bounds[0], F.shiftright(position, window.bit_length() - 1)).otherwise(F.lit(bounds[0] // window) + after - 1)


def _bound(number: Column, bounds: list[int], window: int) -> Column:
    """Where the line's sequence of that number begins."""
    full = bounds[0] // window
    tail = F.array(*[F.lit(b).cast("long") for b in [*bounds, bounds[-1]]])
    return F.when(number < full, number * window).otherwise(F.element_at(tail, (F.greatest(number - full, F.lit(0)) + 1).cast("int")))


PIECE = "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint,ids_crc32:bigint>>"


def _places(measured: DataFrame, found: Plan, n_full: int, window: int) -> DataFrame:
    """One row per piece: ``measured`` with full windows first, then the fills, then the line."""
    spark = measured.sparkSession
    size = F.lit(window).cast("long")
    full = F.transform(
        "checks",
        lambda check, i: F.struct(
            (i * size).alias("start"), size.alias("length"), (F.col("full_before") + i).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"), check.alias("ids_crc32"),
        ),
    )

    rows = [(length, a, b, first + n_full, offset, None) for length, a, b, first, offset in found.fills]
    rows += [(length, a, b, None, None, start) for length, a, b, start in found.line]
    # bounded by the combinations and lengths there are
    table = spark.createDataFrame(rows, "of_length int, from_rank bigint, to_rank bigint, first_sequence bigint, at bigint, line_start bigint")
    inside = (F.col("rest") == F.col("of_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    placed = measured.join(F.broadcast(table), inside, "left")

    rest = F.col("rest").cast("long")
    rest_start = F.col("doc_tokens") - rest
    number = F.col("rank") - F.col("from_rank")
    whole = F.array(
        F.struct(
            rest_start.alias("start"), rest.alias("length"), (F.col("first_sequence") + number).alias("sequence_id"),
            F.col("at").alias("offset"), F.col("rest_check").alias("ids_crc32"),
        )
    )
    begin = F.col("line_start") + number * rest
    end = begin + rest
    base = n_full + found.n_fills

    def piece(k: Column) -> Column:
        opens = _bound(k, found.bounds, window)
        first, last = F.greatest(begin, opens), F.least(end, _bound(k + 1, found.bounds, window))
        return F.struct(
            (rest_start + first - begin).alias("start"), (last - first).alias("length"), (k + base).alias("sequence_id"),
            (first - opens).alias("offset"), F.when(last - first == rest, F.col("rest_check")).alias("ids_crc32"),
        )

    cut = F.transform(F.sequence(_sequence_at(begin, found.bounds, window), _sequence_at(end - 1, found.bounds, window)), piece)
    of_rest = F.when(F.col("line_start").isNotNull(), cut).when(F.col("at").isNotNull(), whole).otherwise(F.array().cast(PIECE))
    kept = [c for c in measured.columns if c.startswith("kept_")]
    pieces = placed.select(*kept, "text_key", "doc_tokens", F.explode(F.concat(full.cast(PIECE), of_rest.cast(PIECE))).alias("piece"))
    return pieces.select(*kept, "text_key", "doc_tokens", "piece.*")


def slice_ids(part: pa.RecordBatch, path: str, end_id: int, section: int) -> list[pa.Array]:
    """The ids of the wanted pieces (start, length) of each text, as little-endian unsigned 32-bit integers."""
    out = []
    for ids, wanted in zip(token_ids(part.column(0), path, end_id, section), part.column(1).to_pylist()):
        out.append([ids[w["start"] * 4 : (w["start"] + w["length"]) * 4] for w in wanted])
    return [pa.array(out, pa.list_(pa.binary()))]


def text_key(text: Column) -> Column:
    """What names a text; a null one is empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def piece_ids(df: DataFrame, wanted: DataFrame, path: str, end_id: int, text: str = "text") -> DataFrame:
    """The ids of pieces: distinct (text_key, start, length) of ``wanted`` with ``ids``, binary.

    Each distinct text is tokenized once, however many rows hold it.
    """
    wanted = wanted.select("text_key", "start", "length").distinct()
    lists = wanted.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("wanted"))
    lists = workspace.materialize(lists, "wanted")
    keyed = df.select(text_key(col(text)).alias("text_key"), F.coalesce(col(text), F.lit("")).alias("text"))
    keys = workspace.broadcast_within(lists.select("text_key"))
    texts = keyed.join(keys, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    rows = texts.join(lists, "text_key").select("text", "wanted", "text_key")
    options = {"path": path, "end_id": end_id, "section": SECTION}
    found = append_columns(rows, slice_ids, ["text", "wanted"], [StructField("ids", ArrayType(BinaryType()))], SLICE_BYTES, **options)
    both = found.select("text_key", F.explode(F.arrays_zip("wanted", "ids")).alias("x"))
    return both.select("text_key", F.col("x.wanted.start").alias("start"), F.col("x.wanted.length").alias("length"), F.col("x.ids").alias("ids"))


def pack(
    df: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The pieces of all rows' token sequences, packed into sequences of at most ``window`` tokens.

    ``path`` is the file of a byte-level tokenizer. A row's sequence is the ids of
    its text and ``end_id``. Columns: those of ``keep`` (all but ``text`` otherwise;
    columns named like an output are left out), ``text_key``, ``doc_tokens``, and per piece ``start`` and ``length`` in the row's
    sequence, ``sequence_id`` and ``offset`` where it lies, and ``ids_crc32``, the CRC-32
    of its ids as little-endian unsigned 32-bit integers. Every id lies in exactly one
    piece. Sequences are numbered without gaps and are full, but for at most one of
    each power of two. :func:`piece_ids` gives the ids themselves.

    A null or empty text is the end mark alone. Repeated rows are packed each. An
    empty table has no pieces. Texts may be of any length: they are cut into chunks
    before they are tokenized, and a task holds a few of them at a time; one unbroken
    run of letters is one chunk. ``window`` is a power of two.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window has to be a power of two")
    kept = [c for c in without(df, [*OUTPUTS, text]) if keep is None or c in keep]
    slim = df.select(
        col(text).alias("text"), *(col(c).alias(f"kept_{i}") for i, c in enumerate(kept)), text_key(col(text)).alias("text_key")
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields[1:])
    schema = f"{fields}, doc_tokens bigint, checks array<bigint>, rest int, rest_check bigint, rank bigint, full_before bigint"
    run = in_tasks(measure, path=path, end_id=end_id, window=window, section=SECTION)
    measured = workspace.materialize(slim.mapInArrow(run, schema).withColumn("segment", F.spark_partition_id()), "measured")

    # one row per task and length, and per task
    counts = measured.groupBy("segment", "rest").agg(F.count(F.lit(1)).alias("rows"))
    counts = workspace.materialize(counts, "rests")
    earlier = Window.partitionBy("rest").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("segment", "rest", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rank_start"))
    windows = measured.groupBy("segment").agg(F.sum(F.size("checks").cast("long")).alias("full"))
    windows = workspace.materialize(windows, "windows")
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    full_starts = windows.select("segment", F.coalesce(F.sum("full").over(before), F.lit(0)).alias("full_start"))
    numbers = workspace.summary(starts.join(full_starts, "segment"), "numbers")
    ranked = measured.join(numbers, ["segment", "rest"]).withColumns(
        {"rank": F.col("rank") + F.col("rank_start"), "full_before": F.col("full_before") + F.col("full_start")}
    )

    histogram = np.zeros(window, np.int64)
    for row in counts.groupBy("rest").agg(F.sum("rows").alias("rows")).collect():
        histogram[row["rest"]] = row["rows"]
    n_full = windows.agg(F.sum("full")).first()[0] or 0
    pieces = workspace.materialize(_places(ranked, plan(histogram, window), n_full, window), "pieces")

    # pieces that a cut made
    open_pieces = pieces.where("ids_crc32 IS NULL")
    known = piece_ids(df, open_pieces, path, end_id, text).select("text_key", "start", "length", F.crc32("ids").alias("found"))
    known = workspace.summary(known, "cut-pieces")
    mended = open_pieces.drop("ids_crc32").join(known, ["text_key", "start", "length"])
    names = [c for c in pieces.columns if c.startswith("kept_")]
    rest = OUTPUTS[:-1]
    all_pieces = pieces.where("ids_crc32 IS NOT NULL").select(*names, *rest, "ids_crc32").unionByName(
        mended.select(*names, *rest, F.col("found").alias("ids_crc32"))
    )
    return all_pieces.select(*(F.col(n).alias(c) for n, c in zip(names, kept)), *rest, "ids_crc32")
