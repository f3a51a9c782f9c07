"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside the tasks.

A text is cut by the tokenizer's pattern into pieces; each piece is encoded on
its own. For the public pattern the texts are first cut into chunks at places that
are boundaries of pieces wherever they stand, and each distinct chunk of a slice is
looked at once. The pieces of chunks that a task has not met yet become token-position rows of an
in-process DuckDB, one row per byte. A recursive query joins neighbouring tokens
with the merge table, contracts the leftmost pair of least rank in every piece,
and goes on until no piece has a pair left. Decoding joins nothing but the ids
of a document in their order: an ordered aggregation lines them up and their
bytes are looked up in the vocabulary.

The vocabulary is fixed and small (tens of thousands of tokens), so it is
broadcast. Rows never move between tasks, so neither hot keys nor copies matter,
and a lost task is run again from its input.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField

from brindle.llm.chunks import KnownIds, cuts, flat_bytes
from brindle.llm.tasks import append_columns, worker_cache

# Unicode White_Space, as the patterns of public tokenizers mean \s.
WHITE = "\t-\r \x85\xa0  -     　"

# White space, and what follows it up to the next.
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

# Text that is encoded at a time; its chunks, tokens and decoded lists are held together.
SLICE_BYTES = 3 << 19

# Tokens of whole documents that are lined up by one query.
DECODED_TOKENS = 1 << 17

# The recursion keeps the rows of all its steps, about half the square of a
# piece's length; so many at a time, and longer pieces are contracted by a heap.
STEP_ROWS = 1_000_000
LONGEST_PIECE = 256

CONTRACT = """
WITH RECURSIVE steps(step, word, pos, token, next_pos, next_token, merged) AS (
    SELECT 0::SMALLINT, word, pos, token, next_pos, next_token, merged FROM first_step
    UNION ALL
    SELECT step, word, pos, token, next_pos, next_token,
           CASE WHEN changed THEN merges.merged ELSE moved.merged END
    FROM (
        -- the right half of the chosen pair becomes the merged token, the left half goes
        SELECT (s.step + 1)::SMALLINT AS step, s.word, s.pos, s.merged,
               CASE WHEN s.pos = b.right_pos THEN b.token ELSE s.token END AS token,
               CASE WHEN s.next_pos = b.left_pos THEN b.right_pos ELSE s.next_pos END AS next_pos,
               CASE WHEN s.next_pos = b.left_pos THEN b.token ELSE s.next_token END AS next_token,
               s.pos = b.right_pos OR s.next_pos IS NOT DISTINCT FROM b.left_pos AS changed,
               CASE WHEN s.pos = b.right_pos THEN (b.token::BIGINT << 32) | s.next_token
                    WHEN s.next_pos = b.left_pos THEN (s.token::BIGINT << 32) | b.token END AS pair
        FROM steps s JOIN (
            SELECT word, min((merged::BIGINT << 32) | pos) AS least,
                   (least & 4294967295)::INT AS left_pos, (least >> 32)::INT AS token,
                   arg_min(next_pos, (merged::BIGINT << 32) | pos) AS right_pos
            FROM steps WHERE merged IS NOT NULL GROUP BY word
        ) b ON s.word = b.word AND s.pos <> b.left_pos
    ) moved LEFT JOIN merges ON merges.pair = moved.pair
)
SELECT steps.word, pos, token
FROM steps JOIN (SELECT word, max(step) AS step FROM steps GROUP BY word) last ON last.word = steps.word AND last.step = steps.step
"""

FIRST_STEP = """
CREATE OR REPLACE TEMP TABLE first_step AS
SELECT word, pos, token, next_pos, next_token, merges.merged
FROM (
    SELECT *, lead(pos) OVER byte AS next_pos, lead(token) OVER byte AS next_token
    FROM bytes WINDOW byte AS (PARTITION BY word ORDER BY pos)
) LEFT JOIN merges ON merges.pair = (token::BIGINT << 32) | next_token
"""

IN_ORDER = "SELECT doc, list(token ORDER BY pos) AS ids FROM tokens GROUP BY doc"


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """A vocabulary with its merge table in an in-process DuckDB."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        by_rank = {rank: token for token, rank in ranks.items()}
        self.vocabulary = pa.array([by_rank.get(rank) for rank in range(max(by_rank) + 1)], pa.binary())
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        # only what is known of the pattern allows chunks that are cut before it is applied
        self.cut = pattern == public_tokenizers.PATTERN
        self.known = KnownIds(self._ids)
        pairs, merged = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET temp_directory = ''")
        merges = pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())})
        self.db.register("given", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        flat, offsets = flat_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        starts = cuts(flat, offsets) if self.cut else np.unique(offsets[:-1][np.diff(offsets) > 0])
        return self.known.encode(flat, offsets, starts)

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks: they are cut into pieces, and each piece is encoded on its own."""
        split = []
        for raw in chunks:
            chunk = raw.decode()
            is_piece = self.cut and (chunk[1:] if chunk[0] == " " else chunk).isalpha()
            split.append((chunk,) if is_piece else self.pattern.findall(chunk))
        ids = self._learn({piece for pieces in split for piece in pieces})
        return [ids[p[0]] if len(p) == 1 else b"".join([ids[x] for x in p]) for p in split]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        short, found = [], {}
        for piece in pieces:
            raw = piece.encode()
            if (rank := self.ranks.get(raw)) is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(raw) > LONGEST_PIECE:
                found[piece] = contract_long(raw, self.ranks)
            else:
                short.append((piece, raw))
        rows, start = 0, 0
        for i, (_, raw) in enumerate(short):
            rows += len(raw) * (len(raw) + 1) // 2
            if rows > STEP_ROWS or i + 1 == len(short):
                part = short[start : i + 1]
                found.update(zip([p for p, _ in part], self._contract([r for _, r in part])))
                rows, start = 0, i + 1
        return found

    def _contract(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        table = pa.table(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": (np.arange(len(flat)) - first).astype(np.int32),
                "token": self.byte_ids[flat],
            }
        )
        self.db.register("bytes", table)
        self.db.execute(FIRST_STEP)
        found = self.db.sql(CONTRACT).to_arrow_table()
        self.db.unregister("bytes")
        word, pos = found["word"].to_numpy(), found["pos"].to_numpy()
        order = np.lexsort((pos, word))
        ids = found["token"].to_numpy()[order].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def decode(self, ids: list[bytes | None]) -> list[bytes | None]:
        """The bytes that each sequence of ids stands for; null where an id is unknown.

        Sequences are decoded some tokens at a time, a long one in several parts.
        """
        step = DECODED_TOKENS * 4
        parts = [(i, x[a : a + step]) for i, x in enumerate(ids) for a in range(0, len(x or b""), step)]
        out: list[list[bytes | None]] = [[] for _ in ids]
        start = held = 0
        for k, (_, part) in enumerate(parts):
            held += len(part)
            if held >= step or k + 1 == len(parts):
                group = parts[start : k + 1]
                for (i, _), raw in zip(group, self._decode([x for _, x in group])):
                    out[i].append(raw)
                start, held = k + 1, 0
        return [None if x is None or None in found else b"".join(found) for x, found in zip(ids, out)]

    def _decode(self, ids: list[bytes | None]) -> list[bytes | None]:
        counts = [len(x or b"") // 4 for x in ids]
        flat = np.frombuffer(b"".join(x or b"" for x in ids), "<u4")
        tokens = pa.table(
            {
                "doc": np.repeat(np.arange(len(ids), dtype=np.int32), counts),
                "pos": np.arange(len(flat), dtype=np.int32),
                "token": flat,
            }
        )
        self.db.register("tokens", tokens)
        lined = self.db.sql(IN_ORDER).to_arrow_table()
        self.db.unregister("tokens")
        out = [None if x is None else b"" for x in ids]
        for batch in lined.to_batches():
            docs, lists = batch.columns
            values = lists.flatten()
            known = pc.less(values, len(self.vocabulary))
            # the bytes of all tokens one after the other, those of a document in one stretch
            parts = self.vocabulary.take(pc.if_else(known, values, None))
            starts = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
            missing = np.flatnonzero(pc.is_null(parts).to_numpy(zero_copy_only=False))
            unknown = np.searchsorted(missing, starts)
            _, offsets, data = parts.buffers()
            at = np.frombuffer(offsets, np.int32)[starts + parts.offset].tolist()
            raw = memoryview(data or b"")
            for i, doc in enumerate(docs.to_pylist()):
                out[doc] = bytes(raw[at[i] : at[i + 1]]) if unknown[i] == unknown[i + 1] else None
        return out


def contract_long(raw: bytes, ranks: dict[bytes, int]) -> bytes:
    """The same contraction of one long piece, with a heap of its pairs."""
    after = list(range(1, len(raw) + 1))
    before = list(range(-1, len(raw) - 1))
    part: list[bytes | None] = [raw[i : i + 1] for i in range(len(raw))]
    heap = [(rank, i, i + 1) for i in range(len(raw) - 1) if (rank := ranks.get(raw[i : i + 2])) is not None]
    size = [1] * len(raw)
    heap = [(rank, i, 2) for rank, i, _ in heap]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if j < len(raw) and (rank := ranks.get(part[i] + part[j])) is not None:
            heapq.heappush(heap, (rank, i, size[i] + size[j]))

    while heap:
        _, i, width = heapq.heappop(heap)
        j = after[i] if part[i] is not None else len(raw)
        if j >= len(raw) or size[i] + size[j] != width:
            continue
        part[i], part[j], size[i], after[i] = part[i] + part[j], None, width, after[j]
        if after[i] < len(raw):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return b"".join(ranks[p].to_bytes(4, "little") for p in part if p is not None)


_encoders: dict[tuple, Encoder] = worker_cache(__name__)


def encoder(ranks, pattern: str) -> Encoder:
    """This worker's encoder of a broadcast vocabulary."""
    key = (ranks.id if hasattr(ranks, "id") else id(ranks), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks.value if hasattr(ranks, "value") else ranks, pattern)
    return _encoders[key]


def encode_slice(part: pa.RecordBatch, ranks, pattern: str) -> list[pa.Array]:
    ids = encoder(ranks, pattern).encode(part.column(0))
    offsets = np.cumsum([0, *(len(x) // 4 for x in ids)])
    values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))]


def decode_slice(part: pa.RecordBatch, ranks, pattern: str) -> list[pa.Array]:
    ids = [
        None if x is None else np.array([-1 if i is None else i for i in x], "<i8").astype("<u4").tobytes()
        for x in part.column(0).to_pylist()
    ]
    return [pa.array(encoder(ranks, pattern).decode(ids), pa.binary())]


def digest_slice(part: pa.RecordBatch, ranks, pattern: str) -> list[pa.Array]:
    coder = encoder(ranks, pattern)
    ids = coder.encode(part.column(0))
    decoded = coder.decode(ids)
    return [
        pa.array([len(x) // 4 for x in ids], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
        pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
    ]


def share_ranks(spark: SparkSession, path: str):
    """The vocabulary of ``path``, broadcast: a fixed file, whatever the data."""
    return spark.sparkContext.broadcast(read_ranks(path))


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` as an array of ints in the column ``ids``.

    A null or empty text has no ids, and an empty table no rows. Rows keep their place
    and number, repeated rows included; a column named like the output is replaced. Long
    texts are cut and coded a section at a time; one unbroken run of letters is one piece.
    """
    ranks = share_ranks(df.sparkSession, ranks_path)
    field = StructField(ids, ArrayType(IntegerType()))
    return append_columns(df, encode_slice, [text], [field], slice_bytes=SLICE_BYTES, ranks=ranks, pattern=pattern)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for in the column ``decoded``.

    Null for null ids and where an id is null or not in the vocabulary.
    """
    ranks = share_ranks(df.sparkSession, ranks_path)
    field = StructField(decoded, BinaryType())
    return append_columns(df, decode_slice, [ids], [field], slice_bytes=SLICE_BYTES, ranks=ranks, pattern=pattern)


def roundtrip_digests(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: encoded, decoded and digested at once.

    ``keep`` names the columns of ``df`` that stay, all otherwise; a text that does not
    stay is not sent back. The ids are digested as little-endian unsigned 32-bit integers, the decoded
    bytes as they are. A null text counts as an empty one; rows and long texts as in
    :func:`encode`.
    """
    ranks = share_ranks(df.sparkSession, ranks_path)
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    return append_columns(df, digest_slice, [text], fields, slice_bytes=SLICE_BYTES, keep=keep, ranks=ranks, pattern=pattern)
