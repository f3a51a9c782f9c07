"""Token counts that follow edits: a segment tree of pre-tokens per document.

The leaves of a tree are blocks of consecutive pre-tokens, its nodes hold the
code points and tokens below them. An edit changes pre-tokens only between two
boundaries that it cannot move: places where white space follows something
else, or letters, numbers and marks meet, with a character on either side that stays. That stretch is cut and
counted anew, its blocks are replaced and the sums above them updated; nothing else
of the document is encoded. The trees are kept with their sums as a binary
column beside the text. Rows are independent, so nothing is shuffled.
"""

from __future__ import annotations

from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from brindle.llm.bpe import SLICE_BYTES, WHITE, read_ranks
from brindle.llm.chunks import Known, coded, cuts, flat_bytes, spread
from brindle.llm.tasks import append_columns

# Pre-tokens of a new block; a block that grows past GROWN times this starts a new tree.
LEAF = 32
GROWN = 16

# Code points up to which a text is not worth arrays.
SHORT_TEXT = 500

_NUMBER = regex.compile(r"\p{N}")
_SPACE = frozenset(c for c in map(chr, range(0x3001)) if regex.match(f"[{WHITE}]", c))


class Counter:
    """Code points and tokens of the pre-tokens of texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.cut = pattern == public_tokenizers.PATTERN
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = Known()

    def _counts(self, chunks: list[bytes]) -> list[bytes]:
        """The lengths and tokens of distinct chunks' pre-tokens, in turns, as 32-bit integers."""
        known, count = self.known, self.encoding.encode_ordinary
        fresh = [c for c in chunks if c not in known]
        for raw in fresh:
            chunk = raw.decode()
            if self.cut and (chunk[1:] if chunk[0] == " " else chunk).isalpha():
                pieces = (chunk,)
            else:
                pieces = self.pattern.findall(chunk)
            known[raw] = array("i", [x for p in pieces for x in (len(p), len(count(p)))]).tobytes()
        out = [known[c] for c in chunks]
        known.bound(fresh)
        return out

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """Per text two rows, the code points and the tokens of its pre-tokens; a null text has none."""
        flat, offsets = flat_bytes(texts)
        starts = cuts(flat, offsets) if self.cut else np.unique(offsets[:-1][np.diff(offsets) > 0])
        pieces, counts = [np.zeros((0, 2), np.int32)], [np.zeros(1, np.int64)]
        for values, codes in coded(flat, starts):
            found = self._counts(values)
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 8
            rows, n = spread(np.frombuffer(b"".join(found), np.int32).reshape(-1, 2), sizes, codes)
            pieces.append(rows)
            counts.append(n)
        flat_pieces = np.concatenate(pieces)
        bounds = np.cumsum(np.concatenate(counts))[np.searchsorted(starts, offsets)].tolist()
        return [flat_pieces[a:b].T for a, b in zip(bounds, bounds[1:])]

    def __call__(self, text: str) -> np.ndarray:
        """The same for one text; an edit's is short, and its pieces are counted as they come."""
        if len(text) > SHORT_TEXT:
            return self.many(pa.array([text], pa.string()))[0]
        pieces, count = self.pattern.findall(text), self.encoding.encode_ordinary
        return np.array([[len(p) for p in pieces], [len(count(p)) for p in pieces]], np.int32).reshape(2, -1)


class Tree:
    """Blocks of pre-tokens under a complete binary tree of (code points, tokens)."""

    def __init__(self, lengths, tokens, blocks=None, sums=None):
        pieces = np.array([lengths, tokens], np.int32).reshape(2, -1)
        if blocks is None:
            blocks = [LEAF] * (pieces.shape[1] // LEAF) + [pieces.shape[1] % LEAF]
        ends = np.cumsum(blocks)
        self.blocks = [pieces[:, e - n : e] for e, n in zip(ends.tolist(), blocks)]
        self.width = 1 << max(0, len(blocks) - 1).bit_length()
        if sums is not None:
            self.sums = sums
            return
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        whole = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(pieces, axis=1, dtype=np.int64)], axis=1)
        self.sums[self.width : self.width + len(blocks)] = (whole[:, ends] - whole[:, ends - np.array(blocks)]).T
        level = self.width
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level = half

    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """The block that holds code point ``at`` (the last one for the end), and where it begins."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.sums[node, 0] and self.sums[node + 1, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.width, start

    def replace(self, first: int, end: int, lengths: list[int], tokens: list[int]) -> bool:
        """Put other pre-tokens in place of those from ``first`` to ``end``, both boundaries; whether the tree stays balanced."""
        low, low_start = self.find(first)
        high, high_start = self.find(max(first, end - 1))
        before = int(np.searchsorted(np.cumsum(self.blocks[low][0]), first - low_start, side="right")) if first > low_start else 0
        past = int(np.searchsorted(np.cumsum(self.blocks[high][0]), end - high_start, side="left")) + 1 if end > high_start else 0
        middle = np.array([lengths, tokens], np.int32).reshape(2, -1)
        merged = np.concatenate([self.blocks[low][:, :before], middle, self.blocks[high][:, past:]], axis=1)
        for block in range(low, high + 1):
            self._put(block, merged if block == low else merged[:, :0])
        return merged.shape[1] <= LEAF * GROWN

    def _put(self, block: int, pieces: np.ndarray) -> None:
        self.blocks[block] = pieces
        node = self.width + block
        change = pieces.sum(axis=1, dtype=np.int64) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def pack(self) -> bytes:
        """The blocks as bytes: their number, their sizes, all lengths and all tokens; then the sums of all nodes."""
        sizes = [b.shape[1] for b in self.blocks]
        numbers = np.concatenate([[len(sizes)], sizes, np.concatenate(self.blocks, axis=1).ravel()])
        return numbers.astype("<i4").tobytes() + self.sums.astype("<i8").tobytes()

    @staticmethod
    def unpack(packed: bytes) -> Tree:
        """The tree as it was packed; its sums are read, not added up again."""
        n = int.from_bytes(packed[:4], "little")
        sizes = np.frombuffer(packed, "<i4", n, 4)
        pieces = np.frombuffer(packed, "<i4", 2 * int(sizes.sum()), 4 + 4 * n).reshape(2, -1)
        sums = np.frombuffer(packed, "<i8", -1, 4 + 4 * n + 4 * pieces.size).reshape(-1, 2).copy()
        return Tree(pieces[0], pieces[1], sizes.tolist(), sums)


def _kind(c: str) -> int:
    """White space, a letter, a number, or anything else, as the public pattern tells them apart."""
    return 0 if c in _SPACE else 1 if c.isalpha() else 2 if _NUMBER.match(c) else 3


def _boundary(text: str, at: int, marks: bool) -> bool:
    """Whether pre-tokens part here, whatever stands around the two characters at this place.

    White space after something else; with ``marks`` also other kinds side by side, where
    the first is neither white space, which may belong to what follows, nor an apostrophe.
    """
    if at == 0 or at == len(text):
        return True
    before, after = _kind(text[at - 1]), _kind(text[at])
    if after == 0 or not marks:
        return after == 0 and before != 0
    return 0 != before != after and text[at - 1] != "'"


def edit(text: str, tree: Tree, start: int, end: int, new: str, count: Counter) -> tuple[str, Tree, int]:
    """The text and tree after code points ``start`` to ``end`` gave way to ``new``, and how many were encoded anew.

    Places beyond the text count as its end.
    """
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    first = max(0, start - 1)
    while not _boundary(text, first, count.cut):
        first -= 1
    last = min(len(text), end + 1)
    while not _boundary(text, last, count.cut):
        last += 1
    fresh = text[first:start] + new + text[end:last]
    balanced = tree.replace(first, last, *count(fresh))
    text = text[:start] + new + text[end:]
    if not balanced:
        pieces = np.concatenate(tree.blocks, axis=1)
        tree = Tree(pieces[0], pieces[1])
    return text, tree, len(fresh)


_counters: dict[tuple, Counter] = {}


def _counter(ranks, pattern: str) -> Counter:
    key = (ranks.id if hasattr(ranks, "id") else id(ranks), pattern)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(ranks.value if hasattr(ranks, "value") else ranks, pattern)
    return _counters[key]


def tree_slice(part: pa.RecordBatch, ranks, pattern: str) -> list[pa.Array]:
    trees = [Tree(*pieces) for pieces in _counter(ranks, pattern).many(part.column(0))]
    return [pa.array([t.tokens() for t in trees], pa.int64()), pa.array([t.pack() for t in trees], pa.binary())]


def edit_slice(part: pa.RecordBatch, ranks, pattern: str, before: bool) -> list[pa.Array]:
    count = _counter(ranks, pattern)
    texts, trees, edits = (c.to_pylist() for c in part.columns)
    # texts without a tree are counted together
    built = iter(count.many(pc.filter(part.column(0), pc.is_null(part.column(1)))))
    out: list[tuple] = []
    for text, packed, changes in zip(texts, trees, edits):
        text, encoded = text or "", 0
        tree = Tree(*next(built)) if packed is None else Tree.unpack(packed)
        tokens = tree.tokens()
        for e in changes or ():
            if e is not None:
                text, tree, n = edit(text, tree, e["start"] or 0, e["end"] or 0, e["text"] or "", count)
                encoded += n
        out.append((text, tree.tokens(), encoded, tree.pack(), tokens))
    columns = list(zip(*out)) if out else [()] * 5
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return [pa.array(c, t) for c, t in list(zip(columns, types))[: 5 if before else 4]]


def _share(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(read_ranks(path))


def build(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and ``token_tree`` of ``text``; a null text counts as an empty one.

    Columns named like the outputs are replaced; repeated rows are counted each.
    """
    fields = [StructField("n_tokens", LongType()), StructField("token_tree", BinaryType())]
    return append_columns(df, tree_slice, [text], fields, slice_bytes=SLICE_BYTES, ranks=_share(df.sparkSession, ranks_path), pattern=pattern)


def apply_edits(
    df: DataFrame, ranks_path: str, pattern: str, edits: str = "edits", text: str = "text", before: str | None = None
) -> DataFrame:
    """``df`` after the edits of each row, in their order.

    ``edits`` is an array of (start, end, text): code points ``start`` to ``end`` of
    the text as the edits before left it give way to ``text``. ``text``,
    ``n_tokens`` and ``token_tree`` are updated, ``encoded_chars`` tells how
    many code points were encoded anew, and ``before`` names a column for the tokens
    before the edits. Null edits change nothing; a null tree, or one that is not there,
    is built first, in the same pass; places beyond the text count as its end. Repeated
    rows are edited each, an empty table stays empty, and long texts are counted a section
    at a time.
    """
    fields = [
        StructField(text, StringType()),
        StructField("n_tokens", LongType()),
        StructField("encoded_chars", LongType()),
        StructField("token_tree", BinaryType()),
        *([StructField(before, LongType())] if before else []),
    ]
    if "token_tree" not in df.columns:
        df = df.withColumn("token_tree", F.lit(None).cast("binary"))
    inputs = [text, "token_tree", edits]
    options = {"ranks": _share(df.sparkSession, ranks_path), "pattern": pattern, "before": bool(before)}
    return append_columns(df, edit_slice, inputs, fields, slice_bytes=SLICE_BYTES, **options)
