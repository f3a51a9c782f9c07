"""Texts cut into chunks that tokenize alone, as arrays: each distinct chunk is looked at once.

The cuts suit patterns whose pieces hold white space in front only and keep runs of
letters apart from marks, as those of the public byte-level tokenizers do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of texts that are cut and coded at a time.
SECTION = 2 << 20

# By byte: white space, letters, and marks that end a run of letters (not the apostrophe).
ASCII_WHITE, LETTER, MARK = (np.isin(np.arange(256), list(x)) for x in (b"\t\n\x0b\x0c\r ", bytes(range(65, 91)) + bytes(range(97, 123)), b".,;:!?"))

# What a worker remembers of chunks, in bytes with their overhead, and the bytes of a short chunk.
CACHE_BYTES, ENTRY_BYTES, SHORT = 128 << 20, 200, 7

# The same where it is held in arrays, the bytes of texts that are looked up at a time, and the hashes sorted apart.
ARRAY_BYTES, LOOKED_UP, RECENT = 32 << 20, 1 << 19, 1 << 16

# A chunk's hash is the sum of its bytes' numbers times the powers of STEP, modulo 2^64.
BYTE_NUMBERS = np.random.default_rng(1).integers(0, 1 << 64, 256, np.uint64)
STEP = 0x9E3779B97F4A7C15
STEP_BACK = pow(STEP, -1, 1 << 64)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; null texts are empty."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def _ends_white(b: np.ndarray) -> np.ndarray:
    """Where UTF-8 white space ends."""
    two, three = np.roll(b, 1), np.roll(b, 2)
    out = ASCII_WHITE[b]
    out |= (two == 0xC2) & ((b == 0xA0) | (b == 0x85))
    general = (three == 0xE2) & (two == 0x80) & ((b <= 0x8A) | (b == 0xA8) | (b == 0xA9) | (b == 0xAF)) & (b >= 0x80)
    other = ((three == 0xE1) & (two == 0x9A) | (three == 0xE3) & (two == 0x80)) & (b == 0x80)
    return out | general | other | (three == 0xE2) & (two == 0x81) & (b == 0x9F)


def cuts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: each text, white space after something else, and a mark after a letter.

    These are boundaries of the tokenizer's pieces wherever they stand, as a run of
    letters ends at a mark (other than an apostrophe) and pieces hold white space in front only.
    """
    begins = np.zeros(len(flat), bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    for start in range(0, len(flat), SECTION):
        back = min(start, 4)
        b = flat[start - back : start + SECTION]
        white = _ends_white(b)
        cut = ASCII_WHITE[b[1:]] & ~white[:-1] | LETTER[b[:-1]] & MARK[b[1:]]
        # a cut is made by the byte after it and those before
        skip = max(back - 1, 0)
        begins[start - back + 1 + skip : start + SECTION] |= cut[skip:]
    return np.flatnonzero(begins)


def coded(flat: np.ndarray, starts: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Distinct chunks, and the number of each chunk's among them, a section of the texts at a time."""
    first = 0
    while first < len(starts):
        end = max(first + 1, int(np.searchsorted(starts, starts[first] + SECTION)))
        stop = starts[end] if end < len(starts) else len(flat)
        part = np.ascontiguousarray(flat[starts[first] : stop])
        bounds = np.append(starts[first:end] - starts[first], len(part)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), end - first, [None, pa.py_buffer(bounds), pa.py_buffer(part)])
        found = chunks.dictionary_encode()
        yield found.dictionary.to_pylist(), found.indices.to_numpy()
        first = end


def spread(pool: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each code's stretch of ``pool``, one after the other, and how many each has."""
    counts = sizes[codes]
    first = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(counts) - counts)
    return pool[np.arange(counts.sum()) + np.repeat(first, counts)], counts


class Known(dict):
    """What is known of chunks, bounded in bytes: when it is full the short ones stay, which are the frequent ones."""

    def __init__(self, limit: int = CACHE_BYTES):
        super().__init__()
        self.limit, self.held = limit, 0

    def bound(self, fresh: list, per_byte: int = 5) -> None:
        """Take note of new entries, whose values hold up to ``per_byte`` bytes for each of a chunk's with it."""
        self.held += ENTRY_BYTES * len(fresh) + per_byte * sum(map(len, fresh))
        if self.held > self.limit:
            for chunk in [c for c in self if len(c) > SHORT]:
                del self[chunk]
            self.held = (ENTRY_BYTES + per_byte * SHORT) * len(self)
            if self.held > self.limit // 2:
                self.clear()
                self.held = 0


def hashes(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes between two bounds."""
    powers = np.cumprod(np.full(len(flat), STEP, np.uint64))
    through = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(np.multiply(BYTE_NUMBERS[flat], powers, out=powers), out=through[1:])
    back = np.cumprod(np.full(len(flat), STEP_BACK, np.uint64))
    return (through[bounds[1:]] - through[bounds[:-1]]) * back[bounds[:-1]]


class Pool:
    """Stretches of values one after the other, with room for more at the end."""

    def __init__(self, dtype):
        self.values, self.starts, self.n = np.zeros(0, dtype), np.zeros(1, np.int64), 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        end, n = int(self.starts[self.n]) + len(values), self.n + len(sizes)
        if end > len(self.values):
            self.values = np.concatenate([self.values, np.empty(max(end - len(self.values), len(self.values)), self.values.dtype)])
        if n >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty(max(n + 1 - len(self.starts), len(self.starts)), np.int64)])
        self.values[end - len(values) : end] = values
        self.starts[self.n + 1 : n + 1] = self.starts[self.n] + np.cumsum(sizes)
        self.n = n

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts[: self.n + 1])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of stretches, one after the other, and how many each has."""
        first = self.starts[at]
        counts = self.starts[at + 1] - first
        ends = np.cumsum(counts)
        place = np.repeat(first - ends + counts, counts)
        place += np.arange(len(place))
        return self.values[place], counts

    def held(self) -> int:
        return int(self.starts[self.n]) * self.values.itemsize + 8 * self.n


class KnownIds:
    """The ids of texts from those of their chunks; what is known of chunks is held in arrays.

    ``learn`` gives the ids of distinct chunks, as little-endian unsigned 32-bit
    integers. A chunk that was met is found by its hash and then compared byte by
    byte, so that two chunks of one hash stay apart. What is held is bounded: when it
    is full the short chunks stay, which are the frequent ones.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], limit: int = ARRAY_BYTES):
        self.learn, self.limit = learn, limit
        self.forget()

    def forget(self) -> None:
        self.raw, self.ids = Pool(np.uint8), Pool("<u4")
        # hashes in order and where their chunks lie in the pools: most of them, and the recent ones
        self.index = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]

    @property
    def held(self) -> int:
        return self.raw.held() + self.ids.held() + sum(12 * len(known) for known, _ in self.index)

    def encode(self, flat: np.ndarray, offsets: np.ndarray, starts: np.ndarray, section: int = LOOKED_UP) -> list[bytes]:
        """The ids of each text (from one of ``offsets`` to the next), whose chunks begin at ``starts``."""
        tokens, counts = [], [np.zeros(1, np.int64)]
        edges, first = np.append(starts, len(flat)), 0
        while first < len(starts):
            end = max(first + 1, int(np.searchsorted(edges, edges[first] + section, "right")) - 1)
            part = flat[edges[first] : edges[end]]
            if len(part) > section:
                # one chunk that is longer is neither hashed nor kept
                found = np.frombuffer(self.learn([part.tobytes()])[0], "<u4")
                n = np.array([len(found)])
            else:
                found, n = self.ids.take(self._places(part, edges[first : end + 1] - edges[first]))
                self._bound()
            tokens.append(found)
            counts.append(n)
            first = end
        raw = np.concatenate(tokens).tobytes() if tokens else b""
        through = np.cumsum(np.concatenate(counts))
        bounds = (through[np.searchsorted(starts, offsets)] * 4).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _places(self, part: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where each chunk lies in the pools; those not met before are learned."""
        every = hashes(part, bounds)
        order = np.argsort(every)
        ascending = every[order]
        is_first = np.append(True, ascending[1:] != ascending[:-1])
        distinct = ascending[is_first]
        at = np.full(len(distinct), -1, np.int32)
        for known, places in self.index:
            if len(known):
                near = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
                hit = known[near] == distinct
                at[hit] = places[near[hit]]
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            one = order[is_first][fresh]
            raw = part.tobytes()
            at[fresh] = self._add([raw[a:b] for a, b in zip(bounds[one].tolist(), bounds[one + 1].tolist())])
            self._note(distinct[fresh], at[fresh])
        out = np.empty(len(every), np.int32)
        out[order] = at[np.cumsum(is_first) - 1]
        met, sizes = self.raw.take(out)
        if not (np.array_equal(sizes, np.diff(bounds)) and np.array_equal(met, part)):
            self._part(out, part.tobytes(), bounds.tolist(), met.tobytes(), np.cumsum(sizes).tolist())
        return out

    def _part(self, out: np.ndarray, raw: bytes, bounds: list[int], met: bytes, ends: list[int]) -> None:
        """Chunks whose hash is that of another one get places of their own."""
        chunks = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        other = [i for i, (a, b) in enumerate(zip([0, *ends], ends)) if met[a:b] != chunks[i]]
        apart = list(dict.fromkeys(chunks[i] for i in other))
        places = dict(zip(apart, self._add(apart).tolist()))
        out[other] = [places[chunks[i]] for i in other]

    def _add(self, chunks: list[bytes]) -> np.ndarray:
        first = self.raw.n
        for pool, values, width in ((self.raw, chunks, 1), (self.ids, self.learn(chunks), 4)):
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // width
            pool.add(np.frombuffer(b"".join(values), pool.values.dtype), sizes)
        return np.arange(first, self.raw.n, dtype=np.int32)

    def _note(self, fresh: np.ndarray, places: np.ndarray) -> None:
        """Put ascending hashes among the recent ones, and these among the others when they are many."""
        for level in (1, 0):
            known, old = self.index[level]
            at = np.searchsorted(known, fresh)
            self.index[level] = np.insert(known, at, fresh), np.insert(old, at, places)
            if level == 0 or len(self.index[1][0]) <= RECENT:
                return
            fresh, places = self.index[1]
            self.index[1] = fresh[:0], places[:0]

    def _bound(self) -> None:
        if self.held <= self.limit:
            return
        short = self.raw.sizes() <= SHORT
        kept, number = np.flatnonzero(short), np.cumsum(short, dtype=np.int32) - 1
        for name in ("raw", "ids"):
            pool = Pool(getattr(self, name).values.dtype)
            pool.add(*getattr(self, name).take(kept))
            setattr(self, name, pool)
        self.index = [(known[short[places]], number[places[short[places]]]) for known, places in self.index]
        if self.held > self.limit // 2:
            self.forget()
