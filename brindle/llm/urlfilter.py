"""URL filters: all wildcard rules at once, as one bit-parallel automaton.

The rules are packed one after another into the bits of as many 64-bit words as
they need (Shift-And). Reading a byte shifts every state by one place where that
byte is expected there, and holds the states in front of a wildcard. All URLs
of a batch take a step together with numpy. The masks are small and go with the
task; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from brindle.llm.tasks import append_columns, col

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A glob over a canonical URL (a dot, the host, the path) and what it decides.

    In a glob ``*`` stands for any run without a slash and ``**`` for any run.
    ``name`` is reported for site rules and null for general globs.
    """

    glob: str
    verdict: str
    name: str | None = None

    @staticmethod
    def site(host: str, path: str, verdict: str) -> Rule:
        """Fits ``host`` and its subdomains where the path starts with ``path``."""
        return Rule(f"*.{host}{path}**", verdict, host + path)


# Files without text, by the end of the path.
GENERAL = tuple(Rule(f"**.{end}", BLOCK) for end in "jpg jpeg png gif webp mp3 mp4 avi zip gz exe dmg iso".split())


@dataclass
class Automaton:
    """Masks of all rules: per byte the states it leads to and the states it holds."""

    rules: list[Rule]
    step: np.ndarray = field(init=False)
    hold: np.ndarray = field(init=False)
    begin: np.ndarray = field(init=False)
    accept: list[int] = field(init=False)

    def __post_init__(self):
        parsed = []
        for rule in self.rules:
            states, stars = [None], [0]
            raw, i = rule.glob.encode(), 0
            while i < len(raw):
                if raw[i] == 42:
                    deep = raw[i : i + 2] == b"**"
                    stars[-1] = max(stars[-1], 2 if deep else 1)
                    i += 2 if deep else 1
                else:
                    states.append(raw[i])
                    stars.append(0)
                    i += 1
            parsed.append((states, stars))
        words = max(1, -(-sum(len(s) for s, _ in parsed) // 64))
        self.step, self.hold = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
        self.begin, self.accept, bit = np.zeros(words, np.uint64), [], 0
        for states, stars in parsed:
            for k, (byte, star) in enumerate(zip(states, stars)):
                word, mask = bit // 64, np.uint64(1 << bit % 64)
                if k == 0:
                    self.begin[word] |= mask
                else:
                    self.step[byte, word] |= mask
                if star:
                    self.hold[:, word] |= mask
                if star == 1:
                    self.hold[47, word] &= ~mask
                bit += 1
            self.accept.append(bit - 1)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """For each URL and rule, whether the rule's glob fits the whole URL."""
        lengths = np.array([len(u) for u in urls])
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        flat, lengths = np.frombuffer(b"".join(urls), np.uint8), lengths[order]
        state = np.tile(self.begin, (len(urls), 1))
        ends = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), side="right")
        one, top = np.uint64(1), np.uint64(63)
        for at, live in enumerate(ends.tolist()):
            byte, old = flat[starts[:live] + at], state[:live]
            moved = old << one
            moved[:, 1:] |= old[:, :-1] >> top
            state[:live] = (moved & self.step[byte]) | (old & self.hold[byte])
        found = np.empty((len(urls), len(self.rules)), bool)
        for r, bit in enumerate(self.accept):
            found[order, r] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one != 0
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL as it stands; both empty for null and where no ``://`` is."""
    rest = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(rest, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, pattern, 2)


def judge_slice(part: pa.RecordBatch, rules: list[tuple]) -> list[pa.Array]:
    rules = [Rule(*r) for r in rules]
    hosts, paths = part.column(0).to_pylist(), part.column(1).to_pylist()
    fits = Automaton(rules).matches([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
    # the longest site rule decides, then the first general one, then allow
    rank = sorted(range(len(rules)), key=lambda r: (rules[r].name is None, -len(rules[r].name or ""), r))
    fits = fits[:, rank]
    first = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
    won = [rules[rank[k]] if k >= 0 else None for k in first.tolist()]
    return [
        pa.array([r.name if r else None for r in won], pa.string()),
        pa.array([r.verdict if r else ALLOW for r in won], pa.string()),
    ]


def judge(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting site rule decides (of equally long ones the first given);
    ``rule`` is its name. Where none fits ``rule`` is null and the first fitting
    general glob decides; where none of these fits either the URL is allowed.
    A null or empty URL has an empty host and path. Columns named like the
    outputs are replaced, the URL itself excepted.
    """
    host, path = host_and_path(col(url))
    clash = {"host", "path"} - {url.lower()}
    kept = df.select(*(col(c) for c in df.columns if c.lower() not in clash), host.alias("host"), path.alias("path"))
    fields = [StructField("rule", StringType()), StructField("verdict", StringType())]
    return append_columns(kept, judge_slice, ["host", "path"], fields, rules=[(r.glob, r.verdict, r.name) for r in rules])
