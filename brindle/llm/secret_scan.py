"""Secret scan: known shapes, and high entropy in a sliding window over candidate strings.

Everything is column functions over one row, so a scan moves nothing; a text is
matched once per shape, in time that grows with its length. Candidate strings are long runs of token characters with a letter
and a digit. A fold over a candidate's characters holds the count of each
character in the window and the sum of c log2 c over them; the character that
enters and the one that leaves change two counts. The entropy of every window
follows from that sum. Each stretch that windows above the threshold of their
character class cover is a span, unless the candidate is of an allowed shape; windows
that touch a placeholder do not count. A candidate
is hexadecimal as a whole; in others a window of digits and letters of one case
has a lower threshold than one of both cases or with signs.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.tasks import col, without

# Kinds in the order that breaks ties of the start.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed", "entropy_single")

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 18
# Maximal runs; those too short to count are not matched at all.
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"

# Runs of token characters, 20 at least, with a letter and a digit.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{20})(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]+"
)
WINDOW = 20
HEX_CLASS = r"^[0-9a-fA-F]+$"
# Digits and letters of one case, as base32 and base36, which may be padded.
SINGLE_CLASS = r"^(?:[a-z0-9]+|[A-Z0-9]+)=*$"
# Bits per character that a window must exceed. Random windows of 20 have 3.36 bits
# on average over 16 symbols, 3.79 over 32, 3.85 over 36 and 4.03 over 62. The
# thresholds are lower quantiles: 3.0 % of such windows over 16 symbols have no
# more, 1.9 % over 32, 0.9 % over 36 and 3.9 % over 62 (60,000 windows each).
THRESHOLD = {"entropy_hex": 3.0, "entropy_mixed": 3.75, "entropy_single": 3.4}

# No secrets: candidates that are UUIDs, paths and slugs, and, within candidates,
# alphabets and placeholders.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    r"^/?[a-z0-9_-]{1,16}(/[a-z0-9_-]{1,16}){2,}/?$",
    r"^[A-Za-z0-9]{1,14}([-_][A-Za-z0-9]{1,14}){2,}$",
    r"(?i)0123456789|abcdefghij|example|sample|placeholder|changeme|xxxx",
)

# What a placeholder's characters are replaced by, each of them.
MASK = "*"
MASKED = {
    **{f"(?i){word}": MASK * len(word) for word in ("0123456789", "abcdefghij", "example", "sample", "placeholder", "changeme")},
    "(?i)x(?=x{3})|(?<=x)x(?=x{2})|(?<=x{2})x(?=x)|(?<=x{3})x": MASK,
}

# Codes of the candidates' characters run from "+" to "z", after that of the mask.
FIRST_CODE, CODES = 42, 81
DIGIT_CODES, UPPER_CODES, LOWER_CODES = ((ord(a) - FIRST_CODE, ord(b) - FIRST_CODE) for a, b in ("09", "AZ", "az"))

# Spans are laid out so many at a time, which keeps the cost of long lists linear.
BLOCK = 512

REDACTED = "[secret]"

SPAN = "struct<start:int,kind:int,end:int>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(items: Column, zero: Column, step, out: str) -> Column:
    """The outputs of ``step(carry, item)``, a struct of ``carry`` and ``out``, along a list."""

    def one(state: Column, item: Column) -> Column:
        return _let(
            step(state["carry"], item),
            lambda r: F.struct(r["carry"].alias("carry"), F.array_append(state["out"], r["out"]).alias("out")),
        )

    def block(state: Column, b: Column) -> Column:
        empty = F.struct(state["carry"].alias("carry"), F.expr(f"cast(array() as array<{out}>)").alias("out"))
        inner = F.aggregate(F.slice(items, (b * BLOCK + 1).cast("int"), F.lit(BLOCK)), empty, one)
        return _let(
            inner, lambda x: F.struct(x["carry"].alias("carry"), F.array_append(state["out"], x["out"]).alias("out"))
        )

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    start = F.struct(zero.alias("carry"), F.expr(f"cast(array() as array<array<{out}>>)").alias("out"))
    laid = F.flatten(F.aggregate(blocks, start, block)["out"])
    return F.when(F.size(items) > 0, laid).otherwise(F.expr(f"cast(array() as array<{out}>)"))


def _starts(gaps: Column, matches: Column) -> Column:
    """Where each match begins, from the lengths of the matches and of what stands between them."""
    lengths = F.transform(matches, lambda m, i: F.struct(F.length(gaps[i]).alias("gap"), F.length(m).alias("match")))

    def step(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        return F.struct((start + x["match"]).alias("carry"), start.alias("out"))

    return _let(lengths, lambda items: _running(items, F.lit(0), step, "int"))


def _matches(text: Column, pattern: str, use) -> Column:
    """Spans ``use(matches, their starts)``; the text is matched and cut once, whatever is found."""

    def placed(found: Column) -> Column:
        starts = _let(F.split(text, pattern, -1), lambda gaps: _starts(gaps, found))
        return F.when(F.size(found) > 0, _let(starts, lambda at: use(found, at))).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _entropy(candidate: Column) -> Column:
    """The stretches (first, end) that windows over the threshold cover in a candidate."""
    c_log_c = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)))
    hexadecimal = candidate["text"].rlike(HEX_CLASS)
    masked = F.when(
        candidate["text"].rlike(ALLOWED[3]),
        reduce(lambda text, p: F.regexp_replace(text, p, MASKED[p]), MASKED, candidate["text"]),
    ).otherwise(candidate["text"])
    codes = F.transform(
        F.slice(F.split(masked, ""), 1, F.length(candidate["text"])), lambda ch: F.ascii(ch) - FIRST_CODE
    )

    def fold(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            enters = codes[i]
            leaves = F.when(i >= WINDOW, codes[i - WINDOW]).otherwise(-1)

            def move(pair: Column) -> Column:
                enters, leaves, counts = pair["enters"], pair["leaves"], state["counts"]
                more = c_log_c[counts[enters] + 1] - c_log_c[counts[enters]]
                less = F.when(leaves >= 0, c_log_c[counts[leaves] - 1] - c_log_c[counts[leaves]]).otherwise(0.0)
                total = F.when(enters == leaves, state["total"]).otherwise(state["total"] + more + less)
                moved = F.when(enters == leaves, counts).otherwise(
                    F.transform(
                        counts,
                        lambda c, k: c + F.when(k == enters, 1).when(k == leaves, -1).otherwise(0),
                    )
                )

                def latest(seen: Column, name: str) -> Column:
                    return F.when(seen, i).otherwise(state[name])

                upper, lower = enters.between(*UPPER_CODES), enters.between(*LOWER_CODES)
                upper_at, lower_at = latest(upper, "upper"), latest(lower, "lower")
                sign_at = latest(~(upper | lower | enters.between(*DIGIT_CODES)), "sign")
                mask_at = latest(enters == ord(MASK) - FIRST_CODE, "mask")

                def note(total: Column) -> Column:
                    single = (F.least(upper_at, lower_at) <= i - WINDOW) & (sign_at <= i - WINDOW)
                    bits = (
                        F.when(hexadecimal, THRESHOLD["entropy_hex"])
                        .when(single, THRESHOLD["entropy_single"])
                        .otherwise(THRESHOLD["entropy_mixed"])
                    )
                    whole = (i >= WINDOW - 1) & (mask_at <= i - WINDOW)
                    high = whole & (F.lit(math.log2(WINDOW)) - total / WINDOW > bits)
                    opens = high & ((state["first"] < 0) | (i - WINDOW + 1 > state["end"]))
                    closes = opens & (state["first"] >= 0)
                    full = closes & (F.size(state["late"]) >= BLOCK)
                    closed = F.struct(state["first"].alias("first"), state["end"].alias("end"))
                    return F.struct(
                        moved.alias("counts"),
                        total.alias("total"),
                        upper_at.alias("upper"),
                        lower_at.alias("lower"),
                        sign_at.alias("sign"),
                        mask_at.alias("mask"),
                        F.when(opens, i - WINDOW + 1).otherwise(state["first"]).alias("first"),
                        F.when(high, i + 1).otherwise(state["end"]).alias("end"),
                        F.when(full, F.array(closed)).when(closes, F.array_append(state["late"], closed)).otherwise(state["late"]).alias("late"),
                        F.when(full, F.array_append(state["early"], state["late"])).otherwise(state["early"]).alias("early"),
                    )

                return _let(total, note)

            return _let(F.struct(enters.alias("enters"), leaves.alias("leaves")), move)

        zero = F.struct(
            F.array_repeat(F.lit(0), CODES).alias("counts"),
            F.lit(0.0).alias("total"),
            *(F.lit(-1).alias(name) for name in ("upper", "lower", "sign", "mask")),
            F.lit(-1).alias("first"),
            F.lit(-1).alias("end"),
            F.expr("cast(array() as array<struct<first:int,end:int>>)").alias("late"),
            F.expr("cast(array() as array<array<struct<first:int,end:int>>>)").alias("early"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step)

    def stretches(f: Column) -> Column:
        last = F.array(F.struct(f["first"].alias("first"), f["end"].alias("end")))
        return F.when(f["first"] >= 0, F.concat(F.flatten(f["early"]), f["late"], last))

    return _let(_let(codes, fold), stretches)


def _span(start: Column, kind: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), kind.cast("int").alias("kind"), end.cast("int").alias("end"))


def _uncovered(base: Column, added: Column) -> Column:
    """Added spans that no base span covers; both lists are in the order of their starts."""

    def tagged(spans: Column, tag: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(tag).alias("tag"), s.alias("span")))

    def step(reached: Column, x: Column) -> Column:
        is_base = x["tag"] == 0
        return F.struct(
            F.when(is_base, F.greatest(reached, x["span"]["end"])).otherwise(reached).alias("carry"),
            F.when(~is_base & (reached < x["span"]["end"]), x["span"]).alias("out"),
        )

    merged = F.array_sort(F.concat(tagged(base, 0), tagged(added, 1)))
    kept = _let(merged, lambda items: F.filter(_running(items, F.lit(-1), step, SPAN), lambda s: s.isNotNull()))
    return F.when((F.size(base) > 0) & (F.size(added) > 0), kept).otherwise(added)


def scan(df: DataFrame, text: str = "text", name: str = "secrets") -> DataFrame:
    """``df`` with the spans found in ``text``, as an array of (start, kind, end) ordered by start and kind.

    Starts and ends count code points from 0, ends are exclusive; ``kind`` is an
    index into ``KINDS``. The first three kinds are leftmost matches of fixed
    shapes that do not overlap within a kind; the entropy kinds add what no
    span of the others covers. A null text has no spans. Rows keep their number,
    repeated rows included; a column named like the output is replaced.
    """
    kept = without(df, [name])
    value = F.coalesce(col(text), F.lit(""))
    rows = df.select(*(col(c).alias(f"kept_{i}") for i, c in enumerate(kept)), value.alias("text"))
    text_column = F.col("text")

    def spans_of(kind: str, found: Column, at: Column, lengths: Column, least: int) -> Column:
        number = F.lit(KINDS.index(kind))
        spans = F.transform(at, lambda s, i: F.when(F.length(lengths[i]) >= least, _span(s, number, s + F.length(found[i]))))
        return F.filter(spans, lambda s: s.isNotNull())

    def assigned(found: Column, at: Column) -> Column:
        values = F.regexp_extract_all(text_column, F.lit(ASSIGN), F.lit(2))
        return _let(values, lambda v: spans_of("assign", found, at, v, ASSIGN_VALUE))

    base = F.concat(
        _matches(text_column, ASSIGN, assigned),
        _matches(text_column, ACCESS, lambda found, at: spans_of("access", found, at, found, ACCESS_LENGTH)),
        _matches(text_column, HEX, lambda found, at: spans_of("hex", found, at, found, 0)),
    )

    def judged(start: Column, text: Column) -> Column:
        # a candidate of nothing but hexadecimal digits in lower case is a base span
        allowed = text.rlike("|".join(f"(?:{a})" for a in ALLOWED[1:3])) | text.rlike(ALLOWED[0]) | text.rlike("^[0-9a-f]+$")
        kind = (
            F.when(text.rlike(HEX_CLASS), KINDS.index("entropy_hex"))
            .when(text.rlike(SINGLE_CLASS), KINDS.index("entropy_single"))
            .otherwise(KINDS.index("entropy_mixed"))
        )
        stretches = _entropy(F.struct(text.alias("text")))
        found = _let(kind, lambda k: F.transform(stretches, lambda e: _span(start + e["first"], k, start + e["end"])))
        return F.when(~allowed, found)

    def dense(found: Column, at: Column) -> Column:
        return F.flatten(F.filter(F.transform(at, lambda s, i: _let(found[i], lambda t: judged(s, t))), lambda x: x.isNotNull()))

    added = _matches(text_column, CANDIDATE, dense)
    spans = _let(base, lambda b: _let(added, lambda x: F.array_sort(F.concat(b, _uncovered(b, x))))).alias(name)
    return rows.select(*(F.col(f"kept_{i}").alias(c) for i, c in enumerate(kept)), spans)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < 3)


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each stretch that spans cover replaced by ``REDACTED``."""

    # code points of four bytes each, so that a piece is found by its place; the mark keeps a piece's own one
    mark = F.unhex(F.lit("0000FEFF"))

    def piece(wide: Column, start: Column, length: Column) -> Column:
        return F.decode(F.concat(mark, F.substring(wide, start * 4 + 1, length * 4)), "UTF-32")

    def whole(wide: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            found = F.when(s["start"] >= at, F.concat(piece(wide, at, s["start"] - at), F.lit(REDACTED))).otherwise("")
            return F.struct(F.greatest(at, s["end"]).alias("carry"), found.alias("out"))

        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        rest = _let(end, lambda at: piece(wide, at, F.octet_length(wide)))
        return F.concat(F.array_join(_running(spans, F.lit(0), step, "string"), ""), rest)

    return F.when(F.size(spans) > 0, _let(F.encode(text, "UTF-32"), whole)).otherwise(text)
