"""Benchmark decontamination: SimHash of item-sized windows, exact verification.

An item and a window of as many words are alike if the multisets of their
five-word shingles have a weighted Jaccard similarity of ``SIMILARITY`` or more,
a shingle weighing as much as it occurs. Such a window holds a share of the
item's shingles that is known beforehand, so it holds one at least of the
item's rarest few (``_anchors``); windows without any are not alike to an item
and need no fingerprint. Every other item-sized window is fingerprinted. Fingerprints
within ``MAX_BITS`` bits of an item's agree with it up to ``BLOCK_BITS`` bits in
one of eight blocks, and the items are filed under all such block values:
every fingerprint within the radius is found by an equality join on the item
that an anchor in the window names, the block and its value. Survivors are
verified by the exact similarity.

A document shorter than an item is one window with a length of its own, if it has
enough shingles to be alike. It needs no fingerprint: it is compared with the
items that have a shingle it holds among their anchors for this wider bound.

The documents are exploded to shingle hashes once, against the anchors of the
benchmark, which are broadcast if they are measured to be small. Only matches
and the windows around them are shuffled.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle import workspace
from brindle.llm.tasks import col

WORDS = 5
SIMILARITY = 0.8

# At similarity 0.8 two fingerprints differ in 9.7 of 64 bits on average, with a
# deviation of 2.9; this leaves out less than one pair in 100,000 there.
MAX_BITS = 23
BLOCKS, WIDTH = 8, 8
BLOCK_BITS = MAX_BITS // BLOCKS

# Shingles of a row in which windows begin.
SEGMENT = 4_096

NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def shingle_hashes(words: Column, size: int) -> Column:
    """A hash per shingle of ``size`` words, in the order of the text."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, size))))
    return F.when(F.size(words) >= size, F.slice(hashes, 1, F.size(words) - (size - 1))).otherwise(
        F.expr("cast(array() as array<bigint>)")
    )


def fingerprint(hashes: Column) -> Column:
    """SimHash of an array of 64-bit hashes: a bit is 1 if set in over half of them.

    Two bits are counted in each long, 32 bits apart.
    """
    pair = F.lit((1 << 32) | 1)
    total = F.size(hashes)

    def bits(j: int) -> Column:
        both = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, j).bitwiseAND(pair))
        top = 1 << (j + 32)
        top = top - (1 << 64) if j == 31 else top
        return F.transform(F.array(both), lambda b: _both(b, total, j, top))[0]

    return reduce(lambda a, b: a.bitwiseOR(b), (bits(j) for j in range(32)))


def _both(counts: Column, total: Column, j: int, top: int) -> Column:
    low = F.when(counts.bitwiseAND(F.lit((1 << 32) - 1)) * 2 > total, F.lit(1 << j)).otherwise(F.lit(0).cast("long"))
    high = F.when(F.shiftrightunsigned(counts, 32) * 2 > total, F.lit(top)).otherwise(F.lit(0).cast("long"))
    return low.cast("long").bitwiseOR(high.cast("long"))


def _blocks(fingerprint: Column) -> Column:
    """(block, value) of each block of a fingerprint."""
    mask = (1 << WIDTH) - 1
    return F.array(
        *(
            F.struct(
                F.lit(b).alias("block"),
                F.shiftrightunsigned(fingerprint, b * WIDTH).bitwiseAND(F.lit(mask)).cast("int").alias("value"),
            )
            for b in range(BLOCKS)
        )
    )


def _near_values() -> Column:
    """All differences of a block in ``BLOCK_BITS`` or fewer bits."""
    masks = [sum(1 << i for i in c) for k in range(BLOCK_BITS + 1) for c in combinations(range(WIDTH), k)]
    return F.array(*map(F.lit, masks))


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Items with their word count, shingle size and shingle hashes; items without a word are left out."""
    split = benchmark.select(col(item_id).alias("item_id"), words(col(text)).alias("words"))
    split = split.select("item_id", F.size("words").alias("n_words"), "words").where("n_words > 0")
    size = F.least("n_words", F.lit(WORDS))
    hashes = reduce(
        lambda found, k: F.when(size == k, shingle_hashes(F.col("words"), k)).otherwise(found),
        range(1, WORDS),
        shingle_hashes(F.col("words"), WORDS),
    )
    split = split.select("item_id", "n_words", size.alias("size"), hashes.alias("hashes")).distinct()
    return split.select("*", F.xxhash64("hashes").alias("content"))


def _anchors(items: DataFrame) -> DataFrame:
    """Rows (content, n_words, size, hash, close): of each item the shingles, one of which every alike window holds.

    Items are told apart by ``content``, a hash of their shingles, as ids may repeat.

    Alike means sharing c of n shingles with c / (2n - c) >= SIMILARITY, so any
    n - c + 1 occurrences of shingles do; the rarest in the benchmark are taken.
    A shorter document shares c >= SIMILARITY * n, as c / n is no less than their
    similarity. ``close`` tells the anchors that windows as long as the item need.
    """
    texts = items.select("content", "n_words", "size", "hashes").distinct()
    each = texts.select("content", "n_words", "size", F.size("hashes").alias("n"), F.posexplode("hashes").alias("place", "hash"))
    often = each.groupBy("size", "hash").agg(F.count("*").alias("often"))
    ranked = each.join(often, ["size", "hash"]).groupBy("content", "n_words", "size", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "hash", "place"))).alias("shingles")
    )
    least = F.ceil(F.col("n") * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    taken = F.slice("shingles", 1, (F.col("n") - _least_shorter(F.col("n")) + 1).cast("int"))
    placed = ranked.select("content", "n_words", "size", (F.col("n") - least).alias("last"), F.posexplode(taken).alias("rank", "s"))
    return placed.groupBy("content", "n_words", "size", "s.hash").agg(F.max(F.col("rank") <= F.col("last")).alias("close"))


def _least_shorter(n: Column) -> Column:
    """Shingles that a shorter document must have, and share, to be alike to an item of ``n``."""
    return F.ceil(n * SIMILARITY - 1e-9)


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Rows (doc_id, item_id, start, n_words, bits, similarity): for each pair its most similar window.

    ``start`` is the window's first word, from 0; of equally similar windows the
    first counts. ``bits`` is the distance of the fingerprints. Texts are
    compared as lower-case words without punctuation. An item of fewer than five
    words is one shingle; an item without words, and a document that is null,
    match nothing. A document shorter than an item is one window, with its own
    ``n_words``. Repeated documents give one row per id and item, repeated items
    likewise.
    """
    items = workspace.materialize(_items(benchmark, item_id, item_text), "items")
    anchors = workspace.materialize(_anchors(items), "anchors")
    sizes = sorted(r["size"] for r in anchors.select("size").distinct().collect())
    found = None
    for size in sizes:
        part = _search(documents, items.where(F.col("size") == size), anchors.where(F.col("size") == size), size, doc_id, text)
        found = part if found is None else found.unionByName(part)
    if found is None:
        types = [documents.select(col(doc_id).alias(doc_id)).schema[0], items.schema["item_id"]]
        return documents.sparkSession.createDataFrame([], StructType(types)).select(
            "*", F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0).alias("bits"), F.lit(0.0).alias("similarity")
        )
    best = F.max_by(F.struct("start", "n_words", "bits", "similarity"), F.struct("similarity", -F.col("start")))
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(F.col("doc_id").alias(doc_id), "item_id", "best.*")
    )


def _search(documents: DataFrame, items: DataFrame, anchors: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """All alike windows, for items whose shingles have ``size`` words."""
    rows = documents.select(col(doc_id).alias("doc_id"), words(col(text)).alias("words"))
    rows = rows.select("doc_id", F.size("words").alias("length"), shingle_hashes(F.col("words"), size).alias("hashes"))
    # Exploded with the outer form, as the other adds a filter on the array, which is
    # pushed below and splits the text anew for each word.
    # A document is known by its id and its shingles, as ids may repeat.
    rows = rows.select("doc_id", "length", F.xxhash64("hashes").alias("key"), "hashes")

    sought = anchors.groupBy("hash", "n_words").agg(F.max("close").alias("close"))
    sought = workspace.materialize(sought, "sought")
    shorter = F.col("length") < F.col("n_words")
    enough = F.col("length") - (size - 1) >= _least_shorter(F.col("n_words") - (size - 1))
    hits = (
        rows.select("doc_id", "key", "length", F.posexplode_outer("hashes").alias("pos", "hash"))
        .join(workspace.broadcast_within(sought), "hash")
        .where(F.when(shorter, enough).otherwise(F.col("close")))
        .select("doc_id", "key", "length", "n_words", "pos", "hash")
    )
    hits = workspace.materialize(hits, "hits")
    close = workspace.broadcast_within(anchors.where("close").select("content", "n_words", "hash"))
    pairs = hits.where(~shorter).join(close, ["n_words", "hash"]).select(
        "doc_id",
        "key",
        "n_words",
        "content",
        F.explode(
            F.sequence(
                F.greatest(F.col("pos") - F.col("n_words") + size, F.lit(0)),
                F.least("pos", F.col("length") - F.col("n_words")),
            )
        ).alias("start"),
    ).distinct()
    pairs = workspace.materialize(pairs, "pairs")
    short = (
        hits.where(shorter)
        .join(workspace.broadcast_within(anchors.select("content", "n_words", "hash")), ["n_words", "hash"])
        .select("doc_id", "key", "n_words", "content", F.lit(0).alias("start"), "length")
        .distinct()
    )
    short = workspace.materialize(short, "short-documents")
    segments = _segments(documents, pairs, short, items, size, doc_id, text)

    cut = _own(pairs.select("doc_id", "key", "n_words", "start").distinct(), segments, F.col("n_words"), size)
    printed = workspace.materialize(cut.withColumn("print", fingerprint(F.col("own"))).drop("own"), "fingerprints")
    near = workspace.materialize(_near(pairs, printed, items), "near-windows")
    near = _own(near, segments, F.col("n_words"), size)
    near = near.join(items.select("item_id", "content", "n_words", "hashes"), ["content", "n_words"])
    near = near.select("doc_id", "item_id", "start", "n_words", "bits", similarity(F.col("own"), F.col("hashes")).alias("similarity"))

    known = _own(short, segments, F.col("length"), size)
    known = known.join(items.select("item_id", "content", "n_words", "hashes"), ["content", "n_words"])
    known = known.select("doc_id", "item_id", "start", "length", "own", "hashes", similarity(F.col("own"), F.col("hashes")).alias("similarity"))
    whole = known.where(F.col("similarity") >= SIMILARITY).select(
        "doc_id",
        "item_id",
        "start",
        F.col("length").alias("n_words"),
        F.bit_count(fingerprint(F.col("own")).bitwiseXOR(fingerprint(F.col("hashes")))).alias("bits"),
        "similarity",
    )
    return near.where(F.col("similarity") >= SIMILARITY).unionByName(whole)


def _segments(
    documents: DataFrame, pairs: DataFrame, short: DataFrame, items: DataFrame, size: int, doc_id: str, text: str
) -> DataFrame:
    """Rows (doc_id, key, segment, hashes): the stretches of documents in which windows begin.

    A segment holds ``SEGMENT`` shingles and as many more as the longest item has
    words, so a window lies within the segment it begins in. Long documents
    are spread over tasks, and no row holds more than this.
    """
    wanted = pairs.select("doc_id", "key", _segment()).unionByName(short.select("doc_id", "key", _segment())).distinct()
    wanted = workspace.materialize(wanted, "wanted-segments")
    longest = items.agg(F.max("n_words")).first()[0] or 0
    ids = workspace.materialize(wanted.select(F.col("doc_id").alias("wanted_id")).distinct(), "ids")
    some = documents.join(workspace.broadcast_within(ids), col(doc_id).eqNullSafe(F.col("wanted_id")), "left_semi")
    some = some.select(col(doc_id).alias("doc_id"), words(col(text)).alias("words"))
    some = some.select("doc_id", shingle_hashes(F.col("words"), size).alias("hashes"))
    some = some.select("doc_id", F.xxhash64("hashes").alias("key"), "hashes")
    last = F.greatest(F.size("hashes") - 1, F.lit(0))
    some = some.select("doc_id", "key", "hashes", F.explode_outer(F.sequence(F.lit(0), F.floor(last / SEGMENT).cast("int"))).alias("segment"))
    some = some.select("doc_id", "key", "segment", F.slice("hashes", F.col("segment") * SEGMENT + 1, SEGMENT + longest).alias("hashes"))
    asked = wanted.select(F.col("doc_id").alias("a"), F.col("key").alias("b"), F.col("segment").alias("c"))
    asked = workspace.broadcast_within(asked)
    same = F.col("doc_id").eqNullSafe(F.col("a")) & (F.col("key") == F.col("b")) & (F.col("segment") == F.col("c"))
    some = some.join(asked, same, "left_semi").dropDuplicates(["doc_id", "key", "segment"])
    return workspace.materialize(some, "segments")


def _segment() -> Column:
    return F.floor(F.col("start") / SEGMENT).cast("int").alias("segment")


def _own(windows: DataFrame, segments: DataFrame, n_words: Column, size: int) -> DataFrame:
    """``windows`` with their shingle hashes in ``own``."""
    names = [c for c in windows.columns if c not in ("doc_id", "key")]
    same = F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.key") == F.col("s.key")) & (F.col("w.segment") == F.col("s.segment"))
    found = windows.select("*", _segment()).alias("w").join(segments.alias("s"), same)
    begin = F.col("start") - F.col("w.segment") * SEGMENT + 1
    return found.select("w.doc_id", "w.key", *names, F.slice(F.col("s.hashes"), begin, n_words - (size - 1)).alias("own"))


def _near(pairs: DataFrame, printed: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``pairs`` whose fingerprints differ in ``MAX_BITS`` or fewer bits, with these as ``bits``.

    A window meets the items that an anchor in it names, and of these only the ones
    with a block alike; what is joined are numbers, no arrays.
    """
    filed = items.select("content", "n_words", fingerprint(F.col("hashes")).alias("item_print")).distinct()
    filed = filed.select("*", F.explode(_blocks(F.col("item_print"))).alias("b"))
    filed = filed.select(
        "content", "n_words", "item_print", F.col("b.block").alias("block"),
        F.explode(F.transform(_near_values(), lambda m: F.col("b.value").bitwiseXOR(m))).alias("value"),
    )
    filed = workspace.materialize(filed, "filed-items")
    names = ["key", "n_words", "start"]
    own = printed.select(F.col("doc_id").alias("printed_id"), *names, "print")
    alike = [F.col("doc_id").eqNullSafe(F.col("printed_id")), *(pairs[n] == own[n] for n in names)]
    named = pairs.join(own, reduce(lambda a, b: a & b, alike)).select(
        "doc_id", *(pairs[n] for n in names), "content", "print", F.explode(_blocks(F.col("print"))).alias("b")
    )
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = (
        named.select("doc_id", *names, "content", "print", "b.block", "b.value")
        .join(workspace.broadcast_within(filed), ["content", "n_words", "block", "value"])
        .select("*", distance.alias("bits"))
        .where(F.col("bits") <= MAX_BITS)
    )
    # the same pair may meet in several blocks: the first block in which it does keeps it
    agreed = [
        F.bit_count(F.shiftrightunsigned(F.col("print").bitwiseXOR(F.col("item_print")), b * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)))
        <= BLOCK_BITS
        for b in range(BLOCKS)
    ]
    first = reduce(lambda rest, b: F.when(agreed[b], b).otherwise(rest), reversed(range(BLOCKS)), F.lit(-1))
    return near.where(F.col("block") == first).select("doc_id", *names, "content", "bits")


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of shingle hashes, each weighing as often as it occurs."""

    def count(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda v: v == x))

    shared = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x))
    )
    return F.transform(F.array(shared), lambda s: s / (F.size(a) + F.size(b) - s))[0].cast("double")
