"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of a bounded sample of labelled rows, per language
and bucket; what reaches the driver is one number per language and bucket. The
matrix of log probabilities has at most ``MAX_LANGUAGES`` times ``BUCKETS``
entries whatever the data, and is broadcast. Scoring adds up the matrix rows of
the n-grams that occur, for a slice of texts at a time, with numpy in the tasks
that read the texts; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from brindle.llm.tasks import append_columns, col, in_tasks, slices

SIZES = (2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5

# The classifier is fitted on this many rows of a language, chosen by a hash, and
# on the languages with the most rows.
ROWS_PER_LANGUAGE = 2_000
MAX_LANGUAGES = 256

UNDETERMINED = "und"

# Text whose n-grams are held at a time, at some 80 bytes per byte.
SLICE_BYTES = 1 << 20

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and whether each text has a letter.

    Texts are lower-cased and stand between blanks, what is not a letter counts as
    a blank, and an n-gram holds a letter at least and lies within one text.
    """
    gap = " " * (max(SIZES) - 1)
    codes = [np.frombuffer((gap + t.lower() + gap).encode("utf-32-le", "replace"), "<u4") for t in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) for c in codes])
    flat = np.concatenate(codes) if codes else np.zeros(0, "<u4")
    known = letters()[flat]
    flat = np.where(known, flat, 32).astype(np.uint32)
    buckets, owners = [], []
    for n in SIZES:
        if len(flat) < n:
            continue
        h, any_letter = np.full(len(flat) - n + 1, n, np.uint32), np.zeros(len(flat) - n + 1, bool)
        for k in range(n):
            part = flat[k : len(flat) - n + 1 + k]
            h = (h ^ part) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            any_letter |= known[k : len(flat) - n + 1 + k]
        own = any_letter & (owner[: len(h)] == owner[n - 1 :])
        buckets.append((h & np.uint32(BUCKETS - 1))[own].astype(np.int32))
        owners.append(owner[: len(h)][own])
    has_letter = np.zeros(len(texts), bool)
    has_letter[owner[known]] = True
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), has_letter
    return np.concatenate(buckets), np.concatenate(owners), has_letter


def count_grams(batches):
    """Rows (language, bucket, count) of batches with the columns language and text."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch.select([1, 0]), 1, SLICE_BYTES):
            texts, languages = part.column(0).to_pylist(), part.column(1).to_pylist()
            names = sorted(set(languages))
            codes = np.array([names.index(x) for x in languages], np.int64)
            buckets, owners, _ = grams(texts)
            counts = np.bincount(codes[owners] * BUCKETS + buckets, minlength=len(names) * BUCKETS)
            for name, row in zip(names, counts.reshape(-1, BUCKETS)):
                held[name] = held.get(name, 0) + row
    for name, counts in held.items():
        found = np.flatnonzero(counts)
        columns = [pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(counts[found])]
        yield pa.RecordBatch.from_arrays(columns, names=["language", "bucket", "n"])


@dataclass
class Model:
    """Languages and, for each bucket and language, the log probability."""

    languages: list[str]
    log_p: np.ndarray


def fit(df: DataFrame, text: str, language: str, row_id: str) -> Model:
    """A classifier from the rows of ``df`` that have both a text and a language.

    Of a language with more than ``ROWS_PER_LANGUAGE`` rows about that many are
    used, chosen by a hash of ``row_id``. All languages are taken as equally
    likely beforehand.
    """
    labelled = df.select(
        col(language).cast("string").alias("language"), col(text).alias("text"), F.xxhash64(col(row_id)).alias("place")
    ).where("language IS NOT NULL AND text IS NOT NULL")
    rows = labelled.groupBy("language").count().orderBy(F.desc("count"), "language").limit(MAX_LANGUAGES).collect()
    if not rows:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    scale = 1 << 20
    share = F.create_map(*(F.lit(x) for r in rows for x in (r["language"], -(-scale * ROWS_PER_LANGUAGE // r["count"]))))
    sample = labelled.where(
        F.col("language").isin([r["language"] for r in rows])
        & (F.pmod("place", F.lit(scale)) < F.try_element_at(share, F.col("language")))
    )
    schema = StructType(
        [StructField("language", StringType()), StructField("bucket", IntegerType()), StructField("n", LongType())]
    )
    counted = (
        sample.select("language", "text")
        .mapInArrow(in_tasks(count_grams), schema)
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted({r["language"] for r in rows})
    index = {name: i for i, name in enumerate(languages)}
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    at = [index[name] for name in counted["language"].to_pylist()]
    counts[counted["bucket"].to_numpy(), at] += counted["n"].to_numpy()
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def predict_slice(part: pa.RecordBatch, model) -> list[pa.Array]:
    languages, log_p = model.value.languages, model.value.log_p
    texts = [text or "" for text in part.column(0).to_pylist()]
    buckets, owners, has_letter = grams(texts)
    known = has_letter & bool(languages)
    total = np.stack(
        [np.bincount(owners, log_p[:, k][buckets], minlength=len(texts)) for k in range(len(languages))] or [np.zeros(len(texts))],
        axis=1,
    )
    best = total.argmax(axis=1)
    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = [languages[k] if ok else UNDETERMINED for k, ok in zip(best, known)]
    return [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))]


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the probability of that language among the learned ones.

    A text that is null or has no letter is ``und`` with score 0, as is every text
    if nothing was learned. Ties go to the first language by name. Columns named
    like the outputs are replaced; rows keep their number, repeated rows included.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return append_columns(df, predict_slice, [text], fields, slice_bytes=SLICE_BYTES, model=shared)


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text is 2 modulo 4 (never for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
