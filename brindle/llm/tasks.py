"""What the operators share: Python per Arrow batch, column names, bounded slices."""

from __future__ import annotations

import ctypes
import importlib
import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

ROOT = str(Path(__file__).resolve().parents[2])

# Text that is held as Python objects at a time.
SLICE_BYTES = 4 << 20


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` that do not share a name with ``names`` (as Spark compares names)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def row_key(doc_id: str, text: str) -> Column:
    """A key of a row's id and text, which tells null and repeated ids apart by their text; never null."""
    return F.concat_ws(":", F.coalesce(F.md5(col(text).cast("binary")), F.lit("")), col(doc_id).cast("string"))


# By module, what its functions keep in this worker from task to task.
_kept: dict[str, dict] = {}


def worker_cache(module: str) -> dict:
    """A cache that a worker keeps until it runs a function of another module."""
    return _kept.setdefault(module, {})


def release() -> None:
    """Give freed memory back to the machine."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def keep_only(module: str) -> None:
    """Drop what other modules keep: a worker serves one operator after another."""
    others = [cache for name, cache in _kept.items() if name != module and cache]
    for cache in others:
        cache.clear()
    if others:
        release()


def in_tasks(function: Callable, **options) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function(batches, **options)`` looked up by name where it runs.

    A worker's module keeps its caches from task to task, and a local session
    finds the package even if it was started elsewhere.
    """
    module, name, root = function.__module__, function.__name__, ROOT

    def run(batches):
        if root not in sys.path:
            sys.path.append(root)
        importlib.import_module(__name__).keep_only(options.get("module", module))
        return getattr(importlib.import_module(module), name)(batches, **options)

    return run


def append_columns(
    df: DataFrame,
    function: Callable,
    inputs: list[str],
    fields: list[StructField],
    slice_bytes: int = SLICE_BYTES,
    keep: list[str] | None = None,
    **options,
) -> DataFrame:
    """``df`` with the columns ``function(slice, **options)`` computes from ``inputs``.

    ``function`` gets a record batch of the inputs, a few MB at a time, and
    returns one Arrow array per field. A column of ``df`` that has the name of
    a field is replaced; with ``keep`` only those columns stay. Each column goes
    to the task once, and back only if it stays.
    """
    kept = [c for c in without(df, [f.name for f in fields]) if keep is None or c in keep]
    beside = [c for c in kept if c not in inputs]
    positional = df.select(
        *(col(c).alias(f"in_{i}") for i, c in enumerate(inputs)),
        *(col(c).alias(f"kept_{i}") for i, c in enumerate(beside)),
    )
    schema = StructType([*(StructField(c, df.schema[c].dataType) for c in kept), *fields])
    names = [f.name for f in schema]
    run = in_tasks(
        _append,
        module=function.__module__,
        name=function.__name__,
        n_inputs=len(inputs),
        kept=[[*inputs, *beside].index(c) for c in kept],
        names=names,
        slice_bytes=slice_bytes,
        options=options,
    )
    return positional.mapInArrow(run, schema)


def _append(batches, module: str, name: str, n_inputs: int, kept: list[int], names: list[str], slice_bytes: int, options: dict):
    function = getattr(importlib.import_module(module), name)
    for batch in batches:
        for part in slices(batch, n_inputs, slice_bytes):
            inputs = pa.RecordBatch.from_arrays(part.columns[:n_inputs], names=part.schema.names[:n_inputs])
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *function(inputs, **options)], names=names)
        # before the next batch is read
        batch = part = inputs = None
        release()


def slices(batch: pa.RecordBatch, n_inputs: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose text or binary inputs hold about ``limit`` bytes, one row at least."""
    sizes = [0] * batch.num_rows
    for column in batch.columns[:n_inputs]:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
            sizes = [a + (b or 0) for a, b in zip(sizes, pc.binary_length(column).to_pylist())]
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
