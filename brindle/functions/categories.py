"""Banding of numbers into labels: native, SQL-text and Python-function forms."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def band(value: Column | str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for the first ``bounds[i]`` above the value, else the last label; null stays null."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    column = F.col(value) if isinstance(value, str) else value
    banded = F.when(column.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        banded = banded.when(column < bound, label)
    return banded.otherwise(labels[-1])


def band_sql(value: str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """:func:`band` written as a SQL CASE expression over the column named ``value``."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    column = "`" + value.replace("`", "``") + "`"
    quoted = ["'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'" for label in labels]
    branches = " ".join(f"WHEN {column} < {bound} THEN {label}" for bound, label in zip(bounds, quoted))
    return F.expr(f"CASE WHEN {column} IS NULL THEN NULL {branches} ELSE {quoted[-1]} END")


def band_udf(bounds: Sequence[float], labels: Sequence[str]):
    """:func:`band` as a user-defined function over Arrow batches.

    The extension point for logic that has no native expression; prefer
    :func:`band`, which Catalyst can see through.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    edges, names = np.asarray(bounds, dtype=float), np.asarray(labels, dtype=object)

    @F.arrow_udf(StringType())
    def to_band(values: pa.Array) -> pa.Array:
        slots = np.searchsorted(edges, values.to_numpy(zero_copy_only=False), side="right")
        missing = values.is_null().to_numpy(zero_copy_only=False)
        return pa.array(names[slots], type=pa.string(), mask=missing)

    return to_band
