"""Shared scratch folder, written intermediate tables and size checks.

Nothing here changes the session. Intermediate tables go to the folder the
cluster names in ``spark.checkpoint.dir`` so that they outlive any executor.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SHARED_DIR_CONF = "spark.checkpoint.dir"

# What one task sorts or writes with room to spare.
ROWS_PER_PARTITION = 5_000_000

# A table is only broadcast after it was measured against both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20

VARIABLE_WIDTH = ("string", "char", "varchar", "binary", "array", "map", "struct", "variant")

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    Outside a cluster (``local`` masters, as in tests) a temporary folder stands
    in when the session names none. On a cluster a missing setting is an error:
    a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder all executors share")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="brindle-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def application_dir(spark: SparkSession) -> str:
    """Where the written tables of this application go."""
    return f"{shared_dir(spark)}/brindle/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table, or all of them with ``application_dir(spark)``.

    Frames hold on to their files by path only, so this is the caller's to time.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it read back.

    Cuts the lineage and fixes values that a recomputation could change
    (partition ids, row positions).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, rows: int) -> list[int]:
    """A partition count for ``rows``, or nothing where the session's own is enough."""
    needed = -(-rows // ROWS_PER_PARTITION)
    return [needed] if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else []


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (a footer-only count on a file scan)."""
    return df.count() <= max_rows


def variable_bytes(df: DataFrame) -> Column | None:
    """The bytes of a row's columns of variable width; None if there are none."""
    lengths = [
        F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)).cast("bigint")
        for name, type_name in df.dtypes
        if type_name.startswith(VARIABLE_WIDTH)
    ]
    return reduce(lambda a, b: a + b, lengths) if lengths else None


def counted(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of the columns of variable width (a footer-only count on a file scan without such columns)."""
    lengths = variable_bytes(df)
    if lengths is None:
        return df.count(), 0
    rows, size = df.agg(F.count(F.lit(1)), F.sum(lengths)).first()
    return rows, size or 0


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` was measured to be small in rows and in bytes."""
    return within(df, max_rows) and counted(df)[1] <= MAX_BROADCAST_BYTES


def broadcast_within(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows, else ``df`` as it is.

    Without the hint the join shuffles and adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def measured(df: DataFrame, label: str, **sums: Column) -> tuple[DataFrame, dict[str, int]]:
    """:func:`materialize`, with ``rows``, ``bytes`` (of variable width) and ``sums`` observed by the same job."""
    lengths = variable_bytes(df)
    observed = {"rows": F.count(F.lit(1)), "bytes": F.lit(0) if lengths is None else F.sum(lengths), **sums}
    observation = Observation()
    written = materialize(df.observe(observation, *[F.coalesce(c, F.lit(0)).alias(n) for n, c in observed.items()]), label)
    return written, observation.get


def summary(df: DataFrame, label: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The result of a small aggregate, written once and measured as it is written. It is
    broadcast where it is joined if its rows and bytes allow; beyond that it is shuffled."""
    written, size = measured(df, label)
    return F.broadcast(written) if size["rows"] <= max_rows and size["bytes"] <= MAX_BROADCAST_BYTES else written
