"""Structured Streaming: file sources, watermarked aggregates, sinks and restarts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from brindle.sources.tables import table

# The in-memory sink keeps its result on the driver, so it is for results of known size.
MAX_MEMORY_ROWS = 100_000

# Bounds the work a failed micro-batch repeats.
FILES_PER_TRIGGER = 10_000


def json_stream(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of the JSON-lines files that appear in a directory."""
    return _file_stream(spark, "json", directory, schema, max_files_per_trigger)


def parquet_stream(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of the Parquet files that appear in a directory."""
    return _file_stream(spark, "parquet", directory, schema, max_files_per_trigger)


def table_stream(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
) -> DataFrame:
    """A Parquet table of a data directory replayed as a stream.

    Files come in no order of event time: where a watermark would take the later
    batches for late, deal the events into loads by time first.
    The file source refuses a path that is a file; as a glob it takes a
    file and a directory of files alike.
    """
    schema = table(spark, sf_dir, name).schema
    return parquet_stream(spark, f"{sf_dir}/{name}.parque[t]", schema, max_files_per_trigger)


def _file_stream(
    spark: SparkSession,
    file_format: str,
    directory: str,
    schema: StructType | str,
    max_files_per_trigger: int | None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def with_event_time(df: DataFrame, time: str, delay: str) -> DataFrame:
    """``df`` with a watermark on ``time``, which is made an instant if it has no zone."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def windowed(
    df: DataFrame, time: str, width: str, by: Sequence[str], aggregates: dict[str, Column]
) -> DataFrame:
    """Aggregates per tumbling window and key, with the window's start and end."""
    grouped = df.groupBy(F.window(time, width).alias("window"), *by)
    return grouped.agg(*[c.alias(name) for name, c in aggregates.items()]).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *by,
        *aggregates,
    )


def start_to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    **trigger: object,
) -> StreamingQuery:
    """Append the stream to files. ``trigger`` is as for ``DataStreamWriter.trigger``;
    by default the query takes what is there and ends."""
    writer = df.writeStream.format(file_format).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_to_memory(
    df: DataFrame, name: str, mode: str, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Keep the stream's result as table ``name`` on the driver; for results of known size."""
    return (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_to_state(df: DataFrame, checkpoint: str, mode: str = "update", **trigger: object) -> StreamingQuery:
    """Run an aggregate whose result is kept where its state is, in the checkpoint, whatever its size.

    :func:`state_of` reads it as a table, :func:`state_changes` what each batch changed.
    """
    return (
        df.writeStream.format("noop")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _named(state: DataFrame, names: Sequence[str]) -> Column:
    """The aggregation buffer with a name for each of its fields, which are told apart by place only."""
    fields = state.schema["value"].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"the state holds {len(fields)} fields: only counts, sums of longs, least and greatest values are their own state")
    return F.col("value").cast(StructType([StructField(n, f.dataType) for n, f in zip(names, fields)]))


def state_of(spark: SparkSession, checkpoint: str, names: Sequence[str]) -> DataFrame:
    """The keys and aggregates of a query after its last batch, read by all executors from the checkpoint.

    ``names`` are those of the aggregates, in their order: counts, sums of longs,
    minima and maxima, which are their own state.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", _named(state, names).alias("value")).select("*", "value.*").drop("value")


def state_changes(spark: SparkSession, checkpoint: str, names: Sequence[str]) -> DataFrame:
    """The rows that each batch changed, with its ``batch_id``: the log of update mode as a table.

    As far back as the state store keeps its batches (``spark.sql.streaming.minBatchesToRetain``).
    """
    changes = spark.read.format("statestore").option("readChangeFeed", True).option("changeStartBatchId", 0).load(checkpoint)
    updates = changes.filter("change_type = 'update'")
    return updates.select("batch_id", "key.*", _named(updates, names).alias("value")).select("*", "value.*").drop("value")


def dropped_as_late(query: StreamingQuery) -> int:
    """What the watermark dropped, from the query's progress: groups of late rows, as combined by each task."""
    return sum(state.get("numRowsDroppedByWatermark", 0) for step in query.recentProgress for state in step["stateOperators"])


def drain(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for the query to end (or for ``timeout`` seconds), then stop it.

    A failure of the query is raised here.
    """
    try:
        query.awaitTermination(timeout)
    finally:
        query.stop()


def latest_per_key(log: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The newest entry per key of an update-mode change log."""
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), version).alias("_newest")
    return log.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
