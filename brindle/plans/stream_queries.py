"""The events table replayed as a stream; the oracle is the same result in batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.numbers import count_rows, from_parts, unit_parts
from brindle.operators.layout import write_partitioned
from brindle.plans.registry import query
from brindle.sources.tables import save_dataset, table
from brindle.streaming import streams
from brindle.workspace import scratch_path, within

LARGE_EVENTS = "SELECT event_id, event_type, round(value, 1) AS value, ts FROM events WHERE value > 200"

# Events of one micro-batch of a replay in the order of time.
SLICE_ROWS = 500_000_000

TYPE_COUNTS = "SELECT event_type, COUNT(*) AS event_count FROM events GROUP BY event_type"


def _large(events: DataFrame) -> DataFrame:
    return events.filter(F.col("value") > 200).select(
        "event_id", "event_type", F.round("value", 1).alias("value"), "ts"
    )


def _run_to_files(df: DataFrame, label: str, **options: object) -> DataFrame:
    """The rows a stream appends, read back from its files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    streams.drain(
        streams.start_to_files(df, path, scratch_path(spark, f"{label}-progress"), **options)
    )
    return spark.read.schema(df.schema).parquet(path)


def _place(value: Column, borders: list[int], at_border: int) -> Column:
    """How many of the sorted borders lie below ``value``, or also at it, by halving."""
    if not borders:
        return F.lit(0)
    middle = len(borders) // 2
    beyond = value > borders[middle] if at_border == 0 else value >= borders[middle]
    above = _place(value, borders[middle + 1 :], at_border) + (middle + 1)
    return F.when(beyond, above).otherwise(_place(value, borders[:middle], at_border))


def arrivals(events: DataFrame, loads: int) -> DataFrame:
    """Events with ``arrival``, the number of their load from 0: loads in the order of time, about equal in rows.

    The borders are quantiles of event time. An instant that holds several of them is
    spread over the loads it borders on, so no load has more than about twice the mean.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    shares = F.array(*[F.lit(i / loads) for i in range(1, loads)]) if loads > 1 else None
    borders = [] if shares is None else events.select(F.percentile_approx(micros, shares, max(10_000, 100 * loads))).first()[0] or []
    first, last = _place(micros, borders, 0), _place(micros, borders, 1)
    spread = F.pmod(F.xxhash64(*events.columns), F.lit(loads) if not borders else last - first + 1)
    arrival = (first + spread).cast("int") if borders else F.lit(0)
    # rows without a time come first
    return events.withColumn("arrival", F.coalesce(arrival, F.lit(0)))


def _replayed(
    arriving: DataFrame, loads: int, transform: Callable[[DataFrame], DataFrame], label: str
) -> tuple[DataFrame, int]:
    """What ``transform`` appends as the loads come in one after the other, each a batch of its own, and what was late.

    Watermark and state go from load to load through the checkpoint, and a load
    that fails is repeated alone.
    """
    spark = arriving.sparkSession
    laid, source, path, progress = (
        scratch_path(spark, f"{label}-{part}") for part in ("loads", "in", "out", "progress")
    )
    write_partitioned(arriving, laid, ["arrival"])
    loaded = spark.read.schema(arriving.schema).parquet(laid)
    schema = arriving.drop("arrival").schema
    late = 0
    for load in range(loads):
        save_dataset(loaded.filter(F.col("arrival") == load).drop("arrival"), source, mode="append")
        stream = transform(streams.parquet_stream(spark, source, schema))
        query = streams.start_to_files(stream, path, progress)
        streams.drain(query)
        late += streams.dropped_as_late(query)
    return spark.read.schema(stream.schema).parquet(path), late


def _aggregated(grouped: DataFrame, names: list[str], label: str, mode: str) -> DataFrame:
    """The result of a streaming aggregate of any number of keys, read from its state."""
    spark = grouped.sparkSession
    progress = scratch_path(spark, f"{label}-progress")
    streams.drain(streams.start_to_state(grouped, progress, mode))
    return streams.state_of(spark, progress, names)


def _run_to_memory(df: DataFrame, label: str, mode: str) -> DataFrame:
    """The result table of a stream whose size was checked before."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    query = streams.start_to_memory(df, name, mode, scratch_path(spark, f"{label}-progress"))
    streams.drain(query)
    return spark.table(name)


def _in_files(events: DataFrame, label: str, at_least: int) -> tuple[str, int]:
    """The events written as at least that many files, without a shuffle."""
    path = scratch_path(events.sparkSession, label)
    per_file = max(events.count() // at_least, 1)
    events.write.option("maxRecordsPerFile", per_file).parquet(path)
    return path, len(events.sparkSession.read.parquet(path).inputFiles())


@query(LARGE_EVENTS)
def stream_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_to_files(_large(streams.table_stream(spark, sf_dir, "events")), "stream-filter")


@query(LARGE_EVENTS)
def stream_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events arrive as JSON lines, read with a fixed schema."""
    events = table(spark, sf_dir, "events")
    source = scratch_path(spark, "events-json")
    save_dataset(events, source, "json")
    return _run_to_files(_large(streams.json_stream(spark, source, events.schema)), "stream-json")


@query("""
    SELECT event_type, COUNT(*) AS event_count,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
           round(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS avg_value
    FROM events GROUP BY event_type""")
def stream_category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode, the whole result read with SQL: from the state, however many types there are."""
    sums = unit_parts("value", "cents")
    stats = (
        streams.table_stream(spark, sf_dir, "events")
        .select("event_type", *[part.alias(name) for name, part in sums.items()])
        .groupBy("event_type")
        .agg(count_rows().alias("event_count"), *[F.sum(name).alias(name) for name in sums])
    )
    state = _aggregated(stats, ["event_count", *sums], "category-stats", "complete")
    total = from_parts(F.col("cents_high"), F.col("cents_low"))
    result = state.select("event_type", "event_count", total.alias("total_value"))
    return spark.sql(
        """SELECT event_type, event_count, total_value, round(total_value / event_count, 2) AS avg_value
           FROM {result} ORDER BY total_value DESC""",
        result=result,
    )


@query("""
    SELECT n_name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def stream_memory_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result of known size, a row per nation, in a table on the driver."""
    nation = table(spark, sf_dir, "nation")
    if not within(nation, streams.MAX_MEMORY_ROWS):
        raise ValueError("too many nations for a result table on the driver")
    customers = streams.table_stream(spark, sf_dir, "customer")
    named = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return _run_to_memory(named.groupBy("n_name").agg(count_rows().alias("customers")), "nation_counts", "complete")


WINDOWED = """
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, COUNT(*) AS event_count
    FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type FROM events)
    WHERE window_start + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
    GROUP BY window_start, event_type"""


def _daily(events: DataFrame) -> DataFrame:
    timed = streams.with_event_time(events, "ts", "1 hour")
    return streams.windowed(timed, "ts", "1 day", ["event_type"], {"event_count": count_rows()})


@query(WINDOWED)
def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a window is written once the watermark has passed its end.

    The events come in the order of time, in four loads or more.
    """
    events = table(spark, sf_dir, "events")
    loads = max(4, events.count() // SLICE_ROWS)
    counts, late = _replayed(arrivals(events, loads), loads, _daily, "stream-window")
    if late:
        raise ValueError("events were late although they came in order")
    return counts


@query("""
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, COUNT(*) AS event_count
    FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS window_start FROM events)
    WHERE window_start + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
      AND NOT (event_id % 10 = 0 AND ts < (SELECT MIN(ts) FROM events) + INTERVAL 3 DAY)
    GROUP BY window_start, event_type""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of four loads brings a tenth of the first three days: too late for windows already written."""
    events = table(spark, sf_dir, "events")
    first = events.select(F.min("ts")).scalar()
    is_late = (F.col("ts") < F.lit(first) + F.expr("INTERVAL 3 DAYS")) & (F.col("event_id") % 10 == 0)
    arriving = arrivals(events, 4).withColumn("arrival", F.when(is_late, 3).otherwise(F.col("arrival")))
    counts, late = _replayed(arriving, 4, _daily, "stream-late")
    if not late:
        raise ValueError("no event was late")
    return counts


def _type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts by type over four batches or more."""
    events = table(spark, sf_dir, "events").select("event_type")
    path, files = _in_files(events, "events-files", at_least=4)
    replay = streams.parquet_stream(spark, path, events.schema, -(-files // 4))
    return replay.groupBy("event_type").agg(count_rows().alias("event_count"))


@query(TYPE_COUNTS)
def stream_multi_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State carried over several micro-batches, and read as a table after the last."""
    return _aggregated(_type_counts(spark, sf_dir), ["event_count"], "type-counts", "complete")


@query(TYPE_COUNTS)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: the state store logs the changed rows of each batch; the newest per key is the table."""
    progress = scratch_path(spark, "type-log-progress")
    streams.drain(streams.start_to_state(_type_counts(spark, sf_dir), progress))
    log = streams.state_changes(spark, progress, ["event_count"])
    return streams.latest_per_key(log, ["event_type"], "batch_id").select("event_type", "event_count")


@query("SELECT event_id, user_id, value, event_type FROM events")
def stream_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned Parquet sink."""
    events = streams.table_stream(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", "event_type"
    )
    return _run_to_files(events, "stream-parquet", partition_by=["event_type"])


@query(LARGE_EVENTS)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream stops after the first half of the period and is started again on the rest."""
    events = table(spark, sf_dir, "events")
    half = events.select(
        F.timestamp_add("SECOND", F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")) / 2, F.min("ts"))
    ).scalar()
    source, path, progress = (
        scratch_path(spark, label) for label in ("restart-in", "restart-out", "restart-progress")
    )
    for part in (events.filter(F.col("ts") < half), events.filter(F.col("ts") >= half)):
        save_dataset(part, source, mode="append")
        stream = _large(streams.parquet_stream(spark, source, events.schema))
        streams.drain(streams.start_to_files(stream, path, progress))
    return spark.read.parquet(path)
