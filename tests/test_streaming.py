"""Watermarks, output modes, restarts and query lifecycle on fixed event files."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brindle.plans.stream_queries import arrivals
from brindle.sources.tables import save_dataset
from brindle.streaming import streams
from brindle.workspace import scratch_path

SCHEMA = "event_id string, category string, amount double, event_time timestamp"
# The fourth event is an hour late.
LATE = [("00:00:00", 10), ("01:00:00", 20), ("01:00:01", 40), ("00:00:05", 80), ("02:00:00", 160)]


def _event_files(directory, events):
    """One JSON-lines file per event, with distinct modification times."""
    os.makedirs(directory)
    for i, (clock, amount) in enumerate(events):
        path = f"{directory}/batch_{i}.json"
        with open(path, "w") as out:
            out.write(
                f'{{"event_id": "E{i}", "category": "Books", "amount": {amount}, '
                f'"event_time": "2024-01-01T{clock}Z"}}\n'
            )
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return directory


def _by_window(events):
    timed = streams.with_event_time(events, "event_time", "10 seconds")
    totals = {"n": F.count(F.lit(1)), "total": F.sum("amount")}
    return streams.windowed(timed, "event_time", "10 minutes", [], totals)


def _rows(df):
    return sorted((r["window_start"].hour, r["n"], r["total"]) for r in df.collect())


def test_append_mode_drops_late_rows(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE)
    stream = _by_window(streams.json_stream(spark, source, SCHEMA, max_files_per_trigger=1))
    out = scratch_path(spark, "late")
    query = streams.start_to_files(stream, out, scratch_path(spark, "progress"))
    streams.drain(query)
    assert _rows(spark.read.schema(stream.schema).parquet(out)) == [(0, 1, 10.0), (1, 2, 60.0)]
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_complete_mode_keeps_late_rows(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE)
    stream = _by_window(streams.json_stream(spark, source, SCHEMA, max_files_per_trigger=1))
    name = f"late_{uuid.uuid4().hex}"
    streams.drain(streams.start_to_memory(stream, name, "complete", scratch_path(spark, "progress")))
    assert _rows(spark.table(name)) == [(0, 2, 90.0), (1, 2, 60.0), (2, 1, 160.0)]


def test_update_mode_logs_changes(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE)
    events = streams.json_stream(spark, source, SCHEMA, max_files_per_trigger=1)
    counts = events.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    name = f"log_{uuid.uuid4().hex}"
    streams.drain(streams.start_to_memory(counts, name, "update", scratch_path(spark, "progress")))
    log = spark.table(name)
    assert sorted(r["n"] for r in log.collect()) == [1, 2, 3, 4, 5]
    assert list(map(tuple, streams.latest_per_key(log, ["category"], "n").collect())) == [("Books", 5, 310.0)]


def test_restart_continues_after_the_last_file(spark):
    source, out, progress = (scratch_path(spark, x) for x in ("in", "out", "progress"))
    rows = spark.range(10).selectExpr("id")
    for _ in range(2):
        save_dataset(rows, source, mode="append")
        for _ in range(2):  # the second start finds nothing new
            stream = streams.parquet_stream(spark, source, "id bigint")
            streams.drain(streams.start_to_files(stream, out, progress))
    assert spark.read.parquet(out).groupBy("id").count().filter("count <> 2").isEmpty()
    assert spark.read.parquet(out).count() == 20


def test_processing_time_query_is_stopped(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE[:2])
    stream = streams.json_stream(spark, source, SCHEMA)
    out = scratch_path(spark, "timed")
    query = streams.start_to_files(
        stream, out, scratch_path(spark, "progress"), processingTime="100 milliseconds"
    )
    query.processAllAvailable()
    assert query.isActive
    streams.drain(query, timeout=0.1)
    assert isinstance(query, StreamingQuery) and not query.isActive
    assert spark.read.schema(SCHEMA).parquet(out).count() == 2


def test_a_failed_query_raises(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE[:1])
    stream = streams.json_stream(spark, source, SCHEMA).select(F.raise_error(F.lit("broken")).alias("x"))
    stream = stream.select(F.col("x").cast("string"))
    query = streams.start_to_files(stream, scratch_path(spark, "bad"), scratch_path(spark, "progress"))
    with pytest.raises(Exception, match="broken"):
        streams.drain(query)


def test_table_stream_takes_a_file_and_a_directory(spark):
    base = scratch_path(spark, "tables")
    spark.range(30).repartition(3).write.parquet(f"{base}/events.parquet")
    for sf_dir, rows in ((base, 30), ("/root/testdata/sf0.001", None)):
        stream = streams.table_stream(spark, sf_dir, "events")
        out = scratch_path(spark, "copied")
        streams.drain(streams.start_to_files(stream, out, scratch_path(spark, "progress")))
        expected = rows or spark.read.parquet(f"{sf_dir}/events.parquet").count()
        assert spark.read.parquet(out).count() == expected


def test_loads_of_skewed_events_are_even(spark):
    """A third of the events in one hour, another third in one instant, and some without a time."""
    events = spark.range(9000).selectExpr(
        "id AS event_id",
        """CASE WHEN id % 3 = 0 THEN timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, id * 0.4)
                WHEN id % 3 = 1 THEN timestamp_ntz'2024-01-07 00:00:00'
                WHEN id % 300 <> 2 THEN timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) END AS ts""",
    )
    for loads in (1, 4, 12, 40):
        found = arrivals(events, loads)
        sizes = found.groupBy("arrival").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
        sizes = sorted(map(tuple, sizes.collect()))
        assert [x[0] for x in sizes] == list(range(loads)) and sum(x[1] for x in sizes) == 9000
        assert max(x[1] for x in sizes) <= 2.05 * 9000 / loads
        assert all(x[3] <= y[2] for x, y in zip(sizes, sizes[1:]))
    assert arrivals(events.limit(0), 4).collect() == []


def test_state_is_read_as_a_table(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE)
    events = streams.json_stream(spark, source, SCHEMA, max_files_per_trigger=1)
    sums = {"n": F.count(F.lit(1)), "total": F.sum(F.col("amount").cast("bigint")), "least": F.min("amount")}
    counts = events.groupBy("category").agg(*[c.alias(n) for n, c in sums.items()])
    for mode in ("complete", "update"):
        progress = scratch_path(spark, "state")
        query = streams.start_to_state(counts, progress, mode)
        streams.drain(query)
        assert streams.dropped_as_late(query) == 0
        assert list(map(tuple, streams.state_of(spark, progress, list(sums)).collect())) == [("Books", 5, 310, 10.0)]
    log = streams.state_changes(spark, progress, list(sums))
    assert sorted(r["n"] for r in log.collect()) == [1, 2, 3, 4, 5]
    assert streams.latest_per_key(log, ["category"], "batch_id").first()["n"] == 5
    with pytest.raises(ValueError, match="3 fields"):
        streams.state_of(spark, progress, ["n"])


def test_late_groups_are_counted(spark, tmp_path):
    source = _event_files(f"{tmp_path}/in", LATE)
    stream = _by_window(streams.json_stream(spark, source, SCHEMA, max_files_per_trigger=1))
    query = streams.start_to_files(stream, scratch_path(spark, "late"), scratch_path(spark, "progress"))
    streams.drain(query)
    assert streams.dropped_as_late(query) == 1
