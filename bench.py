"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the data directory and ``BENCH_CPUS`` the local cores.
``BENCH_QUERIES`` (comma-separated) replaces the headline queries, ``all`` means
every one. Each query runs once to warm up, then ``BENCH_RUNS`` times; the best
run counts. Results go to the no-op sink, so all rows and columns are computed
and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from brindle.plans import QUERIES

HEADLINE = """
    sql_revenue_by_country computed_price filter_and case_when late_cutoff_batch
    join_inner_using join_left join_full join_broadcast join_sort_merge join_salted bucketed_join
    products_never_ordered revenue_by_category user_spending
    join_salted_full join_outer_hot_key customers_without_events orders_without_lines documents_with_labels
    agg_global group_multi_agg count_distinct pivot_sum pivot_found_values dedup_first skew_profile
    win_row_number_global win_rank win_running_total win_moving_avg win_pct_of_total top_n_per_group
    sort_multi top_k word_count array_explode udf_price_category
    win_rank_hot_key win_running_total_hot_key csv_roundtrip_texts
    dynamic_overwrite partition_prune_multi gen_orders_fk_check
    stream_filter_project stream_window_append stream_upsert stream_category_stats
""".split()


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        spark = session(os.environ.get("BENCH_CPUS", "8"), scratch)
        times = {}
        for name in names:
            seconds(spark, name, sf_dir)
            times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
            print(f"{name} {times[name]}", file=sys.stderr)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
