"""Plans of registered queries: what reaches the scan, what is shuffled, sorted results."""

import pytest

import __spark_entry__
from brindle.operators.layout import plan_text
from brindle.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _plan(spark, name):
    return plan_text(QUERIES[name](spark, SF_DIR))


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["country", "order_count", "total_revenue"]
    assert 0 < len(result.collect()) <= 10


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "filter_gt")
    assert "GreaterThan(o_totalprice,250000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_year_and_status_prune_directories(spark):
    plan = _plan(spark, "partition_prune_multi")
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "o_year" in filters and "o_orderstatus" in filters


def test_case_and_udf(spark):
    assert "ArrowEvalPython" not in _plan(spark, "case_when")
    assert "ArrowEvalPython" in _plan(spark, "udf_price_category")


@pytest.mark.parametrize("name", ["top_k", "sql_revenue_by_country", "user_spending", "top3_users_by_orders"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in _plan(spark, name)


@pytest.mark.parametrize("name", ["top_n_per_group", "dedup_first", "second_highest_per_user"])
def test_groups_are_limited_on_the_map_side(spark, name):
    plan = _plan(spark, name)
    assert plan.count("WindowGroupLimit") >= 2


def test_split_windows_do_not_gather_the_table(spark):
    for name in ("win_running_total_hot_key", "win_change_hot_key", "win_row_number_hot_key"):
        assert "SinglePartition" not in _plan(spark, name), name


def test_bucketed_join_has_no_shuffle(spark):
    plan = _plan(spark, "bucketed_join")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


SORTED = {
    "sort_desc": lambda r: (-r["o_totalprice"], r["o_orderkey"]),
    "sort_multi": lambda r: (r["o_orderdate"], r["o_orderkey"]),
    "top_k": lambda r: (-r["o_totalprice"], r["o_orderkey"]),
    "filter_sort": lambda r: (-r["p_retailprice"], r["p_partkey"]),
    "agg_dict": lambda r: -r["total"],
    "sql_having": lambda r: -r["avg_price"],
    "word_count": lambda r: (-r["count"], r["word"].encode()),
    "skew_profile": lambda r: (-r["count"], r["user_id"]),
    "sql_revenue_by_country": lambda r: (-r["total_revenue"], r["country"]),
    "stream_category_stats": lambda r: -r["total_value"],
}


@pytest.mark.parametrize("name", SORTED)
def test_sorted_results_are_sorted(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows == sorted(rows, key=SORTED[name])


def test_queries_leave_the_session_alone(spark):
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    views = {t.name for t in spark.catalog.listTables()}
    for name in ("sql_where", "dynamic_overwrite", "bucketed_join", "join_sort_merge", "cached_reuse"):
        QUERIES[name](spark, SF_DIR).collect()
    assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before
    assert {t.name for t in spark.catalog.listTables()} == views
