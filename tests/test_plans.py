"""Plan shapes that matter at scale: one exchange and three sorts for trailing
windows, partial aggregation, partial top-N, size-checked broadcasts."""

from __future__ import annotations

import pytest
from conftest import SF001

from tidemark.functions.columns import broadcast_if_small
from tidemark.operators import alerts as A
from tidemark.operators import candles as C
from tidemark.operators.marts import enrich, recent_per_asset
from tidemark.sources.fixtures import event_ticks, load


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_trailing_window_one_exchange(spark):
    df = A.multi_window_alerts(event_ticks(spark, SF001, hourly_ts=True), (3600, 21600), 1.0, 1800)
    plan = _plan(df)
    assert plan.count("Exchange") == 1
    assert "unboundedfollowing" not in plan.lower().replace("$()", "")  # growing frames only
    assert "_bk" in plan  # partitioned by (asset, time bucket), not by asset alone


def test_zscore_one_exchange(spark):
    plan = _plan(A.zscore_alerts(event_ticks(spark, SF001, hourly_ts=True), 21600, 2.0, 1800))
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("query", ["trailing_alerts", "trailing_alerts_multi_window", "zscore_alerts"])
def test_trailing_windows_sort_three_times(spark, query):
    from tidemark.plans.registry import QUERIES, load_all

    load_all()
    plan = _plan(QUERIES[query](spark, SF001))
    assert plan.count("Sort [") == 3 and plan.count("Exchange") == 1


def test_candles_partial_aggregate_and_pruned_scan(spark):
    plan = _plan(C.candles(event_ticks(spark, SF001), "5 minutes"))
    assert "partial_min_by" in plan and plan.count("Exchange") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan


def test_top_n_is_limited_before_the_exchange(spark):
    plan = _plan(recent_per_asset(event_ticks(spark, SF001), 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_broadcast_only_when_small(spark):
    orders = load(spark, SF001, "orders").select("o_orderkey", "o_custkey")
    cust = load(spark, SF001, "customer").select("c_custkey", "c_mktsegment") \
        .withColumnRenamed("c_custkey", "o_custkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(enrich(orders, cust, "o_custkey"))
        assert "BroadcastHashJoin" not in _plan(enrich(orders, cust, "o_custkey", broadcast_bytes=1))
        assert broadcast_if_small(cust, 1) is cust
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_per_key_limits_before_the_exchange(spark):
    from tidemark.operators.keyed import first_per_key
    li = load(spark, SF001, "lineitem")
    plan = _plan(first_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_the_plan_table_of_the_readme(spark):
    """Every row of it is what is planned now."""
    from pathlib import Path

    from conftest import SF01
    from plan_report import HEAD, rows

    readme = (Path(__file__).parent.parent / "README.md").read_text().split("\n")
    at = readme.index(HEAD) + 2
    table = readme[at : readme.index("", at)]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        assert rows(spark, SF01) == table
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
