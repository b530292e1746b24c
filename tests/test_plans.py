"""Physical-plan checks: no nested-loop or cartesian joins anywhere, scans
read only the needed columns, ranked output uses a partial group limit."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from viewtally.plans.catalog import QUERIES
from viewtally.sources import kafka as KF


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian(spark, name):
    p = plan_text(E.queries()[name](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_events_scan_is_pruned_and_filtered(spark):
    p = plan_text(E.queries()["trending_exact"](spark, SF001))
    assert "PushedFilters: [In(event_type" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p
    assert "value" not in p.split("ReadSchema:")[1].split(">")[0]


def test_top_k_uses_partial_window_group_limit(spark):
    p = plan_text(E.queries()["trending_top_k"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_kafka_options():
    o = KF.stream_options("b:9092", "prod", min_partitions=64)
    assert o["subscribe"] == "prod-pageview,prod-click,prod-order"
    assert o["minPartitions"] == "64" and o["kafka.bootstrap.servers"] == "b:9092"
    r = KF.range_options([{"topic": "t", "part": 0, "from_off": 100, "until_off": 250},
                          {"topic": "t", "part": 1, "from_off": 0, "until_off": 9}])
    assert r == {"startingOffsets": '{"t": {"0": 100, "1": 0}}',
                 "endingOffsets": '{"t": {"0": 250, "1": 9}}'}


def test_backfill_log_write_is_rebalanced(spark, tmp):
    from viewtally.functions import parse as P
    from viewtally.sinks import parquet as PS
    from viewtally.sources import messages as M
    rows = PS.with_log_day(P.log_rows(M.messages(spark, SF001, with_offsets=False)))
    plan = plan_text(rows.hint("rebalance", "metric", "log_day"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


SINGLE_SCAN = ["views_per_minute", "clicks_per_minute", "orders_per_minute", "video_views_per_minute",
               "video_views_per_hour", "visible_minute_counters", "batch_counts", "trending_exact",
               "trending_top_k", "active_users", "order_users", "uid_fallback", "expire_by_lex",
               "expire_by_score", "approx_active_users", "log_rows_per_day", "json_reject_split"]


@pytest.mark.parametrize("name", SINGLE_SCAN)
def test_metric_queries_scan_their_input_once(spark, name):
    """Branches that prune differently defeat exchange reuse and re-read the
    input; every metric query is one linear plan over one scan."""
    assert plan_text(E.queries()[name](spark, SF001)).count("FileScan") == 1
