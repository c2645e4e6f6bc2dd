"""Physical-plan properties that matter at scale (checked on sf0.001 plans):
partial top-k before the shuffle, partial aggregation, no cross joins or
nested-loop joins, no Python in batch plans, and pruned scans."""

import pytest

from logstream.plans.registry import all_queries
from conftest import SF_SMALL

QUERIES = all_queries()
BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_or_nested_loop_joins_and_no_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, (name, bad)


def test_top_k_uses_partial_window_group_limit(spark):
    plan = _plan(spark, "top_urls_per_window")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sessions_bound_candidates_before_shuffle(spark):
    plan = _plan(spark, "sessions_30m")
    assert plan.count("WindowGroupLimit") >= 2          # partial + final per bucket
    assert "partial_min" in plan and "partial_count" in plan


def test_scan_reads_only_needed_columns(spark):
    df = QUERIES["url_strict_counts"](spark, SF_SMALL)
    fmt = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(fmt)
    schema = [l for l in text.splitlines() if l.startswith("ReadSchema")][0]
    assert "value:double" not in schema      # events.value is not needed for URL counts


ONE_SCAN = [
    "parse_access_log", "url_strict_counts", "url_lenient_counts", "status_class_counts",
    "sliding_url_counts", "sliding_url_counts_event_time", "top_urls_per_window",
    "status_totals", "error_alarm", "agent_counts_per_interval", "requests_by_agent",
    "access_rows"]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_one_regex_per_line(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_filters_on_parsed_columns_do_not_copy_the_regex(spark):
    from logstream.functions.parse import parse_access_log
    from logstream.sources.fixtures import access_lines
    parsed = parse_access_log(access_lines(spark, SF_SMALL))
    for df in (parsed.where("matched"), parsed.where("ip is not null and status = 200"),
               parsed.where("event_time is not null").groupBy("agent").count()):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_latest_per_key_sorts_no_raw_rows(spark):
    plan = _plan(spark, "latest_by_ip")
    assert "HashAggregate(keys=[_top_key" in plan and "SortAggregate(keys=[_top_key" not in plan
