"""Registered batch queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (``events``, ``conversations``) through
the fixture derivations, over whole tables.  Output conventions for the
DuckDB oracle: times as epoch-second BIGINT, lists joined by a blank, doubles
rounded to 6 digits, every computed column aliased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse_access_log, with_status_class
from ..operators.alarm import alarms, error_alarm
from ..operators.latest import latest_by_key
from ..operators.records import to_access_rows, to_clicks, to_requests, to_urls
from ..operators.sessions import sessionize
from ..operators.windows import (counts_per_interval, rank_counts, sliding_counts, status_runs,
                                 status_totals, top_k)
from ..session import write_once
from ..sources.fixtures import access_lines, status_json, table
from ..sources.lines import status_texts

# Parameters of the registered queries (FIXTURES.md part 3).
URL_WINDOW, URL_SLIDE = "300 seconds", "60 seconds"
TOP_WINDOW, TOP_SLIDE = "1 day", "6 hours"       # windows with more than 10 URLs
ALARM_WINDOW, ALARM_SLIDE = "1 day", "6 hours"
AGENT_INTERVAL = "1 hour"
TOP_K = 10


def epoch_s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_seconds(c)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(access_lines(spark, sf_dir))


def _win(df: DataFrame) -> list[Column]:
    return [epoch_s(F.col("window.start")).alias("window_start"),
            epoch_s(F.col("window.end")).alias("window_end")]


def q_parse_access_log(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.select("event_id", "value", "matched", "ip", "client", "user", "ts_raw",
                    epoch_s("event_time").alias("event_time_s"), "request", "status",
                    "bytes", "referer", "agent")


def q_url_strict_counts(spark, sf_dir):
    return to_urls(_parsed(spark, sf_dir)).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def q_url_lenient_counts(spark, sf_dir):
    return to_requests(_parsed(spark, sf_dir)).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def q_status_class_counts(spark, sf_dir):
    return (with_status_class(_parsed(spark, sf_dir))
            .groupBy("status_class").agg(F.count(F.lit(1)).alias("n")))


def _url_counts(spark, sf_dir):
    urls = to_urls(_parsed(spark, sf_dir), carry=["ts"])
    return sliding_counts(urls, "url", URL_WINDOW, URL_SLIDE, time_col="ts")


def q_sliding_url_counts(spark, sf_dir):
    c = _url_counts(spark, sf_dir)
    return c.select(*_win(c), "url", "n")


def q_sliding_url_counts_1s(spark, sf_dir):
    """The reference's own parameters: 300 s windows sliding every second."""
    urls = to_urls(_parsed(spark, sf_dir), carry=["ts"])
    c = sliding_counts(urls, "url", URL_WINDOW, "1 second", time_col="ts")
    return c.select(*_win(c), "url", "n")


def q_sliding_url_counts_event_time(spark, sf_dir):
    """Windows over the log's own time (event-time mode): lines that do not
    parse have no time and are left out."""
    urls = to_urls(_parsed(spark, sf_dir), carry=["event_time"])
    c = sliding_counts(urls, "url", URL_WINDOW, URL_SLIDE, time_col="event_time")
    return c.select(*_win(c), "url", "n")


def q_top_urls_per_window(spark, sf_dir):
    urls = to_urls(_parsed(spark, sf_dir), carry=["ts"])
    c = sliding_counts(urls, "url", TOP_WINDOW, TOP_SLIDE, time_col="ts")
    c = c.select(*_win(c), "url", "n")
    return top_k(c, "url", TOP_K, per="window_start")


def q_top_urls_overall(spark, sf_dir):
    return top_k(q_url_strict_counts(spark, sf_dir), "url", TOP_K, per=None)


def q_url_ranking(spark, sf_dir):
    """All URLs in rank order; the sorted frame also carries its order as a column."""
    ranked = rank_counts(q_url_strict_counts(spark, sf_dir), "url")
    return ranked.select("url", "n")


def _status_totals(spark, sf_dir):
    classified = with_status_class(_parsed(spark, sf_dir))
    return status_totals(classified, ALARM_WINDOW, ALARM_SLIDE, time_col="ts")


def q_status_totals(spark, sf_dir):
    t = _status_totals(spark, sf_dir)
    return t.select(*_win(t), "success", "failure", "other")


def q_error_alarm(spark, sf_dir):
    a = error_alarm(_status_totals(spark, sf_dir))
    return a.select(*_win(a), "success", "failure", F.round("ratio", 6).alias("ratio"), "state")


def q_alarms(spark, sf_dir):
    """Only the windows that raise an alarm."""
    a = alarms(_status_totals(spark, sf_dir))
    return a.select(*_win(a), "success", "failure", F.round("ratio", 6).alias("ratio"))


def q_status_totals_filled(spark, sf_dir):
    """Windows of 1 hour every 10 minutes; those without traffic are 0 / 0 / 0."""
    t = status_totals(with_status_class(_parsed(spark, sf_dir)), "1 hour", "10 minutes",
                      time_col="ts", fill=True)
    return t.select(*_win(t), "success", "failure", "other")


def q_status_totals_1s(spark, sf_dir):
    """The reference's 300 s / 1 s totals with the alarm state, one row per run of windows
    with equal totals; windows without traffic are runs of 0 / 0 / 0."""
    t = error_alarm(status_runs(with_status_class(_parsed(spark, sf_dir)), URL_WINDOW, "1 second",
                                time_col="ts"))
    return t.select(epoch_s("first_start").alias("first_start"),
                    epoch_s("last_start").alias("last_start"), "success", "failure", "other",
                    F.round("ratio", 6).alias("ratio"), "state")


def q_agent_counts_per_interval(spark, sf_dir):
    req = to_requests(_parsed(spark, sf_dir), carry=["ts"])
    c = counts_per_interval(req, "agent", AGENT_INTERVAL, time_col="ts")
    return c.select(epoch_s(F.col("window.start")).alias("window_start"), "agent", "total")


def q_requests_by_agent(spark, sf_dir):
    # Q1: any SQL over the requests table, given as a parameter: no view is left behind
    return spark.sql("select agent, count(*) as total from {requests} group by agent",
                     requests=to_requests(_parsed(spark, sf_dir)))


def q_access_rows(spark, sf_dir):
    return to_access_rows(_parsed(spark, sf_dir), carry=["event_id"])


def _sessions(spark, sf_dir, gap):
    # sessionize reads its input twice: parse once into a narrow table
    clicks = write_once(to_clicks(_parsed(spark, sf_dir), carry=["event_id", "ts"]), "clicks")
    s = sessionize(clicks, gap=gap, max_clicks=10, key="ip", time_col="ts")
    return s.select("ip", epoch_s("session_start").alias("session_start"),
                    epoch_s("session_end").alias("session_end"), "session_length",
                    F.array_join("clickstream", " ").alias("clickstream"))


def q_sessions_30m(spark, sf_dir):
    return _sessions(spark, sf_dir, "30 minutes")


def q_sessions_2d_first10(spark, sf_dir):
    return _sessions(spark, sf_dir, "2 days")


def q_latest_by_ip(spark, sf_dir):
    rows = to_access_rows(_parsed(spark, sf_dir), carry=["event_id", "ts"])
    latest = latest_by_key(rows, "ip", order_by=["ts", "event_id"],
                           value_cols=["event_id", "url", "status", "agent"])
    return latest


def q_status_texts(spark, sf_dir):
    statuses = status_json(table(spark, sf_dir, "conversations"))
    return status_texts(statuses, carry=["conv_id", "turn"])


BATCH_QUERIES = {
    "parse_access_log": q_parse_access_log,
    "url_strict_counts": q_url_strict_counts,
    "url_lenient_counts": q_url_lenient_counts,
    "status_class_counts": q_status_class_counts,
    "sliding_url_counts": q_sliding_url_counts,
    "sliding_url_counts_1s": q_sliding_url_counts_1s,
    "sliding_url_counts_event_time": q_sliding_url_counts_event_time,
    "top_urls_per_window": q_top_urls_per_window,
    "top_urls_overall": q_top_urls_overall,
    "url_ranking": q_url_ranking,
    "alarms": q_alarms,
    "status_totals_filled": q_status_totals_filled,
    "status_totals_1s": q_status_totals_1s,
    "status_totals": q_status_totals,
    "error_alarm": q_error_alarm,
    "agent_counts_per_interval": q_agent_counts_per_interval,
    "requests_by_agent": q_requests_by_agent,
    "access_rows": q_access_rows,
    "sessions_30m": q_sessions_30m,
    "sessions_2d_first10": q_sessions_2d_first10,
    "latest_by_ip": q_latest_by_ip,
    "status_texts": q_status_texts,
}
