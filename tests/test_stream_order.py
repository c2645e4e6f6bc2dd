"""Streams over tables of many files whose order is not the order of time."""

import pytest

from conftest import SF_SMALL
from logstream.plans.registry import all_queries, all_sql
from logstream.plans.stream_queries import MAX_FILES, disorder
from oracle_harness import compare, duck

TIMED = ["stream_sliding_url_counts", "stream_sliding_url_counts_1s", "stream_top_urls",
         "stream_top_urls_newest", "stream_error_alarm", "stream_error_alarm_1s",
         "stream_sessions"]


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """The events in more than two batches of files, each over the whole time span."""
    root = str(tmp_path_factory.mktemp("scattered"))
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(2 * MAX_FILES + 8, "event_id").write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", TIMED)
def test_no_row_is_late(spark, scattered, name):
    res = compare(spark, duck(SF_SMALL), all_queries()[name], all_sql()[name], scattered)
    assert res["ok"], res


def test_disorder_of_files(spark, scattered, tmp_path):
    events = spark.read.parquet(f"{scattered}/events.parquet")
    assert disorder(events) > 20 * 86_400
    assert disorder(events, max_files=1_000) == 0
    assert disorder(spark.read.parquet(f"{SF_SMALL}/events.parquet")) == 0
