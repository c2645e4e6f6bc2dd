"""Sliding counts (both strategies) against brute force; top-k; alarm rule."""

import datetime as dt
import random

from pyspark.sql import functions as F

from logstream.operators.alarm import error_alarm
from logstream.operators.windows import sliding_counts, top_k


def _rows(n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    keys = ["/a", "/b", "/c", "/hot"]
    return [(base + dt.timedelta(seconds=rnd.randint(0, 3600)),
             "/hot" if rnd.random() < 0.4 else rnd.choice(keys)) for _ in range(n)]


def brute(rows, window, slide):
    out = {}
    for t, k in rows:
        s = int(t.replace(tzinfo=dt.timezone.utc).timestamp())
        last = s - s % slide
        start = last
        while start > s - window:
            out[(start, k)] = out.get((start, k), 0) + 1
            start -= slide
    return out


def test_sliding_counts_strategies_equal_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "event_time timestamp, url string")
    for window, slide in [(300, 60), (300, 1), (120, 30)]:
        expect = brute(rows, window, slide)
        for strategy in ("direct", "two_step", "runs"):
            got = sliding_counts(df, "url", f"{window} seconds", f"{slide} seconds",
                                 strategy=strategy)
            got = {(int(r["s"]), r["url"]): r["n"] for r in got.select(
                F.unix_seconds(F.col("window.start")).alias("s"), "url", "n").collect()}
            assert got == expect, (window, slide, strategy)
    # sum over windows of one slide = rows x (window/slide)
    total = sum(v for v in brute(rows, 300, 60).values())
    assert total == len(rows) * 5


def test_runs_with_small_time_chunks(spark):
    """Carried-in offsets across time chunks give the same counts (chunk of
    90 s, far smaller than the 300 s window, with a hot key)."""
    from logstream.operators.windows import _sliding_runs
    rows = _rows(500, seed=9)
    df = spark.createDataFrame(rows, "event_time timestamp, url string")
    got = _sliding_runs(df, ["url"], {"n": F.lit(1)}, 300_000_000, 10_000_000, "event_time",
                        chunk_us=90_000_000)
    got = {(int(r["s"]), r["url"]): r["n"] for r in got.select(
        F.unix_seconds(F.col("window.start")).alias("s"), "url", "n").collect()}
    assert got == brute(rows, 300, 10)


def test_sliding_from_slices_equals_brute_force(spark):
    from logstream.operators.windows import counts_per_interval, sliding_from_slices
    rows = _rows(400, seed=4)
    df = spark.createDataFrame(rows, "event_time timestamp, url string")
    per = counts_per_interval(df, "url", "10 seconds", count_col="n").select(
        F.col("window.start").alias("slice_start"), "url", "n")
    got = sliding_from_slices(per, "url", "300 seconds", "10 seconds")
    got = {(int(r["s"]), r["url"]): r["n"] for r in got.select(
        F.unix_seconds(F.col("window.start")).alias("s"), "url", "n").collect()}
    assert got == brute(rows, 300, 10)


def test_top_k_per_window_and_ties(spark):
    df = spark.createDataFrame([(0, "b", 3), (0, "a", 3), (0, "c", 1), (1, "z", 5)],
                               "window_start long, url string, n long")
    got = top_k(df, "url", k=2, per="window_start").orderBy("window_start", "rank").collect()
    assert [(r["window_start"], r["url"], r["rank"]) for r in got] == [(0, "a", 1), (0, "b", 2),
                                                                      (1, "z", 1)]
    overall = top_k(df, "url", k=1, per=None).collect()
    assert overall[0]["url"] == "z"


def test_alarm_rule_boundaries(spark):
    rows = [(1, 50, 50), (2, 60, 41), (3, 70, 34), (4, 66, 34), (5, 0, 101), (6, 0, 0),
            (7, 100, 1)]
    df = spark.createDataFrame(rows, "w int, success long, failure long")
    got = {r["w"]: (r["state"], r["ratio"]) for r in error_alarm(df).collect()}
    assert got[1][0] == "insufficient"           # exactly 100 events
    assert got[2][0] == "alarm"                  # 101 events, 41 > 30
    assert got[3][0] == "ok" and abs(got[3][1] - 34 / 70) < 1e-12
    assert got[4][0] == "insufficient"           # 66 + 34 = 100
    assert got[5] == ("alarm", None)             # zero successes alarms, ratio NULL
    assert got[6] == ("insufficient", None)
    assert got[7][0] == "ok"
    # ratio exactly 0.5 is not an alarm
    r = error_alarm(spark.createDataFrame([(100, 50)], "success long, failure long")).first()
    assert r["state"] == "ok" and r["ratio"] == 0.5


def test_windows_without_traffic_are_reported_as_zeros(spark):
    from logstream.operators.windows import status_runs, status_totals
    base = dt.datetime(1969, 12, 31, 23, 0)
    rows = [(base, "Success"), (base + dt.timedelta(hours=3), "Failure")]
    df = spark.createDataFrame(rows, "ts timestamp, status_class string")
    full = status_totals(df, "10 minutes", "5 minutes", time_col="ts", fill=True).collect()
    got = {r["window"]["start"]: (r["success"], r["failure"], r["other"]) for r in full}
    starts = [base - dt.timedelta(minutes=5) + dt.timedelta(minutes=5 * i) for i in range(38)]
    assert sorted(got) == starts
    assert [got[s] for s in starts] == [(1, 0, 0)] * 2 + [(0, 0, 0)] * 34 + [(0, 1, 0)] * 2
    runs = status_runs(df, "10 minutes", "5 minutes", time_col="ts").collect()
    assert sorted((r["first_start"], r["last_start"], r["success"], r["failure"]) for r in runs) == [
        (starts[0], starts[1], 1, 0), (starts[2], starts[35], 0, 0), (starts[36], starts[37], 0, 1)]


def test_wide_expansion_on_a_stream_must_be_named(spark, workdir):
    import pytest
    spark.createDataFrame([(dt.datetime(2024, 1, 1), "/a")], "ts timestamp, url string") \
        .write.parquet(f"{workdir}/in")
    s = spark.readStream.schema("ts timestamp, url string").parquet(f"{workdir}/in")
    with pytest.raises(ValueError, match="keep_slice_counts"):
        sliding_counts(s, "url", "300 seconds", "1 second", time_col="ts")
