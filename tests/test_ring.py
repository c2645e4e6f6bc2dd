"""Incremental sliding counts: every window against brute force, bounded state, restarts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logstream.session import new_work_dir
from logstream.streaming.ring import advance, open_runs, run_windows, sliding_runs_stream

S = 1_000_000


def brute(rows, window, slide):
    """(key, window start) -> rows, starts from the first to the last window with rows."""
    out = Counter()
    for key, t in rows:
        w = t - t % slide
        while w > t - window:
            out[key, w] += 1
            w -= slide
    return out


def test_totals_advance_by_entering_and_leaving_slices():
    rng = random.Random(1)
    for _ in range(200):
        slide = rng.choice([1, 5])
        window = slide * rng.randint(1, 12)
        n = rng.randint(1, 30)
        times = sorted(rng.randrange(0, 200) // slide * slide for _ in range(n))
        slices, counts = np.unique(np.array(times), return_counts=True)
        want = brute([("k", t) for t in times], window, slide)
        got, done, total = {}, int(slices[0]) - window, 0
        while done < int(slices[-1]):
            last = done + slide * rng.randint(1, 20)
            live = slices + slide > done
            runs, total = advance(done, total, slices[live], counts[live], last, window, slide)
            for a, b, k in runs:
                for w in range(a, b + 1, slide):
                    assert w not in got
                    got[w] = k
            done = last
        assert {("k", w): k for w, k in got.items()} == dict(want)


@pytest.fixture()
def landed(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    root = new_work_dir(spark, "ring-test")

    def add(rows, watermark):
        df = spark.createDataFrame(rows, "url string, t long")
        df.select("url", F.timestamp_micros("t").alias("ts")).coalesce(2).write.mode(
            "append").parquet(f"{root}/in")
        stream = spark.readStream.schema("url string, ts timestamp").parquet(f"{root}/in")
        runs = sliding_runs_stream(stream, "url", "60 seconds", "2 seconds", "ts", watermark)
        runs.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
    yield root, add
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_equals_brute_force_over_batches_with_a_hot_key(spark, landed):
    root, add = landed
    rng = random.Random(7)
    t, rows = 10_000 * S, []
    for i in range(2400):
        t += rng.choice([0, 0, S // 2, S, 4 * S])
        if i % 800 == 400:
            t += 500 * S                                   # a gap longer than the window
        rows.append((rng.choice(["hot", "hot", "hot", "b", "c", None]), t + rng.randrange(S)))
    for a in range(0, 2400, 600):
        part = rows[a:a + 600]
        rng.shuffle(part)
        add(part, "20 seconds")
        held = spark.read.format("statestore").load(f"{root}/cp").select(
            F.size("value.groupState.slices").alias("n"))
        # window and delay, in slides; one for the slice that the watermark cuts
        assert held.agg(F.max("n")).first()[0] <= (60 + 20) // 2 + 2
    opened = open_runs(spark, f"{root}/cp", "url", "60 seconds", "2 seconds")
    closed = spark.read.parquet(f"{root}/out")
    assert opened.count() and closed.count()
    got = {(r["url"], r["s"]): r["n"] for r in run_windows(closed.unionByName(opened), "2 seconds")
           .select("url", F.unix_micros("window_start").alias("s"), "n").collect()}
    want = brute(rows, 60 * S, 2 * S)
    assert got == dict(want)
    assert sum(1 for _ in got) == run_windows(closed.unionByName(opened), "2 seconds").count()


def test_window_must_be_a_multiple_of_the_slide(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="multiple"):
        sliding_runs_stream(stream, "value", "5 seconds", "2 seconds", "timestamp")
