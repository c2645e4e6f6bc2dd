"""Rankings batch by batch without history; scoring batches that keep their model."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logstream.operators.online_ml import LinRegState
from logstream.operators.windows import sliding_counts
from logstream.session import new_work_dir
from logstream.streaming.ml import load_model, score_stream, train_stream
from logstream.streaming.sinks import delete_folder
from logstream.streaming.windows import newest_window_top_k


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_top_k_of_every_batch_needs_the_last_one_only(spark):
    root = new_work_dir(spark, "top-test")
    rng = random.Random(3)
    seen, before = Counter(), {}
    for batch in range(8):
        rows = [(rng.choice(["a", "a", "b", "c", "d", "e", "f", None]),
                 1_000_000 + 40 * batch + rng.randint(-60, 60)) for _ in range(25)]
        spark.createDataFrame(rows, "url string, s long").select(
            "url", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode(
            "append").parquet(f"{root}/in")
        stream = spark.readStream.schema("url string, ts timestamp").parquet(f"{root}/in")
        counts = sliding_counts(stream.withWatermark("ts", "1 hour"), "url", "100 seconds",
                                "50 seconds", time_col="ts")
        newest_window_top_k(counts, "url", 3, f"{root}/top", f"{root}/cp",
                            f"{root}/changes").awaitTermination()
        for url, s in rows:
            first = s // 50 * 50
            seen.update([(first, url), (first - 50, url)])
        newest = max(w for w, _ in seen)
        best = sorted(((-n, u is not None, u or "", u) for (w, u), n in seen.items()
                       if w == newest))[:3]
        top = spark.read.parquet(f"{root}/top")
        done = top.agg(F.max("batch_id")).first()[0]
        got = {r["rank"]: (r["window_start"], r["url"], r["n"]) for r in
               top.where(F.col("batch_id") == done).withColumn(
                   "window_start", F.unix_seconds("window_start")).collect()}
        assert got == {i + 1: (newest, b[3], -b[0]) for i, b in enumerate(best)}
        now = {(w, u): r for r, (w, u, _) in got.items()}
        changed = {(r["w"], r["url"]): (r["rank"], r["previous_rank"]) for r in
                   spark.read.parquet(f"{root}/changes/batch_id={done}").withColumn(
                       "w", F.unix_seconds("window_start")).collect()}
        # the last batch of a run may bring no rows: its ranks are those of the one before
        last = {r["batch_id"] for r in top.select("batch_id").distinct().collect()}
        if len(last) == 1 or max(x for x in last if x != done) == before.get("id"):
            was = before.get("ranks", {})
            assert changed == {k: (now.get(k), was.get(k)) for k in now.keys() | was.keys()
                               if now.get(k) != was.get(k)}
        for old in last - {done}:
            delete_folder(spark, f"{root}/top/batch_id={old}")
        before = {"id": done, "ranks": now}


def test_a_replayed_scoring_batch_keeps_its_model(spark):
    root = new_work_dir(spark, "pin-test")
    schema = "features array<double>, label double"

    def land(name, slope):
        spark.createDataFrame([([x / 10], slope * x / 10) for x in range(20)], schema).coalesce(
            1).write.mode("append").parquet(f"{root}/{name}")

    def stream(name):
        return spark.readStream.schema(schema).parquet(f"{root}/{name}")

    def train():
        train_stream(stream("train"), f"{root}/model", f"{root}/cp/train",
                     LinRegState.zeros(1)).awaitTermination()

    def score():
        score_stream(stream("test"), f"{root}/model", f"{root}/scored", f"{root}/cp/score",
                     LinRegState.zeros(1)).awaitTermination()

    def scores():
        rows = spark.read.parquet(f"{root}/scored").collect()
        return sorted((r["batch_id"], r["label"], r["prediction"]) for r in rows)

    land("train", 2.0)
    land("test", 1.0)
    train()
    score()
    first, model = scores(), load_model(spark, f"{root}/model").weights
    delete_folder(spark, f"{root}/cp/score/commits")          # the batch ends without a commit
    delete_folder(spark, f"{root}/scored/batch_id=0")
    land("train", -3.0)
    train()
    assert load_model(spark, f"{root}/model").weights != model
    score()
    assert scores() == first                                  # run again, same model
    land("test", 1.0)
    score()
    later = [r for r in scores() if r[0] > 0]
    assert len(later) == 20 and [r[2] for r in later] != [r[2] for r in first]
