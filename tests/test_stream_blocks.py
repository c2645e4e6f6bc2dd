"""Streams whose batches are blocks of a key: rows without a key, empty tables."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logstream.operators import online_ml
from logstream.plans import stream_queries
from logstream.plans.registry import all_queries, all_sql
from logstream.streaming.ml import train_and_score
from logstream.streaming.sinks import running_totals
from oracle_harness import compare

EMPTY = ["stream_text_until_limit", "stream_linreg_train_score", "stream_kmeans_train_score"]


def test_texts_without_a_conversation_are_written_once(spark, tmp_path):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    odd = turns.limit(7).withColumns({"conv_id": F.lit(None).cast("long"), "text": F.lit("lost")})
    turns.unionByName(odd).write.parquet(f"{tmp_path}/conversations.parquet")
    got = all_queries()["stream_text_until_limit"](spark, str(tmp_path))
    assert got.where("value = 'lost'").count() == 7
    assert got.count() == 7 + all_queries()["stream_text_until_limit"](spark, SF_SMALL).count()


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table(spark, tmp_path, name):
    for t in ("events", "conversations"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{t}.parquet")
    got = all_queries()[name](spark, str(tmp_path))
    assert got.count() == 0
    assert got.dtypes == all_queries()[name](spark, SF_SMALL).dtypes


@pytest.fixture(scope="module")
def many_blocks(spark, tmp_path_factory):
    """Events and conversations whose ids spread over 24 blocks and over 60."""
    root = str(tmp_path_factory.mktemp("blocks"))
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    spread = (F.col("event_id") % 24 * 4_000 + F.floor(F.col("event_id") / 24)).cast("long")
    events.withColumn("event_id", spread).write.parquet(f"{root}/events.parquet")
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    turns = turns.crossJoin(spark.range(60)).withColumn(
        "conv_id", F.col("id") * 32 + F.col("conv_id") % 32).drop("id")
    turns.write.parquet(f"{root}/conversations.parquet")
    return root


@pytest.mark.parametrize("name", ["stream_linreg_train_score", "stream_kmeans_train_score"])
def test_blocks_share_a_query_start(spark, many_blocks, monkeypatch, name):
    starts = []

    def counted(*args, **options):
        starts.append(1)
        return train_and_score(*args, **options)

    monkeypatch.setattr(stream_queries, "train_and_score", counted)
    monkeypatch.setattr(stream_queries, "PIECE_BLOCKS", 9, raising=False)
    monkeypatch.setattr(online_ml, "WINDOW", 5, raising=False)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{many_blocks}/events.parquet/*.parquet'")
    res = compare(spark, con, all_queries()[name], all_sql()[name], many_blocks)
    assert res["ok"], res
    assert len(starts) == 3


def test_batches_after_the_limit_do_not_follow_the_blocks(spark, many_blocks, monkeypatch):
    folders = []

    class Run(stream_queries._Run):
        def __init__(self, *args):
            super().__init__(*args)
            folders.append(self.out)

    monkeypatch.setattr(stream_queries, "_Run", Run)
    got = all_queries()["stream_text_until_limit"](spark, many_blocks)
    turns = spark.read.parquet(f"{many_blocks}/conversations.parquet")
    want = turns.select(F.explode(F.split("text", "\n")).alias("value"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    first = turns.groupBy(F.floor(F.col("conv_id") / 32).alias("b")).count().orderBy("b").first()[1]
    batches = running_totals(spark, folders[0]).orderBy("batch_id").collect()
    assert batches[0]["rows"] == first                 # a block before the limit
    assert len(batches) <= 2 + 200 // first            # those up to the limit, then one


@pytest.mark.parametrize("window", [1, 7])
def test_blocks_trained_together_equal_one_after_another(spark, monkeypatch, window):
    monkeypatch.setattr(online_ml, "WINDOW", window)
    rnd = random.Random(5)
    rows = [(rnd.choice([2, 3, 7, 8, 9, 15, 21, 22, 23, 40]),
             [rnd.gauss(j % 3, 0.8), rnd.gauss(j % 2, 0.8)]) for j in range(600)]
    rows += [(30, None), (30, [1.0, None]), (None, [0.0, 0.0])]    # a block without a usable row
    df = spark.createDataFrame(rows, "block long, features array<double>")
    start = online_ml.KMeansState.random(3, 2, weight=1.0)
    want, state = [], start
    for b in sorted({r[0] for r in rows if r[0] is not None}):
        state = online_ml.kmeans_train_batch(df.where(F.col("block") == b), state)
        want.append((b, state))
    got = online_ml.kmeans_train_blocks(df, start, "block")
    assert [b for b, _ in got] == [b for b, _ in want]
    for (_, a), (_, b) in zip(got, want):
        assert a.batches == b.batches and a.weights == pytest.approx(b.weights, rel=1e-12)
        for x, y in zip(a.centers, b.centers):
            assert x == pytest.approx(y, abs=1e-12)


def test_scoring_names_a_model_for_every_block(spark, workdir):
    from logstream.streaming.ml import load_models, pinned_models, save_models
    states = [online_ml.LinRegState([float(i)], 0.0) for i in range(4)]
    save_models(spark, f"{workdir}/model", 0, list(zip([None, 3, 4, 8], states)))
    named = pinned_models(spark, f"{workdir}/model", f"{workdir}/out", 0, states[0], [1, 3, 6, 9])
    assert [(b, m.weights[0]) for b, m in named] == [(None, 0.0), (1, 0.0), (3, 1.0), (6, 2.0),
                                                     (9, 3.0)]
    save_models(spark, f"{workdir}/model", 1, [(None, states[3])])      # later training
    assert pinned_models(spark, f"{workdir}/model", f"{workdir}/out", 0, states[0],
                         [1, 3, 6, 9]) == named
    assert load_models(spark, f"{workdir}/none") == []
    rows = spark.createDataFrame([(1, [2.0]), (6, [2.0]), (None, [2.0]), (7, [2.0]), (9, None)],
                                 "_block long, features array<double>")
    got = online_ml.score_blocks(rows, named, "_block").collect()
    assert sorted((r["prediction"] is None, r["prediction"] or 0.0) for r in got) == [
        (False, 0.0), (False, 4.0), (True, 0.0), (True, 0.0), (True, 0.0)]
