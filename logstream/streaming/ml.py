"""Train on one stream and score another, batch by batch (trainOn +
predictOnValues).

The model is a few numbers; after every training micro-batch it is saved as
a one-row table ``model_dir/batch=<id>`` in shared storage.  Training batch
``b`` always starts from the newest model saved by a batch *before* ``b``, so
a replayed batch recomputes the same model (idempotent), and a restarted
query continues from the saved model.  The scoring stream uses the newest
saved model at the time its batch first runs, and writes it to
``out_dir/_models/batch=<id>`` before it scores: a batch that is run again, after
whatever training went on meanwhile, scores with the model it had.

Where results depend on what a batch holds, batches can be *blocks* of the data (``block``, a
column of block numbers): a micro-batch then holds any number of whole blocks, trains on one
after another and saves the model after each; a row is scored with the model of its block.  The
cost of a micro-batch (its start, its commit) is so not that of a block.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.online_ml import (KMeansState, LinRegState, blocks_of, kmeans_score,
                                   kmeans_train_batch, kmeans_train_blocks, linreg_score,
                                   linreg_train_batch, linreg_train_blocks, score_blocks)
from ..session import path_exists
from .sinks import newest_batch, run_batches

_KINDS_BY_NAME = {c.__name__: c for c in (LinRegState, KMeansState)}


_MODEL = "batch_id long, block long, model string"


def save_model(spark: SparkSession, model_dir: str, batch_id: int, state) -> None:
    save_models(spark, model_dir, batch_id, [(None, state)])


def save_models(spark: SparkSession, model_dir: str, batch_id: int, models: list[tuple]) -> None:
    """(block, model) pairs of one batch; block None: the model that all blocks start from."""
    rows = [(int(batch_id), block, json.dumps({"kind": type(state).__name__,
                                               "state": asdict(state)}))
            for block, state in models]
    spark.createDataFrame(rows, _MODEL).coalesce(1) \
        .write.mode("overwrite").json(f"{model_dir}/batch={batch_id}")


def load_models(spark: SparkSession, model_dir: str, before: int | None = None) -> list[tuple]:
    """(block, model) pairs of the newest batch with models (optionally one before ``before``),
    in order of the blocks.

    Reads one folder, whatever the number of batches before it."""
    newest = newest_batch(spark, model_dir, "batch", before)
    if newest is None:
        return []
    rows = spark.read.schema(_MODEL).json(f"{model_dir}/batch={newest}").collect()
    found = []
    for row in sorted(rows, key=lambda r: (r["block"] is not None, r["block"] or 0)):
        data = json.loads(row["model"])
        found.append((row["block"], _KINDS_BY_NAME[data["kind"]](**data["state"])))
    return found


def load_model(spark: SparkSession, model_dir: str, before: int | None = None):
    """Newest saved model (optionally from a batch before ``before``), or None."""
    models = load_models(spark, model_dir, before)
    return models[-1][1] if models else None


def train_stream(train: DataFrame, model_dir: str, checkpoint: str, initial,
                 features: str = "features", label: str = "label",
                 trigger: dict | None = None, block: Column | None = None) -> StreamingQuery:
    """Update the model with every non-empty training batch (trainOn), or with every block."""
    def step(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        state = load_model(spark, model_dir, before=batch_id) or initial
        if block is not None:
            df = df.withColumn("_block", block)
        df.persist()
        try:
            if df.isEmpty():
                return
            if block is not None:
                if isinstance(state, LinRegState):
                    models = linreg_train_blocks(df, state, "_block", features, label)
                else:
                    models = kmeans_train_blocks(df, state, "_block", features)
                save_models(spark, model_dir, batch_id, [(None, state), *models])
                return
            if isinstance(state, LinRegState):
                new = linreg_train_batch(df, state, features, label)
            else:
                new = kmeans_train_batch(df, state, features)
            save_model(spark, model_dir, batch_id, new)
        finally:
            df.unpersist()

    return run_batches(train, step, checkpoint, trigger)


def pinned_model(spark: SparkSession, model_dir: str, out_dir: str, batch_id: int, initial):
    """The model of a scoring batch: the one it is pinned to, else the newest, which it is
    pinned to from now on."""
    pins = f"{out_dir}/_models"
    if path_exists(spark, f"{pins}/batch={batch_id}/_SUCCESS"):
        return load_model(spark, pins, before=batch_id + 1)
    state = load_model(spark, model_dir) or initial
    save_model(spark, pins, batch_id, state)
    return state


def pinned_models(spark: SparkSession, model_dir: str, out_dir: str, batch_id: int, initial,
                  blocks: list[int]) -> list[tuple]:
    """(block, model) for the blocks of a scoring batch, pinned as by :func:`pinned_model`: the
    newest model of a block up to the row's own, of those of the last training batch."""
    pins = f"{out_dir}/_models"
    if not path_exists(spark, f"{pins}/batch={batch_id}/_SUCCESS"):
        found, at, named = load_models(spark, model_dir) or [(None, initial)], 0, []
        named.append((None, found[0][1]))
        for b in blocks:
            while at + 1 < len(found) and found[at + 1][0] <= b:
                at += 1
            named.append((b, found[at][1]))
        save_models(spark, pins, batch_id, named)
    return load_models(spark, pins, before=batch_id + 1)


def score_stream(test: DataFrame, model_dir: str, out_dir: str, checkpoint: str, initial,
                 features: str = "features", label: str | None = "label",
                 trigger: dict | None = None, block: Column | None = None) -> StreamingQuery:
    """Score every test batch with the newest model, or every row with that of its block
    (predictOnValues); results go to ``out_dir/batch_id=<id>`` (idempotent: a replayed batch
    keeps its models)."""
    def step(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if block is not None:
            df = df.withColumn("_block", block)
            df.persist()
            try:
                models = pinned_models(spark, model_dir, out_dir, batch_id, initial,
                                       blocks_of(df, "_block"))
                out = score_blocks(df, models, "_block", features, label).drop(features)
                out.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
            finally:
                df.unpersist()
            return
        state = pinned_model(spark, model_dir, out_dir, batch_id, initial)
        if isinstance(state, LinRegState):
            out = linreg_score(df, state, features).drop(features)
        else:
            out = kmeans_score(df, state, features, label)
        out.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return run_batches(test, step, checkpoint, trigger)


def train_and_score(train: DataFrame, test: DataFrame, initial, model_dir: str, out_dir: str,
                    checkpoint_root: str, features: str = "features", label: str = "label",
                    trigger: dict | None = None,
                    block: Column | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the training query, then the scoring query (two checkpoints)."""
    tq = train_stream(train, model_dir, f"{checkpoint_root}/train", initial, features, label,
                      trigger, block)
    if (trigger or {"availableNow": True}).get("availableNow"):
        tq.awaitTermination()   # train first within the interval, as the reference does
    sq = score_stream(test, model_dir, out_dir, f"{checkpoint_root}/score", initial, features,
                      label, trigger, block)
    return tq, sq
