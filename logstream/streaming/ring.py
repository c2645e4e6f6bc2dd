"""Sliding-window counts kept incrementally in state: add the entering slice, subtract the
leaving one.

A slice (``slide`` long) lies in the windows that start in ``(slice - window, slice]``: its
count is added where the first of them starts and subtracted one slide after the last.  The
state of a key is the ring of its slices that are still in some open window, and the running
total of the last window put out.  When the watermark closes windows, the change points up to
the newest closed one are added to that total in order; each stretch of windows with one total
comes out once, as a *run* (first and last window start, count), in append mode.  So a row
costs one addition and one subtraction, whatever window / slide is; windows without rows of a
key cost nothing; and a key holds (window + watermark delay + time span of a batch) / slide
slices at most.

Before the shuffle every task sums its rows up by (key, slice), so a hot key reaches its state
function as at most that many rows from each task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.sessions import gap_micros
from ..operators.windows import DEFAULT_SLIDE, DEFAULT_WINDOW
from ..session import ship_package

_SLICES = "k string, at timestamp, slice long, n long"
_STATE = "done long, total long, slices array<long>, counts array<long>"
_RUNS = "k string, first_start long, last_start long, n long"
COMBINE_SLICES = 200_000     # (key, slice) sums a task holds before it passes them on


def _summed(slide: int):
    """Rows of a task to one row per key and slice; ``at`` is the newest of its rows."""
    def emit(held: pd.DataFrame) -> pd.DataFrame:
        return held.assign(at=pd.to_datetime(held["at"], unit="us"))[["k", "at", "slice", "n"]]

    def fn(frames):
        held = None
        for f in frames:
            t = f["t"].to_numpy(dtype="int64")
            part = pd.DataFrame({"k": f["k"].to_numpy(dtype=object), "slice": t - t % slide,
                                 "at": t, "n": 1})
            both = part if held is None else pd.concat([held, part])
            held = both.groupby(["k", "slice"], dropna=False, as_index=False, sort=False).agg(
                {"at": "max", "n": "sum"})
            held["k"] = held["k"].astype(object).where(held["k"].notna(), None)
            if len(held) >= COMBINE_SLICES:
                yield emit(held)
                held = None
        if held is not None and len(held):
            yield emit(held)
    return fn


def advance(done: int, total: int, slices: np.ndarray, counts: np.ndarray, last: int, window: int,
            slide: int) -> tuple[list[tuple[int, int, int]], int]:
    """Runs (first start, last start, count above 0) of the windows after ``done`` up to
    ``last``, and the count of window ``last``; ``total`` is that of window ``done``."""
    enter, leave = slices - window + slide, slices + slide
    at = np.concatenate([[done + slide], enter[enter > done], leave[leave > done]])
    change = np.concatenate([[total], counts[enter > done], -counts[leave > done]])
    points, where = np.unique(at, return_inverse=True)
    change = np.bincount(where, change, len(points)).astype(np.int64)
    here = points <= last
    points, sums = points[here], np.cumsum(change[here])
    ends = np.append(points[1:], last + slide) - slide
    runs = [(int(a), int(b), int(n)) for a, b, n in zip(points, ends, sums) if n > 0]
    return runs, int(sums[-1]) if len(sums) else total


def _ring(window: int, slide: int):
    def fn(key, frames, state):
        done, total, slices, counts = None, 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        if state.exists:
            done, total, held, n = state.get
            slices, counts = np.array(held, np.int64), np.array(n, np.int64)
        if not state.hasTimedOut:
            for f in frames:
                slices = np.concatenate([slices, f["slice"].to_numpy(dtype="int64")])
                counts = np.concatenate([counts, f["n"].to_numpy(dtype="int64")])
            slices, where = np.unique(slices, return_inverse=True)
            counts = np.bincount(where, counts, len(slices)).astype(np.int64)
        now = state.getCurrentWatermarkMs() * 1000
        if len(slices):
            before = int(slices[0]) - window           # the last window without the first slice
            # an older slice than those held: nothing can have been put out yet
            done = before if done is None else min(done, before) if total == 0 else done
        last = (now - window) // slide * slide
        runs = []
        if len(slices) and last > done:
            runs, total = advance(done, total, slices, counts, last, window, slide)
            done = last
            stay = slices + slide > done
            slices, counts = slices[stay], counts[stay]
        if len(slices):
            state.update((done, total, slices.tolist(), counts.tolist()))
            points = np.concatenate([slices - window + slide, slices + slide])
            state.setTimeoutTimestamp(int(points[points > done].min() + window) // 1000 + 1)
        else:
            state.remove()
        if runs:
            yield pd.DataFrame({"k": [key[0]] * len(runs), "first_start": [r[0] for r in runs],
                                "last_start": [r[1] for r in runs], "n": [r[2] for r in runs]})
    return fn


def sliding_runs_stream(rows: DataFrame, key: str, window: str = DEFAULT_WINDOW,
                        slide: str = DEFAULT_SLIDE, time_col: str = "event_time",
                        watermark: str = "10 minutes") -> DataFrame:
    """Closed runs of a streaming frame (append mode): key, first_start, last_start
    (TIMESTAMP, starts of the first and last window with that count), n.  Rows without a time
    are dropped; a NULL key is a key."""
    w, s = gap_micros(window), gap_micros(slide)
    if w % s:
        raise ValueError("the window must be a multiple of the slide")
    ship_package(rows.sparkSession)
    narrow = rows.where(F.col(time_col).isNotNull()).select(
        F.col(key).cast("string").alias("k"),
        F.unix_micros(F.col(time_col).cast("timestamp")).alias("t"))
    slices = narrow.mapInPandas(_summed(s), _SLICES)
    runs = slices.withWatermark("at", watermark).groupBy("k").applyInPandasWithState(
        _ring(w, s), _RUNS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return _named(runs, key)


def _named(runs: DataFrame, key: str) -> DataFrame:
    return runs.select(F.col("k").alias(key), F.timestamp_micros("first_start").alias("first_start"),
                       F.timestamp_micros("last_start").alias("last_start"), "n")


def open_runs(spark: SparkSession, checkpoint: str, key: str, window: str = DEFAULT_WINDOW,
              slide: str = DEFAULT_SLIDE, batch_id: int | None = None) -> DataFrame:
    """Runs of the windows that the stream has not closed, from its state: as closed ones."""
    w, s = gap_micros(window), gap_micros(slide)
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    held = reader.load(checkpoint).select(F.col("key.k").alias("k"), "value.groupState.*")
    ring = F.arrays_zip("slices", "counts")
    enter = F.transform(ring, lambda x: F.struct((x["slices"] - w + s).alias("p"),
                                                 x["counts"].alias("d")))
    leave = F.transform(ring, lambda x: F.struct((x["slices"] + s).alias("p"),
                                                 (-x["counts"]).alias("d")))
    first = F.array(F.struct((F.col("done") + s).alias("p"), F.col("total").alias("d")))
    points = held.select("k", "done", F.explode(F.concat(first, enter, leave)).alias("x")) \
        .where(F.col("x.p") > F.col("done")).groupBy("k", F.col("x.p").alias("p")).agg(
        F.sum("x.d").alias("d"))
    in_order = W.partitionBy("k").orderBy("p")           # a key's open points: bounded
    runs = points.select("k", F.col("p").alias("first_start"),
                         (F.lead("p").over(in_order) - s).alias("last_start"),
                         F.sum("d").over(in_order).alias("n")).where("n > 0")
    return _named(runs, key)


def run_windows(runs: DataFrame, slide: str = DEFAULT_SLIDE) -> DataFrame:
    """One row per window of the runs: ``window_start`` (TIMESTAMP) in place of the run's."""
    step = F.lit(gap_micros(slide))
    starts = F.explode(F.sequence(F.unix_micros("first_start"), F.unix_micros("last_start"), step))
    rest = [c for c in runs.columns if c not in ("first_start", "last_start")]
    return runs.select(*rest, starts.alias("window_start")).withColumn(
        "window_start", F.timestamp_micros("window_start"))
