"""Streaming sessions per key with keyed state and an idle timeout.

The state of a key is a short list of *segments*: maximal runs of its clicks
in which consecutive clicks are at most ``gap`` apart, each with start, end,
count and its first ``max_clicks`` (time, tie, url) entries.  Two segments join
when they are at most ``gap`` apart, so rows may arrive in any order within the
watermark and the sessions still equal the batch result.  A segment is final
once the watermark passes ``end + gap`` (no later row can reach it): it is
emitted and dropped; an event-time timeout at the earliest such point wakes
idle keys.

Before the shuffle every task cuts its rows into segments per key (a map-side
combine, COMBINE_ROWS rows at a time), so what reaches a key's state function in a micro-batch
is at most (tasks + rows / COMBINE_ROWS) x (batch time span / gap) segments of ``max_clicks``
entries, whatever the key's row rate.  Between batches a key holds at most (watermark delay + gap) /
gap segments; while a batch is folded in, also those of the batch's time span.
A segment is late as a whole, when its end is before the watermark.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.sessions import DEFAULT_GAP, DEFAULT_MAX_CLICKS, gap_micros
from ..session import ship_package

_OUT = "key string, session_start long, session_end long, session_length long, clickstream array<string>"
_STATE = ("segments array<struct<start:long,end:long,n:long,"
          "firsts:array<struct<t:long,tie:long,v:string>>>>")


def _merge(segs: list[dict], g: int, max_clicks: int) -> list[dict]:
    segs = sorted(segs, key=lambda s: s["start"])
    out: list[dict] = []
    for s in segs:
        if out and s["start"] - out[-1]["end"] <= g:
            cur = out[-1]
            cur["end"] = max(cur["end"], s["end"])
            cur["n"] += s["n"]
            cur["firsts"] = sorted(cur["firsts"] + s["firsts"],
                                   key=lambda f: (f["t"], f["tie"]))[:max_clicks]
        else:
            out.append({"start": s["start"], "end": s["end"], "n": s["n"],
                        "firsts": list(s["firsts"])})
    return out


_SEGMENTS = ("_k string, _end timestamp, _s long, _e long, _n long, "
             "_firsts array<struct<t:long,tie:long,v:string>>")
COMBINE_ROWS = 1 << 18   # rows a task combines before it passes their segments on
SEND_ROWS = 1 << 14      # segments per Arrow batch


def _combine(g: int, max_clicks: int):
    """Per task: rows to segments per key, over COMBINE_ROWS rows or more at a time."""
    def cut(batches: list) -> pa.Table:
        rows = pa.Table.from_batches(batches).combine_chunks()
        key = rows["_k"].combine_chunks()
        codes = key.dictionary_encode(null_encoding="encode").indices.to_numpy()
        t = rows["_t"].to_numpy()
        tie = rows["_tie"].fill_null(np.iinfo(np.int64).min).to_numpy()
        order = np.lexsort((tie, t, codes))
        k, at = codes[order], t[order]
        new = (k[1:] != k[:-1]) | (np.diff(at) > g)
        starts = np.flatnonzero(np.concatenate([[True], new]))
        counts = np.diff(np.append(starts, len(at)))
        kept = np.minimum(counts, max_clicks)
        offsets = np.concatenate([[0], np.cumsum(kept)])
        firsts = order[np.repeat(starts - offsets[:-1], kept) + np.arange(offsets[-1])]
        entries = pa.StructArray.from_arrays(
            [pa.array(t[firsts]), pa.array(tie[firsts]), rows["_v"].combine_chunks().take(
                pa.array(firsts))], ["t", "tie", "v"])
        ends = at[starts + counts - 1]
        return pa.table({
            "_k": key.take(pa.array(order[starts])),
            "_end": pa.array(ends).cast(pa.timestamp("us", "UTC")),
            "_s": pa.array(at[starts]), "_e": pa.array(ends), "_n": pa.array(counts),
            "_firsts": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)})

    def fn(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= COMBINE_ROWS:
                yield from cut(held).to_batches(SEND_ROWS)
                held, n = [], 0
        if n:
            yield from cut(held).to_batches(SEND_ROWS)
    return fn


def _as_dicts(firsts) -> list[dict]:
    return [f.asDict() if hasattr(f, "asDict") else dict(f) for f in firsts]


def _session_fn(g: int, max_clicks: int):
    def fn(key, pdfs, state):
        segs = []
        if state.exists:
            segs = [{"start": s["start"], "end": s["end"], "n": s["n"],
                     "firsts": _as_dicts(s["firsts"])} for s in state.get[0]]
        if not state.hasTimedOut:
            for pdf in pdfs:
                segs += [{"start": int(a), "end": int(e), "n": int(n), "firsts": _as_dicts(f)}
                         for a, e, n, f in zip(pdf["_s"], pdf["_e"], pdf["_n"], pdf["_firsts"])]
            segs = _merge(segs, g, max_clicks)
        wm_us = state.getCurrentWatermarkMs() * 1000
        done = [s for s in segs if s["end"] + g < wm_us]
        keep = [s for s in segs if s["end"] + g >= wm_us]
        if keep:
            state.update(([(s["start"], s["end"], s["n"],
                            [(f["t"], f["tie"], f["v"]) for f in s["firsts"]]) for s in keep],))
            state.setTimeoutTimestamp(int(math.ceil(min(s["end"] + g for s in keep) / 1000)))
        else:
            state.remove()
        if done:
            yield pd.DataFrame({
                "key": [key[0]] * len(done),
                "session_start": [s["start"] for s in done],
                "session_end": [s["end"] for s in done],
                "session_length": [s["n"] for s in done],
                "clickstream": [[f["v"] for f in s["firsts"]] for s in done],
            })
    return fn


def segments(clicks: DataFrame, gap: str | int, max_clicks: int, key: str, time_col: str,
             value_col: str, tie_col: str | None) -> DataFrame:
    """Clicks reduced to segments per key inside each task (no shuffle)."""
    ship_package(clicks.sparkSession)
    tie = F.col(tie_col).cast("long") if tie_col else F.lit(0).cast("long")
    rows = (clicks.where(F.col(time_col).isNotNull())
            .select(F.col(key).cast("string").alias("_k"),
                    F.unix_micros(F.col(time_col).cast("timestamp")).alias("_t"),
                    tie.alias("_tie"), F.col(value_col).cast("string").alias("_v")))
    return rows.mapInArrow(_combine(gap_micros(gap), max_clicks), _SEGMENTS)


def sessionize_stream(clicks: DataFrame, gap: str | int = DEFAULT_GAP,
                      max_clicks: int = DEFAULT_MAX_CLICKS, key: str = "ip",
                      time_col: str = "event_time", value_col: str = "url",
                      tie_col: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    """Closed sessions of a streaming click frame (append mode).

    Output: key, session_start, session_end (TIMESTAMP), session_length,
    clickstream.  Sessions still open at the end of the input stay in the
    state store; read them with :func:`session_snapshot`.
    """
    rows = segments(clicks, gap, max_clicks, key, time_col, value_col, tie_col)
    out = rows.withWatermark("_end", watermark).groupBy("_k").applyInPandasWithState(
        _session_fn(gap_micros(gap), max_clicks), _OUT, _STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("key").alias(key),
                      F.timestamp_micros("session_start").alias("session_start"),
                      F.timestamp_micros("session_end").alias("session_end"),
                      "session_length", "clickstream")


def session_snapshot(spark: SparkSession, checkpoint: str, key: str = "ip",
                     batch_id: int | None = None) -> DataFrame:
    """Open sessions held in the state store of a sessionize_stream query
    (the reference's state snapshots), as the same columns as closed ones; after the last
    batch, or after an earlier one that the store still has."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    raw = reader.load(checkpoint)
    # the value row wraps the user state as value.groupState (plus its timeout)
    seg = raw.select(F.col("key").getField("_k").alias(key),
                     F.explode(F.col("value.groupState.segments")).alias("s"))
    return seg.select(key,
                      F.timestamp_micros(F.col("s.start")).alias("session_start"),
                      F.timestamp_micros(F.col("s.end")).alias("session_end"),
                      F.col("s.n").alias("session_length"),
                      F.transform(F.col("s.firsts"), lambda f: f["v"]).alias("clickstream"))
