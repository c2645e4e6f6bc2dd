"""Arrival times that survive a replay, and late rows as output.

``stamp_arrivals`` is an ingest log: every micro-batch of a landing stream gets one arrival
time, written down before its rows are, so a batch that runs again keeps it.  Windows and idle
timeouts by arrival time over the stamped rows come out the same after any restart.

``split_late`` parts each batch by the watermark of the batches before it (newest event time
less the delay): accepted rows go one way, rows that a stateful operator with that watermark
would drop go to a table of late rows, so that none is lost without a trace.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sessions import gap_micros
from ..session import path_exists
from .sinks import newest_batch, run_batches

_NOTE = "batch_id long, micros long"


def _note(spark: SparkSession, folder: str, batch_id: int, micros: int | None) -> None:
    spark.createDataFrame([(int(batch_id), micros)], _NOTE).coalesce(1).write.mode(
        "overwrite").json(f"{folder}/batch={batch_id}")


def _noted(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    return spark.read.schema(_NOTE).json(f"{folder}/batch={batch_id}").first()["micros"]


def _now(batch_id: int) -> int:
    return time.time_ns() // 1000


def arrival_of(spark: SparkSession, out_dir: str, batch_id: int,
               clock: Callable[[int], int] = _now) -> int:
    """Arrival time (micros) of a batch: the one written down, else the clock's, which is
    written down and never before that of an earlier batch."""
    log = f"{out_dir}/_arrivals"
    if path_exists(spark, f"{log}/batch={batch_id}/_SUCCESS"):
        return _noted(spark, log, batch_id)
    last = newest_batch(spark, log, "batch", before=batch_id)
    at = clock(batch_id)
    if last is not None:
        at = max(at, _noted(spark, log, last))
    _note(spark, log, batch_id, at)
    return at


def stamp_arrivals(stream: DataFrame, out_dir: str, checkpoint: str,
                   clock: Callable[[int], int] = _now, col: str = "arrival_time",
                   trigger: dict | None = None) -> StreamingQuery:
    """Every batch with its arrival time ``col`` (TIMESTAMP) in ``out_dir/batch_id=<id>``;
    ``clock`` gives micros for a batch id."""
    def write(df: DataFrame, batch_id: int) -> None:
        at = arrival_of(df.sparkSession, out_dir, batch_id, clock)
        df.withColumn(col, F.timestamp_micros(F.lit(at).cast("long"))).write.mode(
            "overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return run_batches(stream, write, checkpoint, trigger)


def split_late(stream: DataFrame, time_col: str, delay: str, out_dir: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """``out_dir/accepted/batch_id=<id>`` and ``out_dir/late/batch_id=<id>``: a row is late if
    its time is before the watermark, the newest time of earlier batches less ``delay``.  Rows
    without a time are late (no window takes them).  The newest time is kept per batch, one
    number, so a batch reads no history and a replayed one parts its rows as before."""
    late_by = gap_micros(delay)

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        log = f"{out_dir}/_newest"
        last = newest_batch(spark, log, "batch", before=batch_id)
        before = None if last is None else _noted(spark, log, last)
        t = F.unix_micros(F.col(time_col).cast("timestamp"))
        late = t.isNull() if before is None else t.isNull() | (t < before - late_by)
        df.persist()
        try:
            here = df.agg(F.max(t)).first()[0]                       # one number
            df.where(~late).write.mode("overwrite").parquet(f"{out_dir}/accepted/batch_id={batch_id}")
            df.where(late).write.mode("overwrite").parquet(f"{out_dir}/late/batch_id={batch_id}")
        finally:
            df.unpersist()
        known = [x for x in (before, here) if x is not None]
        _note(spark, log, batch_id, max(known) if known else None)

    return run_batches(stream, write, checkpoint, trigger)
