"""Gap-based sessions per key for batch tables (the state-free form of the
sessionizer): a click continues the key's session when it comes at most
``gap`` after the previous click; each session keeps its first ``max_clicks``
URLs and a click count that keeps growing.

Skew-safe plan (one key may hold a third of all rows):

1. Cut time into buckets of width ``gap``.  Two clicks in one bucket are less
   than ``gap`` apart, so a session can only break *between* consecutive
   non-empty buckets of a key.  One aggregation per (key, bucket) -- partial
   aggregation before the shuffle -- gives min/max time and the count.
2. Session starts come from the bucket table alone (lag over buckets of a
   key).  Its size per key is bounded by time span / gap, not by row count.
3. The first ``max_clicks`` clicks of each bucket (``row_number() <= k``,
   planned as a partial WindowGroupLimit before the shuffle) are the only
   row-level candidates for a session's click stream.
4. Sessions = sums and maxima over the buckets, joined with their first
   ``max_clicks`` candidates (again a partial WindowGroupLimit).

No step collects a key's rows into one task; no cross join; no row cap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Session timeout and click-stream bound of the reference.
DEFAULT_GAP = "30 minutes"
DEFAULT_MAX_CLICKS = 10


def gap_micros(gap: str | int | float) -> int:
    if isinstance(gap, (int, float)):
        return int(gap * 1_000_000)
    n, unit = gap.split()
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(float(n) * mult * 1_000_000)


def sessionize(clicks: DataFrame, gap: str | int = DEFAULT_GAP,
               max_clicks: int = DEFAULT_MAX_CLICKS, key: str = "ip",
               time_col: str = "ts", value_col: str = "url",
               tie_cols: Sequence[str] = ("event_id",)) -> DataFrame:
    """Sessions: key, session_start, session_end (TIMESTAMP), session_length,
    clickstream (first ``max_clicks`` values ordered by time, then ``tie_cols``).

    NULL keys form their own sessions (SQL grouping semantics).
    """
    g = gap_micros(gap)
    t_us = F.unix_micros(F.col(time_col).cast("timestamp"))
    rows = (clicks.where(F.col(time_col).isNotNull())
            .select(F.col(key).alias("_k"), t_us.alias("_t"), *tie_cols,
                    F.col(value_col).alias("_v"))
            .withColumn("_b", F.expr(f"(_t - pmod(_t, {g})) div {g}")))   # floor, also before 1970

    # 1. bucket aggregates (partial aggregation; a hot key spreads over buckets)
    buckets = rows.groupBy("_k", "_b").agg(F.min("_t").alias("_bmin"),
                                            F.max("_t").alias("_bmax"),
                                            F.count(F.lit(1)).alias("_bn"))
    # 2. session start per bucket: a break where the idle time exceeds the gap
    #    (one partition per key, at most span / gap rows each)
    wk = Window.partitionBy("_k").orderBy("_b")
    prev = F.lag("_bmax").over(wk)
    starts = (buckets
              .withColumn("_new", prev.isNull() | (F.col("_bmin") - prev > g))
              .withColumn("_s", F.max(F.when(F.col("_new"), F.col("_bmin")))
                          .over(wk.rowsBetween(Window.unboundedPreceding, 0)))
              .select(F.col("_k").alias("_mk"), F.col("_b").alias("_mb"), "_s", "_bn", "_bmax"))

    # 3. first max_clicks clicks of every bucket (partial top-k before the
    #    shuffle), tagged with their bucket's session
    order = [F.col("_t"), *[F.col(c) for c in tie_cols]]
    wb = Window.partitionBy("_k", "_b").orderBy(*order)
    cand = rows.withColumn("_rb", F.row_number().over(wb)).where(F.col("_rb") <= max_clicks)
    cand = cand.join(starts.select("_mk", "_mb", "_s"), F.col("_k").eqNullSafe(F.col("_mk"))
                     & (F.col("_b") == F.col("_mb")), "inner")

    # 4. session lengths from the buckets, click streams from the candidates
    ws = Window.partitionBy("_k", "_s").orderBy(*order)
    clicks_of = (cand.withColumn("_rs", F.row_number().over(ws))
                 .where(F.col("_rs") <= max_clicks)
                 .groupBy("_k", "_s")
                 .agg(F.sort_array(F.collect_list(F.struct("_rs", "_v"))).alias("_cl")))
    totals = (starts.groupBy("_mk", F.col("_s").alias("_ms"))
              .agg(F.sum("_bn").cast("long").alias("session_length"), F.max("_bmax").alias("_e")))
    out = clicks_of.join(totals, F.col("_k").eqNullSafe(F.col("_mk"))
                         & (F.col("_s") == F.col("_ms")), "inner")
    return out.select(
        F.col("_k").alias(key),
        F.timestamp_micros("_s").alias("session_start"),
        F.timestamp_micros("_e").alias("session_end"),
        "session_length",
        F.transform("_cl", lambda x: x["_v"]).alias("clickstream"),
    )
