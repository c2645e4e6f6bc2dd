"""Sliding-window counts on a stream with small state.

A stream that counts per (key, window) with a 300 s window sliding every second
copies each row 300 times into the state store.  Instead the stream keeps one
count per (key, slide): a tumbling window, one copy per row, upserted by
(slice, key) in update mode, so a replayed batch overwrites itself.  Readers
derive any sliding window from that table with the change-point runs
(``sliding_from_slices``), exactly as a batch query over all rows would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import (counts_per_interval, sliding_from_slices, status_sums, top_k)
from .sinks import newest_batch, read_latest, run_batches, upsert_by_key


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def keep_slice_counts(stream: DataFrame, key, slide: str, table_dir: str, checkpoint: str,
                      time_col: str = "event_time", watermark: str = "10 minutes",
                      trigger: dict | None = None) -> StreamingQuery:
    """Keep per-(slide, key) counts of a stream current in a keyed table."""
    keys = _keys(key)
    per = counts_per_interval(stream.withWatermark(time_col, watermark), keys, slide,
                              time_col=time_col, count_col="n")
    rows = per.select(F.col("window.start").alias("slice_start"), *keys, "n")
    return upsert_by_key(rows, table_dir, ["slice_start", *keys], checkpoint, trigger,
                         output_mode="update")


def read_sliding_counts(spark: SparkSession, table_dir: str, key, window: str,
                        slide: str) -> DataFrame:
    """Sliding-window counts (``window`` struct, key, ``n``) from the kept slices."""
    keys = _keys(key)
    slices = read_latest(spark, table_dir, ["slice_start", *keys], ["batch_id"], ["n"])
    return sliding_from_slices(slices, keys, window, slide)


def read_status_runs(spark: SparkSession, table_dir: str, window: str, slide: str) -> DataFrame:
    """Status totals from kept slices of ``status_class``, as in ``status_runs``."""
    slices = read_latest(spark, table_dir, ["slice_start", "status_class"], ["batch_id"], ["n"])
    sums = status_sums(F.col("n"))
    wide = slices.groupBy("slice_start").agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    return sliding_from_slices(wide, None, window, slide, count_col=list(sums), fill=True,
                               expand=False)


def newest_window_top_k(counts: DataFrame, key: str, k: int, out_dir: str, checkpoint: str,
                        changes_dir: str | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    """In every micro-batch, the k largest counts of the newest window, incrementally.

    ``counts``: streaming ``sliding_counts`` (update mode).  A batch brings the counts that
    changed, and counts only grow, so a key that is neither among the last k of its window nor
    in the batch cannot be among the next k: a batch ranks its own rows of the newest window
    and the k rows written before it, whatever the history.  Written to
    ``out_dir/batch_id=<id>``: window_start, key, n, rank.  ``changes_dir`` gets the rows whose
    rank differs from the batch before: window_start, key, rank and previous_rank (NULL where
    there is none: entered, or left).
    """
    columns = ["window_start", key, "n", "rank"]

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = df.select(F.col("window.start").alias("window_start"), key, "n")
        last = newest_batch(spark, out_dir, "batch_id", before=batch_id)
        held = rows.withColumn("rank", F.lit(None).cast("int")).select(*columns).limit(0) \
            if last is None else spark.read.parquet(f"{out_dir}/batch_id={last}").select(*columns)
        rows.persist()
        try:
            both = rows.unionByName(held.drop("rank"))
            newest = both.agg(F.max("window_start")).first()[0]      # one time
            if newest is None:
                return
            now = both.where(F.col("window_start") == F.lit(newest)).groupBy(
                "window_start", key).agg(F.max("n").alias("n"))
            top_k(now, key, k, per="window_start").select(*columns).write.mode(
                "overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
            if changes_dir:
                ranked = spark.read.parquet(f"{out_dir}/batch_id={batch_id}")
                was = held.select("window_start", F.col(key).alias("_key"),
                                  F.col("rank").alias("previous_rank"))
                same = (ranked["window_start"] == was["window_start"]) & F.col(key).eqNullSafe(
                    F.col("_key"))
                changed = ranked.join(was, same, "full").where(
                    ~F.col("rank").eqNullSafe(F.col("previous_rank")))
                changed.select(
                    F.coalesce(ranked["window_start"], was["window_start"]).alias("window_start"),
                    F.when(F.col("rank").isNull(), F.col("_key")).otherwise(F.col(key)).alias(key),
                    "rank", "previous_rank").write.mode("overwrite").parquet(
                    f"{changes_dir}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return run_batches(counts, write, checkpoint, trigger, output_mode="update")
