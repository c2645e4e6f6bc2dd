"""Streaming sinks, all built on ``foreachBatch`` with idempotent writes.

Every write is addressed by the micro-batch id, so a batch that is retried
after a failure (the engine replays it from the checkpoint) overwrites its own
output instead of duplicating it.

| reference                        | here                                     |
|----------------------------------|------------------------------------------|
| ``print()`` / ``show()``         | ``to_console``                           |
| ``saveAsTextFiles``              | ``text_batches`` (+ ``max_rows`` stop)   |
| one text file per batch          | ``text_batches(files_per_batch=1)``      |
| ``saveToCassandra`` (keyed)      | ``upsert_by_key`` + ``read_latest``      |
|                                  | (``compact_keyed_table`` bounds reads)   |
| JDBC append (suggested)          | ``jdbc_append``                          |
| SQL on each batch                | ``sql_per_batch``                        |
| ``foreachRDD((rdd, time) => …)`` | ``run_batches``                          |
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by_key
from ..session import path_exists


def _start(writer, checkpoint: str, trigger: dict | None, query_name: str | None):
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def run_batches(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                trigger: dict | None = None, output_mode: str = "append",
                query_name: str | None = None) -> StreamingQuery:
    """Call ``fn(batch_df, batch_id)`` for every micro-batch (foreachRDD)."""
    return _start(stream.writeStream.outputMode(output_mode).foreachBatch(fn),
                  checkpoint, trigger, query_name)


def to_console(stream: DataFrame, num_rows: int = 20, checkpoint: str | None = None,
               trigger: dict | None = None, output_mode: str = "append",
               truncate: bool = False) -> StreamingQuery:
    """Print each batch (``print()`` shows 10 rows, ``show()`` 20)."""
    w = (stream.writeStream.format("console").outputMode(output_mode)
         .option("numRows", str(num_rows)).option("truncate", str(truncate).lower()))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


# -- batch folders --------------------------------------------------------------

def newest_batch(spark: SparkSession, folder: str, name: str, before: int | None = None) \
        -> int | None:
    """Largest n of the complete folders ``<name>=<n>`` (below ``before``), from one listing."""
    if not path_exists(spark, folder):
        return None
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((int(n.split("=", 1)[1]) for n in (
        st.getPath().getName() for st in fs.listStatus(path)) if n.startswith(f"{name}=")),
        reverse=True)
    for n in found:
        if (before is None or n < before) and fs.exists(
                jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}={n}/_SUCCESS")):
            return n
    return None


def delete_folder(spark: SparkSession, folder: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_LEDGER = "batch_id long, rows long, total long"


def record_rows(spark: SparkSession, out_dir: str, batch_id: int, rows: int) -> None:
    """Ledger entry of a batch: its rows and the running total, from the newest entry
    before it (a replayed batch writes the same entry again)."""
    total = ledger_total(spark, out_dir, before=batch_id) + rows
    spark.createDataFrame([(int(batch_id), int(rows), total)], _LEDGER) \
        .coalesce(1).write.mode("overwrite").json(f"{out_dir}/_ledger/batch={batch_id}")


def ledger_total(spark: SparkSession, out_dir: str, before: int | None = None) -> int:
    """Rows written so far (by batches below ``before``); survives restarts.  Reads the
    newest ledger entry only."""
    newest = newest_batch(spark, f"{out_dir}/_ledger", "batch", before)
    if newest is None:
        return 0
    entry = spark.read.schema(_LEDGER).json(f"{out_dir}/_ledger/batch={newest}").first()
    return int(entry["total"])


def running_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows per written batch and the running total after it."""
    return spark.read.schema(_LEDGER).json(f"{out_dir}/_ledger")


# -- text batches -------------------------------------------------------------

class RowLimitReached(Exception):
    """More than the wanted rows are written; the batch at hand was not read."""


def text_batches(stream: DataFrame, out_dir: str, checkpoint: str, col: str = "value",
                 files_per_batch: int | None = None, max_rows: int | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """One text folder per non-empty batch: ``out_dir/batch=<id>``.

    The batch's partitions are written in parallel; ``files_per_batch=1`` gives a
    single file and so writes the whole batch in one task.  With ``max_rows`` the
    query ends once more rows are written (the last batch stays whole, so the total
    may overshoot): the next batch raises before it writes or commits anything, so
    its rows stay unread and a later start, with or without a limit, begins with
    them.  :func:`await_limit` waits for either end.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if max_rows is not None:
            written = ledger_total(spark, out_dir, before=batch_id)
            if written > max_rows:
                raise RowLimitReached(f"{written} rows written, the limit is {max_rows}")
        lines = df.select(F.col(col).cast("string").alias("value"))
        lines.persist()
        try:
            n = lines.count()
            if n == 0:
                return
            out = lines.coalesce(files_per_batch) if files_per_batch else lines
            out.write.mode("overwrite").text(f"{out_dir}/batch={batch_id}")
            record_rows(spark, out_dir, batch_id, n)
        finally:
            lines.unpersist()

    return run_batches(stream, write, checkpoint, trigger)


def await_limit(query: StreamingQuery) -> bool:
    """Wait for a text-batch query to end; True if its row limit ended it."""
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if RowLimitReached.__name__ in str(e):
            return True
        raise
    return False


# -- keyed table (upsert) -------------------------------------------------------

def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def upsert_by_key(stream: DataFrame, table_dir: str, key, checkpoint: str,
                  trigger: dict | None = None, output_mode: str = "append",
                  order_by: Sequence[str] | None = None) -> StreamingQuery:
    """Keyed table: every batch is written to ``log/batch_id=<id>`` (overwrite,
    so retries are idempotent); rows with a NULL key go to ``rejects``.  Read
    the current table with :func:`read_latest`.

    ``order_by``: the batch is reduced to its latest row per key before the write, so
    the log holds at most one row per key and batch.  :func:`running_totals` has the
    rows that each batch brought.
    """
    keys = _keys(key)

    def write(df: DataFrame, batch_id: int) -> None:
        # batch_id comes back as the partition column of the folder name
        spark = df.sparkSession
        null_key = F.lit(False)
        for k in keys:
            null_key = null_key | F.col(k).isNull()
        df.persist()
        try:
            rows = df.where(~null_key)
            if order_by:
                rows = _latest(rows, keys, order_by)
            rows.write.mode("overwrite").parquet(f"{table_dir}/log/batch_id={batch_id}")
            df.where(null_key).write.mode("overwrite").parquet(
                f"{table_dir}/rejects/batch_id={batch_id}")
            record_rows(spark, table_dir, batch_id, df.count())
        finally:
            df.unpersist()

    return run_batches(stream, write, checkpoint, trigger, output_mode)


def _latest(rows: DataFrame, keys: list[str], order_by: Sequence[str],
            value_cols: Sequence[str] | None = None) -> DataFrame:
    if len(keys) == 1:
        return latest_by_key(rows, keys[0], order_by, value_cols)
    packed = rows.withColumn("_key", F.struct(*keys))
    vals = value_cols or [c for c in rows.columns if c not in keys]
    out = latest_by_key(packed, "_key", order_by, vals)
    return out.select(*[F.col("_key")[k].alias(k) for k in keys], *vals)


def _current_rows(spark: SparkSession, table_dir: str) -> DataFrame:
    """Newest complete snapshot plus the log batches written after it."""
    upto = newest_batch(spark, f"{table_dir}/snapshot", "upto")
    log = None
    if newest_batch(spark, f"{table_dir}/log", "batch_id") is not None:
        log = spark.read.parquet(f"{table_dir}/log").withColumn(
            "batch_id", F.col("batch_id").cast("long"))
    if upto is None:
        return log
    snapshot = spark.read.parquet(f"{table_dir}/snapshot/upto={upto}")
    if log is None:
        return snapshot
    return snapshot.unionByName(log.where(F.col("batch_id") > upto))   # partition pruning


def read_latest(spark: SparkSession, table_dir: str, key, order_by: Sequence[str],
                value_cols: Sequence[str] | None = None) -> DataFrame:
    """Current content of a keyed table: the latest row per key by ``order_by``."""
    return _latest(_current_rows(spark, table_dir), _keys(key), order_by, value_cols)


def compact_keyed_table(spark: SparkSession, table_dir: str, key, order_by: Sequence[str]) -> int:
    """Fold the log into a snapshot ``snapshot/upto=<batch>`` holding one row per
    key, then remove the folded log folders and older snapshots, so neither reads
    nor storage grow with history.  A rerun with no new batch changes nothing; one
    that follows a crash removes what the crash left.  Run it between readers: a
    reader that listed the old folders must start again.  Returns the batch id
    folded up to."""
    upto = newest_batch(spark, f"{table_dir}/log", "batch_id")
    done = newest_batch(spark, f"{table_dir}/snapshot", "upto")
    if upto is not None and (done is None or upto > done):
        rows = _current_rows(spark, table_dir)
        keys = _keys(key)
        vals = [c for c in rows.columns if c not in keys]
        _latest(rows, keys, order_by, vals).write.mode("overwrite").parquet(
            f"{table_dir}/snapshot/upto={upto}")
        done = upto
    if done is None:
        return -1
    while (old := newest_batch(spark, f"{table_dir}/log", "batch_id", done + 1)) is not None:
        delete_folder(spark, f"{table_dir}/log/batch_id={old}")
    while (old := newest_batch(spark, f"{table_dir}/snapshot", "upto", done)) is not None:
        delete_folder(spark, f"{table_dir}/snapshot/upto={old}")
    return done


# -- JDBC -----------------------------------------------------------------------

def _delete_batch(spark: SparkSession, url: str, table: str, batch_id: int,
                  properties: dict) -> None:
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        found = connection.getMetaData().getTables(None, None, table, None)
        if found.next():
            connection.createStatement().executeUpdate(
                f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}")
    finally:
        connection.close()


def jdbc_append(stream: DataFrame, url: str, table: str, checkpoint: str,
                properties: dict | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append each batch to a JDBC table with its ``batch_id``.

    The rows of the batch id are deleted before they are appended: a replayed batch,
    also one of which some partitions had committed, ends up in the table once.
    """
    props = dict(properties or {})

    def write(df: DataFrame, batch_id: int) -> None:
        _delete_batch(df.sparkSession, url, table, batch_id, props)
        df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")) \
          .write.jdbc(url, table, mode="append", properties=props)

    return run_batches(stream, write, checkpoint, trigger)


# -- SQL on every batch -----------------------------------------------------------

def sql_per_batch(stream: DataFrame, view: str, sql: str, out_dir: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Register each batch as ``view``, run ``sql`` on it, and store the result
    under ``out_dir/batch_id=<id>`` (any SQL, per batch)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.createOrReplaceTempView(view)
        res = df.sparkSession.sql(sql)   # batch_id: partition column of the folder
        res.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return run_batches(stream, write, checkpoint, trigger)
