"""Streaming operators: batch/stream parity with out-of-order arrival,
late rows, sink stop rule and restarts, keyed rejects and compaction,
and source/JDBC option mapping (no servers)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from logstream.operators.sessions import sessionize
from logstream.operators.windows import sliding_counts
from logstream.sources.lines import _source_options, decode_messages
from landing import land_piece
from logstream.streaming.sessions import session_snapshot, sessionize_stream
from logstream.streaming import sinks
from logstream.streaming.sinks import (await_limit, compact_keyed_table, jdbc_append, ledger_total,
                                       read_latest, running_totals, text_batches, upsert_by_key)

BASE = dt.datetime(2024, 1, 1)
CLICKS = "event_id long, ts timestamp, ip string, url string"


def _clicks(n=300, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ip = "hot" if rnd.random() < 0.3 else f"10.0.0.{rnd.randint(1, 5)}"
        rows.append((i, BASE + dt.timedelta(seconds=rnd.randint(0, 6 * 3600)), ip,
                     f"/p{rnd.randint(0, 9)}"))
    return rows


def _run_once(q):
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_stream_sessions_equal_batch_with_out_of_order_pieces(spark, workdir):
    rows = _clicks()
    df = spark.createDataFrame(rows, CLICKS)
    hours = F.floor(F.hour("ts") / 2)
    landing, staging, ckpt, out = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt", "out"))

    def start():
        s = spark.readStream.schema(CLICKS).parquet(landing)
        closed = sessionize_stream(s, gap="30 minutes", key="ip", time_col="ts",
                                   tie_col="event_id", watermark="1 day")
        return (closed.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    for piece in (1, 0, 2):        # the earliest rows arrive second
        land_piece(spark, df.where(hours == piece), landing, staging, f"p{piece}")
        _run_once(start())
    closed = spark.read.parquet(out) if _exists(spark, out) else None
    got = session_snapshot(spark, ckpt)
    # SQL over the live state, as the reference queries its state snapshots
    got.createOrReplaceTempView("sessionData")
    live = spark.sql("select ip, session_length from sessionData where session_length > 0")
    assert live.count() == got.count() > 0
    if closed is not None:
        got = closed.unionByName(got)
    expect = sessionize(df, gap="30 minutes", key="ip", time_col="ts")
    key = ["ip", "session_start", "session_end", "session_length", "clickstream"]
    assert sorted(map(tuple, got.select(*key).collect())) == \
        sorted(map(tuple, expect.select(*key).collect()))


def _exists(spark, path):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def test_late_row_is_dropped_and_counted(spark, workdir):
    landing, staging, ckpt = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt"))
    first = spark.createDataFrame([(i, BASE + dt.timedelta(hours=5, seconds=i), "x", "/a")
                                   for i in range(5)], CLICKS)
    late = spark.createDataFrame([(99, BASE, "x", "/late"),
                                  (100, BASE + dt.timedelta(hours=5, minutes=1), "x", "/a")],
                                 CLICKS)
    seen = []

    def collect(df, _bid):
        seen.extend(r["url"] for r in df.collect())

    def start():
        s = spark.readStream.schema(CLICKS).parquet(landing).withWatermark("ts", "10 minutes")
        counts = sliding_counts(s, "url", "10 minutes", "5 minutes", time_col="ts")
        return (counts.writeStream.outputMode("update").foreachBatch(collect)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    land_piece(spark, first, landing, staging, "a")
    _run_once(start())
    land_piece(spark, late, landing, staging, "b")
    q = _run_once(start())
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped >= 1 and "/late" not in seen


def test_row_limit_leaves_unread_rows_for_the_next_start(spark, workdir):
    landing, staging, ckpt, out = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt", "out"))
    docs = spark.createDataFrame([(i, f'{{"text": "t{i}"}}') for i in range(12)],
                                 "i int, value string")

    def start(max_rows):
        s = spark.readStream.schema("text string").json(landing)
        return text_batches(s, out, ckpt, col="text", max_rows=max_rows)

    ended = []
    for piece in range(3):
        land_piece(spark, docs.where(F.floor(F.col("i") / 4) == piece).select("value"),
                   landing, staging, f"p{piece}", "text")
        ended.append(await_limit(start(5)))
    assert ended == [False, False, True]
    assert ledger_total(spark, out) == 8      # 4 + 4 (> 5), the third batch stays unread
    assert not await_limit(start(None))       # and is written by a start without a limit
    assert sorted((r["rows"], r["total"]) for r in running_totals(spark, out).collect()) == \
        [(4, 4), (4, 8), (4, 12)]
    written = spark.read.text(f"{out}/batch=*").collect()
    assert sorted(r["value"] for r in written) == sorted(f"t{i}" for i in range(12))


def test_hot_key_reaches_state_as_few_segments(spark):
    """Rows of a key that a task passes on do not grow with the key's rate."""
    from logstream.streaming.sessions import segments
    sizes = []
    for n in (2_000, 40_000):
        rows = spark.range(n, numPartitions=2).select(
            F.col("id").alias("event_id"), F.lit("error").alias("ip"), F.lit("/a").alias("url"),
            F.timestamp_micros(F.col("id") * F.lit(3_600_000_000 // n)).alias("ts"))
        got = segments(rows, "30 minutes", 10, "ip", "ts", "url", "event_id").collect()
        assert sum(r["_n"] for r in got) == n
        sizes.append(len(got))
    assert sizes == [2, 2]


def test_segments_of_whole_batches(monkeypatch):
    """Rows of many keys are cut at once, over Arrow batches and in pieces: NULL keys, urls and
    ties, more clicks than kept, a gap exactly at the limit."""
    import pyarrow as pa
    from logstream.streaming import sessions
    monkeypatch.setattr(sessions, "COMBINE_ROWS", 5)
    rows = [("a", 0, 1, "/1"), (None, 7, 2, "/2"), ("a", 10, 3, None), ("a", 21, 4, "/4"),
            ("a", 5, None, "/5"), ("b", 9, 6, "/6"),                       # six rows, a piece
            ("b", 9, 5, "/7"), ("b", 19, 7, "/8"), ("b", 18, 8, "/9")]

    def batch(part):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*part), (pa.string(), pa.int64(), pa.int64(),
                                                         pa.string()))],
            ["_k", "_t", "_tie", "_v"])

    batches = [batch(rows[:3]), batch(rows[3:6]), batch(rows[6:])]
    out = [r for b in sessions._combine(10, 2)(iter(batches)) for r in b.to_pylist()]
    got = sorted(((r["_k"] or "", r["_s"], r["_e"], r["_n"], [f["v"] for f in r["_firsts"]])
                  for r in out))
    assert got == [("", 7, 7, 1, ["/2"]), ("a", 0, 10, 3, ["/1", "/5"]), ("a", 21, 21, 1, ["/4"]),
                   ("b", 9, 9, 1, ["/6"]), ("b", 9, 19, 3, ["/7", "/9"])]


def test_upsert_keeps_latest_and_rejects_null_keys(spark, workdir):
    landing, staging, ckpt, out = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt", "out"))
    rows = [(1, BASE, "a", "/1"), (2, BASE + dt.timedelta(1), "a", "/2"),
            (3, BASE, None, "/n"), (4, BASE, "b", "/b")]
    df = spark.createDataFrame(rows, CLICKS)

    def start():
        s = spark.readStream.schema(CLICKS).parquet(landing)
        return upsert_by_key(s, out, "ip", ckpt)

    land_piece(spark, df.where("event_id <= 2"), landing, staging, "p0")
    _run_once(start())
    land_piece(spark, df.where("event_id > 2"), landing, staging, "p1")
    _run_once(start())
    latest = {r["ip"]: r["url"] for r in read_latest(spark, out, "ip", ["ts", "event_id"],
                                                       ["url"]).collect()}
    assert latest == {"a": "/2", "b": "/b"}
    rejects = spark.read.parquet(f"{out}/rejects").collect()
    assert [r["url"] for r in rejects] == ["/n"]
    # compaction folds the log into a snapshot; a later batch still wins
    assert compact_keyed_table(spark, out, "ip", ["ts", "event_id"]) == 1
    land_piece(spark, spark.createDataFrame([(5, BASE + dt.timedelta(2), "b", "/b2")], CLICKS),
               landing, staging, "p2")
    _run_once(start())
    latest = {r["ip"]: r["url"] for r in read_latest(spark, out, "ip", ["ts", "event_id"],
                                                       ["url"]).collect()}
    assert latest == {"a": "/2", "b": "/b2"}
    # compaction is rerunnable: folding again changes nothing
    assert compact_keyed_table(spark, out, "ip", ["ts", "event_id"]) == 2
    assert compact_keyed_table(spark, out, "ip", ["ts", "event_id"]) == 2
    again = {r["ip"]: r["url"] for r in read_latest(spark, out, "ip", ["ts", "event_id"],
                                                      ["url"]).collect()}
    assert again == latest
    names = [f.getPath().getName() for d in ("log", "snapshot") for f in _listed(spark, f"{out}/{d}")]
    assert [n for n in names if "=" in n] == ["upto=2"]      # folded folders are gone


def _listed(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.listStatus(p) if fs.exists(p) else []


def test_source_option_mapping_and_decode(spark):
    fmt, opts = _source_options("kafka", servers="b:9092", topics=["testLogs"])
    assert fmt == "kafka" and opts["subscribe"] == "testLogs"
    assert opts["kafka.bootstrap.servers"] == "b:9092"
    fmt, opts = _source_options("kinesis", stream="s", endpoint="https://e", region="r")
    assert fmt == "kinesis" and opts["startingPosition"] == "LATEST"
    fmt, opts = _source_options("socket", host="h", port=9999)
    assert (fmt, opts) == ("socket", {"host": "h", "port": "9999"})
    raw = spark.createDataFrame([(b"k", "héllo line".encode("utf-8"))],
                                "key binary, value binary")
    assert decode_messages(raw).collect()[0]["value"] == "héllo line"


def test_jdbc_append_deletes_the_batch_before_it_appends(spark, workdir, monkeypatch):
    from pyspark.sql import readwriter
    calls = []
    monkeypatch.setattr(sinks, "_delete_batch", lambda s, url, table, batch_id, props:
                        calls.append(("delete", table, batch_id)))
    monkeypatch.setattr(readwriter.DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None:
                        calls.append((url, table, mode)))
    landing, staging, ckpt = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt"))
    land_piece(spark, spark.createDataFrame(_clicks(5), CLICKS), landing, staging, "p0")
    s = spark.readStream.schema(CLICKS).parquet(landing)
    _run_once(jdbc_append(s, "jdbc:none://x", "requests", ckpt))
    assert calls == [("delete", "requests", 0), ("jdbc:none://x", "requests", "append")]


def test_two_step_sliding_counts_stream_append_equals_batch(spark, workdir):
    """Chained windows (two-step) on a stream: append mode emits each window
    once it is closed; closed windows equal the batch counts."""
    rows = _clicks(400)
    df = spark.createDataFrame(rows, CLICKS)
    landing, staging, ckpt, out = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt", "out"))
    hours = F.floor(F.hour("ts") / 2)

    def start():
        s = spark.readStream.schema(CLICKS).parquet(landing).withWatermark("ts", "1 minute")
        c = sliding_counts(s, "url", "300 seconds", "10 seconds", time_col="ts",
                           strategy="two_step")
        flat = c.select(F.col("window.start").alias("ws"), F.col("window.end").alias("we"),
                        "url", "n")
        return (flat.writeStream.outputMode("append").format("parquet").option("path", out)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    for piece in range(3):
        land_piece(spark, df.where(hours == piece), landing, staging, f"p{piece}")
        _run_once(start())
    got = {(r["ws"], r["url"]): r["n"] for r in spark.read.parquet(out).collect()}
    batch = sliding_counts(df, "url", "300 seconds", "10 seconds", time_col="ts",
                           strategy="direct").select(F.col("window.start").alias("ws"),
                                                      F.col("window.end").alias("we"), "url", "n")
    last = df.agg(F.max("ts")).first()[0]
    closed = {(r["ws"], r["url"]): r["n"] for r in batch.collect()
              if r["we"] <= last - dt.timedelta(minutes=1)}
    assert got and all(got[k] == v for k, v in closed.items() if k in got)
    assert set(closed) <= set(got)


def test_streaming_training_equals_sequential_batches(spark, workdir):
    """Train on each landed piece with restarts in between: the saved model
    history equals training batch by batch; scoring uses the newest model."""
    from logstream.operators.online_ml import LinRegState, linreg_train_batch
    from logstream.streaming.ml import load_model, train_and_score
    rnd = random.Random(2)
    pts = [(i, 0.5 * x - 0.2 + rnd.uniform(-0.01, 0.01), [x])
           for i, x in enumerate(rnd.uniform(-1, 1) for _ in range(90))]
    schema = "event_id long, label double, features array<double>"
    df = spark.createDataFrame(pts, schema)
    landing, staging, ckpt = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt"))
    models, scored = f"{workdir}/models", f"{workdir}/scored"
    expect = LinRegState.zeros(1)
    for piece in range(3):
        part = df.where(F.floor(F.col("event_id") / 30) == piece)
        land_piece(spark, part, landing, staging, f"p{piece}")
        s = spark.readStream.schema(schema).parquet(landing)
        tq, sq = train_and_score(s, spark.readStream.schema(schema).parquet(landing),
                                 LinRegState.zeros(1), models, scored, ckpt)
        _run_once(sq)
        expect = linreg_train_batch(part, expect)
        got = load_model(spark, models)
        assert abs(got.weights[0] - expect.weights[0]) < 1e-12
        assert abs(got.intercept - expect.intercept) < 1e-12
    out = spark.read.parquet(scored)
    assert out.count() == 90 and sorted(r["batch_id"] for r in
                                        out.select("batch_id").distinct().collect()) == [0, 1, 2]


def test_arrival_time_mode(spark):
    from logstream.sources.lines import with_arrival_time
    df = with_arrival_time(spark.createDataFrame([("/a",), ("/b",)], "url string"))
    c = sliding_counts(df, "url", "300 seconds", "60 seconds", time_col="arrival_time")
    assert c.agg(F.sum("n")).first()[0] == 2 * 5


def test_stream_slice_counts_give_batch_windows(spark, workdir):
    """Per-second counts kept by a stream (pieces out of order, inside the
    watermark) give the same sliding windows as the batch over all rows."""
    from logstream.streaming.windows import keep_slice_counts, read_sliding_counts
    rows = _clicks(300, seed=8)
    df = spark.createDataFrame(rows, CLICKS)
    landing, staging, ckpt, out = (f"{workdir}/{x}" for x in ("in", "stage", "ckpt", "out"))
    hours = F.floor(F.hour("ts") / 2)

    def start():
        s = spark.readStream.schema(CLICKS).parquet(landing)
        return keep_slice_counts(s, "url", "1 second", out, ckpt, time_col="ts",
                                 watermark="1 day")

    for piece in (1, 0, 2):
        land_piece(spark, df.where(hours == piece), landing, staging, f"p{piece}")
        _run_once(start())
    got = read_sliding_counts(spark, out, "url", "300 seconds", "1 second")
    expect = sliding_counts(df, "url", "300 seconds", "1 second", time_col="ts")
    cols = [F.col("window.start").alias("s"), "url", "n"]
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, expect.select(*cols).collect()))
