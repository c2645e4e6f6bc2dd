"""Registered streaming queries.

Most queries stream over the files of the given table itself: the table's folder is
the landing folder, ``maxFilesPerTrigger`` bounds a micro-batch (MAX_FILES), and an
``availableNow`` trigger ends with the last file.  What the agent would write as
lines is derived per row (FIXTURES.md), so no copy of the table is made.  The result
is the sink's content.

Queries with a watermark need more than that: the file source goes by modification time,
which need not follow ``ts``.  Their delay covers the disorder of the table's files as
measured before the start; a table of several batches that is further out of order than
WATERMARK is streamed from a copy in ranges of ``ts``, so that the state stays small.

Where results depend on what a batch holds (training batch by batch), batches are blocks of
the key, BLOCK_ROWS ids each; their number follows the data.  Pieces of PIECE_BLOCKS blocks land
one after another and the same query is restarted from its checkpoint after each; it trains on
a piece's blocks in their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import (parse_access_log, parse_labeled, parse_vector, parsed_columns,
                               with_status_class)
from ..operators.alarm import error_alarm
from ..operators.online_ml import KMeansState, LinRegState
from ..operators.records import to_access_rows, to_clicks, to_requests, to_urls
from ..operators.windows import sliding_counts, status_totals, top_k
from ..session import new_work_dir, write_once
from ..sources.fixtures import (KMEANS_START_CENTERS, access_log, clustering_lines,
                                regression_lines, status_json, table)
from ..sources.lines import read_lines, status_texts
from ..streaming.arrivals import split_late, stamp_arrivals
from ..streaming.history import committed_batches, sql_on_states
from ..streaming.ml import train_and_score
from ..streaming.ring import open_runs, run_windows, sliding_runs_stream
from ..streaming.sessions import session_snapshot, sessionize_stream
from ..streaming.state import ClickProgress, finish, map_with_state, state_conf
from ..streaming.sinks import (await_limit, newest_batch, read_latest, running_totals,
                               sql_per_batch, text_batches, upsert_by_key)
from ..streaming.windows import (keep_slice_counts, newest_window_top_k, read_sliding_counts,
                                 read_status_runs)
from .ml_oracle import CLUSTER_POINTS_CTE, REG_POINTS_CTE, argmin_sql, distances_sql
from .oracle import (BATCH_SQL, arrival_counts, late_rows, open_sessions, session_progress,
                     status_run_states)
from .queries import (ALARM_SLIDE, ALARM_WINDOW, TOP_SLIDE, TOP_WINDOW, URL_SLIDE, URL_WINDOW,
                      epoch_s)

MAX_FILES = 16           # files of the table per micro-batch
BLOCK_ROWS = 4_000       # ids per block
PIECE_BLOCKS = 512       # blocks that land at once
TEXT_LIMIT = 200         # row limit of stream_text_until_limit
TEXT_BLOCK = 32          # conversations that land at once before that limit
WATERMARK = 600          # seconds; least delay of a watermark
HISTORY_SPANS = 4        # spans of time that stream_session_history lands one by one
PIECES = 4               # pieces (event_id % PIECES) that the arrival queries land
ARRIVAL_STEP = 10        # seconds between the arrivals of two pieces


class _Run:
    """Folders of one streaming run (fresh, never reused)."""

    def __init__(self, spark: SparkSession, name: str):
        root = new_work_dir(spark, name)
        self.landing = f"{root}/landing"
        self.checkpoint = f"{root}/checkpoint"
        self.out = f"{root}/out"


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files: int = MAX_FILES) -> DataFrame:
    """Stream over the files of a table (one file, or a folder of files)."""
    # a character class: Spark takes the path as a pattern, which may also match one file
    pattern = f"{sf_dir.rstrip('/')}/{name}[.]parquet"
    return read_lines(spark, "files", pattern, fmt="parquet",
                      schema=table(spark, sf_dir, name).schema, max_files_per_trigger=max_files)


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _drive(spark: SparkSession, start: Callable[[], StreamingQuery]) -> None:
    """Run a query over all files.  A stateful query fixes its state partitions at
    first start: size them to the cluster's parallelism, then restore the session value."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(8, spark.sparkContext.defaultParallelism)))
    try:
        _finish(start())
    finally:
        spark.conf.set(key, before)


def _land(df: DataFrame, rows: Column, folder: str) -> None:
    """Append some rows to a landing folder; Spark's committer shows files only when they are
    complete."""
    df.where(rows).write.mode("append").parquet(folder)


def _landed(spark, run: _Run, df: DataFrame, piece: Column, n: int):
    """Land the rows with ``piece`` = 0, 1, .. n - 1 one after another (yields after each)."""
    kept = _staged(spark, run, df, piece)
    for k in range(n):
        kept.where(F.col("_piece") == k).drop("_piece").write.mode("append").parquet(run.landing)
        yield k


def _staged(spark, run: _Run, df: DataFrame, piece: Column) -> DataFrame:
    """The rows with ``_piece``: one scan sets the pieces apart, so that each can be copied from
    its own folder."""
    staged = f"{run.landing}-staged"
    df.withColumn("_piece", piece.cast("long")).write.partitionBy("_piece").parquet(staged)
    return spark.read.schema(f"{_ddl(df)}, _piece long").parquet(staged)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _lines(spark, sf_dir) -> DataFrame:
    return access_log(table_stream(spark, sf_dir, "events"))


def disorder(df: DataFrame, max_files: int = MAX_FILES) -> int:
    """Seconds, rounded up, by which a row of the files of ``df`` can be older than a row of
    an earlier micro-batch: 0 if one batch takes all files.  Files written at the same time
    may come in any order; a file counts among its own predecessors."""
    if len(df.inputFiles()) <= max_files:
        return 0
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    files = df.groupBy(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_modification_time").alias("written")) \
        .agg(F.min(ts).alias("oldest"), F.max(ts).alias("newest"))       # a row per file
    seen = F.max("newest").over(W.orderBy("written").rangeBetween(
        W.unboundedPreceding, W.currentRow))
    late = files.select((seen - F.col("oldest")).alias("late")).agg(F.max("late")).first()[0]
    return 0 if late is None else late // 1_000_000 + 1


def _timed_lines(spark, sf_dir) -> tuple[DataFrame, str]:
    """Stream of access-log lines, and the watermark delay under which no row is late."""
    events = table(spark, sf_dir, "events")
    late = disorder(events)
    if late <= WATERMARK:
        return _lines(spark, sf_dir), f"{WATERMARK} seconds"
    path = new_work_dir(spark, "events-by-time")
    events.repartitionByRange(len(events.inputFiles()), "ts").write.parquet(path)
    late = disorder(spark.read.schema(events.schema).parquet(path))    # tasks end in any order
    lines = access_log(read_lines(spark, "files", path, fmt="parquet", schema=events.schema,
                                  max_files_per_trigger=MAX_FILES))
    return lines, f"{max(WATERMARK, late)} seconds"


def _stream_url_counts(spark, sf_dir, name, window, slide) -> _Run:
    run = _Run(spark, name)

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        urls = to_urls(parse_access_log(lines), carry=["ts"])
        counts = sliding_counts(urls.withWatermark("ts", delay), "url", window,
                                slide, time_col="ts")
        rows = counts.select(epoch_s(F.col("window.start")).alias("window_start"),
                             epoch_s(F.col("window.end")).alias("window_end"), "url", "n")
        return upsert_by_key(rows, run.out, ["window_start", "url"], run.checkpoint,
                             output_mode="update")

    _drive(spark, start)
    return run


def _kept_url_counts(spark, run: _Run) -> DataFrame:
    return read_latest(spark, run.out, ["window_start", "url"], ["batch_id"],
                       ["window_end", "n"])


def q_stream_sliding_url_counts(spark, sf_dir):
    return _kept_url_counts(spark, _stream_url_counts(spark, sf_dir, "stream-sliding",
                                                      URL_WINDOW, URL_SLIDE))


def q_stream_sliding_url_counts_1s(spark, sf_dir):
    """The reference's streaming parameters: 300 s windows sliding every second.

    The stream keeps one count per (second, URL) current; the 300 s windows are
    derived when the table is read (streaming/windows.py)."""
    run = _Run(spark, "stream-sliding-1s")

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        urls = to_urls(parse_access_log(lines), carry=["ts"])
        return keep_slice_counts(urls, "url", "1 second", run.out, run.checkpoint,
                                 time_col="ts", watermark=delay)

    _drive(spark, start)
    c = read_sliding_counts(spark, run.out, "url", URL_WINDOW, "1 second")
    return c.select(epoch_s(F.col("window.start")).alias("window_start"),
                    epoch_s(F.col("window.end")).alias("window_end"), "url", "n")


def q_stream_top_urls(spark, sf_dir):
    """Top 10 URLs of every window over the counts that the stream keeps current."""
    run = _stream_url_counts(spark, sf_dir, "stream-top", TOP_WINDOW, TOP_SLIDE)
    counts = _kept_url_counts(spark, run).select("window_start", "window_end", "url", "n")
    return top_k(counts, "url", 10, per="window_start")


def q_stream_top_urls_newest(spark, sf_dir):
    """Top 10 of the newest window, ranked anew in every micro-batch; the result is
    what the last batch printed."""
    run = _Run(spark, "stream-top-newest")

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        urls = to_urls(parse_access_log(lines), carry=["ts"])
        counts = sliding_counts(urls.withWatermark("ts", delay), "url", TOP_WINDOW,
                                TOP_SLIDE, time_col="ts")
        return newest_window_top_k(counts, "url", 10, f"{run.out}/top", run.checkpoint)

    _drive(spark, start)
    top = spark.read.parquet(f"{run.out}/top")
    newest = top.where(F.col("batch_id") == top.agg(F.max("batch_id")).first()[0])
    return newest.select(epoch_s("window_start").alias("window_start"), "url", "n", "rank")


def q_stream_sliding_incremental(spark, sf_dir):
    """300 s windows sliding every second, kept up to date in state: entering slices are
    added, leaving ones subtracted.  Closed windows come from the sink, open ones from state."""
    run = _Run(spark, "stream-ring")

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        urls = to_urls(parse_access_log(lines), carry=["ts"])
        runs = sliding_runs_stream(urls, "url", URL_WINDOW, "1 second", time_col="ts",
                                   watermark=delay)
        return (runs.writeStream.outputMode("append").format("parquet")
                .option("path", f"{run.out}/closed")
                .option("checkpointLocation", run.checkpoint)
                .trigger(availableNow=True).start())

    _drive(spark, start)
    opened = open_runs(spark, run.checkpoint, "url", URL_WINDOW, "1 second")
    runs = spark.read.schema(opened.schema).parquet(f"{run.out}/closed").unionByName(opened)
    start_s = epoch_s("window_start")
    return run_windows(runs, "1 second").select(
        start_s.alias("window_start"), (start_s + 300).alias("window_end"), "url", "n")


def q_stream_error_alarm(spark, sf_dir):
    """Status totals per sliding window kept up to date by the stream (update
    mode into the keyed sink); the alarm rule runs on the current totals."""
    run = _Run(spark, "stream-alarm")

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        classified = with_status_class(parse_access_log(lines))
        totals = status_totals(classified.withWatermark("ts", delay), ALARM_WINDOW,
                               ALARM_SLIDE, time_col="ts")
        rows = totals.select(epoch_s(F.col("window.start")).alias("window_start"),
                             epoch_s(F.col("window.end")).alias("window_end"),
                             "success", "failure", "other")
        return upsert_by_key(rows, run.out, "window_start", run.checkpoint, output_mode="update")

    _drive(spark, start)
    current = read_latest(spark, run.out, "window_start", ["batch_id"],
                          ["window_end", "success", "failure", "other"])
    a = error_alarm(current)
    return a.select("window_start", "window_end", "success", "failure",
                    F.round("ratio", 6).alias("ratio"), "state")


def q_stream_error_alarm_1s(spark, sf_dir):
    """The alarm at 300 s / 1 s: the stream keeps counts per second and class, windows
    and states are derived on read, as runs of windows with equal totals; windows
    without traffic are 0 / 0 / 0."""
    run = _Run(spark, "stream-alarm-1s")

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        classified = with_status_class(parse_access_log(lines))
        return keep_slice_counts(classified, "status_class", "1 second", run.out,
                                 run.checkpoint, time_col="ts", watermark=delay)

    _drive(spark, start)
    a = error_alarm(read_status_runs(spark, run.out, URL_WINDOW, "1 second"))
    return a.select(epoch_s("first_start").alias("first_start"),
                    epoch_s("last_start").alias("last_start"), "success", "failure", "other",
                    F.round("ratio", 6).alias("ratio"), "state")


def q_stream_sessions(spark, sf_dir):
    run = _Run(spark, "stream-sessions")

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        clicks = to_clicks(parse_access_log(lines), carry=["event_id", "ts"])
        closed = sessionize_stream(clicks, gap="30 minutes", max_clicks=10, key="ip",
                                   time_col="ts", tie_col="event_id", watermark=delay)
        return (closed.writeStream.outputMode("append").format("parquet")
                .option("path", f"{run.out}/closed")
                .option("checkpointLocation", run.checkpoint)
                .trigger(availableNow=True).start())

    _drive(spark, start)
    closed = spark.read.parquet(f"{run.out}/closed")
    open_ = session_snapshot(spark, run.checkpoint)
    both = closed.unionByName(open_)
    return both.select("ip", epoch_s("session_start").alias("session_start"),
                       epoch_s("session_end").alias("session_end"), "session_length",
                       F.array_join("clickstream", " ").alias("clickstream"))


def q_stream_session_history(spark, sf_dir):
    """SQL on the live session state after every batch.  The events arrive in HISTORY_SPANS
    spans of time, one batch each; a span's rows are set apart once, then landed."""
    run = _Run(spark, "stream-history")
    events = table(spark, sf_dir, "events")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(t), F.max(t)).first()              # two numbers
    span = F.floor((t - F.lit(low)) * HISTORY_SPANS / F.lit((high or 0) - (low or 0) + 1))
    after = {}                                   # span -> the batch that ended it

    def start():
        lines = access_log(read_lines(spark, "files", run.landing, fmt="parquet",
                                      schema=events.schema))
        clicks = to_clicks(parse_access_log(lines), carry=["event_id", "ts"])
        closed = sessionize_stream(clicks, gap="30 minutes", max_clicks=10, key="ip",
                                   time_col="ts", tie_col="event_id",
                                   watermark=f"{WATERMARK} seconds")
        return (closed.writeStream.outputMode("append").format("parquet")
                .option("path", f"{run.out}/closed")
                .option("checkpointLocation", run.checkpoint)
                .trigger(availableNow=True).start())

    for k in _landed(spark, run, events.where(F.col("ts").isNotNull()), span, HISTORY_SPANS):
        _drive(spark, start)
        after[k] = max(committed_batches(spark, run.checkpoint), default=None)

    def states(k: int) -> DataFrame:
        return session_snapshot(spark, run.checkpoint, batch_id=after[k])

    found = sql_on_states(
        spark, states, [k for k in after if after[k] is not None], "session_data",
        "SELECT batch_id AS span, ip, unix_seconds(session_start) AS session_start, "
        "session_length, array_join(clickstream, ' ') AS clickstream FROM session_data")
    return found if found is not None else spark.createDataFrame(
        [], "span long, ip string, session_start long, session_length long, clickstream string")


def _piece() -> Column:
    return F.coalesce(F.pmod(F.col("event_id"), F.lit(PIECES)), F.lit(0))


def q_stream_late_rows(spark, sf_dir):
    """Pieces that each span the whole time, one batch each: accepted and late rows."""
    run = _Run(spark, "stream-late")
    events = table(spark, sf_dir, "events")

    def start():
        rows = read_lines(spark, "files", run.landing, fmt="parquet", schema=events.schema)
        return split_late(rows.select("event_id", "ts", "event_type"), "ts",
                          f"{WATERMARK} seconds", run.out, run.checkpoint)

    for _ in _landed(spark, run, events, _piece(), PIECES):
        _finish(start())
    schema = f"{_ddl(events.select('event_id', 'ts', 'event_type'))}, batch_id long"

    def part(name: str, late: bool) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{run.out}/{name}").select(
            "event_id", "event_type", F.lit(late).alias("late"))

    return part("accepted", False).unionByName(part("late", True))


def q_stream_arrival_url_counts(spark, sf_dir):
    """URL counts over 30 s / 10 s windows of arrival time.  The ingest log stamps each batch
    once; here its clock shows ARRIVAL_STEP seconds more for every batch."""
    run = _Run(spark, "stream-arrival")
    events = table(spark, sf_dir, "events")

    def start():
        rows = read_lines(spark, "files", run.landing, fmt="parquet", schema=events.schema)
        urls = to_urls(parse_access_log(access_log(rows)))
        return stamp_arrivals(urls, run.out, run.checkpoint,
                              clock=lambda batch: (batch + 1) * ARRIVAL_STEP * 1_000_000)

    for _ in _landed(spark, run, events, _piece(), PIECES):
        _finish(start())
    stamped = spark.read.schema("url string, arrival_time timestamp").parquet(f"{run.out}/batch_id=*")
    counts = sliding_counts(stamped, "url", "30 seconds", "10 seconds", time_col="arrival_time")
    return counts.select(epoch_s(F.col("window.start")).alias("window_start"),
                         epoch_s(F.col("window.end")).alias("window_end"), "url", "n")


def q_stream_click_progress(spark, sf_dir):
    """Every click with its session so far: general keyed state, a row out per row in.  Rows
    that the last watermark has not passed come from the checkpoint."""
    run, process = _Run(spark, "stream-progress"), ClickProgress(10)

    def start():
        lines, delay = _timed_lines(spark, sf_dir)
        clicks = to_clicks(parse_access_log(lines), carry=["event_id", "ts"])
        out = map_with_state(clicks, "ip", process, "ts", tie_col="event_id", watermark=delay)
        return (out.writeStream.outputMode("append").format("parquet")
                .option("path", f"{run.out}/rows").option("checkpointLocation", run.checkpoint)
                .trigger(availableNow=True).start())

    with state_conf(spark):
        _drive(spark, start)
    rest = finish(spark, run.checkpoint, "ip", process)
    both = spark.read.schema(rest.schema).parquet(f"{run.out}/rows").unionByName(rest)
    return both.select("event_id", "ip",
                       F.expr("session_start div 1000000").alias("session_start"), "clicks",
                       F.array_join("clickstream", " ").alias("clickstream"))


def q_stream_upsert_by_ip(spark, sf_dir):
    run = _Run(spark, "stream-upsert")

    def start():
        rows = to_access_rows(parse_access_log(_lines(spark, sf_dir)), carry=["event_id", "ts"])
        return upsert_by_key(rows, run.out, "ip", run.checkpoint, order_by=["ts", "event_id"])

    _drive(spark, start)
    return read_latest(spark, run.out, "ip", ["ts", "event_id"],
                       ["event_id", "url", "status", "agent"])


def q_stream_upsert_row_counts(spark, sf_dir):
    """Rows that the batches brought to the keyed sink (rejects included), from its ledger."""
    run = _Run(spark, "stream-upsert-rows")

    def start():
        rows = to_access_rows(parse_access_log(_lines(spark, sf_dir)), carry=["event_id", "ts"])
        return upsert_by_key(rows, run.out, "ip", run.checkpoint, order_by=["ts", "event_id"])

    _drive(spark, start)
    return running_totals(spark, run.out).agg(F.sum("rows").alias("rows"),
                                              F.max("total").alias("total"))


def q_stream_sql_per_batch(spark, sf_dir):
    """SQL on every batch, keyed by the log's hour; the batches' partial counts add up."""
    run = _Run(spark, "stream-sql")

    def start():
        req = to_requests(parse_access_log(_lines(spark, sf_dir)), carry=["ts"])
        hourly = req.withColumn("hour", F.date_trunc("hour", "ts"))
        return sql_per_batch(hourly, "requests", "select hour, agent, count(*) as total "
                             "from requests group by hour, agent", run.out, run.checkpoint)

    _drive(spark, start)
    return spark.read.parquet(run.out).groupBy(epoch_s("hour").alias("window_start"), "agent") \
        .agg(F.sum("total").alias("total"))


def q_stream_text_batches(spark, sf_dir):
    """Every status text, written per batch by all partitions."""
    run = _Run(spark, "stream-text")

    def start():
        statuses = status_json(table_stream(spark, sf_dir, "conversations"))
        return text_batches(status_texts(statuses), run.out, run.checkpoint, col="text")

    _drive(spark, start)
    return spark.read.text(f"{run.out}/batch=*")


def q_stream_text_until_limit(spark, sf_dir):
    """A run that ends at the row limit, then one without: every text exactly once (those
    without a conv_id land last).  The first blocks of TEXT_BLOCK ids, as many as exceed the
    limit, land one after another, and the run with the limit takes a file per batch; what
    follows them lands at once, and the second run takes MAX_FILES files per batch."""
    run = _Run(spark, "stream-text-limit")
    statuses = status_json(table(spark, sf_dir, "conversations"))
    block = F.floor(F.col("conv_id") / TEXT_BLOCK)
    sizes = statuses.where("conv_id IS NOT NULL").groupBy(block.alias("b")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("b").limit(TEXT_LIMIT + 1).collect()
    first, rows = [], 0
    for b, n in sizes:
        if rows <= TEXT_LIMIT:
            first, rows = [*first, b], rows + n
    if first:
        head = write_once(statuses.where(block <= first[-1]), "stream-text-first")
        for b in first:
            _land(head, block == b, run.landing)
        _land(statuses, block > first[-1], run.landing)
    _land(statuses, F.col("conv_id").isNull(), run.landing)

    def start(limit):
        landed = read_lines(spark, "files", run.landing, fmt="parquet", schema=statuses.schema,
                            max_files_per_trigger=MAX_FILES if limit is None else 1)
        return text_batches(status_texts(landed), run.out, run.checkpoint, col="text",
                            max_rows=limit)

    await_limit(start(TEXT_LIMIT))
    _finish(start(None))
    if newest_batch(spark, run.out, "batch") is None:        # no rows
        return spark.createDataFrame([], "value string")
    return spark.read.text(f"{run.out}/batch=*")


def _train_and_score(spark, sf_dir, name, train_lines, test_lines, train_points, test_points,
                     initial, scores: str) -> DataFrame:
    """Pieces of training and of test lines land in two folders; after each, train on the
    blocks of new training lines, then score the new test lines, each with its block's model.
    Lines without an event_id are in no block.  ``scores``: columns of an empty result."""
    run = _Run(spark, name)
    events = table(spark, sf_dir, "events").where("event_id IS NOT NULL")
    schema = "event_id long, ts timestamp, value string"

    def points(folder, parse):
        return parse(read_lines(spark, "files", folder, fmt="parquet", schema=schema))

    least = events.agg(F.min("event_id")).first()[0]
    if least is None:
        return spark.createDataFrame([], f"event_id long, {scores}, block long")
    # the batch of a row is its block, a property of the data
    block = (F.floor(F.col("event_id") / BLOCK_ROWS) - F.lit(least // BLOCK_ROWS)).cast("long")
    # a piece's rows in as many files as there are cores, not in those that hold its ids
    files = max(spark.sparkContext.defaultParallelism, len(events.inputFiles()))
    kept = _staged(spark, run, events.repartition(files), F.floor(block / PIECE_BLOCKS))
    for (k,) in sorted(kept.select("_piece").distinct().collect()):
        piece = kept.where(F.col("_piece") == k)
        train_lines(piece).write.mode("append").parquet(f"{run.landing}/train")
        test_lines(piece).write.mode("append").parquet(f"{run.landing}/test")
        _, scoring = train_and_score(
            points(f"{run.landing}/train", train_points), points(f"{run.landing}/test", test_points),
            initial, f"{run.out}/model", f"{run.out}/scored", run.checkpoint, block=block)
        _finish(scoring)
    return spark.read.parquet(f"{run.out}/scored").withColumn("block", block)


def _labeled(lines: DataFrame) -> DataFrame:
    label, feats = parse_labeled(F.col("value"))
    return parsed_columns(lines, "event_id", label=label, features=feats)


def q_stream_linreg_train_score(spark, sf_dir):
    """Train on each landed block, then score the block's test lines with the new model."""
    scored = _train_and_score(spark, sf_dir, "stream-linreg", regression_lines, regression_lines,
                              _labeled, _labeled, LinRegState.zeros(1),
                              "label double, prediction double")
    return scored.select("block", "event_id", F.round("label", 6).alias("label"),
                         F.round("prediction", 6).alias("prediction"))


def q_stream_kmeans_train_score(spark, sf_dir):
    """Streaming k-means: training lines "[a, b]", test lines "(label,[a, b])"."""
    def vectors(lines):
        return parsed_columns(lines, "event_id", features=parse_vector(F.col("value")))

    scored = _train_and_score(
        spark, sf_dir, "stream-kmeans", clustering_lines,
        lambda events: clustering_lines(events, labeled=True), vectors, _labeled,
        KMeansState.fixed(KMEANS_START_CENTERS, weight=0.0), "label int, cluster int")
    return scored.select("block", "event_id", "label", "cluster")


STREAM_QUERIES = {
    "stream_sliding_url_counts": q_stream_sliding_url_counts,
    "stream_sliding_url_counts_1s": q_stream_sliding_url_counts_1s,
    "stream_top_urls": q_stream_top_urls,
    "stream_top_urls_newest": q_stream_top_urls_newest,
    "stream_error_alarm": q_stream_error_alarm,
    "stream_error_alarm_1s": q_stream_error_alarm_1s,
    "stream_sessions": q_stream_sessions,
    "stream_sliding_incremental": q_stream_sliding_incremental,
    "stream_click_progress": q_stream_click_progress,
    "stream_session_history": q_stream_session_history,
    "stream_late_rows": q_stream_late_rows,
    "stream_arrival_url_counts": q_stream_arrival_url_counts,
    "stream_upsert_by_ip": q_stream_upsert_by_ip,
    "stream_upsert_row_counts": q_stream_upsert_row_counts,
    "stream_sql_per_batch": q_stream_sql_per_batch,
    "stream_text_batches": q_stream_text_batches,
    "stream_text_until_limit": q_stream_text_until_limit,
    "stream_linreg_train_score": q_stream_linreg_train_score,
    "stream_kmeans_train_score": q_stream_kmeans_train_score,
}

# Streaming regression: blocks in event_id order are the micro-batches; each
# batch runs up to 50 descent steps from the previous weights with the intercept
# restarted at 1.0, then its rows are scored with the new model.
_STREAM_LINREG = "WITH RECURSIVE " + REG_POINTS_CTE + f""",
bounds AS (SELECT min(event_id) // {BLOCK_ROWS} AS lo,
                  max(event_id) // {BLOCK_ROWS} - min(event_id) // {BLOCK_ROWS} AS last
           FROM events),
pp AS (
  SELECT pts.*, CAST(event_id // {BLOCK_ROWS} - lo AS BIGINT) AS piece FROM pts, bounds
),
stats AS (
  SELECT piece, count(*) AS n, sum(x * x) AS sxx, sum(x) AS sx, sum(x * y) AS sxy,
         sum(y) AS sy
  FROM pp GROUP BY piece
),
it AS (
  SELECT CAST(0 AS BIGINT) AS piece, 0 AS i, CAST(0.0 AS DOUBLE) AS w,
         CAST(1.0 AS DOUBLE) AS b, false AS done
  UNION ALL
  SELECT CASE WHEN q.adv THEN q.piece + 1 ELSE q.piece END,
         CASE WHEN q.adv THEN 0 ELSE q.i + 1 END,
         CASE WHEN q.adv THEN q.w ELSE q.nw END,
         CASE WHEN q.adv THEN 1.0 ELSE q.nb END,
         CASE WHEN q.adv THEN false
              ELSE q.i + 1 > 1 AND sqrt((q.w - q.nw) * (q.w - q.nw) + (q.b - q.nb) * (q.b - q.nb))
                   < 0.001 * greatest(sqrt(q.nw * q.nw + q.nb * q.nb), 1.0) END
  FROM (
    SELECT it.*, (it.done OR it.i >= 50) AS adv,
           it.w - (0.1 / sqrt(it.i + 1)) * (((s.sxx * it.w + s.sx * it.b) - s.sxy) / s.n) AS nw,
           it.b - (0.1 / sqrt(it.i + 1)) * (((s.sx * it.w + s.n * it.b) - s.sy) / s.n) AS nb
    FROM it JOIN stats s ON s.piece = it.piece
  ) q
  WHERE NOT (q.adv AND q.piece >= (SELECT last FROM bounds))
),
models AS (
  SELECT piece, w, b FROM (
    SELECT *, row_number() OVER (PARTITION BY piece ORDER BY i DESC) AS r FROM it) z
  WHERE r = 1
)
SELECT pp.piece AS block, pp.event_id, (round(pp.y, 6) + 0.0) AS label,
       (round(pp.x * m.w + m.b, 6) + 0.0) AS prediction
FROM pp JOIN models m ON pp.piece = m.piece"""


# Streaming k-means with decay 1: the centre of a cluster becomes the mean of its old
# centre, weighted by the rows it stands for, and of its new rows.  (Clusters that die are
# split; none does here: every start centre gets rows in the first block.)
_KK = range(len(KMEANS_START_CENTERS))
_NOW = [(f"s.a{j}", f"s.b{j}") for j in _KK]
_STREAM_KMEANS = "WITH RECURSIVE " + CLUSTER_POINTS_CTE + f""",
bounds AS (SELECT min(event_id) // {BLOCK_ROWS} AS lo FROM events),
pp AS (SELECT cpts.*, CAST(event_id // {BLOCK_ROWS} - lo AS BIGINT) AS block FROM cpts, bounds),
s AS (
  SELECT CAST(-1 AS BIGINT) AS block, {", ".join(
      f"CAST({a!r} AS DOUBLE) AS a{j}, CAST({b!r} AS DOUBLE) AS b{j}, CAST(0 AS DOUBLE) AS w{j}"
      for j, (a, b) in enumerate(KMEANS_START_CENTERS))}
  UNION ALL
  SELECT block, {", ".join(
      f"(any_value(a{j}) * any_value(w{j}) + sum(a * (c = {j})::INT)) "
      f"/ (any_value(w{j}) + sum((c = {j})::INT)), "
      f"(any_value(b{j}) * any_value(w{j}) + sum(b * (c = {j})::INT)) "
      f"/ (any_value(w{j}) + sum((c = {j})::INT)), any_value(w{j}) + sum((c = {j})::INT)"
      for j in _KK)}
  FROM (SELECT *, {argmin_sql('d', len(_KK))} AS c
        FROM (SELECT p.block, p.a, p.b, s.* EXCLUDE (block), {distances_sql('d', _NOW)}
              FROM s JOIN pp p ON p.block = s.block + 1) z) y
  GROUP BY block
)
SELECT block, event_id, label, CAST({argmin_sql('e', len(_KK))} AS INTEGER) AS cluster
FROM (SELECT pp.block, pp.event_id, pp.label, {distances_sql('e', _NOW)}
      FROM pp JOIN s ON s.block = pp.block) z"""

_TEXT_LINES = """
SELECT unnest(string_split(text, chr(10))) AS value FROM conversations"""

STREAM_SQL = {
    "stream_linreg_train_score": _STREAM_LINREG,
    "stream_kmeans_train_score": _STREAM_KMEANS,
    # every written text comes back as its lines (text files split on newlines)
    "stream_text_batches": _TEXT_LINES,
    "stream_text_until_limit": _TEXT_LINES,
    "stream_sliding_url_counts": BATCH_SQL["sliding_url_counts"],
    "stream_sliding_url_counts_1s": BATCH_SQL["sliding_url_counts_1s"],
    "stream_top_urls": BATCH_SQL["top_urls_per_window"],
    "stream_top_urls_newest": "SELECT window_start, url, n, rank FROM ("
    + BATCH_SQL["top_urls_per_window"] + """) t
WHERE window_start = (SELECT max(epoch_us(ts)) // 21600000000 * 21600 FROM events)""",
    "stream_error_alarm": BATCH_SQL["error_alarm"],
    "stream_error_alarm_1s": status_run_states(),
    "stream_sessions": BATCH_SQL["sessions_30m"],
    "stream_sliding_incremental": BATCH_SQL["sliding_url_counts_1s"],
    "stream_click_progress": session_progress(1800),
    "stream_late_rows": late_rows(PIECES, WATERMARK),
    "stream_arrival_url_counts": arrival_counts(PIECES, ARRIVAL_STEP),
    "stream_session_history": open_sessions(1800, HISTORY_SPANS, WATERMARK),
    "stream_upsert_by_ip": BATCH_SQL["latest_by_ip"],
    "stream_upsert_row_counts": "SELECT count(*) AS rows, count(*) AS total FROM events",
    "stream_sql_per_batch": BATCH_SQL["agent_counts_per_interval"],
}
