"""Windowed counting, ranking and top-k.

Sliding windows replace the reference's incremental reduceByKeyAndWindow.
A row falls into ``window / slide`` overlapping windows; expanding every row
that many times (300x for 300 s / 1 s) is the dominant cost at scale.  The
``two_step`` strategy first counts per (key, slide-sized slice) -- a tumbling
window with map-side partial aggregation -- and expands only the slice
counts, so the expansion happens once per (key, slice) instead of once per row.
For batch tables the ``runs`` strategy goes further: slices become +/- change
points, a running sum per key gives runs of equal counts, and only the output
rows are generated (no hash aggregation over every (window, key) pair).
Both forms are plain DataFrame aggregations and also run on streaming frames:
the direct form in any output mode, the two-step form (chained time windows
through ``window_time``) in append mode, which emits each window once closed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import FAILURE, OTHER, SUCCESS

# The reference's window and slide.
DEFAULT_WINDOW = "300 seconds"
DEFAULT_SLIDE = "1 second"
# Expansion factor from which the two-step form is used by default.
TWO_STEP_MIN_EXPANSION = 10


def _seconds(interval: str) -> float:
    n, unit = interval.split()
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800,
            "millisecond": 0.001}[unit]
    return float(n) * mult


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def sliding_agg(df: DataFrame, key, sums: dict[str, Column], window: str = DEFAULT_WINDOW,
                slide: str = DEFAULT_SLIDE, time_col: str = "event_time",
                strategy: str = "auto", fill: bool = False) -> DataFrame:
    """Sum the given per-row expressions over sliding windows by key.

    Returns ``window`` (struct start/end), the key columns and one BIGINT per
    entry of ``sums``.  Rows with a NULL time are left out (no window).  With
    ``fill`` (batch, ``runs``) windows without rows between a key's first and last
    window come out with zeros.
    """
    keys = _keys(key)
    t = F.col(time_col)
    base = df.where(t.isNotNull())
    w_us, s_us = int(_seconds(window) * 1e6), int(_seconds(slide) * 1e6)
    expansion = w_us / s_us
    aligned = w_us % s_us == 0     # a slide-sized slice then lies in whole windows only
    if fill:
        if df.isStreaming:
            raise ValueError("fill works on batch frames (on a stream: keep slices, fill on read)")
        strategy = "runs"
    if strategy == "auto":
        big = expansion >= TWO_STEP_MIN_EXPANSION and aligned
        if big and df.isStreaming:
            raise ValueError(
                f"{expansion:.0f} windows per row on a stream: keep per-slide counts with "
                "streaming.windows.keep_slice_counts, or name strategy='direct' (every row is "
                "copied into that many state rows) or 'two_step' (append mode)")
        strategy = "runs" if big else "direct"
    if strategy in ("two_step", "runs") and not aligned:
        raise ValueError("two_step / runs need a window that is a multiple of the slide")
    if strategy == "direct":
        return base.groupBy(F.window(t, window, slide).alias("window"), *keys).agg(
            *[F.sum(e).cast("long").alias(n) for n, e in sums.items()])
    if strategy == "runs":
        return _sliding_runs(base, keys, sums, w_us, s_us, time_col, fill=fill)
    if strategy != "two_step":
        raise ValueError(f"unknown strategy {strategy!r}")
    slices = base.groupBy(F.window(t, slide).alias("_slice"), *keys).agg(
        *[F.sum(e).cast("long").alias(n) for n, e in sums.items()])
    return slices.groupBy(F.window(F.window_time("_slice"), window, slide).alias("window"),
                          *keys).agg(*[F.sum(n).cast("long").alias(n) for n in sums])


RUNS_CHUNK_US = 86_400 * 1_000_000   # time chunk of the runs strategy (1 day)


def _sliding_runs(base: DataFrame, keys: list[str], sums: dict[str, Column], w_us: int,
                  s_us: int, time_col: str, chunk_us: int = RUNS_CHUNK_US,
                  fill: bool = False, expand: bool = True) -> DataFrame:
    """Batch sliding sums from change points (the inverse-function idea as a query).

    Per (key, slice): the sums and the row count (partial aggregation).  A slice
    starting at ``a`` is inside the windows starting in ``[a - W + slide, a]``, so
    it adds its values at ``a - W + slide`` and removes them at ``a + slide``.  A
    running sum over a key's change points gives runs of window starts with the
    same values; runs with rows are expanded into one row per window start.

    The running sum is computed per (key, time chunk) plus a carried-in offset
    from a small per-(key, chunk) totals table, so one task holds at most
    2 x chunk / slide points of one key whatever the time span or row count.
    """
    t_us = F.unix_micros(F.col(time_col).cast("timestamp"))
    slice_start = t_us - F.pmod(t_us, F.lit(s_us))
    slices = base.groupBy(*keys, slice_start.alias("_a")).agg(
        *[F.sum(e).cast("long").alias(n) for n, e in sums.items()],
        F.count(F.lit(1)).alias("_rows"))
    return _runs_from_slices(slices, keys, list(sums), w_us, s_us, chunk_us, fill, expand)


def _runs_from_slices(slices: DataFrame, keys: list[str], sum_names: list[str], w_us: int,
                      s_us: int, chunk_us: int = RUNS_CHUNK_US, fill: bool = False,
                      expand: bool = True) -> DataFrame:
    """Sliding sums from slice aggregates (keys, _a = slice start in micros,
    sums, _rows); see :func:`_sliding_runs`.  Without a key the carried-in totals
    are one window over a row per time chunk (a day).  ``expand=False`` returns the
    runs themselves (first_start, last_start of windows with equal sums), for rankings
    and alarms that need no row per window."""
    chunk_us = max(chunk_us // s_us, 1) * s_us
    names = [*sum_names, "_rows"]
    deltas = F.array(
        F.struct((F.col("_a") - F.lit(w_us - s_us)).alias("_p"),
                 *[F.col(n).alias(n) for n in names]),
        F.struct((F.col("_a") + F.lit(s_us)).alias("_p"),
                 *[(-F.col(n)).alias(n) for n in names]))
    points = (slices.select(*keys, F.explode(deltas).alias("_d"))
              .select(*keys, F.col("_d._p").alias("_p"), *[F.col(f"_d.{n}").alias(n) for n in names])
              .withColumn("_c", F.expr(f"(_p - pmod(_p, {chunk_us})) div {chunk_us}")))

    # local running sums and next point inside each (key, chunk)
    wl = Window.partitionBy(*keys, "_c").orderBy("_p")
    local = points.select(*keys, "_c", "_p", F.lead("_p").over(wl).alias("_q"),
                          *[F.sum(n).over(wl.rowsBetween(Window.unboundedPreceding, 0)).alias(n)
                            for n in names])
    # per (key, chunk): totals carried into later chunks, first point of the next chunk
    totals = points.groupBy(*keys, "_c").agg(*[F.sum(n).alias(n) for n in names],
                                             F.min("_p").alias("_first"))
    wc = Window.partitionBy(*keys).orderBy("_c")
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*[F.col(k).alias(f"_ck{i}") for i, k in enumerate(keys)],
                          F.col("_c").alias("_cc"), F.lead("_first").over(wc).alias("_next"),
                          *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_cy_{n}")
                            for n in names])
    cond = F.col("_c") == F.col("_cc")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ck{i}"))
    runs = local.join(carry, cond, "inner").select(
        *keys, "_p", F.coalesce("_q", "_next").alias("_q"),
        *[(F.col(n) + F.col(f"_cy_{n}")).alias(n) for n in names])
    # points at one position form empty runs except the last (which has the full sum)
    # (``fill``: windows without rows between a key's first and last one stay, with 0)
    runs = runs.where((F.col("_q") > F.col("_p")) if fill else
                      (F.col("_rows") > 0) & (F.col("_q") > F.col("_p")))
    if not expand:
        return runs.select(*keys, F.timestamp_micros("_p").alias("first_start"),
                           F.timestamp_micros(F.col("_q") - F.lit(s_us)).alias("last_start"),
                           *[F.col(n).cast("long").alias(n) for n in sum_names])
    out = runs.select(*keys, *[F.col(n).cast("long").alias(n) for n in sum_names],
                      F.explode(F.sequence(F.col("_p"), F.col("_q") - F.lit(s_us),
                                           F.lit(s_us))).alias("_s"))
    win = F.struct(F.timestamp_micros("_s").alias("start"),
                   F.timestamp_micros(F.col("_s") + F.lit(w_us)).alias("end"))
    return out.select(win.alias("window"), *keys, *sum_names)


def sliding_from_slices(slices: DataFrame, key, window: str, slide: str,
                        start_col: str = "slice_start", count_col: str | Sequence[str] = "n",
                        fill: bool = False, expand: bool = True) -> DataFrame:
    """Sliding-window counts from per-(key, slide) counts that are already
    aggregated -- e.g. the per-second counts a stream keeps current.  Windows
    are derived at read time with the change-point runs, so the stream itself
    holds one count per (key, second) instead of window x rows."""
    w_us, s_us = int(_seconds(window) * 1e6), int(_seconds(slide) * 1e6)
    if w_us % s_us:
        raise ValueError("the window must be a multiple of the slide")
    keys = _keys(key)
    start = F.unix_micros(F.col(start_col).cast("timestamp"))
    counts = _keys(count_col)
    pre = slices.select(*keys, (start - F.pmod(start, F.lit(s_us))).alias("_a"), *counts)
    pre = pre.groupBy(*keys, "_a").agg(*[F.sum(c).cast("long").alias(c) for c in counts])
    pre = pre.withColumn("_rows", sum((F.col(c) for c in counts), F.lit(0)))
    return _runs_from_slices(pre, keys, counts, w_us, s_us, fill=fill, expand=expand)


def sliding_counts(df: DataFrame, key, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                   time_col: str = "event_time", count_col: str = "n",
                   strategy: str = "auto") -> DataFrame:
    """Rows per key over sliding windows (reduceByKeyAndWindow / countByValueAndWindow).

    Keys whose count is zero do not appear (the reference keeps them at 0).
    """
    return sliding_agg(df, key, {count_col: F.lit(1)}, window, slide, time_col, strategy)


def counts_per_interval(df: DataFrame, key, interval: str, time_col: str = "event_time",
                        count_col: str = "total") -> DataFrame:
    """Tumbling-window counts per key (the per-batch ``group by agent`` query)."""
    t = F.col(time_col)
    return (df.where(t.isNotNull())
            .groupBy(F.window(t, interval).alias("window"), *_keys(key))
            .agg(F.count(F.lit(1)).alias(count_col)))


def rank_counts(counts: DataFrame, key, count_col: str = "n") -> DataFrame:
    """Global order by count descending; ties by key ascending (deterministic)."""
    return counts.orderBy(F.col(count_col).desc(), *[F.col(k).asc() for k in _keys(key)])


def top_k(counts: DataFrame, key, k: int = 10, count_col: str = "n",
          per: Sequence[str] | str | None = "window", rank_col: str = "rank") -> DataFrame:
    """The k largest counts, overall (``per=None``) or per group (e.g. per window).

    Per group this is ``row_number() <= k``; Spark plans it with a partial
    WindowGroupLimit before the shuffle, so each task forwards at most k rows
    per group.  Overall it is ``orderBy().limit()`` (TakeOrderedAndProject).
    """
    order = [F.col(count_col).desc(), *[F.col(c).asc() for c in _keys(key)]]
    if per is None:
        return counts.orderBy(*order).limit(k)
    w = Window.partitionBy(*_keys(per)).orderBy(*order)
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def status_totals(classified: DataFrame, window: str = DEFAULT_WINDOW,
                  slide: str = DEFAULT_SLIDE, time_col: str = "event_time",
                  strategy: str = "auto", fill: bool = False) -> DataFrame:
    """Success / Failure / Other line counts per sliding window (no collect).

    ``fill``: windows without traffic are reported as 0 / 0 / 0 (batch)."""
    return sliding_agg(classified, None, status_sums(), window, slide, time_col, strategy, fill)


def status_sums(weight: Column | None = None) -> dict[str, Column]:
    """Per-row contributions (``weight``, default 1) to the three status totals."""
    c, one = F.col("status_class"), F.lit(1) if weight is None else weight
    return {name: F.when(c == value, one).otherwise(0)
            for name, value in (("success", SUCCESS), ("failure", FAILURE), ("other", OTHER))}


def status_runs(classified: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
                time_col: str = "event_time") -> DataFrame:
    """Status totals as runs of windows: first_start, last_start, success, failure, other,
    gap-free from the first window to the last (windows without traffic are 0 / 0 / 0)."""
    base = classified.where(F.col(time_col).isNotNull())
    return _sliding_runs(base, [], status_sums(), int(_seconds(window) * 1e6),
                         int(_seconds(slide) * 1e6), time_col, fill=True, expand=False)
