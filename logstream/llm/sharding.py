"""Sharding by histogram sort: shards are ranges of a key with near-equal bytes.

Splitters are found without moving a row.  Every round counts, exactly, the bytes and rows
below a set of candidate keys (probes) in each partition and adds the counts up; for every
splitter the two probes around its target become the next interval.  A splitter is done
when the bytes below it are within ``tolerance`` of the target or nothing is left between
the probes.  The counts are exact, so the result does not depend on sampling.  Then the
rows are exchanged once, by final range.

The key is (key, row number of the written input), a total order: rows that share one key,
a third of all rows perhaps, are split like any others.  Shards are cut into ranges of
about ``range_bytes``, each sorted by one task; a row's slot is the number of rows before
its range in the shard (known from the counts) plus its place in the range.

Defined results: NULL keys come first; a NULL text has 0 bytes (size 1, CRC-32 0); an empty
table gives no rows; fewer rows than shards leave shards empty; extra columns pass through,
columns named ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, per_batch, read_table, text_or_empty

SHARDS = 8
PROBES = 32                 # candidate boundaries per open splitter and round
TOLERANCE = 0.0005          # of a shard's bytes, for shard boundaries
RANGE_TOLERANCE = 0.05      # of a range's bytes, for boundaries inside a shard
RANGE_BYTES = 64 << 20      # of input that one sorting task is meant to hold
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _pack(key: int, row: int) -> int:
    return ((key - LOW) << 64) + row


def _unpack(packed: int) -> tuple[int, int]:
    return (packed >> 64) + LOW, packed & ((1 << 64) - 1)


def _below(rows: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact (bytes, rows) strictly below each probe, probes sorted.

    Each partition sends one row per probe interval it has rows in.
    """
    keys, ordinals = zip(*map(_unpack, probes))
    keys = np.array(keys, np.int64)
    ordinals = np.array([min(o, HIGH) for o in ordinals], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(keys) + 1, np.int64)
        counts = np.zeros(len(keys) + 1, np.int64)
        for batch in batches:
            at = _place(batch.column(0).to_numpy(), batch.column(1).to_numpy(), keys, ordinals)
            np.add.at(sums, at, batch.column(2).to_numpy())
            np.add.at(counts, at, 1)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(sums[found]),
                                          pa.array(counts[found])], ["at", "bytes", "n"])

    got = per_batch(rows.select("__key", "__row", "__size"), run, "at long, bytes long, n long") \
        .groupBy("at").agg(F.sum("bytes").alias("b"), F.sum("n").alias("n")).collect()
    size, n = np.zeros(len(keys) + 1, np.int64), np.zeros(len(keys) + 1, np.int64)
    for r in got:
        size[r["at"]], n[r["at"]] = r["b"], r["n"]
    return list(zip(np.cumsum(size)[:-1].tolist(), np.cumsum(n)[:-1].tolist()))


def _place(key: np.ndarray, row: np.ndarray, keys: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
    """Number of probes at or below (key, row)."""
    at = np.searchsorted(keys, key, "left")
    ties = np.searchsorted(keys, key, "right")
    for i in np.flatnonzero(ties > at):       # probes that share the row's key
        at[i] += np.searchsorted(ordinals[at[i]:ties[i]], row[i], "right")
    return at


def splitters(rows: DataFrame, goals: list[tuple[int, int]], low: int, high: int, total: int,
              count: int, n_probes: int = PROBES) -> list[tuple[int, int, int]]:
    """For every goal (bytes below, allowed difference): (boundary, bytes below, rows below).

    ``rows``: __key, __row, __size; all keys lie in [low, high).
    """
    span = [[low, 0, 0, high, total, count] for _ in goals]
    best: list[tuple[int, int, int] | None] = [None] * len(goals)
    while open_ := [i for i in range(len(goals)) if best[i] is None]:
        wanted: set[int] = set()
        for i in open_:
            lo, hi = span[i][0], span[i][3]
            step = max(1, (hi - lo) // (n_probes + 1))
            wanted.update(p for p in range(lo + step, hi, step))
        probes = sorted(wanted)
        below = _below(rows, probes) if probes else []
        for i in open_:
            goal, allowed = goals[i]
            lo, lo_b, lo_n, hi, hi_b, hi_n = span[i]
            for p, (b, n) in zip(probes, below):
                if lo < p < hi:
                    if b <= goal:
                        lo, lo_b, lo_n = p, b, n
                    else:
                        hi, hi_b, hi_n = p, b, n
                        break
            span[i] = [lo, lo_b, lo_n, hi, hi_b, hi_n]
            if goal - lo_b <= hi_b - goal:
                near = (lo, lo_b, lo_n)
            else:
                near = (hi, hi_b, hi_n)
            if abs(near[1] - goal) <= allowed or hi - lo <= 1 or hi_n - lo_n <= 1:
                best[i] = near
    return best


def histogram_shards(df: DataFrame, key: str, size: str, shards: int = SHARDS,
                     range_bytes: int = RANGE_BYTES, tolerance: float = TOLERANCE,
                     row_bytes_of_range: int | None = None) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in the shard).

    ``key``: an integer column; ``size``: a positive integer column.
    """
    df = df.drop(*[c for c in ("shard", "slot") if c not in (key, size)])
    names = [c for c in df.columns]
    rows = materialise(df.withColumns({
        "__key": F.coalesce(F.col(key).cast("long"), F.lit(LOW)),
        "__size": F.col(size).cast("long"), "__row": F.monotonically_increasing_id()}),
        "shard-rows")
    ends = rows.agg(F.min("__key"), F.max("__key"), F.max("__row"), F.sum("__size"),
                    F.count(F.lit(1))).first()
    if not ends[4]:
        return rows.select(*names, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    low, high, total, count = _pack(ends[0], 0), _pack(ends[1], ends[2] + 1), ends[3], ends[4]
    per_shard = max(1, -(-total // shards // range_bytes))
    pieces = shards * per_shard
    goals = [(total * i // pieces, int(total / pieces * RANGE_TOLERANCE) if i % per_shard
              else int(total / shards * tolerance)) for i in range(1, pieces)]
    cuts = splitters(rows, goals, low, high, total, count)
    cuts = [max(c, cuts[i - 1]) if i else c for i, c in enumerate(cuts)]    # keep them ordered

    keys = np.array([_unpack(c[0])[0] for c in cuts] or [HIGH], np.int64)[:len(cuts)]
    ordinals = np.array([min(_unpack(c[0])[1], HIGH) for c in cuts], np.int64)
    first = [0] + [c[2] for c in cuts]                   # rows before each range
    shift = [first[i] - first[i // per_shard * per_shard] for i in range(pieces)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _place(batch.column("__key").to_numpy(), batch.column("__row").to_numpy(),
                        keys, ordinals)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())],
                                             [*batch.schema.names, "__range"])

    placed = per_batch(rows, place, T.StructType(
        [*rows.schema.fields, T.StructField("__range", T.IntegerType())]))
    offsets = rows.sparkSession.createDataFrame(
        [(i, i // per_shard, s) for i, s in enumerate(shift)],
        "__r int, shard int, __shift long")              # one row per range
    in_range = W.partitionBy("__range").orderBy("__key", "__row")
    return placed.withColumn("__place", F.row_number().over(in_range)).join(
        F.broadcast(offsets), F.col("__range") == F.col("__r")).select(
        *names, "shard", (F.col("__shift") + F.col("__place") - 1).alias("slot"))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """Law ``bytes``: doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL)."""
    text = text_or_empty()
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return histogram_shards(docs, "doc_id", "size").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
