"""Exact dedup with an extendible-hash index on shared files.

The index is a directory and buckets, both tables below ``spark.checkpoint.dir``:

* Every text is normalised (A-Z to a-z) and hashed to 64 bits.
* The directory starts with one bucket and doubles: as long as a bucket holds more than
  ``capacity`` distinct hashes its local depth grows by one bit and its entries are split
  by that bit.  Counts per hash prefix come from one distributed aggregate; the directory
  has at most 2^MAX_DEPTH cells, whatever the input (a bucket at that depth just stays
  larger: it is data for a task, not a limit on what is found).
* Owner tasks hold ranges of buckets: the index is range-partitioned by bucket and hash.
  Rows with the same hash form a chain, one link per distinct text.
* Bytes decide.  Every text that shares its hash with another row is compared byte by byte
  with the head of its chain; a text that differs moves on to the next link.

Copies are counted before the shuffle (one entry per hash and map task), so a group with a
third of all rows is a handful of entries.  The byte comparison joins texts with heads by
hash; that is a plain equi-join, whose hot keys adaptive execution splits.

Defined results: NULL text counts as empty, and empty texts are copies of each other; of
equal texts the row with the largest doc_id stays (NULL ids are smallest); of rows that
repeat that id exactly one stays; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, per_batch, read_table, text_or_empty

CAPACITY = 50_000     # distinct hashes a bucket holds before it splits
MAX_DEPTH = 16        # directory of 65,536 cells at most
HASH_BITS = 64
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _normal(text: str) -> bytes:
    return text.encode("utf-8").lower()      # bytes.lower() changes A-Z only


def _hash(sha: bytes, bits: int) -> int:
    """The leading bits as an unsigned number, moved to Spark's signed order."""
    value = int.from_bytes(sha[:8], "big") >> (64 - bits) << (64 - bits)
    return value - (1 << 63)


def _keyed(rows: DataFrame, bits: int, with_text: bool) -> DataFrame:
    """(__id, __text) -> __id, __hash, __sha and, if asked for, the normalised bytes."""
    names = ["__id", "__hash", "__sha"] + ["__bytes"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [_normal(t.as_py()) for t in batch.column(1)]
            shas = [hashlib.sha256(d) for d in data]
            columns = [batch.column(0),
                       pa.array([_hash(s.digest(), bits) for s in shas], pa.int64()),
                       pa.array([s.hexdigest() for s in shas], pa.string())]
            if with_text:
                columns.append(pa.array(data, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["__id"].dataType.simpleString()
    return per_batch(rows, run, f"__id {kind}, __hash long, __sha string"
                     + ", __bytes binary" * with_text)


def build_directory(links: DataFrame, capacity: int = CAPACITY,
                    max_depth: int = MAX_DEPTH) -> list[tuple[int, int, int]]:
    """Buckets of the extendible hash as (first cell, local depth, entries), in hash order.

    Cells are the 2^max_depth hash prefixes; a bucket of local depth d covers
    2^(max_depth - d) of them.
    """
    cell = F.shiftright(F.col("__hash"), 64 - max_depth) + (1 << (max_depth - 1))
    counts = dict(links.groupBy(cell.alias("cell")).agg(
        F.count_distinct("__hash").alias("n")).collect())   # 2^max_depth rows at most
    buckets, open_ = [], [(0, 0)]
    cells = sorted(counts)
    below = [0, *accumulate(counts[c] for c in cells)]

    def held(first: int, depth: int) -> int:
        lo = bisect.bisect_left(cells, first)
        return below[bisect.bisect_left(cells, first + (1 << (max_depth - depth)))] - below[lo]

    while open_:
        first, depth = open_.pop()
        n = held(first, depth)
        if n > capacity and depth < max_depth:      # overfull: one more bit, two buckets
            half = 1 << (max_depth - depth - 1)
            open_ += [(first + half, depth + 1), (first, depth + 1)]
        else:
            buckets.append((first, depth, n))
    return buckets


def _owned(links: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """The index: links with their bucket, range-partitioned so that a task owns a run of
    buckets, sorted by hash.  Written with the directory below the shared folder."""
    spark = links.sparkSession
    buckets = build_directory(links, capacity, max_depth)
    cells = [(cell, i, depth) for i, (first, depth, _) in enumerate(buckets)
             for cell in range(first, first + (1 << (max_depth - depth)))]
    directory = materialise(spark.createDataFrame(
        cells, "__cell int, bucket int, local_depth int"), "dedup-directory")
    cell = F.shiftright(F.col("__hash"), 64 - max_depth) + (1 << (max_depth - 1))
    placed = links.withColumn("__at", cell.cast("int")).join(
        F.broadcast(directory), F.col("__at") == F.col("__cell"))   # 2^max_depth rows at most
    return materialise(placed.drop("__at", "__cell").repartitionByRange("bucket", "__hash")
                       .sortWithinPartitions("bucket", "__hash", "__link"), "dedup-index")


def _chained(members: DataFrame) -> list[DataFrame]:
    """Rows of shared hashes by chain link: round k compares the bytes of what is left of
    each chain with its head; equal ones are link k, the others wait for link k + 1.  The
    rounds are as many as the longest chain has different texts (one, for 64 bits)."""
    done, pending = [], members
    while not pending.isEmpty():
        # written, so that both sides of the join are plain exchanges and a hot hash is split
        heads = materialise(pending.groupBy(F.col("__hash").alias("__h")).agg(
            F.max_by("__bytes", F.struct("__sha", "__row")).alias("__head")), "dedup-heads")
        compared = materialise(pending.join(heads, F.col("__hash") == F.col("__h")).select(
            "__id", "__hash", "__sha", "__row",
            (F.col("__bytes") == F.col("__head")).alias("__same"),
            F.when(F.col("__bytes") != F.col("__head"), F.col("__bytes")).alias("__bytes")),
            "dedup-link")
        done.append(compared.where("__same").select(
            "__id", "__hash", "__sha", "__row", F.lit(len(done)).alias("__link")))
        pending = compared.where("NOT __same").drop("__same")
    return done


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
          hash_bits: int = HASH_BITS) -> DataFrame:
    """One row per input row: __id, __keep_id, __group_size, __kept, __sha (of the
    normalised text).  ``hash_bits`` below 64 forces collisions (tests)."""
    texts = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    rows = materialise(_keyed(texts, hash_bits, False), "dedup-rows")
    shared = rows.groupBy(F.col("__hash").alias("__h")).agg(
        F.count(F.lit(1)).alias("__n")).where("__n > 1")
    shared = materialise(shared.select("__h"), "dedup-shared")
    in_shared = F.col("__hash") == F.col("__h")
    members = materialise(_keyed(texts, hash_bits, True).join(shared, in_shared, "left_semi")
                          .withColumn("__row", F.monotonically_increasing_id()), "dedup-members")
    alone = rows.join(shared, in_shared, "left_anti")

    # of a link the last row by (id, row) stays
    chain = _chained(members)
    linked = [part.groupBy("__hash", "__link").agg(
        F.max(F.struct("__id", "__row")).alias("__last"),
        F.count(F.lit(1)).alias("__size"), F.lit(True).alias("__shared")) for part in chain]
    links = alone.select("__hash", F.lit(0).alias("__link"), F.struct(
        "__id", F.lit(0).cast("long").alias("__row")).alias("__last"),
        F.lit(1).cast("long").alias("__size"), F.lit(False).alias("__shared"))
    for part in linked:
        links = links.unionByName(part)
    index = _owned(links, capacity, max_depth)

    out = alone.select("__id", F.col("__id").alias("__keep_id"),
                       F.lit(1).cast("long").alias("__group_size"),
                       F.lit(True).alias("__kept"), "__sha")
    entries = index.where("__shared").select(
        F.col("__hash").alias("__h"), F.col("__link").alias("__l"), "__last", "__size")
    for part in chain:
        out = out.unionByName(part.join(entries, (F.col("__hash") == F.col("__h")) & (
            F.col("__link") == F.col("__l"))).select(
            "__id", F.col("__last.__id").alias("__keep_id"),
            F.col("__size").alias("__group_size"),
            (F.col("__row") == F.col("__last.__row")).alias("__kept"), "__sha"))
    return out


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``documents``."""
    out = dedup(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("__id").alias("doc_id"), F.col("__keep_id").alias("keep_id"),
                      F.col("__group_size").alias("group_size"), F.col("__kept").alias("kept"),
                      F.col("__sha").alias("text_sha256"))


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that stay, all input columns."""
    decided = materialise(dedup(docs), "dedup-decided")
    kept = decided.where("__kept").select(F.col("__id").alias("__kept_id"),
                                          F.col("__sha").alias("__kept_sha"))
    names = docs.columns
    keyed = docs.withColumns({"__row_id": F.col("doc_id"), "__row_sha": F.sha2(F.translate(
        text_or_empty(), UPPER, UPPER.lower()), 256)})
    out = keyed.join(kept, F.col("__row_id").eqNullSafe(F.col("__kept_id"))
                     & (F.col("__row_sha") == F.col("__kept_sha")), "left_semi")
    again = decided.where(F.col("__id").eqNullSafe(F.col("__keep_id")) & ~F.col("__kept"))
    if not again.isEmpty():       # rows that repeat id and text: one of them
        out = out.dropDuplicates(["__row_id", "__row_sha"])
    return out.select(*names)


OP9_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
