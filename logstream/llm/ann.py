"""Approximate nearest neighbours by adaptive dimension scan (Gao and Long, 2023).

Index: equal vectors become one entry that keeps the smallest ids of its copies; entries are
rotated by a random orthogonal matrix and filed by nearest centroid into lists.  A list is
stored in chunks of about CHUNK entries; a chunk holds the rotated vectors as column blocks
of BLOCK_DIMS dimensions, beside the originals.

Search: a query probes the lists whose centroids are nearest.  In a chunk the first column
block is read for all entries.  After each block a hypothesis test estimates the distance
from the partial one (after a random rotation, d of D dimensions hold about d/D of it),
against a bound that the SEEDS * k nearest by the first block give, scored whole: entries for which "this one is among the nearest k" is rejected at EPSILON are abandoned;
their other columns are never read.  The threshold, the k-th smallest distance found so far,
is carried from chunk to chunk inside a task.  Survivors are scored on the original vectors
in double precision.

Spark deals chunks and blocks of queries out by list; a list with a third of all entries is
many chunks, a list that many queries probe has many query blocks, and each pair of them is
one row of an equi-join, which adaptive execution splits where it is hot.  Centroids are
fitted on at most SAMPLE entries (by hash order); every entry is indexed.

Probing: PROBE_SHARE of the lists, PROBE_LEAST at least.  On unstructured vectors (noise
around few centres in 64 dimensions) nearest neighbours are spread over half of all lists,
so the share is high; recall against brute force on the given tables is in the README.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components,
and rows with a NULL id, take no part; neither do vectors of another length than the
commonest one (of equally common lengths the smallest).  Rows that repeat id and vector are
one; a query never meets rows of its own id; ties go to the smaller id; with fewer
candidates than k all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, per_batch, read_table

K = 10
SAMPLE = 16_384          # entries that centroids are fitted on, at most
MAX_LISTS = 1_024
PROBE_SHARE, PROBE_LEAST = 0.85, 32
BLOCK_DIMS = 16
EPSILON = 1.0            # of the hypothesis test; larger abandons less
SEEDS = 8                # candidates per neighbour that are scored whole for the first bound
CHUNK = 2_048            # entries
QUERY_BLOCK = 256        # queries
SEED = 7
QUERY_STEP = 100         # registered query: ids divisible by it are queries


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """__id, __vec (array<double> of one length), one row per id and vector."""
    rows = df.select(F.col(id_col).cast("long").alias("__id"),
                     F.col(vec_col).cast("array<double>").alias("__vec"))
    finite = F.forall("__vec", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("__id").isNotNull() & F.col("__vec").isNotNull() & finite
                      & F.exists("__vec", lambda x: x != 0))
    lengths = rows.groupBy(F.size("__vec").alias("d")).count().orderBy(
        F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("__vec") == (lengths[0]["d"] if lengths else 0)).distinct()


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """__entry, __vec, __ids: each different vector with the k + 1 smallest ids that have it
    (enough for k neighbours besides the query's own id)."""
    first = F.row_number().over(W.partitionBy("__vec").orderBy("__id"))
    kept = rows.withColumn("__n", first).where(F.col("__n") <= k + 1)
    entries = kept.groupBy("__vec").agg(F.sort_array(F.collect_list("__id")).alias("__ids"))
    return materialise(entries.withColumn("__entry", F.monotonically_increasing_id()),
                       "ann-entries")


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """Random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def fit_centroids(entries: DataFrame, n: int, rounds: int = 8) -> np.ndarray:
    """k-means centroids of a bounded sample, about sqrt(n) of them."""
    sample = entries.orderBy(F.xxhash64("__vec"), "__vec").limit(SAMPLE).select(
        F.col("__vec").cast("array<float>").alias("v")).toArrow()
    x = _matrix(sample["v"].combine_chunks())
    lists = int(min(MAX_LISTS, max(1, round(n ** 0.5)), len(x)))
    rng = np.random.default_rng(SEED)
    c = x[rng.permutation(len(x))[:lists]].copy()
    for _ in range(rounds):
        at = np.concatenate([_nearest(x[i:i + 4096], c, 1)[:, 0]
                             for i in range(0, len(x), 4096)])
        counts = np.bincount(at, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], c)
    return c


def _nearest(x: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    d = (centroids ** 2).sum(1) - 2 * x @ centroids.T
    if probes >= d.shape[1]:
        return np.broadcast_to(np.arange(d.shape[1]), d.shape)
    if probes == 1:
        return d.argmin(1)[:, None]
    return np.argpartition(d, probes - 1, axis=1)[:, :probes]


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _listed(rows: DataFrame, key: str, centroids: np.ndarray, probes: int) -> DataFrame:
    """(key, __vec) once for each of its nearest lists: adds __list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = _nearest(_matrix(batch.column(1)).astype(np.float32), centroids, probes)
            rows_at = np.repeat(np.arange(batch.num_rows), at.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows_at)),
                 pa.array(at.reshape(-1).astype(np.int32))], [key, "__list"])

    return per_batch(rows.select(key, "__vec"), run, f"{key} long, __list int")


def _salted(listed: DataFrame, key: str, most: int) -> DataFrame:
    """Adds __part: about ``most`` rows of a list each."""
    sizes = listed.groupBy(F.col("__list").alias("__l")).agg(
        F.ceil(F.count(F.lit(1)) / most).alias("__parts"))        # MAX_LISTS rows at most
    return listed.join(F.broadcast(sizes), F.col("__list") == F.col("__l")).select(
        key, "__list", F.pmod(F.xxhash64(key), F.col("__parts")).cast("int").alias("__part"))


def build_chunks(entries: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per chunk: __list, n, keys (smallest id and entry), originals, column blocks."""
    listed = _salted(_listed(entries, "__entry", centroids, 1), "__entry", CHUNK)
    rows = listed.withColumnRenamed("__entry", "__e").join(
        entries, F.col("__e") == F.col("__entry")).select(
        "__list", "__part", "__entry", F.element_at("__ids", 1).alias("__least"), "__vec")

    def pack(table):
        x = _matrix(table["__vec"].combine_chunks())
        turned = (x @ rotation(x.shape[1])).astype(np.float32)
        blocks = [np.ascontiguousarray(turned[:, i:i + BLOCK_DIMS]).tobytes()
                  for i in range(0, x.shape[1], BLOCK_DIMS)]
        return pa.table({
            "__list": pa.array([table["__list"][0].as_py()], pa.int32()),
            "__least": pa.array([table["__least"].to_numpy().tobytes()], pa.binary()),
            "__entries": pa.array([table["__entry"].to_numpy().tobytes()], pa.binary()),
            "__original": pa.array([x.tobytes()], pa.binary()),
            "__blocks": pa.array([blocks], pa.list_(pa.binary()))})

    return rows.groupBy("__list", "__part").applyInArrow(
        pack, "__list int, __least binary, __entries binary, __original binary, "
              "__blocks array<binary>")


def query_blocks(queries: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """One row per block of queries that probe a list: __ql, __queries, __vectors."""
    probed = _salted(_listed(queries, "__query", centroids, probes), "__query", QUERY_BLOCK)
    rows = probed.withColumnRenamed("__query", "__q").join(
        queries, F.col("__q") == F.col("__query")).select("__list", "__part", "__query", "__vec")

    def pack(table):
        return pa.table({
            "__ql": pa.array([table["__list"][0].as_py()], pa.int32()),
            "__queries": pa.array([table["__query"].to_numpy().tobytes()], pa.binary()),
            "__vectors": pa.array([_matrix(table["__vec"].combine_chunks()).tobytes()],
                                  pa.binary())})

    return rows.groupBy("__list", "__part").applyInArrow(
        pack, "__ql int, __queries binary, __vectors binary")


def scan_chunk(query: np.ndarray, turned: np.ndarray, blocks: list[np.ndarray],
               original: np.ndarray, least: np.ndarray, k: int, bound: float,
               first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest k of a chunk by the adaptive scan: places, exact distances, values read.

    ``bound``: squared distance that the k nearest found elsewhere stay within.
    ``first``: partial distances over the first block, if already computed.
    """
    dims, n = len(query), len(least)
    width = blocks[0].shape[1]
    partial = ((blocks[0] - turned[:width]) ** 2).sum(1) if first is None else first
    read, done = n * width, width
    if n > k:       # the k-th best of those nearest so far is close to that of all
        most = min(n, SEEDS * k)
        seeds = np.argpartition(partial, most - 1)[:most]
        whole = ((original[seeds] - query) ** 2).sum(1)
        bound = min(bound, float(np.partition(whole, k - 1)[k - 1]))
        read += most * dims
    alive = np.arange(n)
    for block in blocks[1:]:
        factor = (1 + EPSILON / done ** 0.5) ** 2 * done / dims
        stays = partial <= bound * factor * (1 + 1e-5)     # not rejected
        alive, partial = alive[stays], partial[stays]
        part = block[alive] - turned[done:done + block.shape[1]]
        partial = partial + (part * part).sum(1)
        read += part.size
        done += block.shape[1]
    alive = alive[partial <= bound * (1 + 1e-4)]
    exact = ((original[alive] - query) ** 2).sum(1)
    order = np.lexsort((least[alive], exact))[:k]
    return alive[order], exact[order], read


def _scan(chunks: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """__query, __entry, __score, __least: the nearest k of every query in each chunk."""
    pairs = chunks.join(blocks, F.col("__list") == F.col("__ql")).select(
        "__least", "__entries", "__original", "__blocks", "__queries", "__vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds: dict[int, list[float]] = {}       # of each query, the k smallest found
        for batch in batches:
            for row in batch.to_pylist():
                least = np.frombuffer(row["__least"], np.int64)
                entry = np.frombuffer(row["__entries"], np.int64)
                original = np.frombuffer(row["__original"]).reshape(len(least), -1)
                columns = [np.frombuffer(b, np.float32).reshape(len(least), -1)
                           for b in row["__blocks"]]
                ids = np.frombuffer(row["__queries"], np.int64)
                vectors = np.frombuffer(row["__vectors"]).reshape(len(ids), -1)
                turned = (vectors @ rotation(vectors.shape[1])).astype(np.float32)
                out_q, out_e, out_s, out_l = [], [], [], []
                for i, q in enumerate(ids.tolist()):
                    if len(bounds) > 100_000:
                        bounds.clear()
                    best = bounds.get(q, [])
                    at, exact, _ = scan_chunk(vectors[i], turned[i], columns, original, least, k,
                                              best[-1] if len(best) == k else np.inf)
                    bounds[q] = sorted(best + exact.tolist())[:k]
                    out_q.append(np.full(len(at), q))
                    out_e.append(entry[at])
                    out_s.append(np.sqrt(exact))
                    out_l.append(least[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (out_q, out_e, out_s, out_l)],
                    ["__query", "__entry", "__score", "__least"])

    return per_batch(pairs, run, "__query long, __entry long, __score double, __least long")


def search(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
           vec_col: str = "embedding", probe_share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``is_query``
    (a condition on ``__id``) selects."""
    rows = materialise(valid_vectors(df, id_col, vec_col), "ann-rows")
    entries = entries_of(rows, k)
    n = entries.count()
    if not n:
        return rows.select(F.col("__id").alias("query_id"), F.lit(0).alias("rank"),
                           F.col("__id").alias("vec_id"), F.lit(0.0).alias("score"))
    asked = rows.where(is_query).select(F.col("__id").alias("__asked"),
                                        F.col("__vec").alias("__v")).join(
        entries, F.col("__v") == F.col("__vec")).select(
        "__asked", F.col("__entry").alias("__query"), "__vec")
    asked = materialise(asked, "ann-asked")
    # one search per different query vector, for k + 1 so that its own row can go
    queries = materialise(entries.join(
        asked.select(F.col("__query").alias("__q")).distinct(), F.col("__entry") == F.col("__q"),
        "left_semi").select(F.col("__entry").alias("__query"), "__vec"), "ann-queries")
    centroids = fit_centroids(entries, n)
    probes = min(len(centroids), max(PROBE_LEAST, int(np.ceil(probe_share * len(centroids)))))
    chunks = materialise(build_chunks(entries, centroids), "ann-chunks")
    found = _scan(chunks, query_blocks(queries, centroids, probes), k + 1)

    nearest = F.row_number().over(W.partitionBy("__query").orderBy("__score", "__least"))
    found = found.withColumn("__n", nearest).where(F.col("__n") <= k + 1).drop("__n", "__least")
    ids = found.join(entries.select(F.col("__entry").alias("__e"), "__ids"),
                     F.col("__entry") == F.col("__e")).select(
        "__query", "__score", F.explode("__ids").alias("__id"))
    best = F.row_number().over(W.partitionBy("__query").orderBy("__score", "__id"))
    short = ids.withColumn("__n", best).where(F.col("__n") <= k + 1).groupBy(
        F.col("__query").alias("__q")).agg(F.sort_array(F.collect_list(
            F.struct("__score", "__id"))).alias("__found"))       # k + 1 at most
    own = F.filter("__found", lambda x: x["__id"] != F.col("__asked"))
    answered = asked.select("__asked", "__query").join(
        materialise(short, "ann-found"), F.col("__query") == F.col("__q"))
    # rows of one id and different vectors are queries of their own and rank together
    return answered.select("__asked", F.posexplode(F.slice(own, 1, k)).alias("__at", "__hit")) \
        .select(F.col("__asked").alias("query_id"), (F.col("__at") + 1).cast("int").alias("rank"),
                F.col("__hit.__id").alias("vec_id"), F.col("__hit.__score").alias("score"))


def op1_ann(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: 10 nearest of the rows with vec_id divisible by 100."""
    return search(read_table(spark, sf_dir, "embeddings"), F.col("__id") % QUERY_STEP == 0)
