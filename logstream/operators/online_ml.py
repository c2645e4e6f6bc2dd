"""Online (batch-by-batch) linear regression and k-means on DataFrames.

The models are tiny parameter sets kept on the driver between batches; every
batch contributes through ONE distributed aggregate whose result size depends
only on the model (d features, k clusters), never on the data:

* linear regression: n, sum(x x^T), sum(x y) over the batch.  Full-batch
  gradient descent (step / sqrt(i), tolerance check) is then run on those
  sufficient statistics, which is the same iteration as gradient descent over
  the rows in exact arithmetic, without 50 passes over the data.
* k-means: assign each row to its nearest center with array expressions,
  then count and per-dimension sums grouped by cluster (partial aggregation).

Semantics follow the streaming MLlib models the reference uses: each batch
starts from the previous weights with the intercept restarted at 1.0 (bias
appended to the initial weights), and k-means uses the forgetful update with
``decay`` and splits the largest cluster when one is dying.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The streaming models' defaults used by the reference.
SGD_STEP = 0.1
SGD_ITERATIONS = 50
SGD_TOLERANCE = 0.001
KMEANS_K = 5
KMEANS_DECAY = 1.0
KMEANS_DIM = 2
DYING_RATIO = 1e-8
SPLIT_PERTURBATION = 1e-14
WINDOW = 256     # blocks that a pass of kmeans_train_blocks assigns


# --------------------------------------------------------------------------
# Linear regression
# --------------------------------------------------------------------------

@dataclass
class LinRegState:
    weights: list[float]
    intercept: float = 0.0
    batches: int = 0
    iterations: int = 0

    @staticmethod
    def zeros(d: int) -> "LinRegState":
        return LinRegState([0.0] * d)


def usable(features: Column, d: int) -> Column:
    """True for vectors of ``d`` numbers (no NULL vector, length or element)."""
    return F.coalesce((F.size(features) == d) & F.forall(features, lambda v: v.isNotNull()),
                      F.lit(False))


def rejected(df: DataFrame, d: int, features: str = "features") -> DataFrame:
    """Rows that training leaves out and scoring answers with NULL."""
    return df.where(~usable(F.col(features), d))


def dot(features: Column, weights: list[float] | Column) -> Column:
    w = weights if isinstance(weights, Column) else F.array(*[F.lit(float(x)) for x in weights])
    return F.aggregate(F.zip_with(features, w, lambda a, b: a * b), F.lit(0.0),
                       lambda acc, v: acc + v)


def linreg_stats(df: DataFrame, d: int, features: str = "features", label: str = "label",
                 intercept: bool = True) -> tuple[int, np.ndarray, np.ndarray]:
    """n, X~^T X~ and X~^T y for the batch (X~ = features plus a bias column)."""
    valid = df.where(F.col(label).isNotNull() & usable(F.col(features), d))
    return _linreg_sums(valid.agg(*_linreg_aggs(d, features, label, intercept)).first(),
                        d + intercept)


def _linreg_aggs(d: int, features: str, label: str, intercept: bool = True) -> list[Column]:
    """(d+1)^2 numbers over rows with a label and usable features."""
    x, y = F.col(features), F.col(label)
    cols = [F.get(x, j) for j in range(d)] + ([F.lit(1.0)] if intercept else [])
    m = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(m):
        for j in range(i, m):
            aggs.append(F.sum(cols[i] * cols[j]).alias(f"a_{i}_{j}"))
        aggs.append(F.sum(cols[i] * y).alias(f"b_{i}"))
    return aggs


def _linreg_sums(row, m: int) -> tuple[int, np.ndarray, np.ndarray]:
    n = int(row["n"])
    a = np.zeros((m, m))
    b = np.zeros(m)
    if n:
        for i in range(m):
            for j in range(i, m):
                a[i, j] = a[j, i] = row[f"a_{i}_{j}"]
            b[i] = row[f"b_{i}"]
    return n, a, b


def sgd_from_stats(n: int, a: np.ndarray, b: np.ndarray, w0: np.ndarray,
                   step: float = SGD_STEP, iterations: int = SGD_ITERATIONS,
                   tol: float = SGD_TOLERANCE) -> tuple[np.ndarray, int]:
    """Full-batch gradient descent on least squares from sufficient statistics."""
    w = np.array(w0, dtype=float)
    done = 0
    for i in range(1, iterations + 1):
        grad = (a @ w - b) / n
        new = w - (step / math.sqrt(i)) * grad
        done = i
        if i > 1 and np.linalg.norm(w - new) < tol * max(np.linalg.norm(new), 1.0):
            w = new
            break
        w = new
    return w, done


def linreg_train_batch(df: DataFrame, state: LinRegState, features: str = "features",
                       label: str = "label", step: float = SGD_STEP,
                       iterations: int = SGD_ITERATIONS, tol: float = SGD_TOLERANCE,
                       intercept: bool = True, carry_intercept: bool = False) -> LinRegState:
    """One training batch.  Empty batches leave the model unchanged."""
    sums = linreg_stats(df, len(state.weights), features, label, intercept)
    return linreg_update(state, sums, step, iterations, tol, intercept, carry_intercept)


def linreg_update(state: LinRegState, sums: tuple[int, np.ndarray, np.ndarray],
                  step: float = SGD_STEP, iterations: int = SGD_ITERATIONS,
                  tol: float = SGD_TOLERANCE, intercept: bool = True,
                  carry_intercept: bool = False) -> LinRegState:
    d = len(state.weights)
    n, a, b = sums
    if n == 0:
        return state
    start = list(state.weights)
    if intercept:
        start.append(state.intercept if carry_intercept else 1.0)
    w, its = sgd_from_stats(n, a, b, np.array(start), step, iterations, tol)
    return LinRegState([float(v) for v in w[:d]], float(w[d]) if intercept else 0.0,
                       state.batches + 1, its)


def linreg_train_blocks(df: DataFrame, state: LinRegState, block: str,
                        features: str = "features", label: str = "label") \
        -> list[tuple[int, LinRegState]]:
    """(block, model after it) of a frame that holds several batches, trained on one after
    another in order of ``block``.  The sums of all of them are one aggregate, a row per block;
    only the descent on these sums goes from block to block.  Rows without a block are left out."""
    d = len(state.weights)
    valid = df.where(F.col(block).isNotNull() & F.col(label).isNotNull()
                     & usable(F.col(features), d))
    sums = {r[block]: _linreg_sums(r, d + 1)
            for r in valid.groupBy(block).agg(*_linreg_aggs(d, features, label)).collect()}
    out = []
    for b in blocks_of(df, block):
        if b in sums:
            state = linreg_update(state, sums[b])
        out.append((b, state))
    return out


def blocks_of(df: DataFrame, block: str) -> list[int]:
    """Blocks that a frame has rows of, ascending."""
    return sorted(r[0] for r in df.where(F.col(block).isNotNull()).select(block).distinct().collect())


def linreg_closed_form(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope / intercept of one feature (regr_slope / regr_intercept)."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_count(F.col(y), F.col(x)).alias("n"))


def linreg_score(df: DataFrame, state: LinRegState, features: str = "features",
                 out: str = "prediction") -> DataFrame:
    """Add the model's prediction (predictOn / predictOnValues); NULL for rejected rows."""
    x = F.col(features)
    return df.withColumn(out, F.when(usable(x, len(state.weights)),
                                     dot(x, state.weights) + F.lit(state.intercept)))


# --------------------------------------------------------------------------
# Feature scaling (mean 0, range about -1..1) and back
# --------------------------------------------------------------------------

@dataclass
class Scaling:
    mean: dict[str, float]
    half_range: dict[str, float]


def fit_scaling(df: DataFrame, cols: list[str]) -> Scaling:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    row = df.agg(*aggs).first()   # one row
    mean = {c: float(row[f"m_{c}"]) for c in cols}
    half = {c: (float(row[f"hi_{c}"]) - float(row[f"lo_{c}"])) / 2.0 or 1.0 for c in cols}
    return Scaling(mean, half)


def scale_features(df: DataFrame, scaling: Scaling, suffix: str = "_scaled") -> DataFrame:
    out = df
    for c, m in scaling.mean.items():
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(m)) / F.lit(scaling.half_range[c]))
    return out


def unscale(col: Column, scaling: Scaling, name: str) -> Column:
    return col * F.lit(scaling.half_range[name]) + F.lit(scaling.mean[name])


# --------------------------------------------------------------------------
# Streaming k-means
# --------------------------------------------------------------------------

@dataclass
class KMeansState:
    centers: list[list[float]]
    weights: list[float]
    decay: float = KMEANS_DECAY
    time_unit: str = "batches"
    batches: int = 0

    @staticmethod
    def fixed(centers: list[list[float]], weight: float = 0.0, decay: float = KMEANS_DECAY):
        return KMeansState([list(map(float, c)) for c in centers], [weight] * len(centers), decay)

    @staticmethod
    def random(k: int = KMEANS_K, dim: int = KMEANS_DIM, weight: float = 0.0,
               seed: int = 42, decay: float = KMEANS_DECAY) -> "KMeansState":
        rng = np.random.default_rng(seed)
        return KMeansState(rng.standard_normal((k, dim)).tolist(), [weight] * k, decay)


def nearest_center(features: Column, centers: list[list[float]]) -> Column:
    """Index of the nearest center (squared Euclidean; ties -> lowest index); NULL for
    vectors of another length or with NULL elements."""
    cand = []
    for j, c in enumerate(centers):
        cv = F.array(*[F.lit(float(v)) for v in c])
        dist = F.aggregate(F.zip_with(features, cv, lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda acc, v: acc + v)
        cand.append(F.struct(dist.alias("d"), F.lit(j).alias("i")))
    return F.when(usable(features, len(centers[0])), F.array_min(F.array(*cand))["i"])


def nearest_of(features: Column, centers: Column, k: int, d: int) -> Column:
    """:func:`nearest_center` with the ``k`` centers of each row's own column."""
    cand = []
    for j in range(k):
        dist = F.lit(0.0)
        for i in range(d):
            gap = F.get(features, i) - F.get(F.get(centers, j), i)
            dist = dist + gap * gap
        cand.append(F.struct(dist.alias("d"), F.lit(j).alias("i")))
    return F.when(usable(features, d) & centers.isNotNull(), F.array_min(F.array(*cand))["i"])


def kmeans_assign(df: DataFrame, state: KMeansState, features: str = "features",
                  out: str = "cluster") -> DataFrame:
    return df.withColumn(out, nearest_center(F.col(features), state.centers))


def kmeans_batch_stats(df: DataFrame, state: KMeansState, features: str = "features"):
    """Per-cluster count and coordinate sums: at most k rows reach the driver."""
    d = len(state.centers[0])
    assigned = kmeans_assign(df.where(usable(F.col(features), d)), state, features, "_c")
    rows = (assigned.groupBy("_c")
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(F.get(F.col(features), j)).alias(f"s{j}") for j in range(d)])
            .collect())
    return {int(r["_c"]): (int(r["n"]), [float(r[f"s{j}"]) for j in range(d)]) for r in rows}


def kmeans_update(state: KMeansState, stats: dict) -> KMeansState:
    """The forgetful streaming k-means update, then the dying-cluster split."""
    centers = [list(c) for c in state.centers]
    weights = list(state.weights)
    total = sum(n for n, _ in stats.values())
    discount = state.decay if state.time_unit == "batches" else state.decay ** total
    weights = [w * discount for w in weights]
    for j, (n, sums) in stats.items():
        if n == 0:
            continue
        updated = weights[j] + n
        lam = n / max(updated, 1e-16)
        weights[j] = updated
        centers[j] = [c * (1.0 - lam) + s * (lam / n) for c, s in zip(centers[j], sums)]
    largest = max(range(len(weights)), key=lambda i: weights[i])
    smallest = min(range(len(weights)), key=lambda i: weights[i])
    if weights[smallest] < DYING_RATIO * weights[largest]:
        w = (weights[largest] + weights[smallest]) / 2.0
        weights[largest] = weights[smallest] = w
        base = centers[largest]
        p = [SPLIT_PERTURBATION * max(abs(x), 1.0) for x in base]
        centers[largest] = [x + e for x, e in zip(base, p)]
        centers[smallest] = [x - e for x, e in zip(base, p)]
    return replace(state, centers=centers, weights=weights, batches=state.batches + 1)


def kmeans_train_batch(df: DataFrame, state: KMeansState,
                       features: str = "features") -> KMeansState:
    return kmeans_update(state, kmeans_batch_stats(df, state, features))


def kmeans_train_blocks(df: DataFrame, state: KMeansState, block: str,
                        features: str = "features") -> list[tuple[int, KMeansState]]:
    """(block, model after it) of a frame that holds several batches, trained on one after
    another in order of ``block``; rows without a block are left out.

    A block's assignment needs the centers after the block before.  Each pass assigns the rows
    of up to WINDOW blocks at once, a block's with the centers that the pass before found for
    it, and follows the updates from the first block on.  A block is done when it was assigned
    with exactly the centers that the blocks before, all done, lead to: the first open block is
    in every pass, the others soon, as their rows change sides less and less.  The models are
    those of one block after the other."""
    blocks, out = blocks_of(df, block), []
    d = len(state.centers[0])
    x = F.col(features)
    points = df.where(F.col(block).isNotNull() & usable(x, d)).select(
        F.col(block).alias("_b"), F.col(features).alias("_x"))
    points.persist()
    try:
        for at in range(0, len(blocks), WINDOW):
            for b, state in _follow(points, blocks[at:at + WINDOW], state):
                out.append((b, state))
    finally:
        points.unpersist()
    return out


def _follow(points: DataFrame, blocks: list[int], state: KMeansState):
    """(block, model after it) of one window of blocks."""
    guess, kept = dict.fromkeys(blocks, state), {}
    while blocks:
        for b, found in _block_stats(points, {b: guess[b] for b in blocks}).items():
            # the same rows as before: the same sums, to the last digit
            if b not in kept or kept[b][0] != found[0]:
                kept[b] = found
        now, exact, done = state, True, 0
        for b in blocks:
            exact = exact and guess[b].centers == now.centers
            guess[b] = now
            now = kmeans_update(now, kept[b][1])
            if exact:
                state, done = now, done + 1
                yield b, now
        blocks = blocks[done:]


def _block_stats(points: DataFrame, models: dict[int, KMeansState]) -> dict:
    """Of each block: which rows its clusters got (a count and a sum of hashes each), and per
    cluster count and coordinate sums.  At most k rows per block reach the driver."""
    centers = next(iter(models.values())).centers
    k, d = len(centers), len(centers[0])
    names = points.sparkSession.createDataFrame(
        [(b, m.centers) for b, m in models.items()], "_m long, _centers array<array<double>>")
    x = F.col("_x")
    rows = points.join(F.broadcast(names), F.col("_b") == F.col("_m")).select(
        "_b", "_x", nearest_of(x, F.col("_centers"), k, d).alias("_c")) \
        .groupBy("_b", "_c").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(F.xxhash64("_x"), 24)).alias("h"),
            *[F.sum(F.get(x, j)).alias(f"s{j}") for j in range(d)]).collect()
    found = {b: ({}, {}) for b in models}
    for r in rows:
        who, stats = found[r["_b"]]
        who[r["_c"]] = (r["n"], r["h"])
        stats[int(r["_c"])] = (int(r["n"]), [float(r[f"s{j}"]) for j in range(d)])
    return found


def kmeans_score(df: DataFrame, state: KMeansState, features: str = "features",
                 label: str | None = "label") -> DataFrame:
    """(label as int, cluster) per row; scoring does not change the model."""
    cols = [F.col(label).cast("int").alias(label)] if label else []
    extra = [c for c in df.columns if c not in (features, label)]
    return df.select(*extra, *cols,
                     nearest_center(F.col(features), state.centers).alias("cluster"))


def score_blocks(df: DataFrame, models: list[tuple], block: str, features: str = "features",
                 label: str | None = "label") -> DataFrame:
    """The rows scored with the model that ``models`` names for their block (one kind of
    model; NULL where it names none), as :func:`linreg_score` and :func:`kmeans_score` do."""
    state, name = models[0][1], df.sparkSession.createDataFrame
    if isinstance(state, LinRegState):
        d = len(state.weights)
        names = name([(b, m.weights, m.intercept) for b, m in models],
                     "_m long, _weights array<double>, _bias double")
        score = F.when(usable(F.col(features), d) & F.col("_m").isNotNull(),
                       dot(F.col(features), F.col("_weights")) + F.col("_bias")).alias("prediction")
        cols = [c for c in df.columns if c != block]
    else:
        names = name([(b, m.centers) for b, m in models],
                     "_m long, _centers array<array<double>>")
        score = nearest_of(F.col(features), F.col("_centers"), len(state.centers),
                           len(state.centers[0])).alias("cluster")
        cols = [c for c in df.columns if c not in (features, label, block)]
        cols += [F.col(label).cast("int").alias(label)] if label else []
    return df.join(F.broadcast(names), F.col(block) == F.col("_m"), "left").select(*cols, score)
