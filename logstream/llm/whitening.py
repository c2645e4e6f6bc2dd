r"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers x = floor(64 c) + 1000000.  Mean and covariance are those of
the distinct vectors; sums are exact, and rows are centred as (n x - S) / n before they are
multiplied.  Tasks add up their rows' products, Spark adds up the tasks' sums, so the driver
sees dimension squared numbers, however many rows there are.

The leading eigenvectors of that matrix V are found on the driver:

* V is reduced to tridiagonal form by Householder reflections (the inertia of V - s I and of
  the reduced matrix agree at every shift s).  The negative pivots of the LDL^T factorisation
  at s count the eigenvalues below s (Sylvester), so bisection with counts encloses each
  leading eigenvalue alone, with its number known.
* Rayleigh quotient iteration on V converges cubically to the vector; an iterate that leaves
  the enclosure goes back to it, which is halved.  Eigenvalues that cannot be told apart in
  double precision share an enclosure; their vectors are orthogonal to each other.
* Counts on both sides of the result certify its number.

Then each row is projected.  Components whose eigenvalue is zero (below 10^-12 of the trace)
cannot be scaled to variance one and are left out, so there are fewer than ``components``
where the vectors span fewer dimensions.

Defined results: vectors that are NULL, empty or hold NULL or non-finite entries are left out,
and so are those whose length is not the most common one (of ties the greater); repeated rows
and NULL ids are rows like others, the fit takes equal vectors once; an empty table, or one
distinct vector only, gives no rows; other columns are not read.  A deviation, or an entry,
beyond the range of long is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, per_batch, read_table

# Fixed values of the contract.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
ZERO = 1e-12            # share of the trace below which an eigenvalue counts as zero
_EPS = np.finfo(np.float64).eps
_START = 20_240_613     # seed of the start vectors


def _tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of the tridiagonal form of a symmetric matrix."""
    a = v.copy()
    n = len(a)
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        off[k] = size
        if size == 0:
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ x
        w = p - (x @ p) * x
        rest -= 2 * (np.outer(x, w) + np.outer(w, x))
    if n > 1:
        off[-1] = a[-1, -2]
    return np.diag(a).copy(), off * off


class Spectrum:
    """Counts of eigenvalues of a symmetric matrix by LDL^T inertia."""

    def __init__(self, v: np.ndarray):
        self.v, self.n = v, len(v)
        diagonal, off2 = _tridiagonal(v)
        self._rows = list(zip(diagonal.tolist(), [0.0, *off2.tolist()]))
        radius = np.sqrt(np.concatenate([[0.0], off2])) + np.sqrt(np.concatenate([off2, [0.0]]))
        self.low, self.high = float((diagonal - radius).min()), float((diagonal + radius).max())
        self.norm = max(abs(self.low), abs(self.high), np.finfo(np.float64).tiny)
        self.low -= 4 * _EPS * self.norm
        self.high += 4 * _EPS * self.norm
        self._least = _EPS * _EPS * self.norm

    def at_least(self, shift: float) -> int:
        """How many eigenvalues are ``shift`` or more."""
        below, pivot = 0, 1.0
        for a, b2 in self._rows:
            pivot = a - shift - b2 / pivot
            if abs(pivot) < self._least:
                pivot = -self._least
            below += pivot < 0
        return self.n - below

    def enclose(self, number: int) -> tuple[float, float, bool]:
        """[low, high) that holds the eigenvalue of this number (1: the greatest), and whether
        it is alone there; if not, the bounds are neighbours in double precision."""
        low, high = self.low, self.high
        at_low, at_high = self.n, 0
        while at_low - at_high > 1 and high - low > 4 * _EPS * self.norm:
            middle = (low + high) / 2
            there = self.at_least(middle)
            if there >= number:
                low, at_low = middle, there
            else:
                high, at_high = middle, there
        return low, high, at_low - at_high == 1

    def halve(self, low: float, high: float, number: int) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.at_least(middle) >= number else (low, middle)


def _solved(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    shifted = v.copy()
    shifted[np.diag_indices(len(v))] -= shift
    try:
        y = np.linalg.solve(shifted, x)
    except np.linalg.LinAlgError:
        shifted[np.diag_indices(len(v))] -= _EPS * max(abs(shift), np.abs(v).max())
        y = np.linalg.solve(shifted, x)
    return y / np.linalg.norm(y)


def leading(v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues above zero, falling, and their unit vectors as columns."""
    n, spectrum, trace = len(v), Spectrum(v), float(np.trace(v))
    rng = np.random.default_rng(_START)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    tolerance = 16 * _EPS * spectrum.norm * np.sqrt(n)
    for number in range(1, min(components, n) + 1):
        low, high, alone = spectrum.enclose(number)
        if high <= ZERO * trace or trace <= 0:
            break
        near = [vectors[i] for i, e in enumerate(values) if abs(e - high) <= 1e-3 * spectrum.norm]

        def cleared(x: np.ndarray) -> np.ndarray:
            for _ in range(2):
                for u in near:
                    x = x - (u @ x) * u
            return x / np.linalg.norm(x)

        x, rho = cleared(rng.normal(size=n)), None
        for _ in range(200):
            inside = rho is not None and low <= rho <= high
            x = cleared(_solved(v, rho if inside else (low + high) / 2, x))
            product = v @ x
            rho = float(x @ product)
            wrong = float(np.linalg.norm(product - rho * x))
            if wrong <= tolerance and low - tolerance <= rho <= high + tolerance:
                break
            if not low <= rho <= high and high - low > 4 * _EPS * spectrum.norm:
                low, high = spectrum.halve(low, high, number)
        else:
            raise ArithmeticError(f"no eigenvector of number {number}")
        margin = wrong + tolerance
        if spectrum.at_least(rho - margin) < number or (
                alone and spectrum.at_least(rho + margin) >= number):
            raise ArithmeticError(f"eigenvalue {rho} is not number {number}")
        if rho <= ZERO * trace:
            break
        values.append(rho)
        vectors.append(x)
    return np.array(values), np.array(vectors).reshape(len(vectors), n).T


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                  scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """__id, __x (array of long) of the rows whose vectors take part."""
    entry = F.col(vec_col).cast("array<double>")
    ok = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ok).select(
        F.col(id_col).alias("__id"),
        F.transform(entry, lambda c: F.floor(c * scale).cast("long") + offset).alias("__x"))
    sizes = rows.groupBy(F.size("__x").alias("s")).count().orderBy(F.desc("count"), F.desc("s"))
    most = sizes.first()
    return rows.where(F.size("__x") == (most["s"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _summed(rows: DataFrame, per_rows, width: int) -> np.ndarray:
    """Sum over all rows of the matrices (of ``width`` columns) that ``per_rows`` makes of the
    whole-number vectors of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_rows(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()),
                 pa.array(total.tolist(), pa.list_(pa.float64()))], ["__i", "__row"])

    parts = per_batch(rows.select("__x"), run, "__i int, __row array<double>")
    cells = parts.select("__i", F.posexplode("__row").alias("__j", "__c")).groupBy(
        "__i", "__j").agg(F.sum("__c").alias("__c")).collect()
    out = np.zeros((max((c["__i"] for c in cells), default=-1) + 1, width))
    for c in cells:
        out[c["__i"], c["__j"]] = c["__c"]
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per row of ``df`` that takes part: __id, __n (distinct vectors), __deviation,
    __whitened (array of double), __explained (share of the trace, by component),
    __identity_error."""
    spark = df.sparkSession
    rows = whole_vectors(df, id_col, vec_col)
    kind = rows.schema["__id"].dataType.simpleString()
    schema = (f"__id {kind}, __n long, __deviation long, __whitened array<double>, "
              "__explained array<double>, __identity_error double")
    # partial aggregation first, so copies of one vector meet as one row per task
    fit = materialise(rows.select("__x").distinct(), "white-fit")
    sums = fit.select(F.posexplode("__x").alias("i", "x")).groupBy("i").agg(
        F.sum("x").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    if not sums or sums[0]["n"] < 2:
        return spark.createDataFrame([], schema)
    n, dims = sums[0]["n"], len(sums)
    s = np.array([r["s"] for r in sums], np.int64)

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - s) / n

    def products(x: np.ndarray) -> np.ndarray:
        c = centred(x)
        return c.T @ c

    v = _summed(fit, products, dims) / n
    v = (v + v.T) / 2
    values, vectors = leading(v, components)
    scaled = vectors / np.sqrt(values)
    explained = (values / np.trace(v)).tolist()

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ scaled
        return np.concatenate([z.T @ z, z.sum(0)[None, :]])

    checked = _summed(fit, moments, len(values)) / n
    covariance = checked[:-1] - np.outer(checked[-1], checked[-1])
    error = float(np.abs(covariance - np.eye(len(values))).max()) if len(values) else 0.0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            apart = n * x - s
            if dims * float(np.abs(apart).max()) ** 2 < 2.0 ** 62:
                deviation = (apart * apart).sum(1)
            else:
                deviation = [sum(e * e for e in row) for row in apart.tolist()]
            many = len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n] * many, pa.int64()),
                 pa.array(deviation, pa.int64()),
                 pa.array((centred(x) @ scaled).tolist(), pa.list_(pa.float64())),
                 pa.array([explained] * many, pa.list_(pa.float64())),
                 pa.array([error] * many, pa.float64())],
                ["__id", "__n", "__deviation", "__whitened", "__explained", "__identity_error"])

    return per_batch(rows, project, schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row of
    embeddings that takes part and each component."""
    out = whiten(read_table(spark, sf_dir, "embeddings"))
    return out.select("*", F.posexplode("__whitened").alias("__at", "whitened")).select(
        F.col("__id").alias("vec_id"), (F.col("__at") + 1).alias("component"),
        F.col("__n").alias("n"), F.col("__deviation").alias("deviation"), "whitened",
        F.get("__explained", F.col("__at")).alias("explained"),
        F.col("__identity_error").alias("identity_error"))
