"""Linear scores and k-means on sparse vectors that stay sparse.

A vector is struct<size, indices, values> (``parse_sparse``); weights and centers are tables of
their stored entries, so nothing here has as many places as a vector has dimensions.  Products
are equi-joins on the index, summed per row: work and shuffle follow the entries that rows and
models share.  The model side is broadcast by Spark where its written size allows; beyond that
the join is on the index, and an index that every row has (a bias, say) is a hot key that
adaptive execution splits on the rows' side.

The update is the forgetful one of ``online_ml`` (decay, weighted means).  Its split of a dying
cluster shifts the stored entries only.  Rows with a NULL vector, or one of another size, are
left out of training and get a NULL cluster or prediction.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_once
from .online_ml import DYING_RATIO, KMEANS_DECAY, SPLIT_PERTURBATION

_ENTRY = "cluster int, index int, value double"


def squared_norm(x: Column) -> Column:
    return F.aggregate(x["values"], F.lit(0.0), lambda a, v: a + v * v)


def usable_sparse(x: Column, size: int) -> Column:
    return F.coalesce(x["size"] == size, F.lit(False))


def entries(df: DataFrame, *keep: str, features: str = "features") -> DataFrame:
    """One row per stored entry: ``keep``, index, value."""
    x = F.col(features)
    pairs = F.arrays_zip(x["indices"].alias("index"), x["values"].alias("value"))
    return df.select(*keep, F.inline(pairs)).toDF(*keep, "index", "value")


def linear_score_sparse(df: DataFrame, weights: DataFrame, size: int, key: str,
                        intercept: float = 0.0, features: str = "features") -> DataFrame:
    """``df`` with ``prediction``: the dot product with ``weights`` (index, weight) and the
    intercept.  ``key`` names a row."""
    part = df.where(usable_sparse(F.col(features), size))
    dots = entries(part, key, features=features).join(weights, "index").groupBy(
        F.col(key).alias("_k")).agg(F.sum(F.col("value") * F.col("weight")).alias("_dot"))
    out = df.join(dots, F.col(key) == F.col("_k"), "left")
    return out.withColumn("prediction", F.when(
        usable_sparse(F.col(features), size), F.coalesce("_dot", F.lit(0.0)) + F.lit(intercept))
    ).drop("_k", "_dot")


@dataclass
class SparseKMeans:
    """Centers as a table (cluster, index, value); k numbers of weight on the driver."""

    centers: DataFrame
    size: int
    weights: list[float]
    decay: float = KMEANS_DECAY
    batches: int = 0

    @staticmethod
    def fixed(spark: SparkSession, centers: list[dict[int, float]], size: int,
              weight: float = 0.0, decay: float = KMEANS_DECAY) -> "SparseKMeans":
        rows = [(j, int(i), float(v)) for j, c in enumerate(centers) for i, v in c.items()]
        table = write_once(spark.createDataFrame(rows, _ENTRY), "sparse-centers")
        return SparseKMeans(table, size, [weight] * len(centers), decay)


def kmeans_assign_sparse(df: DataFrame, model: SparseKMeans, key: str,
                         features: str = "features", out: str = "cluster") -> DataFrame:
    """``df`` with the nearest center (squared Euclidean, ties to the lowest number): |x|^2 -
    2 x.c + |c|^2, where only the products need the join.  ``key`` names a row."""
    k = len(model.weights)
    norms = {r["cluster"]: r["n"] for r in model.centers.groupBy("cluster").agg(
        F.sum(F.col("value") * F.col("value")).alias("n")).collect()}        # k numbers
    part = df.where(usable_sparse(F.col(features), model.size))
    centers = model.centers.select(F.col("index").alias("_i"), "cluster", F.col("value").alias("_c"))
    cells = entries(part, key, features=features).select(F.col(key).alias("_k"), "index", "value")
    dots = cells.join(centers, F.col("index") == F.col("_i")).groupBy("_k").agg(
        *[F.sum(F.when(F.col("cluster") == j, F.col("value") * F.col("_c"))).alias(f"_d{j}")
          for j in range(k)])
    joined = df.join(dots, F.col(key) == F.col("_k"), "left")
    x = F.col(features)
    candidates = [F.struct((squared_norm(x) - 2 * F.coalesce(f"_d{j}", F.lit(0.0))
                            + F.lit(float(norms.get(j, 0.0)))).alias("d"), F.lit(j).alias("j"))
                  for j in range(k)]
    nearest = F.when(usable_sparse(x, model.size), F.array_min(F.array(*candidates))["j"])
    return joined.withColumn(out, nearest).drop("_k", *[f"_d{j}" for j in range(k)])


def kmeans_train_sparse(df: DataFrame, model: SparseKMeans, key: str,
                        features: str = "features") -> SparseKMeans:
    """One training batch: sums per (cluster, index) are a partial aggregate, and the new
    centers a table made from them and the old ones; k counts reach the driver."""
    spark = df.sparkSession
    assigned = write_once(kmeans_assign_sparse(
        df.where(usable_sparse(F.col(features), model.size)), model, key, features, "_cluster")
        .select("_cluster", F.col(features).alias("features")), "sparse-assigned")
    counts = {r["_cluster"]: r["n"] for r in assigned.groupBy("_cluster").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    weights = [w * model.decay for w in model.weights]
    old, new = [], []              # what a cluster's old center and its new sums count for
    for j, w in enumerate(weights):
        n = counts.get(j, 0)
        both = max(w + n, 1e-16)
        old.append((j, 1.0 - n / both if n else 1.0))
        new.append((j, 1.0 / both if n else 0.0))
        weights[j] = w + n

    def factor(pairs: list[tuple[int, float]], cluster: Column) -> Column:
        return F.element_at(F.array(*[F.lit(f) for _, f in pairs]), cluster + 1)

    sums = entries(assigned, "_cluster").select(
        F.col("_cluster").alias("cluster"), "index",
        (F.col("value") * factor(new, F.col("_cluster"))).alias("value"))
    kept = model.centers.select("cluster", "index",
                                (F.col("value") * factor(old, F.col("cluster"))).alias("value"))
    centers = kept.unionByName(sums).groupBy("cluster", "index").agg(F.sum("value").alias("value"))
    largest = max(range(len(weights)), key=weights.__getitem__)
    smallest = min(range(len(weights)), key=weights.__getitem__)
    if weights[smallest] < DYING_RATIO * weights[largest]:
        weights[largest] = weights[smallest] = (weights[largest] + weights[smallest]) / 2.0
        shift = F.lit(SPLIT_PERTURBATION) * F.greatest(F.abs("value"), F.lit(1.0))
        split = centers.where(F.col("cluster") == largest)
        centers = centers.where(~F.col("cluster").isin(largest, smallest)).unionByName(
            split.withColumn("value", F.col("value") + shift)).unionByName(
            split.withColumns({"value": F.col("value") - shift, "cluster": F.lit(smallest)}))
    return replace(model, centers=write_once(centers, "sparse-centers"), weights=weights,
                   batches=model.batches + 1)
