"""Registered online-ML queries over fixtures derived from ``events``.

Each training query treats the whole table as one batch (the streaming form
feeds the same functions batch by batch, see streaming/ml.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse_labeled, parse_sparse, parse_vector, parsed_columns
from ..operators.online_ml import (KMeansState, LinRegState, fit_scaling, kmeans_assign,
                                   kmeans_score, kmeans_train_batch, linreg_closed_form,
                                   linreg_score, linreg_train_batch, scale_features, unscale)
from ..operators.sparse import SparseKMeans, kmeans_assign_sparse, kmeans_train_sparse
from ..session import write_once
from ..sources.fixtures import (KMEANS_START_CENTERS, SPARSE_DIM, WIDE_SPARSE_DIM, clustering_lines,
                                legacy_lines, regression_lines, sparse_lines, table,
                                wide_sparse_centers, wide_sparse_lines, wide_start_centers)


def _r(c, name):
    return F.round(c, 6).alias(name)


def _r6(x: float) -> float:
    """Driver-side rounding as the oracle rounds; -0.0 becomes 0.0."""
    return round(float(x), 6) + 0.0


def regression_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = regression_lines(table(spark, sf_dir, "events"))
    label, feats = parse_labeled(F.col("value"))
    return parsed_columns(lines, "event_id", label=label, features=feats)


def clustering_points(spark: SparkSession, sf_dir: str, labeled: bool = False) -> DataFrame:
    lines = clustering_lines(table(spark, sf_dir, "events"), labeled=labeled)
    if labeled:
        label, feats = parse_labeled(F.col("value"))
        return parsed_columns(lines, "event_id", label=label, features=feats)
    return parsed_columns(lines, "event_id", features=parse_vector(F.col("value")))


def q_parse_vector(spark, sf_dir):
    p = clustering_points(spark, sf_dir)
    return p.select("event_id", F.size("features").alias("dims"),
                    _r(F.get("features", 0), "f0"), _r(F.get("features", 1), "f1"))


def q_parse_labeled(spark, sf_dir):
    p = regression_points(spark, sf_dir)
    return p.select("event_id", _r(F.col("label"), "label"), F.size("features").alias("dims"),
                    _r(F.get("features", 0), "f0"))


def q_scale_features(spark, sf_dir):
    p = regression_points(spark, sf_dir).select("event_id", F.get("features", 0).alias("x"),
                                                 F.col("label").alias("y"))
    s = scale_features(p, fit_scaling(p, ["x", "y"]))
    return s.select("event_id", _r(F.col("x_scaled"), "x_scaled"), _r(F.col("y_scaled"), "y_scaled"))


def q_scale_round_trip(spark, sf_dir):
    """Scaled and back: the original values."""
    p = regression_points(spark, sf_dir).select("event_id", F.get("features", 0).alias("x"),
                                                 F.col("label").alias("y"))
    scaling = fit_scaling(p, ["x", "y"])
    s = scale_features(p, scaling)
    return s.select("event_id", *[_r(unscale(F.col(f"{c}_scaled"), scaling, c), c)
                                  for c in ("x", "y")])


def q_parse_vector_sparse(spark, sf_dir):
    lines = sparse_lines(table(spark, sf_dir, "events"))
    p = lines.select("event_id", parse_vector(F.col("value"), dim=SPARSE_DIM).alias("v"))
    # a value of zero would leave no place: such a row has no "at" but the first
    at = F.greatest(F.array_position(F.transform("v", lambda x: x != 0), True).cast("int") - 1,
                    F.lit(0))
    return p.select("event_id", F.size("v").alias("dims"), at.alias("at"),
                    _r(F.get("v", at), "x"))


def q_parse_labeled_legacy(spark, sf_dir):
    label, feats = parse_labeled(F.col("value"))
    p = legacy_lines(table(spark, sf_dir, "events")).select(
        "event_id", label.alias("label"), feats.alias("f"))
    return p.select("event_id", "label", F.size("f").alias("dims"),
                    _r(F.get("f", 0), "f0"), _r(F.get("f", 1), "f1"))


def q_linreg_closed_form(spark, sf_dir):
    p = regression_points(spark, sf_dir).select(F.get("features", 0).alias("x"), "label")
    r = linreg_closed_form(p, "x", "label")
    return r.select(_r(F.col("slope"), "slope"), _r(F.col("intercept"), "intercept"), "n")


def _trained_linreg(spark, sf_dir) -> LinRegState:
    return linreg_train_batch(regression_points(spark, sf_dir), LinRegState.zeros(1))


def q_linreg_sgd_batch(spark, sf_dir):
    m = _trained_linreg(spark, sf_dir)
    return spark.createDataFrame(
        [(_r6(m.weights[0]), _r6(m.intercept), m.iterations)],
        "weight double, intercept double, iterations int")


def q_linreg_score(spark, sf_dir):
    m = _trained_linreg(spark, sf_dir)
    s = linreg_score(regression_points(spark, sf_dir), m)
    return s.select("event_id", _r(F.col("label"), "label"), _r(F.col("prediction"), "prediction"))


def _start_kmeans() -> KMeansState:
    return KMeansState.fixed(KMEANS_START_CENTERS, weight=0.0)


def q_kmeans_assign(spark, sf_dir):
    return kmeans_assign(clustering_points(spark, sf_dir), _start_kmeans()).select(
        "event_id", "cluster")


def _trained_kmeans(spark, sf_dir) -> KMeansState:
    return kmeans_train_batch(clustering_points(spark, sf_dir), _start_kmeans())


def q_kmeans_train_batch(spark, sf_dir):
    m = _trained_kmeans(spark, sf_dir)
    rows = [(j, _r6(c[0]), _r6(c[1]), _r6(w))
            for j, (c, w) in enumerate(zip(m.centers, m.weights))]
    return spark.createDataFrame(rows, "cluster int, c0 double, c1 double, weight double")


def q_kmeans_score(spark, sf_dir):
    m = _trained_kmeans(spark, sf_dir)
    return kmeans_score(clustering_points(spark, sf_dir, labeled=True), m).select(
        "event_id", "label", "cluster")


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"))


def q_kmeans_assign_wide(spark, sf_dir):
    state = KMeansState.fixed(wide_start_centers(64), weight=0.0)
    return kmeans_assign(_embeddings(spark, sf_dir), state).select("vec_id", "cluster")


def q_kmeans_train_wide(spark, sf_dir):
    """One training batch on 64-dim vectors: the per-cluster sums are one
    aggregate of k x 64 numbers, whatever the number of rows."""
    m = kmeans_train_batch(_embeddings(spark, sf_dir),
                           KMeansState.fixed(wide_start_centers(64), weight=0.0))
    rows = [(j, d, _r6(c[d]), _r6(w))
            for j, (c, w) in enumerate(zip(m.centers, m.weights)) for d in range(len(c))]
    return spark.createDataFrame(rows, "cluster int, dim int, center double, weight double")


def _wide_sparse(spark, sf_dir) -> tuple[DataFrame, SparseKMeans]:
    lines = wide_sparse_lines(table(spark, sf_dir, "events"))
    points = write_once(parsed_columns(lines, "event_id", features=parse_sparse(F.col("value"))),
                        "sparse-points")                # read by both sides of the join
    return points, SparseKMeans.fixed(spark, wide_sparse_centers(), WIDE_SPARSE_DIM)


def q_kmeans_assign_sparse(spark, sf_dir):
    """Nearest of five sparse centers, vectors of a million dimensions."""
    points, model = _wide_sparse(spark, sf_dir)
    return kmeans_assign_sparse(points, model, "event_id").select("event_id", "cluster")


def q_kmeans_train_sparse(spark, sf_dir):
    """Stored entries of the centers after one batch."""
    points, model = _wide_sparse(spark, sf_dir)
    trained = kmeans_train_sparse(points, model, "event_id")
    weight = F.element_at(F.array(*[F.lit(w) for w in trained.weights]), F.col("cluster") + 1)
    return trained.centers.select("cluster", "index", _r(F.col("value"), "center"),
                                  _r(weight, "weight"))


ML_QUERIES = {
    "parse_vector": q_parse_vector,
    "parse_labeled": q_parse_labeled,
    "parse_vector_sparse": q_parse_vector_sparse,
    "parse_labeled_legacy": q_parse_labeled_legacy,
    "scale_features": q_scale_features,
    "scale_round_trip": q_scale_round_trip,
    "linreg_closed_form": q_linreg_closed_form,
    "linreg_sgd_batch": q_linreg_sgd_batch,
    "linreg_score": q_linreg_score,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_train_batch": q_kmeans_train_batch,
    "kmeans_score": q_kmeans_score,
    "kmeans_assign_sparse": q_kmeans_assign_sparse,
    "kmeans_train_sparse": q_kmeans_train_sparse,
    "kmeans_assign_wide": q_kmeans_assign_wide,
    "kmeans_train_wide": q_kmeans_train_wide,
}
