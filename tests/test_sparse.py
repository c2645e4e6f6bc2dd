"""Sparse vectors: parsing, scores and k-means against the dense operators."""

import random

import pytest
from pyspark.sql import functions as F

from logstream.functions.parse import parse_sparse, parse_vector, parsed_columns
from logstream.operators.online_ml import (KMeansState, LinRegState, kmeans_assign,
                                           kmeans_train_batch, linreg_score)
from logstream.operators.sparse import (SparseKMeans, kmeans_assign_sparse, kmeans_train_sparse,
                                        linear_score_sparse)


def test_texts_of_any_size(spark):
    texts = ["(3,[2,0],[4.0,1.0])", "(2000000000,[7,1999999999],[1.5,-2.0])", "[0.0,2.5,0]",
             "(3,[0,0],[1.0,2.0])", "(3,[3],[1.0])", "(3,[-1],[1.0])", "(3,[0,1],[1.0])",
             "(0,[],[])", "[]", "(3,[0],[null])", "[1.0,null]", "[bad", "x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = {r["i"]: r["x"] and (r["x"]["size"], r["x"]["indices"], r["x"]["values"])
           for r in df.select("i", parse_sparse(F.col("v")).alias("x")).collect()}
    assert [got[i] for i in range(len(texts))] == [
        (3, [0, 2], [1.0, 4.0]), (2_000_000_000, [7, 1_999_999_999], [1.5, -2.0]),
        (3, [1], [2.5]), None, None, None, None, (0, [], []), (0, [], []), None, None, None, None,
        None, None]


@pytest.fixture()
def points(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        at = sorted(rng.sample(range(8), rng.randint(0, 4)))
        rows.append((i, f"(8,{at},{[round(rng.uniform(-2, 2), 3) for _ in at]})"))
    rows += [(900, "(9,[1],[1.0])"), (901, "broken"), (902, None)]
    df = spark.createDataFrame(rows, "id long, v string")
    return parsed_columns(df, "id", features=parse_sparse(F.col("v")),
                          dense=parse_vector(F.col("v"))).cache()


def dicts(centers):
    return [{i: v for i, v in enumerate(c) if v} for c in centers]


CENTERS = [[0, 1.0, 0, 0, 0, 0, 0, 2.0], [1.0, 0, 0, 0, 0, 0, 0, 0], [0.0] * 8,
           [0, 0, -1.5, 0, 1.0, 0, 0, 0]]


def test_assignment_and_training_equal_the_dense_ones(spark, points):
    state = KMeansState.fixed(CENTERS, weight=3.0, decay=0.5)
    model = SparseKMeans.fixed(spark, dicts(CENTERS), 8, weight=3.0, decay=0.5)
    for _ in range(3):
        want = {r["id"]: r["cluster"] for r in kmeans_assign(points, state, "dense").collect()}
        got = kmeans_assign_sparse(points, model, "id").collect()
        assert {r["id"]: r["cluster"] for r in got} == want and len(got) == 203
        assert want[900] is None and want[901] is None
        state = kmeans_train_batch(points, state, "dense")
        model = kmeans_train_sparse(points, model, "id")
        entries = {(r["cluster"], r["index"]): r["value"] for r in model.centers.collect()}
        assert model.weights == pytest.approx(state.weights)
        for j, c in enumerate(state.centers):
            for i, v in enumerate(c):
                assert entries.get((j, i), 0.0) == pytest.approx(v, abs=1e-12)


def test_a_dying_cluster_takes_half_of_the_largest(spark, points):
    far = [{0: 0.5}, {1: 1e9}]
    model = kmeans_train_sparse(points, SparseKMeans.fixed(spark, far, 8), "id")
    assert model.weights == [100.0, 100.0]
    a, b = ({r["index"]: r["value"] for r in model.centers.where(F.col("cluster") == j).collect()}
            for j in (0, 1))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-10) for i in a)


def test_scores_equal_the_dense_ones(spark, points):
    weights = [0.5, 0.0, -1.0, 2.0, 0.0, 0.0, 3.0, 0.25]
    table = spark.createDataFrame([(i, w) for i, w in enumerate(weights) if w],
                                  "index int, weight double")
    got = {r["id"]: r["prediction"] for r in
           linear_score_sparse(points, table, 8, "id", intercept=0.75).collect()}
    dense = points.where(F.size("dense") == 8).withColumn("label", F.lit(0.0))
    want = {r["id"]: r["prediction"] for r in
            linreg_score(dense, LinRegState(weights, 0.75), features="dense").collect()}
    assert len(got) == 203 and got[900] is None and got[902] is None
    assert all(got[i] == pytest.approx(p) for i, p in want.items()) and len(want) == 200


def test_a_plan_parses_once(spark, points):
    from logstream.plans.ml_queries import clustering_points, regression_points
    from logstream.operators.online_ml import usable
    for make, d in ((regression_points, 1), (clustering_points, 2)):
        df = make(spark, "/root/testdata/sf0.001")
        plain = df._jdf.queryExecution().optimizedPlan().toString().count("from_json")
        used = df.where(usable(F.col("features"), d)).agg(
            *[F.sum(F.get("features", j)) for j in range(d)])
        assert used._jdf.queryExecution().optimizedPlan().toString().count("from_json") == plain
