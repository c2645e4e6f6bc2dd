"""Online models: sufficient-statistics descent equals row-wise descent,
two-batch warm start, k-means update rule and dying-cluster split."""

import math
import random

import numpy as np

from logstream.operators.online_ml import (KMeansState, LinRegState, kmeans_train_batch,
                                           kmeans_update, linreg_score, linreg_train_batch)


def rowwise_sgd(xs, ys, w, b, step=0.1, iters=50, tol=0.001):
    """Full-batch gradient descent over the rows themselves (no statistics)."""
    wv = np.array([w, b])
    for i in range(1, iters + 1):
        g = np.zeros(2)
        for x, y in zip(xs, ys):
            d = wv[0] * x + wv[1] - y
            g += d * np.array([x, 1.0])
        new = wv - step / math.sqrt(i) * (g / len(xs))
        if i > 1 and np.linalg.norm(wv - new) < tol * max(np.linalg.norm(new), 1.0):
            return new, i
        wv = new
    return wv, iters


def _batch(spark, pts):
    return spark.createDataFrame([(float(y), [float(x)]) for x, y in pts],
                                 "label double, features array<double>")


def test_linreg_two_batches_warm_start(spark):
    rnd = random.Random(1)
    b1 = [(x, 0.7 * x + 0.1 + rnd.uniform(-0.05, 0.05)) for x in
          [rnd.uniform(-1, 1) for _ in range(200)]]
    b2 = [(x, 0.7 * x + 0.1 + rnd.uniform(-0.05, 0.05)) for x in
          [rnd.uniform(-1, 1) for _ in range(150)]]
    m1 = linreg_train_batch(_batch(spark, b1), LinRegState.zeros(1))
    e1, it1 = rowwise_sgd([p[0] for p in b1], [p[1] for p in b1], 0.0, 1.0)
    assert abs(m1.weights[0] - e1[0]) < 1e-9 and abs(m1.intercept - e1[1]) < 1e-9
    assert m1.iterations == it1
    # next batch: weights carried, intercept restarts at 1.0 (bias appended)
    m2 = linreg_train_batch(_batch(spark, b2), m1)
    e2, _ = rowwise_sgd([p[0] for p in b2], [p[1] for p in b2], e1[0], 1.0)
    assert abs(m2.weights[0] - e2[0]) < 1e-9 and abs(m2.intercept - e2[1]) < 1e-9
    # carrying the intercept is an option
    m3 = linreg_train_batch(_batch(spark, b2), m1, carry_intercept=True)
    e3, _ = rowwise_sgd([p[0] for p in b2], [p[1] for p in b2], e1[0], e1[1])
    assert abs(m3.intercept - e3[1]) < 1e-9
    # empty batch leaves the model unchanged
    empty = _batch(spark, []).limit(0)
    assert linreg_train_batch(empty, m2) == m2
    pred = linreg_score(_batch(spark, [(0.5, 0.0)]), m2).first()["prediction"]
    assert abs(pred - (m2.weights[0] * 0.5 + m2.intercept)) < 1e-12


def test_kmeans_update_and_split(spark):
    pts = [[0.0, 0.0], [0.2, 0.0], [5.0, 5.0], [5.2, 5.0], [5.0, 5.2]]
    st = KMeansState.fixed([[0.0, 0.1], [5.0, 5.0], [100.0, 100.0]], weight=0.0)
    df = spark.createDataFrame([(p,) for p in pts], "features array<double>")
    m = kmeans_train_batch(df, st)
    # cluster 2 got no points and weight 0 -> dying: largest (1, weight 3) is split
    assert m.weights == [2.0, 1.5, 1.5]
    c1 = [5.2 / 3 + 5.0 / 3 + 5.0 / 3, 15.2 / 3]
    assert np.allclose(m.centers[0], [0.1, 0.0])
    assert np.allclose(m.centers[1], c1) and np.allclose(m.centers[2], c1)
    assert m.centers[1] != m.centers[2]
    # forgetful update with decay 0.5 on a second batch
    st2 = KMeansState.fixed([[0.0, 0.0], [10.0, 10.0]], weight=4.0, decay=0.5)
    m2 = kmeans_update(st2, {0: (2, [2.0, 0.0])})
    lam = 2 / (4 * 0.5 + 2)
    assert m2.weights == [4.0, 2.0]
    assert np.allclose(m2.centers[0], [(1 - lam) * 0 + lam * 1.0, 0.0])


def test_bad_vectors_neither_train_nor_score(spark):
    from logstream.operators.online_ml import (KMeansState, LinRegState, kmeans_assign,
                                               kmeans_train_batch, linreg_score, linreg_stats,
                                               rejected)
    rows = [(0.0, [4.0]), (0.0, [None, None]), (0.0, [0.2, 0.2]), (0.0, None), (1.0, [3.0, 3.0, 3.0])]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    start = KMeansState.fixed([[0.0, 0.0], [5.0, 5.0]], weight=1.0)
    trained = kmeans_train_batch(df, start)
    assert trained.centers == [[0.1, 0.1], [5.0, 5.0]] and rejected(df, 2).count() == 4
    assert [r["cluster"] for r in kmeans_assign(df, start).collect()] == [None, None, 0, None, None]
    only_bad = kmeans_train_batch(df.where("size(features) != 2"), start)
    assert only_bad.centers[1] == [5.0, 5.0]
    n, a, _ = linreg_stats(df, 1)
    assert n == 1 and a[0, 0] == 16.0 and a[1, 1] == 1.0
    got = linreg_score(df, LinRegState([2.0], 1.0)).collect()
    assert [r["prediction"] for r in got] == [9.0, None, None, None, None]
