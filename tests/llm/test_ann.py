"""Nearest neighbours: recall against brute force, exact scores, defined cases."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from logstream.llm.ann import op1_ann, rotation, scan_chunk, search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    other = np.flatnonzero(ids != ids[q])
    return [(int(ids[i]), float(d[i])) for i in other[np.lexsort((ids[other], d[other]))][:k]]


def answers(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got.setdefault(r["query_id"], [])) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    return got


def test_recall_and_scores_on_the_table(spark):
    rows = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    every = search(spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet"), F.col("__id") % 10 == 0)
    hits = total = 0
    for q, found in answers(every).items():
        true = brute(ids, x, int(np.flatnonzero(ids == q)[0]))
        hits += len({a for a, _ in true} & {a for a, _ in found})
        total += 10
        d = dict(brute(ids, x, int(np.flatnonzero(ids == q)[0]), k=len(ids)))
        assert all(abs(s - d[a]) < 1e-9 for a, s in found) and len(found) == 10
    assert total == 500 and hits / total >= 0.9
    assert answers(op1_ann(spark, SF_ORACLE)).keys() == {i for i in ids.tolist() if i % 100 == 0}


def test_recall_where_the_table_has_more_lists_than_are_probed(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    got = answers(search(df, F.col("__id") % 20 == 0))
    hits = sum(len({a for a, _ in brute(ids, x, int(np.flatnonzero(ids == q)[0]))}
                   & {a for a, _ in found}) for q, found in got.items())
    assert len(got) == sum(i % 20 == 0 for i in ids.tolist()) and hits / (10 * len(got)) >= 0.95


def test_recall_when_lists_are_skipped(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 24))
    x = (centers[rng.integers(0, 30, 4000)] + 0.4 * rng.normal(size=(4000, 24))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = answers(search(df, F.col("__id") % 50 == 0, probe_share=0.3))
    x64, ids = x.astype(float), np.arange(4000)
    hits = sum(len({a for a, _ in brute(ids, x64, q)} & {a for a, _ in got[q]}) for q in got)
    assert len(got) == 80 and hits / 800 >= 0.9


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []),
            (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 2.0, 3.0]),
            (None, [1.0, 1.0]), (100, [1.0, 0.1]), (100, [1.0, 0.1]), (200, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns(
        {"score": F.lit("x"), "rank": F.lit("y"), "__vec2": F.lit(1)})
    got = answers(search(df, F.col("__id") % 100 == 0))
    assert got.keys() == {0, 100}
    assert [a for a, _ in got[0]] == [1, 2, 100, 3]            # fewer than ten: all, ties by id
    assert got[0][0][1] == 0.0 and abs(got[0][3][1] - 2 ** 0.5) < 1e-12
    assert [a for a, _ in got[100]] == [0, 1, 2, 3]
    assert search(df.limit(0), F.col("__id") % 100 == 0).count() == 0
    assert search(df.where("vec_id in (0, 4)"), F.col("__id") % 100 == 0).count() == 0


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(300)] + [(1000, [1.0, 2.0, 3.5], 0)]
    got = answers(search(spark.createDataFrame(rows, SCHEMA), F.col("__id") % 100 == 0))
    for q in (0, 100, 200):
        assert [a for a, _ in got[q]] == [i for i in range(12) if i != q][:10]
    assert [a for a, _ in got[1000]] == list(range(10))


def test_scan_abandons_early_and_keeps_the_nearest():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 64)) * np.linspace(3, 0.1, 64)
    turned = (x @ rotation(64)).astype(np.float32)
    blocks = [np.ascontiguousarray(turned[:, i:i + 16]) for i in range(0, 64, 16)]
    read = hits = 0
    for q in range(50):
        at, exact, n = scan_chunk(x[q], turned[q], blocks, x, np.arange(2000), 10, np.inf)
        true = np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")[:10]
        hits += len(set(at.tolist()) & set(true.tolist()))
        read += n
    print(hits, read / (50 * 2000 * 64))
    assert hits / 500 >= 0.97 and read < 0.9 * 50 * 2000 * 64
    assert np.allclose(rotation(64) @ rotation(64).T, np.eye(64))
