"""Mixing: targets against the iterative rule, budgets, epochs, reruns."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import SF_SMALL
from logstream.llm.mixing import mix, mixing_stage, op2_mixing, targets


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s] + 1e-9]
        if not above:
            return share | capped
        capped.update({s: float(most * sizes[s]) for s in above})


def test_targets_equal_the_iterative_rule(spark):
    rnd = random.Random(4)
    for case in range(6):
        sizes = {f"s{i}": rnd.choice([1, 10, 1000, 50_000, 0]) for i in range(rnd.randint(1, 25))}
        if case % 2:
            sizes[None] = 77
        df = spark.createDataFrame(list(sizes.items()), "__source string, __source_size long")
        got = {r["__source"]: r["__target"] for r in targets(df).collect()}
        expect = brute_targets(sizes)
        assert got.keys() == expect.keys()
        assert all(abs(got[s] - expect[s]) < 1e-6 * max(1, expect[s]) for s in expect)


def test_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = op2_mixing(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for i, d in docs.items()}
    by_source, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, d in docs.items():
        by_source[d["source"]] += size[i]
        longest[d["source"]] = max(longest[d["source"]], size[i])
    expect = brute_targets(by_source)
    for r in out:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[s]
        assert abs(r["target"] - expect[s]) < 1e-6 * max(1, expect[s])
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] <= 3
        taken[s] += r["taken"]
    assert all(abs(taken[s] - expect[s]) <= longest[s] / 2 + 1e-6 for s in expect)
    again = {(r["doc_id"], r["copies"]) for r in op2_mixing(spark, SF_SMALL).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in out}


def test_epochs_before_fractions_and_ranges_do_not_matter(spark):
    rows = spark.range(400).select(F.col("id"), F.lit(10).cast("long").alias("n"),
                                   F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s"))
    results = []
    for per_range in (7, 10_000):
        out = mix(rows, F.col("n"), F.col("s"), F.lit(1.0), F.col("id").cast("string"),
                  [F.col("id").alias("__id")], rows_per_range=per_range)
        results.append({r["__id"]: r["__copies"] for r in out.collect()})
    assert results[0] == results[1]
    for s in (0, 1):        # copies within a source differ by one at most
        part = {c for i, c in results[0].items() if (i % 3 == 0) == (s == 0)}
        assert max(part) - min(part) <= 1


def test_heavier_documents_come_first(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 2).alias("heavy"))
    rows = rows.withColumn("s", F.when(F.col("id") < 2000, "a").otherwise("b"))
    out = mix(rows, F.lit(1).cast("long"), F.col("s"),
              F.when(F.col("heavy") == 1, 4.0).otherwise(1.0), F.col("id").cast("string"),
              [F.col("id").alias("__id"), F.col("heavy").alias("__heavy")])
    taken = out.where("__source = 'b'").groupBy("__heavy").agg(F.sum("__copies").alias("n"))
    n = {r["__heavy"]: r["n"] for r in taken.collect()}
    assert n[1] > 1.3 * n[0]


def test_edge_rows_and_stage(spark, documents, tmp_path):
    rows = [(1, None, None), (2, "", "a"), (3, "one two", "a"), (3, "one two", "a"),
            (None, "x y z", None), (5, "w " * 30_000, "b"), (6, "k", "c")]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    out = op2_mixing(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    assert all(r["taken"] == 0 for r in out if not r["size"])
    staged = mixing_stage(spark, docs, str(tmp_path))
    assert staged.columns == docs.columns
    words = lambda t: len((t or "").split())
    assert sum(words(r["text"]) for r in staged.collect()) == sum(r["taken"] for r in out)
    assert mixing_stage(spark, docs.limit(0), str(tmp_path)).count() == 0
