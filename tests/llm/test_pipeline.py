"""The pipeline stage by stage, each against what it must keep."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from logstream.llm.near_dedup import kmers, near_duplicates
from logstream.llm.toxicity import fit

from .test_bpe import LIBRARY
from .test_mixing import brute_targets
from .test_near_dedup import brute as near_brute


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup",
                                                      "mixing", "bpe"]
    docs = corpus_pipeline.read_table(spark, SF_SMALL, "documents")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns[:len(columns)] == columns
        frames.append(docs)
    rows = [f.select("doc_id", "text").collect() for f in frames]
    model = fit(frames[0], corpus_pipeline.read_table(spark, SF_SMALL, "labels"))
    assert sorted(rows[1]) == sorted(r for r in rows[0] if model.score(r["text"]) < 0.5)
    last = {}
    for i, t in rows[1]:
        key = t.encode().lower()
        last[key] = max(i, last.get(key, -1))
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(last.values())
    classes = near_duplicates(frames[2]).collect()
    assert sorted(r["doc_id"] for r in rows[3]) == sorted({r["__class_id"] for r in classes})
    assert {r["doc_id"] for r in rows[4]} <= {r["doc_id"] for r in rows[3]}
    assert sorted(rows[5]) == sorted(rows[4])
    assert all(len(r["ids"]) == r["n_tokens"] for r in docs.collect())


def test_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def edge_rows(rnd):
    """NULL and empty texts, repeated rows, copies, near copies, a very long text, ties."""
    def text(n):
        return " ".join(f"w{rnd.randint(0, 4000)}" for _ in range(n))

    base, long_ = text(120), text(30_000)
    rows = [(1, None, "a"), (2, "", "a"), (3, None, None), (3, None, None), (4, "Plain Text here", "b"),
            (5, "plain text HERE", "b"), (5, "plain text HERE", "b"), (None, base, "b"),
            (6, base, None), (7, base + " tail", "c"), (8, base.upper(), "c"), (9, long_, "a"),
            (10, long_ + " x", "b"), (11, "...", "a"), (12, "?!", "c"), (None, None, "c")]
    return rows + [(100 + i, text(rnd.randint(1, 90)), "abc"[i % 3]) for i in range(60)]


def test_every_stage_against_brute_force_on_edge_rows(spark, documents, tmp_path):
    """NULL, empty, very long, repeated rows and clashing columns through the whole pipeline."""
    rows = edge_rows(random.Random(9))
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120).collect()
    rows += [(1000 + r["doc_id"], r["text"], r["source"]) for r in given]
    docs = documents(rows).withColumns({"__node": F.lit("n"), "__toxicity": F.lit(9.0),
                                        "n_tokens": F.lit("t"), "__copies": F.lit(5)})
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").withColumn(
        "doc_id", F.col("doc_id") + 1000)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns

    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), f"edge-{name}")
        frames.append(docs)
        if name != "bpe":
            assert docs.columns == names
    got = [[(r["doc_id"], r["text"], r["source"]) for r in f.collect()] for f in frames]

    model = fit(frames[0], labels)
    assert Counter(got[1]) == Counter(
        r for r in got[0] if model is None or model.score(r[1] or "") < 0.5)

    groups = defaultdict(list)
    for r in got[1]:
        groups[(r[1] or "").encode().lower()].append(r)
    kept = Counter((r[1] or "").encode().lower() for r in got[2])
    assert kept == Counter(dict.fromkeys(groups, 1))
    for r in got[2]:
        ids = [x[0] for x in groups[(r[1] or "").encode().lower()] if x[0] is not None]
        assert r in got[1] and r[0] == (max(ids) if ids else None)

    # classes by all pairs; ids are unique now but for NULL, which stands last
    numbered = [(r[0] if r[0] is not None else 10 ** 9, r[1]) for r in got[2]]
    bare = defaultdict(list)                     # without words: alike only if equal
    for i, t in numbered:
        if not len(kmers(t or "")[1]):
            bare[" ".join((t or "").split())].append(i)
    least = near_brute([r for r in numbered if len(kmers(r[1] or "")[1])])
    least.update({i: min(same) for same in bare.values() for i in same})
    assert sorted(r[0] if r[0] is not None else 10 ** 9 for r in got[3]) == sorted(set(least.values()))
    assert len(got[3]) < len(got[2])             # there were near copies

    sizes = {r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in got[3]}
    source, longest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r, n in sizes.items():
        source[r[2]] += n
        longest[r[2]] = max(longest[r[2]], n)
    copies = Counter(got[4])
    assert set(copies) <= set(sizes) and max(copies.values()) <= 3
    for r, k in copies.items():
        taken[r[2]] += k * sizes[r]
    for s, target in brute_targets(source).items():
        assert abs(taken[s] - target) <= longest[s] / 2 + 1e-6

    assert Counter(got[5]) == copies
    for r in frames[5].collect():
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert (r["__node"], r["__toxicity"], r["__copies"]) == ("n", 9.0, 5)
