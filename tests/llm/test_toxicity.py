"""Toxicity: the estimator on made data, held-out accuracy, defined cases."""

import random
import zlib

import numpy as np
import pytest

from logstream.llm.toxicity import fit, nnpu_fit, op3_toxicity, score, toxicity_stage

SF = "/root/testdata/sf0.1"


def test_risk_estimator_separates_hidden_positives():
    rng = np.random.default_rng(0)
    n, d, prior = 4000, 30, 0.2
    hidden = rng.random(n) < prior
    x = rng.random((n, d)) < np.where(hidden[:, None], 0.4, 0.1)
    x[:, 10:] = rng.random((n, d - 10)) < 0.3            # noise
    p = (rng.random((300, d)) < 0.4)
    p[:, 10:] = rng.random((300, d - 10)) < 0.3
    both = np.vstack([p, x])
    rows, cols = np.nonzero(both)
    w, b = nnpu_fit(rows, cols, np.arange(len(both)) < 300, d, prior)
    z = x @ w + b
    auc = (z[hidden][:, None] > z[~hidden][None]).mean()
    assert auc > 0.85 and ((z > 0) == hidden).mean() > 0.85


@pytest.fixture(scope="module")
def scored(spark):
    return op3_toxicity(spark, SF).collect()


def test_held_out_accuracy(spark, scored):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in scored if r["held_out"]
            and r["doc_id"] in toxic]
    caught = sum(p for p, t in held if t) / sum(t for _, t in held)
    false = sum(p for p, t in held if not t) / sum(1 - t for _, t in held)
    assert len(held) > 500 and caught > 0.85 and false < 0.02


def make(spark, documents, n=400):
    rnd = random.Random(1)
    word = lambda: f"w{rnd.randint(0, 400)}"
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(40)]
        if i % 5 == 0:
            words[7] = words[20] = "vile"
            if i % 10 == 0:
                labels.append((i, 1))
        elif i % 3 == 0:
            labels.append((i, 0))
        rows.append((i, " ".join(words)))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(spark, documents):
    docs, labels = make(spark, documents)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    flipped = labels.selectExpr("doc_id", f"CASE WHEN doc_id IN ({','.join(map(str, held))}) "
                                "THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = fit(docs, labels), fit(docs, flipped)
    assert one.weights == two.weights and one.bias == two.bias
    assert one.score("a vile text") > one.score("a text") and one.score("") < 0.5


def test_defined_cases_and_stage(spark, documents, tmp_path):
    docs, labels = make(spark, documents)
    model = fit(docs, labels)
    odd = documents([(None, None), (1, ""), (1, ""), (2, "vile " * 50_000)])
    rows = score(odd, model, out="p").collect()
    assert len(rows) == 4 and all(0 <= r["p"] <= 1 for r in rows)
    assert score(odd.limit(0), model, out="p").count() == 0
    none = fit(docs, labels.where("toxic = 0"))
    assert none is None and {r["p"] for r in score(odd, none, out="p").collect()} == {0.0}
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = toxicity_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert not any("vile" in t for t in texts) and len(texts) >= 310
    assert toxicity_stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_the_sample_is_bounded_in_rows(spark, documents, monkeypatch):
    from logstream.llm import toxicity
    docs, labels = make(spark, documents)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 0]
    toxic = next(r["doc_id"] for r in labels.where("toxic = 1").orderBy("doc_id").collect()
                 if r["doc_id"] in ids)
    hot = documents([(toxic, f"vile row {i % 150}") for i in range(900)])
    sizes, ones = [], toxicity._ones

    def seen(sample, index):
        out = ones(sample, index)
        sizes.append(len(out))
        return out

    monkeypatch.setattr(toxicity, "_ones", seen)
    fit(docs.unionByName(hot), labels, max_positive=50, max_unlabelled=100)
    fit(docs.unionByName(hot), labels)
    known = {r["doc_id"] for r in labels.where("toxic = 1").collect()} & set(ids)
    assert sizes == [50, 100, len(known) + 150, len(ids) + 150]
