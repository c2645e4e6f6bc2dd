"""Quality: EM on made votes, held-out agreement with labels, defined cases."""

import numpy as np

from logstream.llm.quality import (LABELLERS, classify, fit_labels, op8_quality, pattern, unpack,
                                   votes)

SF = "/root/testdata/sf0.1"


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(2)
    n, k = 20_000, len(LABELLERS)
    good = rng.random(n) < 0.8
    on_good, on_bad = rng.uniform(0.93, 0.999, k), rng.uniform(0.3, 0.8, k)
    v = (rng.random((n, k)) < np.where(good[:, None], on_good, on_bad)).astype(int)
    v[rng.random((n, k)) < 0.2] = -1
    codes = ((v + 1) * 3 ** np.arange(k - 1, -1, -1)).sum(1)
    assert (unpack(codes) == v).all()
    kinds, counts = np.unique(codes, return_counts=True)
    model = fit_labels(kinds, counts.astype(float))
    assert abs(model.share - 0.8) < 0.03
    assert np.abs(model.on_good - on_good).max() < 0.02
    assert np.abs(model.on_bad - on_bad).max() < 0.08
    assert ((model.posterior(codes) > 0.5) == good).mean() > 0.93


def test_votes():
    good = "This is a plain sentence of words. " * 3 + "Another one follows here, calmly."
    assert 0 not in votes(good) and set(votes("")) == {0}
    assert 0 in votes("BUY NOW!! CHEAP!! OFFERS!! TODAY!! ONLY!! CALL!! US!! NOW!!")
    assert 0 in votes("a a a a b b b b c c c c d d d d e e e e")
    assert pattern(good) != pattern("")


def test_agrees_with_labels(spark):
    quality = {r["doc_id"]: r["quality"] for r in
               spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op8_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    seen = [(r["predicted"], quality[r["doc_id"]]) for r in rows if r["doc_id"] in quality]
    good = [p for p, q in seen if q]
    bad = [p for p, q in seen if not q]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.45


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "some plain words in a row. And more."),
            (5, "word " * 100_000)] + [
        (100 + i, f"This is text number {i} with calm words and ends. Fine it is.")
        for i in range(40)]
    got = classify(documents(rows)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["__score"] <= 1 and 0 <= r["__posterior"] <= 1 for r in got)
    assert all(r["__posterior"] < 0.5 for r in got if r["__id"] in (1, 2, 5))
    assert classify(documents(rows).limit(0)).count() == 0


def test_the_sample_is_one_row_per_id_and_text(spark, documents, monkeypatch):
    from logstream.llm import quality
    rows = [(1, "The same text in a third of all rows. It is copied.")] * 300 + [
        (100 + i, f"This is text number {i} with calm words and ends.") for i in range(60)]
    sizes, fitted = [], quality.fit_scorer

    def seen(rows, cols, values, target):
        sizes.append(len(target))
        return fitted(rows, cols, values, target)

    monkeypatch.setattr(quality, "fit_scorer", seen)
    one = classify(documents(rows), max_training=20).collect()
    two = classify(documents(rows).repartition(7), max_training=20).collect()
    classify(documents(rows)).collect()
    assert sizes == [20, 20, 61] and len(one) == len(rows)
    scores = lambda got: sorted(round(r["__score"], 9) for r in got)
    assert scores(one) == scores(two)
