"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (label 1) are the positives; the other class is never labelled:
it is the text of all training documents, in which toxic ones hide.  With class prior p the
risk of the unseen negatives is R_u- minus p R_p-, kept from going below zero: when it
does, the step undoes it instead (Kiryo et al., 2017).  The model is a logistic one in
numpy over the presence of words and word beginnings.

* Labels are learned only from rows outside the held-out fold; a score depends on the text
  alone.
* ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` bound the rows the classifier is fitted on: one
  row per doc_id and text, in the order of a hash of both.  Feature counts, too, are of that
  sample.  The class prior
  is the toxic share of all labelled training rows, unless given.
* Every whole text is scored, in one pass without a shuffle.

Defined results: NULL and empty texts have no features and get the score of the intercept;
of several labels for a doc_id the largest counts; NULL doc_ids are scored but not learned
from; without any positive row every score is 0; rows that repeat are scored each; an empty
table gives no rows; other columns are not read (the stage passes them on).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, materialise, per_batch, read_table, text_or_empty

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
MAX_CANDIDATES = 200_000    # features that several positives share, at most
FEATURES = 4_096            # features of the model
LEAST_DOCS, LEAST_SHARE = 4, 0.015   # positives that must have a feature
LEAST_APART = 4.0           # standard errors between its shares of positives and of all
BEGINNINGS = (4, 5)         # lengths of word beginnings
LEVELS = (1, 2, 4)          # different words of a text that share one
EPOCHS, RATE, LASSO = 400, 0.05, 2e-4

_words = re.compile(r"\w+").findall


def features(text: str) -> set[str]:
    """Words, word beginnings, and beginnings that so many different words share."""
    words = set(_words(text.lower()))
    out = set(words)
    for n in BEGINNINGS:
        for start, k in Counter([w[:n] for w in words if len(w) > n]).items():
            out.update([f"{start}*{level}" for level in LEVELS if k >= level])
    return out


class Model:
    """Weights by feature; ``score`` of a text is a probability."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.words = {f for f in weights if "*" not in f}
        self.starts = {n: {f[:n] for f in weights if f[n:n + 1] == "*"} for n in BEGINNINGS}

    def score(self, text: str) -> float:
        words = set(_words(text.lower()))
        found = list(self.words & words)
        for n, starts in self.starts.items():
            shared = Counter([w[:n] for w in words if len(w) > n])
            found += [f for s in starts & shared.keys() for level in LEVELS
                      if shared[s] >= level and (f := f"{s}*{level}") in self.weights]
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def nnpu_fit(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_cols: int, prior: float,
             epochs: int = EPOCHS, rate: float = RATE, lasso: float = LASSO):
    """Weights and bias that minimise the non-negative PU risk (logistic loss,
    Adam, soft thresholds keep few weights).

    ``rows``, ``cols``: places of the ones; ``positive``: by row, else unlabelled.
    """
    n = len(positive)
    w, b = np.zeros(n_cols), 0.0
    m, v = np.zeros(n_cols + 1), np.zeros(n_cols + 1)
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    for t in range(1, epochs + 1):
        z = np.bincount(rows, w[cols], n) + b
        s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss_neg = np.logaddexp(0, z)
        negative_risk = loss_neg[~positive].sum() / n_u - prior * loss_neg[positive].sum() / n_p
        d_negative = np.where(positive, -prior * s / n_p, s / n_u)
        if negative_risk >= 0:
            d = d_negative + np.where(positive, prior * (s - 1) / n_p, 0.0)
        else:
            d = -d_negative
        g = np.append(np.bincount(cols, d[rows], n_cols), d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * lasso / (
            np.sqrt(v[:-1] / (1 - 0.999 ** t)) + 1e-4))
    return w, float(b)


def _counted(sample: DataFrame, wanted: set[str] | None, least: int = 1) -> dict[str, int]:
    """Documents of the sample that have each feature (all, or the wanted ones)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found = features(text.as_py())
                counts.update(found if wanted is None else found & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["feature", "n"])

    total = F.sum("n").alias("n")
    got = per_batch(sample.select("text"), run, "feature string, n long").groupBy("feature").agg(
        total).where(F.col("n") >= least)
    top = got.orderBy(F.desc("n"), "feature").limit(MAX_CANDIDATES).collect()
    return {r["feature"]: r["n"] for r in top}


def _ones(sample: DataFrame, index: dict[str, int]) -> list[np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [sorted(index[f] for f in features(t.as_py()) & index.keys())
                   for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32()))], ["ids"])

    table = per_batch(sample.select("text"), run, "ids array<int>").toPandas()
    return [np.asarray(x, np.int64) for x in table["ids"]]


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None,
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """None if no training row is labelled toxic."""
    known = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .where("toxic IS NOT NULL")
    train = docs.select("doc_id", text_or_empty().alias("text")).where(~held_out())
    if prior is None:
        seen = known.agg(F.avg(F.col("toxic").cast("double")).alias("p")).first()["p"]
        prior = min(0.9, max(0.01, seen or 0.01))
    train = train.withColumn("hash", F.xxhash64("doc_id", "text"))
    rows = train.select("doc_id", "hash").distinct()
    toxic = rows.join(known.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")

    def sample(of: DataFrame, most: int, name: str) -> DataFrame:
        # a bounded sample, so it may be broadcast; rows that repeat come back as one
        chosen = F.broadcast(of.orderBy("hash", "doc_id").limit(most))
        return materialise(train.join(chosen, ["doc_id", "hash"], "left_semi")
                           .dropDuplicates(["doc_id", "hash"]).select("text"), name)

    positives = sample(toxic, max_positive, "toxicity-positives")
    unlabelled = sample(rows, max_unlabelled, "toxicity-unlabelled")

    n_pos = positives.count()
    if not n_pos:
        return None
    in_pos = _counted(positives, None, least=max(LEAST_DOCS, int(n_pos * LEAST_SHARE)))
    in_all = _counted(unlabelled, set(in_pos))
    n_all = max(1, unlabelled.count())

    def apart(f: str) -> float:
        """Normal score of the difference of the two shares."""
        a, b = in_pos[f] / n_pos, in_all.get(f, 0) / n_all
        q = (in_pos[f] + in_all.get(f, 0) + 1) / (n_pos + n_all + 2)
        return abs(a - b) / (q * (1 - q) * (1 / n_pos + 1 / n_all)) ** 0.5

    chosen = sorted((f for f in in_pos if apart(f) >= LEAST_APART),
                    key=lambda f: (-apart(f), f))[:FEATURES]
    index = {f: i for i, f in enumerate(chosen)}
    sets = [_ones(positives, index), _ones(unlabelled, index)]
    every = sets[0] + sets[1]
    rows = np.repeat(np.arange(len(every)), [len(x) for x in every])
    cols = np.concatenate(every) if every else np.zeros(0, np.int64)
    positive = np.arange(len(every)) < len(sets[0])
    w, b = nnpu_fit(rows, cols, positive, len(chosen), prior)
    return Model({f: float(w[i]) for f, i in index.items() if w[i]}, b)


def score(docs: DataFrame, model: Model | None, text_col: str = "text",
          out: str = "score") -> DataFrame:
    """``docs`` with ``out``: probability that the whole text is toxic."""
    docs = docs.drop(out)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py() or "") if model else 0.0 for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             [*batch.schema.names, out])

    return per_batch(docs, run, T.StructType(
        [*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected, all input columns."""
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    name = "__toxicity"
    while name in docs.columns:
        name += "_"
    return score(docs, model, out=name).where(F.col(name) < 0.5).select(*docs.columns)
