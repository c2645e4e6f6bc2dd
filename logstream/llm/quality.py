"""Quality classifier by weak labels: noisy heuristics, EM, hashed linear scorer.

* LABELLERS are overlapping heuristics on the whole text; each votes good (1), bad (0) or
  abstains (-1).  Their votes are one small integer per document, a pattern.
* One aggregate counts the patterns of all documents (at most 3^11 rows).  Expectation-
  maximisation on those counts estimates each labeller's accuracy on good and on bad
  documents and the share of good ones, without any true label.
* The posterior of a pattern is the soft label of its documents.  A linear scorer on hashed
  shapes of the tokens (letters, capitals, digits, punctuation as they stand) learns it, from
  a sample of at most ``MAX_TRAINING`` rows: one per id and text, in the order of a hash of
  both.
* Every whole text is then scored; what a labeller abstained on still gets a score.

Defined results: NULL text counts as empty; a text without words is bad; ids may be NULL or repeat; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, materialise, per_batch, read_table, text_or_empty

MAX_TRAINING = 8_000
HASH_CELLS = 1 << 14
EM_ROUNDS = 200
EPOCHS, RATE, RIDGE = 300, 0.05, 1e-4

# bytes of UTF-8 to shapes: a letter (also every byte of other alphabets), A capital, 0 digit
_SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57
    else 32 if b in b" \t\n\r\v\f" else b for b in range(256))
_runs = re.compile(rb"(.)\1+", re.S)


# labeller: (good from, to), (bad below, above); between them it abstains.  Least words to vote.
LABELLERS = {
    "symbols": ((0, 0.06), (-1, 0.12), 1),
    "capitals": ((0, 0.12), (-1, 0.3), 5),
    "digits": ((0, 0.05), (-1, 0.2), 5),
    "distinct words": ((0.35, 9), (0.15, 9), 30),
    "bars": ((0, 0.01), (-1, 0.1), 5),
    "shouting": ((0, 0.03), (-1, 0.15), 5),
    "word length": ((3.5, 9), (2.2, 14), 5),
    "distinct lines": ((0.9, 1), (0.5, 1), 5),
    "sentences": ((0.02, 0.25), (0.004, 0.5), 30),
    "commonest word": ((0, 0.15), (-1, 0.3), 30),
    "stutter": ((0, 0.03), (-1, 0.12), 10),
}


def measures(text: str) -> tuple[int, list[float]]:
    """Number of words, and what each labeller looks at."""
    words = text.split()
    n = max(1, len(words))
    shape = text.encode("utf-8").translate(_SHAPE)
    small, capital, digit = shape.count(b"a"), shape.count(b"A"), shape.count(b"0")
    solid = max(1, len(shape) - shape.count(b" "))
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    counts = Counter(words)
    return len(words), [
        (solid - small - capital - digit) / solid,
        capital / max(1, small + capital),
        digit / solid,
        len(counts) / min(n, 400 + n / 4),       # long texts repeat words
        text.count("|") / n,
        text.count("!") / n,
        solid / n,
        len(set(lines)) / len(lines),
        sum(map(text.count, ".?!")) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
    ]


def votes(text: str) -> list[int]:
    """One vote per labeller: 1 good, 0 bad, -1 abstains.  A text without words is bad."""
    n, values = measures(text)
    if not n:
        return [0] * len(LABELLERS)
    return [-1 if n < least else 0 if x < below or x > above else 1 if lo <= x <= hi else -1
            for x, ((lo, hi), (below, above), least) in zip(values, LABELLERS.values())]


def pattern(text: str) -> int:
    code = 0
    for v in votes(text):
        code = code * 3 + v + 1
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    """Votes by pattern and labeller."""
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return codes[:, None] // powers % 3 - 1


class LabelModel:
    """P(good), and P(vote good) of each labeller on good and on bad documents, given a vote."""

    def __init__(self, share: float, on_good: np.ndarray, on_bad: np.ndarray):
        self.share, self.on_good, self.on_bad = share, on_good, on_bad

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        v = unpack(np.asarray(codes, np.int64))

        def logp(p):
            return np.where(v == 1, np.log(p), np.where(v == 0, np.log(1 - p), 0.0)).sum(1)

        odds = np.log(self.share / (1 - self.share)) + logp(self.on_good) - logp(self.on_bad)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_labels(codes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """EM from counts of vote patterns.  It starts from labellers that hardly ever fault a good
    document and each find some of the bad ones, which fixes which class is the good one."""
    v = unpack(codes)
    n = len(LABELLERS)
    model = LabelModel(0.85, np.full(n, 0.995), np.full(n, 0.85))
    for _ in range(rounds):
        good = model.posterior(codes) * counts
        bad = counts - good
        pick = lambda w, x: ((v == x) * w[:, None]).sum(0)
        # pseudo-counts of right votes keep labellers that hardly vote at the start
        on_good = (pick(good, 1) + 9.95) / (pick(good, 1) + pick(good, 0) + 10)
        on_bad = (pick(bad, 1) + 8.5) / (pick(bad, 1) + pick(bad, 0) + 10)
        share = (good.sum() + 8.5) / (counts.sum() + 10)
        model = LabelModel(float(np.clip(share, 0.05, 0.99)), np.clip(on_good, 0.01, 0.999),
                           np.clip(on_bad, 0.001, 0.99))
    return model


def shapes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells and values of a text's hashed token shapes (shares of its tokens, square root)."""
    tokens = _runs.sub(rb"\1", text.encode("utf-8").translate(_SHAPE)).split()
    counts = Counter(tokens)
    total = max(1, len(tokens))
    cells: Counter = Counter()
    for t, c in counts.items():
        cells[zlib.crc32(t) % HASH_CELLS] += c / total
    n, values = measures(text)
    for (name, (_, _, least)), x in zip(LABELLERS.items(), values):
        level = "few words" if n < least else str(int(20 * min(x, 1.5)))
        cells[zlib.crc32(f"{name} {level}".encode()) % HASH_CELLS] += 1
    keys = sorted(cells)
    return np.array(keys, np.int64), np.sqrt(np.array([cells[k] for k in keys]))


def fit_scorer(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, target: np.ndarray):
    """Logistic regression on soft labels (Adam, ridge): weights and bias."""
    n = len(target)
    w, b = np.zeros(HASH_CELLS), 0.0
    m, v = np.zeros(HASH_CELLS + 1), np.zeros(HASH_CELLS + 1)
    for t in range(1, EPOCHS + 1):
        z = np.bincount(rows, w[cols] * values, n) + b
        d = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / n
        g = np.append(np.bincount(cols, d[rows] * values, HASH_CELLS) + RIDGE * w, d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_training: int = MAX_TRAINING) -> DataFrame:
    """__id, __posterior (of the label model), __score (of the scorer) for every row."""
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    rows = rows.withColumn("__key", F.xxhash64("__id", "__text"))
    kind = rows.schema["__id"].dataType.simpleString()

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [pattern(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), batch.column(2)],
                                             ["__code", "__key"])

    voted = materialise(per_batch(rows, vote, "__code long, __key long"), "quality-votes")
    counted = voted.groupBy("__code").count().toPandas().sort_values("__code")  # 3^11 at most
    if not len(counted):
        return rows.select("__id", F.lit(0.0).alias("__posterior"), F.lit(0.0).alias("__score"))
    labels = fit_labels(counted["__code"].to_numpy(), counted["count"].to_numpy(float))

    # a bounded sample, so it may be broadcast; rows that repeat come back as one
    chosen = F.broadcast(voted.select("__key").distinct().orderBy("__key").limit(max_training))
    drawn = rows.join(chosen, "__key", "left_semi").dropDuplicates(["__key"])

    def training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            posterior = labels.posterior(np.array([pattern(t) for t in texts], np.int64)) \
                if texts else np.zeros(0)
            found = [shapes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64())), pa.array(posterior)],
                ["cells", "vals", "target"])

    sample = per_batch(drawn.select("__text"), training,
                       "cells array<long>, vals array<double>, target double").toPandas()
    sizes = [len(c) for c in sample["cells"]]
    if not sizes:
        w, b = np.zeros(HASH_CELLS), 0.0
    else:
        w, b = fit_scorer(np.repeat(np.arange(len(sizes)), sizes),
                          np.concatenate(sample["cells"].to_list()).astype(np.int64),
                          np.concatenate(sample["vals"].to_list()), sample["target"].to_numpy())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            posterior = labels.posterior(np.array([pattern(t) for t in texts], np.int64)) \
                if texts else np.zeros(0)
            scores = []
            for t in texts:
                cells, values = shapes(t)
                z = float((w[cells] * values).sum() + b)
                scores.append(1 / (1 + np.exp(-min(50.0, max(-50.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(posterior, pa.float64()),
                 pa.array(scores, pa.float64())], ["__id", "__posterior", "__score"])

    return per_batch(rows, judge, f"__id {kind}, __posterior double, __score double")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, posterior, score, predicted (1: good), kept of every document."""
    out = classify(read_table(spark, sf_dir, "documents"))
    good = F.col("__score") >= 0.5
    return out.select(F.col("__id").alias("doc_id"), held_out("__id").alias("held_out"),
                      F.col("__posterior").alias("posterior"), F.col("__score").alias("score"),
                      good.cast("int").alias("predicted"), good.alias("kept"))
