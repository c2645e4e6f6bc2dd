"""Periodic runs against brute force over all periods, and the query's SQL."""

import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from logstream.llm.periodic import Grammar, periodic_runs, planted, runs_of
from logstream.llm.queries import QUERIES, SQL
from oracle_harness import compare, duck


def brute(w, least=24, repeats=3):
    """Runs (start, length, period), every period tried."""
    found = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def made(rng, kind, n, vocab):
    w = [rng.randrange(vocab) for _ in range(n)]
    if kind == 1 and n:                                  # periodic from some word on
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    elif kind == 2:                                      # one repeated line
        w = (w[:rng.randint(1, 20)] * 20)[:n]
    elif kind == 3:                                      # Fibonacci word: many nested runs
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        w = y[:n]
    elif kind == 4:                                      # several runs next to each other
        b, w = [rng.randrange(vocab) for _ in range(rng.randint(1, 6))], []
        for _ in range(rng.randint(1, 8)):
            w += b * rng.randint(1, 12) + [rng.randrange(vocab) for _ in range(rng.randint(0, 3))]
    return w


def by_document(documents, runs):
    edges = np.cumsum([0] + [len(d) for d in documents])
    out = [[] for _ in documents]
    for s, e, q in zip(*(x.tolist() for x in runs)):
        d = max(i for i in range(len(documents)) if edges[i] <= s and len(documents[i]))
        out[d].append((s - int(edges[d]), e - s, q))
    return out


@pytest.mark.parametrize("least", [24, 10, 40])
def test_equal_to_brute_force(least):
    rng = random.Random(least)
    for _ in range(250):
        docs = [made(rng, rng.randint(0, 4), rng.randint(0, 200), rng.choice([1, 2, 3, 5, 50]))
                for _ in range(rng.randint(1, 6))]
        runs = runs_of([np.array(d, np.int64) for d in docs], 60, least)
        assert by_document(docs, runs) == [brute(d, least) for d in docs]


def test_grammar_derives_the_text_and_no_pair_spans_documents():
    rng = random.Random(3)
    docs = [[rng.randrange(4) for _ in range(300)] * 2 for _ in range(5)]
    words = np.concatenate([np.array(d) for d in docs])
    g = Grammar(words, np.repeat(np.arange(5), 600), 4)

    def derive(s):
        return [s] if s < 4 else derive(int(g.left[s])) + derive(int(g.right[s]))

    assert [w for s in g.symbols.tolist() for w in derive(s)] == words.tolist()
    assert len(g.symbols) < len(words) / 3
    ends = g.starts + g.length[g.symbols]
    assert ((g.starts // 600) == ((ends - 1) // 600)).all()
    for s in range(4, len(g.length)):
        assert derive(s) == words[g.place[s]:g.place[s] + g.length[s]].tolist()


def test_long_runs_and_long_texts():
    n = 200_000
    one = np.zeros(n, np.int64)
    line = np.tile(np.arange(1, 98), n // 97)
    rng = np.random.default_rng(1)
    noise = rng.integers(100, 50_000, n)
    start, end, period = runs_of([one, noise, line], 50_000)
    assert [(int(s), int(e), int(q)) for s, e, q in zip(start, end, period)] == [
        (0, n, 1), (2 * n, 2 * n + len(line), 97)]


ROWS = [(1, "a b c " * 9), (2, None), (3, ""), (4, " \t\n"), (5, "x " * 23), (6, "x " * 24),
        (7, "x y z " * 30), (7, "x y z " * 30), (None, "k " * 30 + "m"),
        (8, "lead " + "p q\x0b" * 40 + "r"), (9, "w" * 100_000 + " " + "v\x1cu " * 26)]


def test_rows_and_collapsed_texts(spark, documents):
    got = sorted(((r["__id"] is None, r["__id"] or 0, [tuple(x) for x in r["__runs"]],
                   r["__collapsed"]) for r in periodic_runs(documents(ROWS)).collect()))
    want = []
    for i, t in ROWS:
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        runs = brute(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i is None, i or 0, runs,
                     " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert got == sorted(want)
    assert periodic_runs(documents(ROWS).limit(0)).count() == 0


def test_planted_words_follow_the_contract():
    import zlib
    hit = 0
    for doc_id in range(300):
        words = [str(i).encode() for i in range(doc_id % 50)]
        h, n, out = zlib.crc32(str(doc_id).encode()), len(words), planted(doc_id, words)
        if h % 10 or not n:
            assert out == words
            continue
        hit += 1
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        assert out == [words[i if i < a else a + (i - a) % p] for i in range(n)]
    assert hit > 10 and planted(None, [b"a"]) == [b"a"]


def test_query_matches_sql(spark):
    res = compare(spark, duck(SF_SMALL), QUERIES["op11_periodic_runs"],
                  SQL["op11_periodic_runs"], SF_SMALL)
    assert res["ok"], res
