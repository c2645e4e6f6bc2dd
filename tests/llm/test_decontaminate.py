"""Benchmark decontamination against brute force over words and the query's SQL."""

import hashlib
import random
import re

import pytest

from conftest import SF_SMALL
from logstream.llm.decontaminate import Benchmark, contamination, op12_decontamination
from logstream.llm.queries import QUERIES, SQL
from oracle_harness import compare, duck


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    sought = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), window)
        for a in range(len(w) - n + 1 if n else 0):
            sought.setdefault(tuple(w[a:a + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in sought}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in sought:
                    hit.update(range(a, a + n))
                    found |= sought[tuple(w[a:a + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None), hit))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:4]))


def frames(spark, documents, items):
    return documents, spark.createDataFrame(
        [(i, t, "x") for i, t in items], "item_id long, text string, __item string")


def run(spark, docs, items, **kw):
    got = [(r["__id"], r["__n_words"], r["__n_hit"], list(r["__items"]),
            {p for s in r["__spans"] for p in range(s["start"], s["end"])})
           for r in contamination(*frames(spark, docs, items), **kw).collect()]
    return sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1:4]))


@pytest.mark.parametrize("window,gram", [(10, 5), (6, 2), (4, 4), (1, 1)])
def test_equal_to_brute_force(spark, documents, window, gram):
    rng = random.Random(window)
    vocab = ["a", "B", "c", "É", "d9"]
    items = [(i % 23 if i % 9 else None, " ".join(rng.choices(vocab, k=rng.randint(0, 25))))
             for i in range(30)] + [(50, None), (51, "..."), (52, "a, B")]
    docs = []
    for i in range(60):
        text = " ".join(rng.choices(vocab, k=rng.randint(0, 40)))
        if i % 3 == 0:
            text += "; " + (items[rng.randrange(30)][1]).upper() + "! " + text
        docs.append((i, text))
    docs += [(7, docs[7][1]), (None, docs[3][1]), (100, None), (101, ""), (102, " .,"),
             (103, "a " * 30_000)]
    assert run(spark, documents(docs), items, window=window, gram=gram) == brute(docs, items, window)


def test_every_shared_span_is_found_wherever_it_stands(spark, documents):
    """The guarantee: one window inside long foreign text on both sides, at every offset."""
    passage = " ".join(f"p{i}" for i in range(10))
    items = [(1, f"{'x ' * 7}{passage} {'y ' * 9}")]
    docs = [(i, " ".join([f"l{j}" for j in range(i)] + [passage] + [f"r{j}" for j in range(i)]))
            for i in range(20)] + [(99, passage.replace("p4", "q4"))]
    for r in contamination(*frames(spark, documents(docs), items)).collect():
        want = 0 if r["__id"] == 99 else 10
        assert r["__n_hit"] == want and list(r["__items"]) == (["1"] if want else [])


def test_empty_tables(spark, documents):
    docs, items = documents([(1, "a b c")]), [(1, "a b c")]
    assert run(spark, docs.limit(0), items) == []
    assert run(spark, docs, []) == [(1, 3, 0, [], set())]
    assert run(spark, docs, [(1, None)]) == [(1, 3, 0, [], set())]


def test_windows_of_the_same_items_are_one_class(spark):
    text = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(i, text) for i in range(50)], "item_id long, text string")
    bench = Benchmark(items)
    assert bench.classes.count() == 31 and bench.members.count() == 50
    assert bench.classes.select("__class").distinct().count() == 1


def test_native_plan(spark):
    plan = op12_decontamination(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|InArrow|InPandas|CartesianProduct", plan)


def test_query_matches_sql(spark):
    res = compare(spark, duck(SF_SMALL), QUERIES["op12_decontamination"],
                  SQL["op12_decontamination"], SF_SMALL)
    assert res["ok"], res
    empty = hashlib.sha256(b"").hexdigest()
    rows = op12_decontamination(spark, SF_SMALL).collect()
    assert any(r["contaminated"] for r in rows)
    assert all((r["items_sha256"] == empty) == (r["n_items"] == 0) for r in rows)
