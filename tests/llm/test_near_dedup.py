"""Near duplicates: classes against brute force, large buckets, alignment, components."""

import random
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from logstream.llm import near_dedup
from logstream.llm.near_dedup import (aligned, bag_jaccard, bands, components, kmers, near_dedup_stage,
                                      near_duplicates, op5_near_dedup)


def words(rnd, n):
    return [f"w{rnd.randint(0, 5000)}" for _ in range(n)]


def edited(rnd, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[at] = f"e{rnd.random()}"
        elif kind == 1:
            out.insert(at, f"e{rnd.random()}")
        else:
            del out[at]
    return out


def brute(rows):
    """Class (smallest id) of every row by all pairs."""
    grams = [kmers(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if grams[i][0] == grams[j][0] or (
                    bag_jaccard(np.sort(grams[i][1]), np.sort(grams[j][1])) >= 0.8
                    and aligned(grams[i][1], grams[j][1]) >= 0.8):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: least[top(i)] for i, (d, _) in enumerate(rows)}


def corpus(seed=3):
    rnd = random.Random(seed)
    rows = []
    passage = words(rnd, 60)
    for _ in range(25):
        base = words(rnd, rnd.randint(20, 300))
        if rnd.random() < 0.5:
            base += passage                           # a passage that many share
        rows.append(" ".join(base))
        for _ in range(rnd.randint(0, 4)):
            rows.append(" ".join(edited(rnd, base, rnd.randint(0, max(1, len(base) // 60)))))
    rows += ["", "  ", "one two", "one two", "One, two!", "x " * 2000, "x " * 2001]
    return [(i, t) for i, t in enumerate(rows)]


def test_equal_to_brute_force(spark, documents):
    rows = corpus()
    got = near_duplicates(documents(rows)).collect()
    assert {r["__id"]: r["__class_id"] for r in got} == brute(rows)
    for r in got:
        assert r["__kept"] == (r["__id"] == r["__class_id"])


def test_texts_without_words_and_words_with_marks(spark, documents):
    ki, ku = "\u0915\u093f", "\u0915\u0941"          # one consonant, two vowel signs
    rows = list(enumerate(["\U0001f600 \U0001f680", "--- ***", "\U0001f600 \U0001f680", "", None,
                           " ".join([ki, ku] * 10), " ".join([ku, ki] * 3 + [ki] * 14)]))
    got = {r["__id"]: r["__class_id"] for r in near_duplicates(documents(rows)).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6}


def test_large_buckets_meet_leaders_and_lose_no_link(spark, documents, monkeypatch):
    """Small blocks: most buckets are large, go through leader rounds and pairs of blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rnd = random.Random(9)
    base = words(rnd, 150)
    rows = [" ".join(edited(rnd, base, rnd.randint(0, 4))) for _ in range(60)]
    other = base[:120] + words(rnd, 40)               # shares most of the base
    rows += [" ".join(edited(rnd, other, rnd.randint(0, 2))) for _ in range(20)]
    rows = list(enumerate(rows))
    got = near_duplicates(documents(rows)).collect()
    expect = brute(rows)
    assert {r["__id"]: r["__class_id"] for r in got} == expect


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in op5_near_dedup(spark, SF_SMALL).collect()}
    assert got == brute(rows)


def test_bands_are_shared_by_similar_texts():
    rnd = random.Random(1)
    found = 0
    for _ in range(200):
        base = words(rnd, 400)
        a, b = kmers(" ".join(base))[1], kmers(" ".join(edited(rnd, base, 7)))[1]
        if aligned(a, b) >= 0.8:
            assert set(bands(a).tolist()) & set(bands(b).tolist())
            found += 1
    assert found > 100


def test_alignment_needs_the_order():
    rnd = random.Random(2)
    base = words(rnd, 200)
    moved = base[100:] + base[:100]
    a, b = kmers(" ".join(base))[1], kmers(" ".join(moved))[1]
    assert bag_jaccard(np.sort(a), np.sort(b)) > 0.9 and aligned(a, b) < 0.8
    assert aligned(a, a) == 1.0


def test_occurrences_are_labelled():
    grams = kmers("a b c d e " * 50)[1]
    assert len(set(grams.tolist())) == len(grams) == 246


def test_null_ids_repeated_rows_and_stage(spark, documents):
    rnd = random.Random(5)
    base = words(rnd, 200)
    rows = [(5, " ".join(base)), (5, " ".join(base)), (3, " ".join(edited(rnd, base, 2))),
            (None, " ".join(edited(rnd, base, 1))), (None, "alone here"), (8, None), (9, ""),
            (10, "far away text of six words")]
    docs = documents(rows)
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sum(r["__kept"] for r in got) == 4          # the group, "alone", empty, "far away"
    staged = near_dedup_stage(spark, docs, "")
    assert staged.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in staged.collect()) == [0, 3, 8, 10]
    assert near_duplicates(docs.limit(0)).count() == 0
    assert near_dedup_stage(spark, docs.limit(0), "").count() == 0


def test_stage_keeps_one_of_repeated_rows(spark, documents):
    docs = documents([(5, "a b c d e f g"), (5, "a b c d e f g"), (6, "other")])
    assert sorted(r["doc_id"] for r in near_dedup_stage(spark, docs, "").collect()) == [5, 6]


@pytest.mark.parametrize("shape", ["path", "random"])
def test_components(spark, shape):
    rnd = random.Random(8)
    names = [f"{i:03d}" for i in range(60)]
    if shape == "path":
        order = names[:]
        rnd.shuffle(order)
        edges = list(zip(order, order[1:]))
    else:
        edges = [(rnd.choice(names), rnd.choice(names)) for _ in range(45)]
    got = {r["__n"]: r["__class"] for r in components(
        spark.createDataFrame(edges, "__node string, __other string")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for start in names:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        if len(seen) > 1:
            assert got.get(start, start) == min(seen)


def test_rows_that_a_large_group_sends_to_comparison(spark, documents, monkeypatch):
    """Loose copies of one text: what is not yet in the class of most of a bucket meets leaders
    once for all buckets and in blocks, so the rows with texts stay near the members'."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    sent, members = [], []

    def counted(name):
        plain = getattr(near_dedup, name)

        def run(rows, *others):
            sent.append(rows.count())
            return plain(rows, *others)
        monkeypatch.setattr(near_dedup, name, run)

    for name in ("_compared", "_verified"):           # the latter compared pairs of texts
        if hasattr(near_dedup, name):
            counted(name)
    large = near_dedup._large

    def seen(rows, *others):
        members.append(rows.count())
        return large(rows, *others)

    monkeypatch.setattr(near_dedup, "_large", seen)
    rnd = random.Random(11)
    base = words(rnd, 150)
    rows = list(enumerate(" ".join(edited(rnd, base, rnd.randint(1, 9))) for _ in range(160)))
    got = near_duplicates(documents(rows)).collect()
    assert {r["__id"]: r["__class_id"] for r in got} == brute(rows)
    assert members[0] > 500
    assert sum(sent[1:]) < 3 * members[0], (sent, members)     # the first: small buckets


def test_a_large_group_takes_few_passes_over_the_graph(spark, documents, monkeypatch):
    """Large buckets add one search for components to that of the first links, and compare what
    stays outside once for all buckets of one main class."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    passes, plain = [], near_dedup.components

    def counted(links):
        passes.append(links.count())
        return plain(links)

    monkeypatch.setattr(near_dedup, "components", counted)
    rnd = random.Random(12)
    base = words(rnd, 150)
    rows = list(enumerate(" ".join(edited(rnd, base, rnd.randint(1, 9))) for _ in range(160)))
    got = near_duplicates(documents(rows)).collect()
    assert {r["__id"]: r["__class_id"] for r in got} == brute(rows)
    assert len(passes) <= 2
