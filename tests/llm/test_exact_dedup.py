"""Exact dedup against grouping by normalised text; forced hash collisions; the directory."""

import hashlib

import pytest

from conftest import SF_SMALL
from logstream.llm.exact_dedup import build_directory, dedup, dedup_stage
from logstream.llm.queries import QUERIES, SQL
from oracle_harness import compare, duck


def normal(text):
    return (text or "").encode().lower()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0], r[1] or -1, *r[2:]))


def brute(rows):
    """(id, keep_id, size, sha) per row."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    return in_order(((i is not None, i or 0), max((x for x in groups[normal(t)] if x is not None),
                                                default=None),
                   len(groups[normal(t)]), hashlib.sha256(normal(t)).hexdigest()) for i, t in rows)


ROWS = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, None), (5, ""), (6, "É"), (7, "é"), (7, "é"),
        (None, "abc"), (None, "only null"), (None, "only null"), (9, "z" * 100_000),
        (8, "Z" * 100_000)] + [(100 + i, f"text {i % 7}") for i in range(60)]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_equal_to_brute_force_with_collisions(spark, documents, bits):
    got = dedup(documents(ROWS), hash_bits=bits, capacity=4).collect()
    assert in_order(((r["__id"] is not None, r["__id"] or 0), r["__keep_id"], r["__group_size"],
                     r["__sha"]) for r in got) == brute(ROWS)
    kept = [r for r in got if r["__kept"]]
    assert len(kept) == len({normal(t) for _, t in ROWS})       # one row of each group
    assert all(r["__id"] == r["__keep_id"] for r in kept)


def test_stage_keeps_one_row_of_each_text(spark, documents):
    docs = documents(ROWS)
    out = dedup_stage(spark, docs, "")
    assert out.columns == docs.columns
    texts = [normal(r["text"]) for r in out.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t in ROWS})


def test_empty_table(spark, documents):
    assert dedup(documents(ROWS).limit(0)).count() == 0


def test_directory_splits_overfull_buckets(spark):
    step = (1 << 64) // 1000
    links = spark.createDataFrame([(i * step - (1 << 63),) for i in range(1000)], "__hash long")
    buckets = build_directory(links, capacity=100, max_depth=8)
    assert sum(n for _, _, n in buckets) == 1000 and all(n <= 100 for _, _, n in buckets)
    spans = [(f, f + (1 << (8 - d))) for f, d, _ in buckets]
    assert spans[0][0] == 0 and spans[-1][1] == 256                # they cover the directory
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_query_matches_sql(spark):
    res = compare(spark, duck(SF_SMALL), QUERIES["op9_exact_dedup"], SQL["op9_exact_dedup"], SF_SMALL)
    assert res["ok"], res
