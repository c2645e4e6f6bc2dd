"""Histogram sort: a sorted, gapless, byte-balanced placement of every row."""

import zlib

from pyspark.sql import functions as F

from conftest import SF_SMALL
from logstream.llm.queries import op10_sharding
from logstream.llm.sharding import histogram_shards


def check(rows, sizes, shards=8, slack=0):
    """rows: (key, size, shard, slot)."""
    total = sum(sizes)
    by_shard = {}
    for key, size, shard, slot in rows:
        by_shard.setdefault(shard, []).append((slot, key, size))
    previous = None
    for shard in sorted(by_shard):
        part = sorted(by_shard[shard])
        assert [p[0] for p in part] == list(range(len(part)))
        for _, key, _ in part:                       # sorted over all shards, NULL first
            here = (key is not None, key or 0)
            assert previous is None or previous <= here
            previous = here
    for shard in range(shards):
        here = sum(p[2] for p in by_shard.get(shard, []))
        assert abs(here - total / shards) <= 2 * max(sizes) + slack


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = op10_sharding(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "bytes")
        assert r["grown_shard"] is None and 0 <= r["shard"] < 8
    check([(r["doc_id"], r["size"], r["shard"], r["slot"]) for r in out], [r["size"] for r in out])


def test_hot_key_nulls_and_wide_keys(spark):
    keys = [None] * 20 + [5] * 2000 + list(range(-1000, 1000)) + [2 ** 63 - 1, -(2 ** 63)]
    df = spark.createDataFrame([(k, 1 + i % 50) for i, k in enumerate(keys)], "k long, s int") \
        .withColumns({"shard": F.lit("x"), "slot": F.lit("y"), "__size2": F.lit(1)})
    out = histogram_shards(df, "k", "s", range_bytes=2000)
    assert out.columns == ["k", "s", "__size2", "shard", "slot"]
    rows = [(r["k"], r["s"], r["shard"], r["slot"]) for r in out.collect()]
    low = -(2 ** 63)              # NULL and the least long share a place
    check([(None if k == low else k, s, a, b) for k, s, a, b in rows], [r[1] for r in rows])


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(3, 10), (1, 10)], "k long, s int")
    rows = histogram_shards(df, "k", "s").collect()
    assert len(rows) == 2 and all(0 <= r["shard"] < 8 for r in rows)
    assert histogram_shards(df.limit(0), "k", "s").count() == 0
