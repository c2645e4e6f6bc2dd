"""Chat: maximal conversations against brute force, rendering, segments."""

import random

import duckdb
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logstream.llm.chat import maximal, render
from logstream.llm.queries import QUERIES, SQL
from oracle_harness import compare, duck

SCHEMA = "conv_id long, turn long, role string, text string"


def turns_of(rows):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t, r, x))
    return {c: [(r, x) for _, r, x in sorted(v, key=key)] for c, v in convs.items()}


def brute(rows):
    convs = turns_of(rows)
    best = {}
    for c, v in convs.items():
        k = tuple(v)
        best[k] = min((x for x in (best.get(k, c), c) if x is not None), default=None)
    keep = {c: v for v, c in best.items()
            if not any(len(o) > len(v) and o[:len(v)] == v for o in best)}
    return {c: "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in v)
            for c, v in keep.items()}


def rendered(spark, rows, segment_turns):
    out = render(maximal(spark.createDataFrame(rows, SCHEMA), segment_turns)).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["segment"]):
        got[r["conv_id"]] = got.get(r["conv_id"], "") + r["rendered"]
    return got


def test_equal_to_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for c in range(60):       # snapshots of a few growing dialogues, at several lengths
        base = rnd.randint(0, 5)
        for t in range(rnd.randint(1, 12)):
            rows.append((c, t * (1 + base % 2), "user" if t % 2 else "assistant",
                         f"{base if t < 9 else c}-{t}"))
    rows += [(100, 0, None, None), (100, None, "user", "x"), (101, 0, "", ""), (None, 0, "user", "n"),
             (None, 1, "user", "m"), (102, 0, "user", "n")]
    rows += rows[:30]         # logged twice
    for segment_turns in (2, 64):
        assert rendered(spark, rows, segment_turns) == brute(rows)


def test_segments_are_bounded_whatever_the_key(spark):
    rows = [(None, i % 7, "user", f"n{i}") for i in range(700)]          # few turn numbers
    rows += [(1, None if i % 2 else i % 5, "user", f"t{i}") for i in range(300)]
    rows += [(2, t, "user", f"s{t}") for t in range(0, 300, 3)]          # gaps
    rows += [(3, i, r, x) for i, (r, x) in enumerate(turns_of(rows)[None][:200])]
    out = render(maximal(spark.createDataFrame(rows, SCHEMA))).collect()
    assert max(r["segment_turns"] for r in out) <= 64
    assert {r["segment"]: r["segment_turns"] for r in out if r["conv_id"] == 2} == {0: 64, 1: 36}
    assert {r["n_turns"] for r in out if r["conv_id"] is None} == {700}
    assert rendered(spark, rows, 64) == brute(rows)      # conversation 3 is a snapshot
    assert 3 not in brute(rows)


def test_places_across_ranges_pieces_and_blocks(spark, monkeypatch):
    monkeypatch.setattr("logstream.llm.chat.PIECE", 3)
    monkeypatch.setattr("logstream.llm.chat.BLOCK", 2)
    rows = [(c, t, "user", f"{t}") for c, n in ((1, 40), (2, 100), (None, 99)) for t in range(n)]
    rows += [(4, t, "user", f"{t if t != 50 else 'other'}") for t in range(90)]
    assert set(rendered(spark, rows, 8)) == {2, 4}
    assert rendered(spark, rows, 8) == brute(rows)


def test_very_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "w" * 300_000), (2, 0, "user", "w" * 300_000), (2, 1, "assistant", "ok")]
    assert set(rendered(spark, rows, 64)) == {2}
    assert render(maximal(spark.createDataFrame([], SCHEMA))).count() == 0


def test_clashing_columns_and_the_sql_on_hot_and_null_conversations(spark, tmp_path):
    rows = [(None, i % 7, "user", f"n{i}") for i in range(200)]
    rows += [(1, i, "user" if i % 2 else None, f"t{i}" if i % 3 else None) for i in range(150)]
    rows += [(2, i, "user" if i % 2 else None, f"t{i}" if i % 3 else None) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"__position": F.lit("x"), "segment": F.lit("y"), "__segment": F.lit(3)})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM "
                f"read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    res = compare(spark, con, QUERIES["op6_chat"], SQL["op6_chat"], str(tmp_path))
    assert res["ok"], res


def test_query_matches_sql(spark):
    res = compare(spark, duck(SF_SMALL), QUERIES["op6_chat"], SQL["op6_chat"], SF_SMALL)
    assert res["ok"], res
