"""Batch sessions against a brute-force per-key scan, with a hot key,
a NULL key, gaps exactly at the limit and more than 10 clicks."""

import datetime as dt
import random

from logstream.operators.sessions import sessionize

BASE = dt.datetime(2024, 1, 1)


def brute(rows, gap_s, k=10):
    by = {}
    for eid, ts, ip, url in rows:
        by.setdefault(ip, []).append((ts, eid, url))
    out = set()
    for ip, evs in by.items():
        evs.sort()
        cur = [evs[0]]
        for e in evs[1:]:
            if (e[0] - cur[-1][0]).total_seconds() > gap_s:
                out.add((ip, cur[0][0], cur[-1][0], len(cur), tuple(u for _, _, u in cur[:k])))
                cur = [e]
            else:
                cur.append(e)
        out.add((ip, cur[0][0], cur[-1][0], len(cur), tuple(u for _, _, u in cur[:k])))
    return out


def make_rows(seed=3, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        r = rnd.random()
        ip = "hot" if r < 0.35 else None if r < 0.40 else f"10.0.0.{rnd.randint(1, 6)}"
        ts = BASE + dt.timedelta(seconds=rnd.randint(0, 6 * 3600))
        rows.append((i, ts, ip, f"/u{rnd.randint(0, 20)}"))
    # clicks exactly one gap apart continue the session; one second more breaks it
    rows += [(10_000, BASE + dt.timedelta(days=2), "edge", "/a"),
             (10_001, BASE + dt.timedelta(days=2, minutes=30), "edge", "/b"),
             (10_002, BASE + dt.timedelta(days=2, minutes=60, seconds=1), "edge", "/c")]
    return rows


def run(spark, rows, gap):
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, ip string, url string")
    got = sessionize(df, gap=gap, max_clicks=10, key="ip", time_col="ts").collect()
    return {(r["ip"], r["session_start"], r["session_end"], r["session_length"],
             tuple(r["clickstream"])) for r in got}


def test_sessions_match_brute_force(spark):
    rows = make_rows()
    for gap_s, gap in [(1800, "30 minutes"), (120, "2 minutes"), (2 * 86400, "2 days")]:
        assert run(spark, rows, gap) == brute(rows, gap_s), gap


def test_gap_boundary_and_first_ten(spark):
    rows = make_rows()
    got = run(spark, rows, "30 minutes")
    edge = sorted(s for s in got if s[0] == "edge")
    assert [s[3] for s in edge] == [2, 1]            # exactly 30 min continues, +1 s breaks
    hot = [s for s in got if s[0] == "hot"]
    assert max(s[3] for s in hot) > 10 and all(len(s[4]) <= 10 for s in hot)
    assert any(s[0] is None for s in got)            # NULL ip sessions kept


def test_sessions_across_1970(spark):
    """Buckets are floors also for times before the epoch."""
    t = lambda *a: dt.datetime(*a)
    df = spark.createDataFrame([(1, t(1969, 12, 31, 23, 31), "a", "/x"),
                                (2, t(1970, 1, 1, 0, 29), "a", "/y"),
                                (3, t(1970, 1, 1, 0, 40), "a", "/z")],
                               "event_id long, ts timestamp, ip string, url string")
    got = sessionize(df, gap="30 minutes", key="ip", time_col="ts").collect()
    assert sorted(r["session_length"] for r in got) == [1, 2]
