"""Edge lines for the access-log parser, URL rules and status classes,
checked against a direct model of the reference's Java behaviour."""

import re

import pytest
from pyspark.sql import functions as F

from logstream.functions.parse import (ACCESS_LOG_PATTERN, classify_status, parse_access_log,
                                       parse_labeled, parse_vector, status_code, status_text)
from logstream.operators.records import to_access_rows, to_clicks, to_requests, to_urls

_RX = re.compile(ACCESS_LOG_PATTERN)


def java_split(s):
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model(line):
    """(strict url, lenient url, status class) as the reference computes them."""
    m = _RX.fullmatch(line) if "\n" not in line else None
    if not m:
        return "[error]", "error", "Other"
    req = m.group(5)
    f = java_split(req)
    strict = f[1] if len(f) == 3 else "[error]"
    lenient = f[1] if len(f) > 1 else "[error]"
    code = int(m.group(6))
    cls = "Success" if 200 <= code < 300 else "Failure" if 500 <= code < 600 else "Other"
    return strict, lenient, cls


def line(ip="1.2.3.4", req="GET /a HTTP/1.1", status="200", agent="Agent/1"):
    return f'{ip} - - [10/Oct/2000:13:55:36 -0700] "{req}" {status} 2326 "-" "{agent}"'


EDGE = [
    line(req=""), line(req="GET"), line(req="GET /a"), line(), line(req="GET /a HTTP/1.1 x"),
    line(req="GET /a HTTP/1.1 "), line(req=" GET /a HTTP/1.1"), line(req="GET  /a"),
    line(ip=""), line(ip="host.example"), "garbage", "", line() + "\n",
    line(agent='Mozilla "quoted" x'), line(status="199"), line(status="299"),
    line(status="300"), line(status="499"), line(status="500"), line(status="599"),
    line(status="600"), line(req="   "), line(req="-"),
]


def test_edge_lines_match_reference_model(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(EDGE)], "id int, value string")
    p = parse_access_log(df)
    from logstream.functions.parse import with_status_class
    strict = {r["id"]: r["url"] for r in to_urls(p, carry=["id"]).collect()}
    lenient = {r["id"]: r["url"] for r in to_requests(p, carry=["id"]).collect()}
    cls = {r["id"]: r["status_class"] for r in with_status_class(p).collect()}
    assert len(strict) == len(EDGE)
    for i, s in enumerate(EDGE):
        assert (strict[i], lenient[i], cls[i]) == model(s), (i, s)


def test_parse_fields_and_missing_ip(spark):
    df = spark.createDataFrame([(line(ip=""),), (line(),), ("nope",)], "value string")
    rows = parse_access_log(df).collect()
    assert rows[0]["matched"] and rows[0]["ip"] is None
    assert rows[1]["ip"] == "1.2.3.4" and rows[1]["status"] == 200
    assert rows[1]["event_time"].isoformat() == "2000-10-10T20:55:36"  # -0700 applied, UTC
    assert rows[1]["agent"] == "Agent/1" and rows[1]["request"] == "GET /a HTTP/1.1"
    assert not rows[2]["matched"] and rows[2]["status"] is None


def test_record_sentinels(spark):
    df = parse_access_log(spark.createDataFrame([("nope",), (line(ip=""),)], "value string"))
    acc = to_access_rows(df).collect()
    assert tuple(acc[0]) == ("error", "error", 0, "error")
    assert acc[1]["ip"] is None and acc[1]["url"] == "/a"
    assert tuple(to_clicks(df).collect()[0]) == ("error", "error")


@pytest.mark.parametrize("text,code,cls", [
    ("199", 199, "Other"), ("200", 200, "Success"), ("299", 299, "Success"),
    ("300", 300, "Other"), ("499", 499, "Other"), ("500", 500, "Failure"),
    ("599", 599, "Failure"), ("600", 600, "Other"), ("[error]", 0, "Other"), ("abc", 0, "Other"),
])
def test_status_code_and_class(spark, text, code, cls):
    r = spark.createDataFrame([(text,)], "t string").select(
        status_code(F.col("t")).alias("c"), classify_status(status_code(F.col("t"))).alias("k")
    ).first()
    assert (r["c"], r["k"]) == (code, cls)


def test_status_text_sentinel(spark):
    r = spark.createDataFrame([(False, None), (True, 404)], "m boolean, s int").select(
        status_text(F.col("m"), F.col("s")).alias("t")).collect()
    assert [x["t"] for x in r] == ["[error]", "404"]


def test_vectors_and_labeled_points(spark):
    df = spark.createDataFrame(
        [("[1.0,2.5]",), ("(3,[0,2],[1.0,4.0])",), ("[bad",), (" [ 1e-3 , -2 ] ",)], "v string")
    got = [r["x"] for r in df.select(parse_vector(F.col("v")).alias("x")).collect()]
    assert got == [[1.0, 2.5], [1.0, 0.0, 4.0], None, [0.001, -2.0]]
    lab = spark.createDataFrame([("(1.5,[2.0,3.0])",), ("2.0,1.0 2.0",), ("(0.0,(2,[1],[5.0]))",)],
                                "v string")
    l, f = parse_labeled(F.col("v"))
    rows = lab.select(l.alias("l"), f.alias("f")).collect()
    assert [(r["l"], r["f"]) for r in rows] == [(1.5, [2.0, 3.0]), (2.0, [1.0, 2.0]),
                                                (0.0, [0.0, 5.0])]


def test_sparse_vectors_of_another_size_or_with_bad_indices_are_null(spark):
    df = spark.createDataFrame(
        [("(3,[0,2],[1.0,4.0])",), ("(2000000000,[0],[1.0])",), ("(3,[0,0],[1.0,2.0])",),
         ("(3,[3],[1.0])",), ("(3,[-1],[1.0])",), ("(3,[0,1],[1.0])",), ("(0,[],[])",),
         ("(3,[],[])",), (None,)], "v string")
    free = [r["x"] for r in df.select(parse_vector(F.col("v")).alias("x")).collect()]
    assert free == [[1.0, 0.0, 4.0], None, None, None, None, None, [], [0.0] * 3, None]
    four = [r["x"] for r in df.select(parse_vector(F.col("v"), dim=4).alias("x")).collect()]
    assert four == [None] * 9


def test_legacy_points_with_a_bad_number_have_no_features(spark):
    df = spark.createDataFrame([("1.0,2.0 x",), ("1.0,2.0 3.0",)], "v string")
    _, feats = parse_labeled(F.col("v"))
    assert [r["f"] for r in df.select(feats.alias("f")).collect()] == [None, [2.0, 3.0]]
