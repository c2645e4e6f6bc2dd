"""WARC: query against SQL, bytes of the files, rolling, retries, defined cases."""

import base64
import glob
import gzip
import hashlib

import pytest

from conftest import SF_SMALL
from logstream.llm.queries import QUERIES, SQL
from logstream.llm.warc import digest_of, parse, read, write
from logstream.session import new_work_dir
from oracle_harness import compare, duck

SCHEMA = "page_id long, url string, html string"


def local(folder):
    return folder.removeprefix("file:")


def test_query_matches_sql(spark):
    res = compare(spark, duck(SF_SMALL), QUERIES["op7_warc"], SQL["op7_warc"], SF_SMALL)
    assert res["ok"], res


def made(n=300):
    return [(i, f"http://h/{i}\r\nX: 1 é", f"<p>{i % 90}</p>" * (1 + i % 40)) for i in range(n)]


def test_same_rows_give_the_same_files(spark):
    rows = made()
    folders = []
    for part in (rows, rows[::-1]):
        folder = new_work_dir(spark, "warc-test")
        manifest = write(spark.createDataFrame(part, SCHEMA).repartition(1 + len(folders) * 6),
                         folder, roll_bytes=2000, shard_bytes=20_000)
        folders.append((folder, {r["__name"]: tuple(r) for r in manifest.collect()}))
    assert folders[0][1] == folders[1][1] and len(folders[0][1]) > 5
    for name, (_, n, size, sha) in folders[0][1].items():
        data = open(f"{local(folders[0][0])}/{name}", "rb").read()
        assert len(data) == size and hashlib.sha256(data).hexdigest() == sha
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == n
    assert not glob.glob(f"{local(folders[0][0])}/_temporary*")
    got = read(spark, folders[0][0], manifest).collect()
    assert sorted(r["page_id"] for r in got) == list(range(300))
    last = {}
    for i, _, html in rows:
        last[html] = max(i, last.get(html, -1))
    html_of = {i: h for i, _, h in rows}
    for r in got:
        html = html_of[r["page_id"]]
        sha = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert (r["payload_digest"], r["payload_bytes"]) == (sha, len(html.encode()))
        if last[html] == r["page_id"]:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"]).decode()) == (
                "response", None, html)
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", last[html], None)
        assert "\r" not in r["url"] and r["url"].startswith("http://h/")


def test_records_have_right_headers(spark):
    folder = new_work_dir(spark, "warc-test")
    manifest = write(spark.createDataFrame([(7, "http://x/", "<b>é</b>")], SCHEMA), folder)
    name = manifest.first()["__name"]
    headers, block = parse(gzip.open(f"{local(folder)}/{name}").read())
    payload = "<b>é</b>".encode()
    assert block.endswith(b"\r\n\r\n" + payload) and int(headers["Content-Length"]) == len(block)
    assert headers["WARC-Block-Digest"] == "sha1:" + digest_of(block)
    assert headers["WARC-Payload-Digest"] == "sha1:" + digest_of(payload)


def test_changed_file_is_refused(spark):
    folder = new_work_dir(spark, "warc-test")
    manifest = write(spark.createDataFrame(made(20), SCHEMA), folder)
    path = f"{local(folder)}/{manifest.first()['__name']}"
    data = bytearray(open(path, "rb").read())
    open(path, "wb").write(data + gzip.compress(b"WARC/1.1\r\n\r\n"))
    with pytest.raises(Exception):
        read(spark, folder, manifest).count()


def test_defined_cases(spark):
    rows = [(1, None, None), (2, "", ""), (None, "u", "same"), (3, "u", "same"), (3, "u", "same"),
            (2, "v", "same"), (None, "u", "alone"), (None, "w", "alone"), (9, "u", "x" * 3_000_000)]
    folder = new_work_dir(spark, "warc-test")
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"__id": F.lit(1), "payload": F.lit("p")})
    got = read(spark, folder, write(df, folder)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"])
                   for r in got), key=key) == sorted(
        [(1, 0, "revisit", 2), (2, 0, "response", None), (None, 4, "revisit", 3),
         (3, 4, "response", None), (3, 4, "response", None), (2, 4, "revisit", 3),
         (None, 5, "response", None), (None, 5, "response", None), (9, 3_000_000, "response", None)],
        key=key)
    folder = new_work_dir(spark, "warc-test")
    small = read(spark, folder, write(df, folder, min_bytes=5)).collect()
    assert all(r["record_type"] == "response" for r in small)
    folder = new_work_dir(spark, "warc-test")
    assert read(spark, folder, write(df.limit(0), folder)).count() == 0
