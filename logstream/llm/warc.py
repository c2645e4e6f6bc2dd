r"""WARC archives from page tables: a deterministic sharded writer, and its reader.

* Records are range-sorted by (page_id, payload digest, url).  Shard boundaries come from
  exact byte counts (the splitters of ``sharding``), so the same rows give the same files,
  byte for byte, on any cluster.
* One task streams the sorted records of a shard.  Every record is a gzip member of its own;
  a file is closed and the next one opened when its compressed size reaches ``ROLL_BYTES``.
* Headers, block and payload digests (SHA-1, base32) are made anew from the payload.  Of
  records with equal payloads the one with the largest page_id is a ``response``, the others
  are ``revisit`` records that name it and store no payload.
* Commit: a file is written under a temporary name and renamed when complete; names and
  bytes depend on the data alone, so a retried task puts the same file in place.  The
  manifest (name, records, bytes, SHA-256) is a table that Spark commits after all tasks.
  Readers take the manifest's files only, and check their sizes and digests.

Files are opened with ``pyarrow.fs`` by the scheme of the folder, below
``spark.checkpoint.dir``, which all executors share.

Defined results: NULL html is an empty payload; payloads below ``min_bytes`` (0: none) are
all ``response``; NULL page_id sorts first and counts as smallest (a group of NULL ids only
is all ``response``); rows that repeat the largest page_id are all ``response``; line breaks
and other control characters in a url are percent-encoded, NULL or empty urls leave the
header out; an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_work_dir
from .common import materialise, per_batch, read_table, text_or_empty
from .sharding import LOW, RANGE_TOLERANCE, _pack, _place, _unpack, splitters

ROLL_BYTES = 32 << 20       # compressed size at which a file is closed
SHARD_BYTES = 64 << 20      # payload bytes of a shard, about
MIN_REVISIT_BYTES = 0
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"       # of every record: archives do not depend on the clock
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:pages")
MANIFEST = "__name string, __records long, __bytes long, __sha256 string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}')}>"


def _header_safe(url: str) -> str:
    return "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8"))
                   for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool,
           refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit carries the HTTP header alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url:
        head.append(f"WARC-Target-URI: {_header_safe(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest_of(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Rolling:
    """Files of one shard, each complete under its final name or not there at all."""

    def __init__(self, root: str, shard: int, roll_bytes: int):
        self.fs, self.root = arrow_fs.FileSystem.from_uri(root)
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None
        self.done: list[tuple[str, int, int, str]] = []

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)     # gzip member, no time stamp
        member = packer.compress(data) + packer.flush()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary-{uuid.uuid4().hex}-{self.name}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.records += 1
        self.bytes += len(member)
        if self.bytes >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.root}/{self.name}")
            self.done.append((self.name, self.records, self.bytes, self.sha.hexdigest()))
            self.out, self.number = None, self.number + 1


def _prepared(pages: DataFrame, with_payload: bool) -> DataFrame:
    """__id, __digest, __bytes, __bits (of the digest); with the payload also __url, __html."""
    rows = pages.select(F.col("page_id").cast("long").alias("__id"),
                        F.col("url").cast("string").alias("__url"),
                        text_or_empty("html").alias("__html"))
    names = ["__id", "__digest", "__bytes", "__bits"] + ["__url", "__html"] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [t.as_py().encode("utf-8") for t in batch.column(2)]
            shas = [hashlib.sha1(p).digest() for p in payloads]
            columns = [batch.column(0), pa.array([base64.b32encode(s).decode() for s in shas],
                                                 pa.string()),
                       pa.array([len(p) for p in payloads], pa.int64()),
                       pa.array([int.from_bytes(s[:8], "big") >> 1 for s in shas], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                columns + [batch.column(1), batch.column(2)] * with_payload, names)

    return per_batch(rows, run, "__id long, __digest string, __bytes long, __bits long"
                     + ", __url string, __html string" * with_payload)


def _cuts(narrow: DataFrame, shard_bytes: int) -> list[int]:
    """Shard boundaries in the order of (page_id, digest)."""
    keyed = materialise(narrow.select(
        F.coalesce("__id", F.lit(LOW)).alias("__key"), F.col("__bits").alias("__row"),
        (F.col("__bytes") + 600).alias("__size")), "warc-keys")
    ends = keyed.agg(F.min("__key"), F.max("__key"), F.sum("__size"), F.count(F.lit(1))).first()
    if not ends[3]:
        return []
    pieces = max(1, -(-ends[2] // shard_bytes))
    goals = [(ends[2] * i // pieces, int(ends[2] / pieces * RANGE_TOLERANCE))
             for i in range(1, pieces)]
    return sorted({c[0] for c in splitters(keyed, goals, _pack(ends[0], 0), _pack(ends[1], 1 << 63),
                                           ends[2], ends[3])}) if goals else []


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES,
          shard_bytes: int = SHARD_BYTES, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the manifest."""
    spark = pages.sparkSession
    narrow = materialise(_prepared(pages, False), "warc-narrow")
    copies = narrow.where(F.col("__bytes") >= min_bytes).groupBy(
        F.col("__digest").alias("__d")).agg(F.max("__id").alias("__last"),
                                            F.count(F.lit(1)).alias("__n"))
    copies = materialise(copies.where("__n > 1").drop("__n"), "warc-copies")
    cuts = _cuts(narrow, shard_bytes)
    keys, ordinals = ([_unpack(c)[i] for c in cuts] for i in (0, 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        k, o = np.array(keys, np.int64), np.array([min(x, (1 << 63) - 1) for x in ordinals], np.int64)
        for batch in batches:
            ids = batch.column("__id").fill_null(LOW).to_numpy()
            at = _place(ids, batch.column("__bits").to_numpy(), k, o)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())],
                                             [*batch.schema.names, "__shard"])

    rows = _prepared(pages, True)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = per_batch(rows, place, schema + ", __shard int")
    revisit = F.col("__last").isNotNull() & ~F.col("__id").eqNullSafe(F.col("__last"))
    placed = placed.join(copies, F.col("__digest") == F.col("__d"), "left").select(
        "__shard", "__id", "__url", "__html", "__digest", revisit.alias("__revisit"),
        F.when(revisit, F.col("__last")).alias("__refers"))
    sorted_ = placed.repartitionByRange(len(cuts) + 1, "__shard").sortWithinPartitions(
        "__shard", "__id", "__digest", "__url")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        done: list[tuple[str, int, int, str]] = []
        for batch in batches:
            for shard, page_id, url, html, digest, again, refers in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if files is None or files.shard != shard:
                    if files:
                        files.close()
                        done += files.done
                    files = _Rolling(folder, shard, roll_bytes)
                files.add(record(page_id, url, html.encode("utf-8"), digest, again, refers))
        if files:
            files.close()
            done += files.done
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            ["__name", "__records", "__bytes", "__sha256"])

    return materialise(per_batch(sorted_, run, MANIFEST), "warc-manifest")


def _members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """Decompressed gzip members of a stream."""
    unpacker, parts = zlib.decompressobj(31), []
    data = stream.read(size)
    while data:
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(size)
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


class _Hashing:
    """A stream that hashes what is read."""

    def __init__(self, stream):
        self.stream, self.sha, self.bytes = stream, hashlib.sha256(), 0

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sha.update(data)
        self.bytes += len(data)
        return data


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's files: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload (NULL for revisits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, n, size, sha in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    stream, rows, held, seen = _Hashing(raw), [], 0, 0
                    for member in _members(stream):
                        rows.append(_row(*parse(member)))
                        seen += 1
                        held += len(member)
                        if held > 8 << 20:
                            yield _records(rows)
                            rows, held = [], 0
                    if (seen, stream.bytes, stream.sha.hexdigest()) != (n, size, sha):
                        raise ValueError(f"{name} is not the file of the manifest")
                    yield _records(rows)

    files = manifest.select("__name", "__records", "__bytes", "__sha256")
    return per_batch(files.repartition(F.col("__name")), run, _READ_SCHEMA)


_READ_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, "
                "record_type string, refers_to long, payload binary")


def _row(headers: dict[str, str], block: bytes) -> tuple:
    if headers["WARC-Block-Digest"] != "sha1:" + digest_of(block):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload), digest_of(payload)) != (size, digest):
        raise ValueError("payload digest differs")
    number = lambda key: int(headers[key]) if key in headers else None
    return (number("X-Page-ID"), headers.get("WARC-Target-URI"), size, digest,
            headers["WARC-Type"], number("X-Refers-To-Page-ID"), None if revisit else payload)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
        [c.split()[0] for c in _READ_SCHEMA.split(", ")])


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back."""
    folder = new_work_dir(spark, "warc")
    manifest = write(read_table(spark, sf_dir, "pages"), folder)
    return read(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"      # fixed value: the RFC 4648 alphabet
_CHARS = " || ".join(f"substr('{_BASE32}', 1 + ((n >> {s}) & 31), 1)" for s in (15, 10, 5, 0))
OP7_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                  sha1(coalesce(html, '')) AS s FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS last FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(8), lambda i: list_transform(
         [CAST('0x' || substr(s, CAST(1 + 5 * i AS BIGINT), 5) AS BIGINT)],
         lambda n: {_CHARS})[1]), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d
"""
