"""Line sources: every source normalises to a frame with one ``value STRING``
column per log line, batch or streaming.

| reference source            | here                                            |
|-----------------------------|-------------------------------------------------|
| socket text stream          | ``read_lines(spark, "socket", host=, port=)``   |
| Kafka direct stream         | ``read_lines(spark, "kafka", servers=, topics=)``|
| Kinesis stream              | ``read_lines(spark, "kinesis", stream=, ...)``  |
| Flume push / pull           | agent lands files: ``read_lines(spark, "files")``|
| custom receiver             | its feed lands as files: ``read_lines("files")``|
| Twitter stream              | JSON status files: ``read_statuses``            |
| static scan (oracle path)   | ``read_lines(spark, "batch", path=)``           |
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS_SCHEMA = T.StructType([T.StructField("text", T.StringType(), True)])


def decode_messages(df: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Message-bus rows (key, value as BINARY or STRING) -> ``value STRING``.

    Only the message body is kept (the key is dropped, as the reference's
    ``map(_._2)``); bytes are decoded with a fixed charset.
    """
    v = F.col("value")
    dtype = dict(df.dtypes).get("value")
    text = F.decode(v, charset) if dtype == "binary" else v.cast("string")
    keep = [c for c in df.columns if c not in ("key", "value")]
    return df.select(*keep, text.alias("value"))


def _source_options(kind: str, **kw) -> tuple[str, dict]:
    if kind == "socket":
        return "socket", {"host": kw.get("host", "127.0.0.1"), "port": str(kw.get("port", 9999))}
    if kind == "kafka":
        opts = {"kafka.bootstrap.servers": kw["servers"],
                "subscribe": ",".join(kw["topics"]) if not isinstance(kw["topics"], str)
                else kw["topics"],
                "startingOffsets": kw.get("starting_offsets", "latest")}
        if kw.get("max_offsets_per_trigger"):
            opts["maxOffsetsPerTrigger"] = str(kw["max_offsets_per_trigger"])
        return "kafka", opts
    if kind == "kinesis":
        return "kinesis", {"streamName": kw["stream"], "endpointUrl": kw["endpoint"],
                           "region": kw.get("region", "us-east-1"),
                           "startingPosition": kw.get("starting_position", "LATEST")}
    raise ValueError(f"unknown source kind {kind!r}")


def read_lines(spark: SparkSession, kind: str, path: str | None = None, *,
               fmt: str = "text", schema: T.StructType | str | None = None,
               max_files_per_trigger: int | None = None, **kw) -> DataFrame:
    """A frame of log lines (``value STRING``) from one of the source kinds.

    ``kind="batch"`` is the static scan.  ``kind="files"`` reads a landing
    directory as a stream (``fmt`` text, json or parquet; ``schema`` needed for
    json/parquet).  Message sources are decoded to ``value STRING``.
    """
    if kind == "batch":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.format(fmt).load(path)
    if kind == "files":
        reader = spark.readStream.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(path)
    fmt_name, opts = _source_options(kind, **kw)
    df = spark.readStream.format(fmt_name).options(**opts).load()
    if kind in ("kafka", "kinesis"):
        if kind == "kinesis" and "data" in df.columns:
            df = df.withColumnRenamed("data", "value")
        df = decode_messages(df)
    return df


def with_arrival_time(df: DataFrame, col: str = "arrival_time") -> DataFrame:
    """Stamp each row with the time it is processed (the reference's only
    notion of time).  On a stream this is the micro-batch time; results then
    depend on when data arrives, so event time is the default elsewhere."""
    return df.withColumn(col, F.current_timestamp())


def read_statuses(spark: SparkSession, path: str, streaming: bool = True,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Tweet-like JSON status documents (one per line) with a fixed schema."""
    if not streaming:
        return spark.read.schema(STATUS_SCHEMA).json(path)
    reader = spark.readStream.schema(STATUS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def status_texts(statuses: DataFrame, col: str = "value",
                 carry: Sequence[str] = ()) -> DataFrame:
    """Text of each status: ``text`` when the frame already has it (parsed
    status documents), else parsed from the JSON column ``col``."""
    if "text" in statuses.columns:
        return statuses.select(*carry, "text")
    parsed = F.from_json(F.col(col), STATUS_SCHEMA)
    return statuses.select(*carry, parsed["text"].alias("text"))
