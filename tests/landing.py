"""Landing directories for tests: how an agent (the reference's Flume / netcat role)
delivers data to a stream.  A piece is written to a staging folder by Spark,
then its part files are renamed into the watched folder, so a stream never
sees a half-written file.  Pieces are split by a key range (every row lands
exactly once), in key order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def land_piece(spark: SparkSession, df: DataFrame, landing_dir: str, staging_dir: str,
               name: str, fmt: str = "parquet") -> int:
    """Write ``df`` with Spark into staging, then move its files into the landing
    folder as ``<name>-<k>.<fmt>``.  Returns the number of files landed."""
    out = f"{staging_dir}/{name}"
    writer = df.write.mode("overwrite")
    if fmt == "text":
        writer.text(out)
    elif fmt == "json":
        writer.json(out)
    else:
        writer.parquet(out)
    fs, src = _fs(spark, out)
    _, dst_dir = _fs(spark, landing_dir)
    fs.mkdirs(dst_dir)
    moved = 0
    for st in fs.listStatus(src):
        fname = st.getPath().getName()
        if not fname.startswith("part-"):
            continue
        target = spark._jvm.org.apache.hadoop.fs.Path(dst_dir, f"{name}-{moved:05d}.{fmt}")
        fs.rename(st.getPath(), target)
        moved += 1
    return moved
