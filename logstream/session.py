"""Spark session and shared-storage helpers.

Everything that writes intermediate state (stream checkpoints, landing
directories, sink tables) goes below the folder the cluster names in
``spark.checkpoint.dir``.  We only pick our own folder when that setting is
unset, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Partial top-k before the shuffle for row_number() <= k filters.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int | None = None,
              app_name: str = "logstream", extra: dict | None = None) -> SparkSession:
    """A session with the library's defaults.  The number of shuffle partitions is the
    caller's or the cluster's; only local masters get a small one by default."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local[") or master == "local":
        conf.setdefault("spark.sql.shuffle.partitions", "8")
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints and written tables, shared by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set on a local master a fresh temporary folder is created and
    registered as the checkpoint dir, so ``DataFrame.checkpoint()`` uses it too;
    on a cluster that is an error, as executors would each write to their own disk.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    ctx_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if ctx_dir.isDefined():
        return ctx_dir.get().rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="logstream-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub folder of :func:`shared_root` (never reused)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared storage and read it back: later uses
    start from the files, not from the plan (one pass; executors may come and go)."""
    path = new_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any Hadoop file system exists (errors are raised)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers on every executor
    (what ``--py-files`` does at submit time).  The zip is built in memory and
    written below the shared root (Hadoop FileSystem API), then added with
    ``addPyFile``.  Needed only by the few operators that run Python on
    executors; idempotent per application."""
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in sorted(os.walk(pkg_dir)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:16]
    target = f"{shared_root(spark)}/pyfiles/logstream-{digest}.zip"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
