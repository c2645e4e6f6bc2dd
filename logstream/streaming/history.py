"""The states of a stateful query over its batches, as tables for SQL.

The state store keeps the versions of the last ``spark.sql.streaming.minBatchesToRetain``
batches (100 by default).  Nothing is written while the stream runs: each snapshot is read
from the store when asked for, in parallel over the state partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def committed_batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """Ids of the batches that a query has committed, ascending (one name per batch; Spark
    itself removes old ones)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def state_history(read: Callable[[int], DataFrame], batches: Iterable[int],
                  name: str = "batch_id") -> DataFrame | None:
    """``read(batch)`` of each batch, one below the other, with the batch in column ``name``;
    None if there is no batch."""
    out = None
    for batch in batches:
        snapshot = read(batch).withColumn(name, F.lit(batch).cast("long"))
        out = snapshot if out is None else out.unionByName(snapshot)
    return out


def sql_on_states(spark: SparkSession, read: Callable[[int], DataFrame], batches: Iterable[int],
                  view: str, query: str) -> DataFrame | None:
    """The result of ``query`` over the states of each batch: the snapshots, with their
    ``batch_id``, are visible as ``view`` while the query is planned."""
    history = state_history(read, batches)
    if history is None:
        return None
    history.createOrReplaceTempView(view)
    try:
        return spark.sql(query)
    finally:
        spark.catalog.dropTempView(view)


def state_changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None,
                  variable: str | None = None) -> DataFrame:
    """Change feed of a state store: batch_id, change_type (update, delete), key, value of
    every change that batches ``first`` to ``last`` (the newest) made."""
    reader = spark.read.format("statestore").option("readChangeFeed", "true") \
        .option("changeStartBatchId", str(first))
    if last is not None:
        reader = reader.option("changeEndBatchId", str(last))
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)
