"""Helpers shared by the operators of this package.

* ``materialise`` cuts lineage with a table written below ``spark.checkpoint.dir``
  (shared storage, so a lost executor costs a re-read and nothing else).
* ``read_table`` reads one of the given tables.
* ``per_batch`` runs a function over Arrow batches of a frame, keeping memory
  bounded by the batch, and ships this package to the executors.
* ``release_memory`` gives free memory of a worker, which outlives its tasks, back.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_work_dir, ship_package

HELD_OUT_FOLDS = 5  # crc32(doc_id as text) % 5 == 0 is the held-out fold


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared storage and read it back.

    One pass over the plan (``checkpoint()`` runs it twice: count, then write).
    """
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_batch(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable on every executor.  A task begins and ends
    without the free memory that its worker still holds."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Arrow's pool and, where it can, the C library return unused memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc
    if trim is not None:
        trim(0)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def held_out(col: str = "doc_id"):
    """True for the fold whose labels are never learned from (NULL ids: also held out)."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % HELD_OUT_FOLDS == 0, F.lit(True))


def keep_rows(docs: DataFrame, kept: DataFrame, repeated: bool, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (every column) named by ``kept`` (``__id``, ``__sha``: id and
    SHA-256 of the text, NULL as empty).  ``repeated``: rows that share id and text
    are reduced to one."""
    keyed = docs.withColumns({"__row_id": F.col(id_col),
                              "__row_sha": F.sha2(text_or_empty(text_col), 256)})
    names = kept.select("__id", "__sha").distinct()
    out = keyed.join(names, F.col("__row_id").eqNullSafe(F.col("__id"))
                     & (F.col("__row_sha") == F.col("__sha")), "left_semi")
    if repeated:
        out = out.dropDuplicates(["__row_id", "__row_sha"])
    return out.drop("__row_id", "__row_sha")
