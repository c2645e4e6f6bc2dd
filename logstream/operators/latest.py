"""Latest row per key: the read side of a keyed (upsert) table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_PACKABLE = (T.TimestampType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType)


def _as_long(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    return F.unix_date(col).cast("long") if isinstance(kind, T.DateType) else F.col(col).cast("long")


def _packed(df: DataFrame, order_by: Sequence[str]) -> Column | None:
    """One number in the order of one or two integer-like columns, NULLs first; None for
    other columns.  Longs fit: 19 digits each, 38 in a decimal."""
    if len(order_by) > 2 or not all(isinstance(df.schema[c].dataType, _PACKABLE)
                                    for c in order_by):
        return None
    first = _as_long(df, order_by[0])
    low = F.lit(-(1 << 63))
    first = F.coalesce(first, low).cast("decimal(20,0)")
    if len(order_by) == 1:
        return first
    second = F.coalesce(_as_long(df, order_by[1]), low).cast("decimal(20,0)")
    # 10^18 steps of the first column lie within +-9.2e36, the second adds less than a step
    step = F.lit(10 ** 18).cast("decimal(19,0)")
    fits = F.abs(second) < step
    return F.when(fits, (first * step + second).cast("decimal(38,0)"))


def latest_by_key(df: DataFrame, key: str, order_by: Sequence[str],
                  value_cols: Sequence[str] | None = None,
                  drop_null_keys: bool = True) -> DataFrame:
    """One row per key: the values of its greatest ``order_by`` tuple.

    For one or two integer-like ``order_by`` columns (times, dates, integers) the
    greatest tuple is a hash aggregate over one fixed-width number, and only the
    rows that carry it are joined back and reduced; raw rows are never sorted.
    Other columns use ``max_by``.  Both combine partially before the shuffle, so a
    hot key does not gather its rows in one task.
    """
    if value_cols is None:
        value_cols = [c for c in df.columns if c != key]
    src = df.where(F.col(key).isNotNull()) if drop_null_keys else df
    number = _packed(df, order_by)
    if number is not None:
        # a second column outside +-10^18 packs to NULL: such a key has no best number
        tops = src.select(F.col(key).alias("_top_key"), number.alias("_number")).groupBy(
            "_top_key").agg(F.max("_number").alias("_top"),
                            F.max(F.col("_number").isNull()).alias("_wide"))
        src = src.withColumn("_number", number).join(
            tops, F.col(key).eqNullSafe(F.col("_top_key"))).where(
            F.col("_wide") | (F.col("_number") == F.col("_top")))
    best = F.max_by(F.struct(*[F.col(c) for c in value_cols]),
                    F.struct(*[F.col(c) for c in order_by]))
    return (src.groupBy(key).agg(best.alias("_best"))
            .select(key, *[F.col("_best")[c].alias(c) for c in value_cols]))


def null_key_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows a keyed table cannot store (NULL key): the reject set."""
    return df.where(F.col(key).isNull())
