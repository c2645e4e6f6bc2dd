"""Error-ratio alarm over status totals, kept in columns (no driver collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the alarm rule: strictly more than 100 classified lines,
# and failures / successes strictly above 0.5.
MIN_EVENTS = 100
MAX_RATIO = 0.5


def error_alarm(totals: DataFrame, min_events: int = MIN_EVENTS,
                max_ratio: float = MAX_RATIO) -> DataFrame:
    """Add ``ratio`` and ``state`` (alarm / ok / insufficient) to status totals.

    The rule is written as ``failure > max_ratio * success`` so zero successes
    alarm (the reference divides doubles and gets Infinity); ``ratio`` is NULL
    when there are no successes.
    """
    s, f = F.col("success"), F.col("failure")
    state = (F.when(s + f <= min_events, F.lit("insufficient"))
             .when(f > F.lit(max_ratio) * s, F.lit("alarm"))
             .otherwise(F.lit("ok")))
    return totals.withColumn("ratio", F.try_divide(f.cast("double"), s.cast("double"))) \
                 .withColumn("state", state)


def alarms(totals: DataFrame, **kw) -> DataFrame:
    """Only the windows that raise an alarm."""
    return error_alarm(totals, **kw).where(F.col("state") == "alarm")
