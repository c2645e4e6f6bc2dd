"""All registered queries and their oracle SQL, in one place."""

from __future__ import annotations

import functools


def _utc(fn):
    """Run a query with the session time zone pinned to UTC: the tables carry
    TIMESTAMP_NTZ wall-clock times, read as UTC instants (as the oracle does)."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def all_queries() -> dict:
    from .ml_queries import ML_QUERIES
    from .queries import BATCH_QUERIES
    from .stream_queries import STREAM_QUERIES
    out = {**BATCH_QUERIES, **ML_QUERIES, **STREAM_QUERIES}
    return {k: _utc(v) for k, v in out.items()}


def all_sql() -> dict:
    from .ml_oracle import ML_SQL
    from .oracle import BATCH_SQL
    from .stream_queries import STREAM_SQL
    return {**BATCH_SQL, **ML_SQL, **STREAM_SQL}
