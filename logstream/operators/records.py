"""Typed record builders over parsed access logs (narrow projections only).

Each builder keeps the columns named in ``carry`` (e.g. ``event_id``, ``ts``)
and replaces unmatched lines by the reference's sentinel record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import RECORD_ERROR, url_lenient, url_strict

def _err():
    return F.lit(RECORD_ERROR)


def _m():
    return F.col("matched")


def to_urls(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Strict URL per line; lines that do not match become [error]."""
    return parsed.select(*carry, url_strict(F.col("request"), _m()).alias("url"))


def to_requests(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(url, status, agent); unmatched lines -> ("error", 0, "error")."""
    return parsed.select(
        *carry,
        F.when(_m(), url_lenient(F.col("request"))).otherwise(_err()).alias("url"),
        F.when(_m(), F.col("status")).otherwise(F.lit(0)).alias("status"),
        F.when(_m(), F.col("agent")).otherwise(_err()).alias("agent"),
    )


def to_clicks(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(ip, url); unmatched lines -> ("error", "error"); missing ip stays NULL."""
    return parsed.select(
        *carry,
        F.when(_m(), F.col("ip")).otherwise(_err()).alias("ip"),
        F.when(_m(), url_lenient(F.col("request"))).otherwise(_err()).alias("url"),
    )


def to_access_rows(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(ip, url, status, agent); unmatched -> ("error", "error", 0, "error")."""
    return parsed.select(
        *carry,
        F.when(_m(), F.col("ip")).otherwise(_err()).alias("ip"),
        F.when(_m(), url_lenient(F.col("request"))).otherwise(_err()).alias("url"),
        F.when(_m(), F.col("status")).otherwise(F.lit(0)).alias("status"),
        F.when(_m(), F.col("agent")).otherwise(_err()).alias("agent"),
    )
