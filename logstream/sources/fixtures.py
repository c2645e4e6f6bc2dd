"""Deterministic inputs derived in Spark from the driver's tables.

The reference reads access-log lines, status texts and ML text lines from live
services.  Here the same shapes are derived row by row from ``events`` and
``conversations`` (rules in FIXTURES.md), so every query's work grows with the
given tables.  All derivations are narrow projections: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the fixture rules (FIXTURES.md part 3)
#   m = event_id % 50 selects the malformed variants:
#   0 corrupt line, 1 two-part request, 2 "-" request, 3 no ip,
#   4 trailing blank in request, 5 four-part request, 6 hostname client.
MALFORMED_MODULUS = 50
#   Event types in label order (clustering label = position).
EVENT_TYPES = ["signup", "error", "click", "view", "purchase"]
#   Start centers of the clustering fixture ([value/100, k/100]).
KMEANS_START_CENTERS = [[0.25, 0.25], [0.75, 0.75], [1.5, 0.25], [2.5, 0.75], [4.0, 0.5]]
#   Sparse vectors: value/100 at index k of SPARSE_DIM.
SPARSE_DIM = 100
#   Wide sparse vectors of WIDE_SPARSE_DIM: value/100 at index WIDE_STEP * k, and 1 at index
#   WIDE_TYPES + label of the event type.  Start center j: 1 at WIDE_TYPES + j and
#   0.3 * (j + 1) at WIDE_STEP * (10 * j + 3).
WIDE_SPARSE_DIM, WIDE_STEP, WIDE_TYPES = 1_000_000, 101, 500_000
#   Wide clustering (embeddings, 64 dims): center j is WIDE_CENTER_VALUE in the
#   dimensions d with d % 5 == j and 0 elsewhere (a rule, not a table).
WIDE_K = 5
WIDE_CENTER_VALUE = 0.05


def wide_start_centers(dim: int = 64) -> list[list[float]]:
    return [[WIDE_CENTER_VALUE if d % WIDE_K == j else 0.0 for d in range(dim)]
            for j in range(WIDE_K)]
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props):
    return F.get_json_object(props, "$.k").cast("int")


def access_log(events: DataFrame) -> DataFrame:
    """One Apache access-log line per event: (event_id, ts, value).

    ``ts`` (the event's time, UTC) is carried as the line's arrival time.
    """
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    k = _k(F.col("props"))
    m = eid % MALFORMED_MODULUS
    ip = (F.when(m == 3, F.lit(""))
          .when(m == 6, F.lit("host.example"))
          .otherwise(F.concat(F.lit("10.0."), F.expr("user_id div 256").cast("string"),
                              F.lit("."), (uid % 256).cast("string"))))
    base = F.concat(F.lit("GET /"), et, F.lit("/"), k.cast("string"))
    request = (F.when(m == 1, base)
               .when(m == 2, F.lit("-"))
               .when(m == 4, F.concat(base, F.lit(" HTTP/1.1 ")))
               .when(m == 5, F.concat(base, F.lit(" x HTTP/1.1")))
               .otherwise(F.concat(base, F.lit(" HTTP/1.1"))))
    status = (F.when(et == "error", 500)
              .when((et == "click") & (F.dayofmonth(ts) % 5 == 0), 503)
              .when(et == "signup", 302)
              .when((et == "purchase") & (k % 7 == 0), 404)
              .otherwise(200))
    line = F.concat(
        ip, F.lit(" - - ["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
        request, F.lit("\" "), status.cast("string"), F.lit(" "),
        ((eid * 17) % 5000).cast("string"), F.lit(" \"-\" \"Agent/"),
        (eid % 5).cast("string"), F.lit("\""))
    value = F.when(m == 0, F.concat(F.lit("corrupt line "), eid.cast("string"))).otherwise(line)
    return events.select(eid.alias("event_id"), ts.alias("ts"), value.alias("value"))


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_log(table(spark, sf_dir, "events"))


def status_json(conversations: DataFrame) -> DataFrame:
    """Turns as tweet-like JSON status documents: (conv_id, turn, value)."""
    return conversations.select("conv_id", "turn",
                                F.to_json(F.struct(F.col("text").alias("text"))).alias("value"))


def regression_lines(events: DataFrame) -> DataFrame:
    """Labeled points "(y,[x])": x = (k - 49.5)/50, y = 0.7x + 0.1 + noise."""
    x = (_k(F.col("props")) - 49.5) / 50.0
    noise = 0.1 * (F.col("value") - F.floor("value") - 0.5)
    y = 0.7 * x + 0.1 + noise
    text = F.concat(F.lit("("), y.cast("string"), F.lit(",["), x.cast("string"), F.lit("])"))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                         text.alias("value"))


def _label_of_type(et):
    expr = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(EVENT_TYPES))):
        expr = F.when(et == name, F.lit(i)).otherwise(expr)
    return expr


def clustering_lines(events: DataFrame, labeled: bool = False) -> DataFrame:
    """Vectors "[a, b]" (a = value/100, b = k/100); labeled: "(label,[a, b])"."""
    a = (F.col("value") / 100.0).cast("string")
    b = (_k(F.col("props")) / 100.0).cast("string")
    vec = F.concat(F.lit("["), a, F.lit(", "), b, F.lit("]"))
    if labeled:
        vec = F.concat(F.lit("("), _label_of_type(F.col("event_type")).cast("string"),
                       F.lit(","), vec, F.lit(")"))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                         vec.alias("value"))


def sparse_lines(events: DataFrame) -> DataFrame:
    """Sparse vectors "(SPARSE_DIM,[k],[value/100])"."""
    text = F.concat(F.lit(f"({SPARSE_DIM},["), _k(F.col("props")).cast("string"), F.lit("],["),
                    (F.col("value") / 100.0).cast("string"), F.lit("])"))
    return events.select("event_id", text.alias("value"))


def wide_sparse_lines(events: DataFrame) -> DataFrame:
    """Sparse vectors "(WIDE_SPARSE_DIM,[WIDE_STEP * k,WIDE_TYPES + label],[value/100,1.0])"."""
    text = F.concat(F.lit(f"({WIDE_SPARSE_DIM},["),
                    (_k(F.col("props")) * WIDE_STEP).cast("string"), F.lit(","),
                    (_label_of_type(F.col("event_type")) + WIDE_TYPES).cast("string"), F.lit("],["),
                    (F.col("value") / 100.0).cast("string"), F.lit(",1.0])"))
    return events.select("event_id", text.alias("value"))


def wide_sparse_centers() -> list[dict[int, float]]:
    return [{WIDE_TYPES + j: 1.0, WIDE_STEP * (10 * j + 3): 0.3 * (j + 1)}
            for j in range(len(EVENT_TYPES))]


def legacy_lines(events: DataFrame) -> DataFrame:
    """Labeled points in the legacy form "label,a b"."""
    text = F.concat(_label_of_type(F.col("event_type")).cast("double").cast("string"), F.lit(","),
                    (F.col("value") / 100.0).cast("string"), F.lit(" "),
                    (_k(F.col("props")) / 100.0).cast("string"))
    return events.select("event_id", text.alias("value"))
