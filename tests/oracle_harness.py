"""Compare a registered Spark query with its DuckDB oracle on the same parquet
tables: row count, column names and an order-insensitive value comparison
(floats to 6 digits), like the driver's correctness gate."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (3, str(v))
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, str(v))


def rows_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    data = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(data)


def rows_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(data)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
          "boolean": "BOOLEAN"}


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_types = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    s_cols, s_rows = rows_spark(df)
    d_cols, d_rows = rows_duck(con, sql)
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = {"rows_spark": len(s_rows), "rows_oracle": len(d_rows),
           "cols_match": s_cols == d_cols, "values_match": s_rows == d_rows,
           "types_match": s_types == d_types}
    if not res["values_match"]:
        ss, dd = set(s_rows), set(d_rows)
        res["only_spark"] = sorted(ss - dd)[:3]
        res["only_oracle"] = sorted(dd - ss)[:3]
    if not res["cols_match"]:
        res["cols"] = (s_cols, d_cols)
    if not res["types_match"]:
        res["types"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                        if s_types.get(c) != d_types.get(c)}
    res["ok"] = res["cols_match"] and res["values_match"] and res["types_match"]
    return res
