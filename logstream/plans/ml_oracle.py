"""DuckDB SQL for the online-ML queries (recursive CTE for gradient descent)."""

from __future__ import annotations

from ..sources.fixtures import (EVENT_TYPES, KMEANS_START_CENTERS, SPARSE_DIM, WIDE_STEP,
                                WIDE_TYPES, wide_sparse_centers, wide_start_centers)

_K = "CAST(regexp_extract(props, '\"k\":\\s*(\\d+)', 1) AS INTEGER)"

_REG_PTS = f"""
reg AS (
  SELECT event_id, (CAST({_K} AS DOUBLE) - 49.5) / 50.0 AS x, value AS v FROM events
),
pts AS (
  SELECT event_id, x, 0.7 * x + 0.1 + 0.1 * (v - floor(v) - 0.5) AS y FROM reg
)"""

REG_POINTS_CTE = _REG_PTS.strip()

_LABEL = "CASE " + " ".join(f"WHEN event_type = '{t}' THEN {i}" for i, t in enumerate(EVENT_TYPES)) + " END"

_CL_PTS = f"""
cpts AS (
  SELECT event_id, value / 100.0 AS a, CAST({_K} AS DOUBLE) / 100.0 AS b,
         CAST({_LABEL} AS INTEGER) AS label
  FROM events
)"""

CLUSTER_POINTS_CTE = _CL_PTS.strip()

_SGD = """
stats AS (
  SELECT count(*) AS n, sum(x * x) AS sxx, sum(x) AS sx, sum(x * y) AS sxy, sum(y) AS sy FROM pts
),
it AS (
  SELECT 0 AS i, CAST(0.0 AS DOUBLE) AS w, CAST(1.0 AS DOUBLE) AS b, false AS done
  UNION ALL
  SELECT i + 1, nw, nb,
         i + 1 > 1 AND sqrt((w - nw) * (w - nw) + (b - nb) * (b - nb))
                       < 0.001 * greatest(sqrt(nw * nw + nb * nb), 1.0)
  FROM (
    SELECT it.i, it.w, it.b,
           it.w - (0.1 / sqrt(it.i + 1)) * (((sxx * it.w + sx * it.b) - sxy) / n) AS nw,
           it.b - (0.1 / sqrt(it.i + 1)) * (((sx * it.w + n * it.b) - sy) / n) AS nb
    FROM it, stats WHERE NOT it.done AND it.i < 50
  ) q
),
model AS (SELECT w, b, i FROM it WHERE i = (SELECT max(i) FROM it))"""


def distances_sql(pref: str, centers_sql: list[tuple[str, str]]) -> str:
    return ", ".join(f"(a - {ca}) * (a - {ca}) + (b - {cb}) * (b - {cb}) AS {pref}{j}"
                     for j, (ca, cb) in enumerate(centers_sql))


def argmin_sql(pref: str, k: int) -> str:
    whens = []
    for j in range(k - 1):
        rest = [f"{pref}{i}" for i in range(j + 1, k)]
        cond = f"{pref}{j} <= {rest[0]}" if len(rest) == 1 else f"{pref}{j} <= least({', '.join(rest)})"
        whens.append(f"WHEN {cond} THEN {j}")
    return "CASE " + " ".join(whens) + f" ELSE {k - 1} END"


_K_CENT = len(KMEANS_START_CENTERS)
_START = [(repr(float(a)), repr(float(b))) for a, b in KMEANS_START_CENTERS]
_CENT_VALUES = ", ".join(f"({j}, {a}, {b})" for j, (a, b) in enumerate(_START))

_ASSIGN_START = f"""
asg AS (
  SELECT *, {argmin_sql('d', _K_CENT)} AS cluster
  FROM (SELECT *, {distances_sql('d', _START)} FROM cpts) z
)"""

_TRAIN = f"""
st AS (SELECT cluster, count(*) AS n, sum(a) AS sa, sum(b) AS sb FROM asg GROUP BY cluster),
cent(cluster, ca, cb) AS (VALUES {_CENT_VALUES}),
upd AS (
  SELECT c.cluster, CAST(coalesce(s.n, 0) AS DOUBLE) AS w,
         CASE WHEN s.n > 0 THEN s.sa * (1.0 / s.n) ELSE c.ca END AS ca,
         CASE WHEN s.n > 0 THEN s.sb * (1.0 / s.n) ELSE c.cb END AS cb
  FROM cent c LEFT JOIN st s ON c.cluster = s.cluster
),
ext AS (
  SELECT (SELECT cluster FROM upd ORDER BY w DESC, cluster LIMIT 1) AS lg,
         (SELECT cluster FROM upd ORDER BY w ASC, cluster LIMIT 1) AS sm,
         (SELECT max(w) FROM upd) AS mx, (SELECT min(w) FROM upd) AS mn
),
trained AS (
  SELECT u.cluster,
    CASE WHEN e.mn < 1e-8 * e.mx AND u.cluster IN (e.lg, e.sm) THEN (e.mx + e.mn) / 2 ELSE u.w END AS weight,
    CASE WHEN e.mn < 1e-8 * e.mx AND u.cluster = e.lg THEN u.ca + 1e-14 * greatest(abs(u.ca), 1.0)
         WHEN e.mn < 1e-8 * e.mx AND u.cluster = e.sm THEN l.ca - 1e-14 * greatest(abs(l.ca), 1.0)
         ELSE u.ca END AS ca,
    CASE WHEN e.mn < 1e-8 * e.mx AND u.cluster = e.lg THEN u.cb + 1e-14 * greatest(abs(u.cb), 1.0)
         WHEN e.mn < 1e-8 * e.mx AND u.cluster = e.sm THEN l.cb - 1e-14 * greatest(abs(l.cb), 1.0)
         ELSE u.cb END AS cb
  FROM upd u, ext e, upd l WHERE l.cluster = e.lg
)"""

_PIVOT = ", ".join(f"max(CASE WHEN cluster = {j} THEN ca END) AS ta{j}, "
                   f"max(CASE WHEN cluster = {j} THEN cb END) AS tb{j}" for j in range(_K_CENT))
_TRAINED_COLS = [(f"p.ta{j}", f"p.tb{j}") for j in range(_K_CENT)]

_WIDE = wide_start_centers(64)
_WIDE_VALUES = ", ".join(f"({j}, {d}, {repr(float(c[d]))})"
                         for j, c in enumerate(_WIDE) for d in range(len(c)))
_WIDE_ASSIGN = f"""
pl AS (
  SELECT vec_id, CAST(d - 1 AS INTEGER) AS d, CAST(embedding[d] AS DOUBLE) AS x
  FROM embeddings, range(1, len(embedding) + 1) r(d)
),
wc(cluster, d, c) AS (VALUES {_WIDE_VALUES}),
dist AS (
  SELECT pl.vec_id, wc.cluster, sum((pl.x - wc.c) * (pl.x - wc.c)) AS dd
  FROM pl JOIN wc ON pl.d = wc.d GROUP BY pl.vec_id, wc.cluster
),
asg AS (
  SELECT vec_id, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dd, cluster) AS rn FROM dist) z
  WHERE rn = 1
)"""

_WIDE_TRAIN = _WIDE_ASSIGN + """,
cn AS (SELECT cluster, count(*) AS n FROM asg GROUP BY cluster),
cs AS (SELECT a.cluster, pl.d, sum(pl.x) AS s FROM asg a JOIN pl ON a.vec_id = pl.vec_id
       GROUP BY a.cluster, pl.d),
wts AS (SELECT k.cluster, CAST(coalesce(cn.n, 0) AS DOUBLE) AS w
        FROM (SELECT DISTINCT cluster FROM wc) k LEFT JOIN cn ON k.cluster = cn.cluster),
upd AS (
  SELECT wc.cluster, wc.d, CASE WHEN cn.n > 0 THEN cs.s * (1.0 / cn.n) ELSE wc.c END AS c
  FROM wc LEFT JOIN cn ON wc.cluster = cn.cluster
          LEFT JOIN cs ON wc.cluster = cs.cluster AND wc.d = cs.d
),
ext AS (
  SELECT (SELECT cluster FROM wts ORDER BY w DESC, cluster LIMIT 1) AS lg,
         (SELECT cluster FROM wts ORDER BY w ASC, cluster LIMIT 1) AS sm,
         (SELECT max(w) FROM wts) AS mx, (SELECT min(w) FROM wts) AS mn
),
trained AS (
  SELECT u.cluster, u.d,
    CASE WHEN e.mn < 1e-8 * e.mx AND u.cluster = e.lg THEN u.c + 1e-14 * greatest(abs(u.c), 1.0)
         WHEN e.mn < 1e-8 * e.mx AND u.cluster = e.sm THEN l.c - 1e-14 * greatest(abs(l.c), 1.0)
         ELSE u.c END AS c,
    CASE WHEN e.mn < 1e-8 * e.mx AND u.cluster IN (e.lg, e.sm) THEN (e.mx + e.mn) / 2
         ELSE wts.w END AS weight
  FROM upd u JOIN wts ON u.cluster = wts.cluster CROSS JOIN ext e
       JOIN upd l ON l.cluster = e.lg AND l.d = u.d
)"""

# Cells of sparse points and centers; distances over the indices that either has.
_SPARSE_ASSIGN = f"""
cell AS (
  SELECT event_id, {WIDE_STEP} * {_K} AS index, value / 100.0 AS v FROM events
  UNION ALL SELECT event_id, {WIDE_TYPES} + {_LABEL}, 1.0 FROM events
),
center AS (
  SELECT * FROM (VALUES {", ".join(
      f"({j}, {i}, CAST({v!r} AS DOUBLE))"
      for j, c in enumerate(wide_sparse_centers()) for i, v in c.items())}) t(cluster, index, c)
),
pair AS (SELECT event_id, cluster FROM events, (SELECT DISTINCT cluster FROM center) k),
dist AS (
  SELECT event_id, cluster, sum((v - c) * (v - c)) AS d
  FROM (
    SELECT p.event_id, p.cluster, x.v, coalesce(m.c, 0.0) AS c
    FROM pair p JOIN cell x ON x.event_id = p.event_id
         LEFT JOIN center m ON m.cluster = p.cluster AND m.index = x.index
    UNION ALL
    SELECT p.event_id, p.cluster, 0.0, m.c
    FROM pair p JOIN center m ON m.cluster = p.cluster
         LEFT JOIN cell x ON x.event_id = p.event_id AND x.index = m.index
    WHERE x.event_id IS NULL
  ) z GROUP BY event_id, cluster
),
near AS (SELECT event_id, min(cluster) AS cluster FROM (
  SELECT *, min(round(d, 9)) OVER (PARTITION BY event_id) AS least FROM dist) z
  WHERE round(d, 9) = least GROUP BY event_id)"""

ML_SQL = {
    "kmeans_assign_sparse": "WITH " + _SPARSE_ASSIGN.strip() + """
SELECT event_id, CAST(cluster AS INTEGER) AS cluster FROM near""",
    "kmeans_train_sparse": "WITH " + _SPARSE_ASSIGN.strip() + """,
n AS (SELECT cluster, count(*) AS n FROM near GROUP BY cluster),
s AS (SELECT cluster, index, sum(v) AS s FROM near JOIN cell USING (event_id) GROUP BY cluster, index)
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(index AS INTEGER) AS index,
       (round(CASE WHEN n.n IS NULL THEN c ELSE coalesce(s, 0.0) / n.n END, 6) + 0.0) AS center,
       CAST(coalesce(n.n, 0) AS DOUBLE) AS weight
FROM (SELECT * FROM center FULL JOIN s USING (cluster, index)) b LEFT JOIN n USING (cluster)""",
    "parse_vector": "WITH " + _CL_PTS.strip() + """
SELECT event_id, 2 AS dims, (round(a, 6) + 0.0) AS f0, (round(b, 6) + 0.0) AS f1 FROM cpts""",
    "parse_labeled": "WITH " + _REG_PTS.strip() + """
SELECT event_id, (round(y, 6) + 0.0) AS label, 1 AS dims, (round(x, 6) + 0.0) AS f0 FROM pts""",
    "scale_features": "WITH " + _REG_PTS.strip() + """,
s AS (SELECT avg(x) AS mx, min(x) AS lx, max(x) AS hx, avg(y) AS my, min(y) AS ly, max(y) AS hy FROM pts)
SELECT event_id, (round((x - mx) / ((hx - lx) / 2.0), 6) + 0.0) AS x_scaled,
       (round((y - my) / ((hy - ly) / 2.0), 6) + 0.0) AS y_scaled
FROM pts, s""",
    "scale_round_trip": "WITH " + _REG_PTS.strip() + """
SELECT event_id, (round(x, 6) + 0.0) AS x, (round(y, 6) + 0.0) AS y FROM pts""",
    "parse_vector_sparse": f"""
SELECT event_id, {SPARSE_DIM} AS dims, CAST({_K} AS INTEGER) AS at, (round(value / 100.0, 6) + 0.0) AS x
FROM events""",
    "parse_labeled_legacy": "WITH " + _CL_PTS.strip() + """
SELECT event_id, CAST(label AS DOUBLE) AS label, 2 AS dims, (round(a, 6) + 0.0) AS f0,
       (round(b, 6) + 0.0) AS f1 FROM cpts""",
    "linreg_closed_form": "WITH " + _REG_PTS.strip() + """
SELECT (round(regr_slope(y, x), 6) + 0.0) AS slope, (round(regr_intercept(y, x), 6) + 0.0) AS intercept,
       CAST(regr_count(y, x) AS BIGINT) AS n FROM pts""",
    "linreg_sgd_batch": "WITH RECURSIVE " + _REG_PTS.strip() + "," + _SGD + """
SELECT (round(w, 6) + 0.0) AS weight, (round(b, 6) + 0.0) AS intercept, CAST(i AS INTEGER) AS iterations FROM model""",
    "linreg_score": "WITH RECURSIVE " + _REG_PTS.strip() + "," + _SGD + """
SELECT event_id, (round(y, 6) + 0.0) AS label, (round(x * model.w + model.b, 6) + 0.0) AS prediction
FROM pts, model""",
    "kmeans_assign": "WITH " + _CL_PTS.strip() + "," + _ASSIGN_START + """
SELECT event_id, CAST(cluster AS INTEGER) AS cluster FROM asg""",
    "kmeans_train_batch": "WITH " + _CL_PTS.strip() + "," + _ASSIGN_START + "," + _TRAIN + """
SELECT CAST(cluster AS INTEGER) AS cluster, (round(ca, 6) + 0.0) AS c0, (round(cb, 6) + 0.0) AS c1,
       (round(weight, 6) + 0.0) AS weight FROM trained""",
    "kmeans_score": "WITH " + _CL_PTS.strip() + "," + _ASSIGN_START + "," + _TRAIN + f""",
p AS (SELECT {_PIVOT} FROM trained),
scored AS (
  SELECT event_id, label, {argmin_sql('e', _K_CENT)} AS cluster
  FROM (SELECT cpts.event_id, cpts.label, {distances_sql('e', _TRAINED_COLS)} FROM cpts, p) z
)
SELECT event_id, label, CAST(cluster AS INTEGER) AS cluster FROM scored""",
    "kmeans_assign_wide": "WITH " + _WIDE_ASSIGN.strip() + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM asg""",
    "kmeans_train_wide": "WITH " + _WIDE_TRAIN.strip() + """
SELECT CAST(cluster AS INTEGER) AS cluster, d AS dim, (round(c, 6) + 0.0) AS center,
       (round(weight, 6) + 0.0) AS weight FROM trained""",
}
