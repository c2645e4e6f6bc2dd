"""DuckDB SQL for the registered queries (the correctness oracle).

Written independently of the Spark plans: the fixture lines are rebuilt with
DuckDB string functions, parsed with RE2, and windows / sessions use plain
SQL (``unnest`` of window starts, ``lag`` + running sum).  Output columns and
conventions match ``plans/queries.py``.
"""

from __future__ import annotations

# Same fixed pattern as functions/parse.py (RE2 accepts it unchanged).
_PAT = (r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) '
        r'"(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"')

ACCESS_LOG_CTE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) AS k,
         event_id % 50 AS m
  FROM events
),
access_log AS (
  SELECT event_id, ts,
    CASE WHEN m = 0 THEN 'corrupt line ' || CAST(event_id AS VARCHAR) ELSE
      (CASE WHEN m = 3 THEN '' WHEN m = 6 THEN 'host.example'
            ELSE '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) END)
      || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
      || (CASE WHEN m = 1 THEN 'GET /' || event_type || '/' || CAST(k AS VARCHAR)
               WHEN m = 2 THEN '-'
               WHEN m = 4 THEN 'GET /' || event_type || '/' || CAST(k AS VARCHAR) || ' HTTP/1.1 '
               WHEN m = 5 THEN 'GET /' || event_type || '/' || CAST(k AS VARCHAR) || ' x HTTP/1.1'
               ELSE 'GET /' || event_type || '/' || CAST(k AS VARCHAR) || ' HTTP/1.1' END)
      || '" ' || CAST(CASE WHEN event_type = 'error' THEN 500
                           WHEN event_type = 'click' AND day(ts) % 5 = 0 THEN 503
                           WHEN event_type = 'signup' THEN 302
                           WHEN event_type = 'purchase' AND k % 7 = 0 THEN 404
                           ELSE 200 END AS VARCHAR)
      || ' ' || CAST((event_id * 17) % 5000 AS VARCHAR) || ' "-" "Agent/'
      || CAST(event_id % 5 AS VARCHAR) || '"'
    END AS value
  FROM ev
),
pm AS (
  SELECT event_id, ts, value, regexp_full_match(value, '{_PAT}') AS matched FROM access_log
),
parsed AS (
  SELECT event_id, ts, value, matched,
    CASE WHEN matched THEN nullif(regexp_extract(value, '^{_PAT}$', 1), '') END AS ip,
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 2) END AS client,
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 3) END AS "user",
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 4) END AS ts_raw,
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 5) END AS request,
    CASE WHEN matched THEN CAST(regexp_extract(value, '^{_PAT}$', 6) AS INTEGER) END AS status,
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 7) END AS bytes,
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 8) END AS referer,
    CASE WHEN matched THEN regexp_extract(value, '^{_PAT}$', 9) END AS agent
  FROM pm
),
req AS (
  SELECT event_id, ts, matched, ip, request, status, agent,
    string_split(rtrim(request), ' ') AS rf,
    CASE WHEN matched AND len(string_split(rtrim(request), ' ')) = 3
         THEN string_split(rtrim(request), ' ')[2] ELSE '[error]' END AS url_strict,
    CASE WHEN matched THEN coalesce(string_split(rtrim(request), ' ')[2], '[error]')
         ELSE 'error' END AS url_lenient,
    CASE WHEN NOT matched THEN 'Other'
         WHEN status >= 200 AND status < 300 THEN 'Success'
         WHEN status >= 500 AND status < 600 THEN 'Failure' ELSE 'Other' END AS status_class
  FROM parsed
)"""


def _with(select: str, ctes: str = "") -> str:
    """The fixture CTEs, optional extra CTEs, then the final SELECT."""
    extra = ",\n" + ctes.strip() if ctes.strip() else ""
    return "WITH " + ACCESS_LOG_CTE.strip() + extra + "\n" + select.strip()


def _sliding_url(window_s: int, slide_s: int) -> str:
    n = window_s // slide_s
    return f"""
urlwin AS (
  SELECT url_strict AS url,
         (epoch_us(ts) // {slide_s * 1000000}) * {slide_s} - i * {slide_s} AS window_start
  FROM req, (SELECT unnest(range(0, {n})) AS i) r
),
urlcounts AS (
  SELECT window_start, window_start + {window_s} AS window_end, url, count(*) AS n
  FROM urlwin GROUP BY window_start, url
)"""


def _session_ctes(gap_s: int) -> str:
    g = gap_s * 1000000
    return f"""
clicks AS (
  SELECT event_id, epoch_us(ts) AS t,
         CASE WHEN matched THEN ip ELSE 'error' END AS ip, url_lenient AS url
  FROM req
),
s1 AS (
  SELECT *, CASE WHEN lag(t) OVER (PARTITION BY ip ORDER BY t, event_id) IS NULL
                   OR t - lag(t) OVER (PARTITION BY ip ORDER BY t, event_id) > {g}
                 THEN 1 ELSE 0 END AS nw
  FROM clicks
),
s2 AS (
  SELECT *, sum(nw) OVER (PARTITION BY ip ORDER BY t, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s1
),
s3 AS (
  SELECT *, row_number() OVER (PARTITION BY ip, sid ORDER BY t, event_id) AS rn FROM s2
)"""


def _sessions(gap_s: int) -> str:
    return _with("""
SELECT ip, min(t) // 1000000 AS session_start, max(t) // 1000000 AS session_end,
       count(*) AS session_length,
       array_to_string(list(url ORDER BY t, event_id) FILTER (WHERE rn <= 10), ' ') AS clickstream
FROM s3 GROUP BY ip, sid""", _session_ctes(gap_s))


def open_sessions(gap_s: int, spans: int, delay_s: int) -> str:
    """Sessions of the rows of spans 0..k that are open after span k, for each k: their end
    and the gap reach the watermark, the newest row (in ms) less the delay."""
    g = gap_s * 1000000
    return _with(f"""
SELECT k AS span, ip, min(t) // 1000000 AS session_start, count(*) AS session_length,
       array_to_string(list(url ORDER BY t, event_id) FILTER (WHERE rn <= 10), ' ') AS clickstream
FROM z3 GROUP BY k, ip, sid
HAVING max(t) + {g} >= any_value(newest) // 1000 * 1000 - {delay_s * 1000000}""", f"""
clicks AS (
  SELECT event_id, epoch_us(ts) AS t,
         CASE WHEN matched THEN ip ELSE 'error' END AS ip, url_lenient AS url
  FROM req
),
ends AS (SELECT min(t) AS low, max(t) AS high FROM clicks),
spanned AS (
  SELECT c.*, ((t - low) * {spans}) // (high - low + 1) AS span FROM clicks c, ends
),
z0 AS (
  SELECT s.*, k, max(t) OVER (PARTITION BY k) AS newest
  FROM spanned s, (SELECT unnest(range({spans})) AS k) r WHERE span <= k
),
z1 AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > {g} THEN 1 ELSE 0 END AS nw
  FROM z0 WINDOW w AS (PARTITION BY k, ip ORDER BY t, event_id)
),
z2 AS (
  SELECT *, sum(nw) OVER (PARTITION BY k, ip ORDER BY t, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM z1
),
z3 AS (
  SELECT *, row_number() OVER (PARTITION BY k, ip, sid ORDER BY t, event_id) AS rn FROM z2
)""")


def late_rows(pieces: int, delay_s: int) -> str:
    """Pieces arrive in order; late: before the newest time of earlier ones less the delay."""
    return f"""
WITH e AS (SELECT *, coalesce(event_id % {pieces}, 0) AS piece, epoch_us(ts) AS t FROM events),
n AS (SELECT piece, max(t) AS newest FROM e GROUP BY piece)
SELECT event_id, event_type,
       t IS NULL OR coalesce(t < (SELECT max(newest) FROM n WHERE n.piece < e.piece)
                             - {delay_s * 1000000}, false) AS late
FROM e"""


def arrival_counts(pieces: int, step_s: int) -> str:
    """Piece k arrives at (k + 1) * step; windows of three steps sliding by one."""
    return _with(f"""
SELECT (event_id % {pieces} + 1 - i) * {step_s} AS window_start,
       (event_id % {pieces} + 1 - i) * {step_s} + {3 * step_s} AS window_end, url_strict AS url, count(*) AS n
FROM req, (SELECT unnest(range(3)) AS i) r GROUP BY ALL""")


def session_progress(gap_s: int) -> str:
    """Every click with its session up to it."""
    return _with("""
SELECT event_id, ip, min(t) OVER w // 1000000 AS session_start, rn AS clicks,
       array_to_string((list(url) OVER w)[1:10], ' ') AS clickstream
FROM s3 WINDOW w AS (PARTITION BY ip, sid ORDER BY t, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", _session_ctes(gap_s))


_ALARM_WINDOW_S, _ALARM_SLIDE_S = 86400, 21600

_STATUS_TOTALS = f"""
stwin AS (
  SELECT status_class,
         (epoch_us(ts) // {_ALARM_SLIDE_S * 1000000}) * {_ALARM_SLIDE_S} - i * {_ALARM_SLIDE_S} AS window_start
  FROM req, (SELECT unnest(range(0, {_ALARM_WINDOW_S // _ALARM_SLIDE_S})) AS i) r
),
totals AS (
  SELECT window_start, window_start + {_ALARM_WINDOW_S} AS window_end,
         CAST(count(*) FILTER (WHERE status_class = 'Success') AS BIGINT) AS success,
         CAST(count(*) FILTER (WHERE status_class = 'Failure') AS BIGINT) AS failure,
         CAST(count(*) FILTER (WHERE status_class = 'Other') AS BIGINT) AS other
  FROM stwin GROUP BY window_start
)"""


def _status_runs(window_s: int, slide_s: int) -> str:
    """Runs of window starts with equal totals, between the first and the last window."""
    w, s = window_s * 1000000, slide_s * 1000000
    return f"""
slices AS (
  SELECT epoch_us(ts) // {s} * {s} AS a,
         CAST(count(*) FILTER (WHERE status_class = 'Success') AS BIGINT) AS success,
         CAST(count(*) FILTER (WHERE status_class = 'Failure') AS BIGINT) AS failure,
         CAST(count(*) FILTER (WHERE status_class = 'Other') AS BIGINT) AS other
  FROM req GROUP BY 1
),
points AS (
  SELECT p, sum(success) AS success, sum(failure) AS failure, sum(other) AS other FROM (
    SELECT a - {w} + {s} AS p, success, failure, other FROM slices
    UNION ALL SELECT a + {s}, -success, -failure, -other FROM slices) d GROUP BY p
),
runs AS (
  SELECT p AS first_us, lead(p) OVER (ORDER BY p) - {s} AS last_us,
         CAST(sum(success) OVER u AS BIGINT) AS success,
         CAST(sum(failure) OVER u AS BIGINT) AS failure, CAST(sum(other) OVER u AS BIGINT) AS other
  FROM points WINDOW u AS (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


_RATIO_STATE = """CASE WHEN success > 0 THEN round(failure / success, 6) + 0.0 END AS ratio,
       CASE WHEN success + failure <= 100 THEN 'insufficient'
            WHEN failure > 0.5 * success THEN 'alarm' ELSE 'ok' END AS state"""


def status_run_states(window_s: int = 300, slide_s: int = 1) -> str:
    return _with(f"""
SELECT first_us // 1000000 AS first_start, last_us // 1000000 AS last_start,
       success, failure, other, {_RATIO_STATE}
FROM runs WHERE last_us IS NOT NULL""", _status_runs(window_s, slide_s))


BATCH_SQL = {
    "top_urls_overall": _with("""
SELECT url_strict AS url, count(*) AS n FROM req GROUP BY 1 ORDER BY n DESC, url LIMIT 10"""),
    "url_ranking": _with("SELECT url_strict AS url, count(*) AS n FROM req GROUP BY 1"),
    "status_totals_1s": status_run_states(),
    "status_totals_filled": _with("""
SELECT unnest(range(first_us // 1000000, last_us // 1000000 + 1, 600)) AS window_start,
       window_start + 3600 AS window_end, success, failure, other
FROM runs WHERE last_us IS NOT NULL""", _status_runs(3600, 600)),
    "alarms": _with("""
SELECT window_start, window_end, success, failure,
       CASE WHEN success > 0 THEN round(failure / success, 6) + 0.0 END AS ratio
FROM totals WHERE success + failure > 100 AND failure > 0.5 * success""", _STATUS_TOTALS),
    "parse_access_log": _with("""
SELECT event_id, value, matched, ip, client, "user", ts_raw,
       epoch_us(try_strptime(trim(ts_raw, '[]'), '%d/%b/%Y:%H:%M:%S %z')) // 1000000 AS event_time_s,
       request, status, bytes, referer, agent
FROM parsed"""),
    "url_strict_counts": _with("""
SELECT url_strict AS url, count(*) AS n FROM req GROUP BY url_strict"""),
    "url_lenient_counts": _with("""
SELECT url_lenient AS url, count(*) AS n FROM req GROUP BY url_lenient"""),
    "status_class_counts": _with("""
SELECT status_class, count(*) AS n FROM req GROUP BY status_class"""),
    "sliding_url_counts": _with("SELECT window_start, window_end, url, n FROM urlcounts",
                                _sliding_url(300, 60)),
    "sliding_url_counts_1s": _with("SELECT window_start, window_end, url, n FROM urlcounts",
                                   _sliding_url(300, 1)),
    "sliding_url_counts_event_time": _with("SELECT window_start, window_end, url, n FROM evcounts", """
evt AS (
  SELECT url_strict AS url,
         epoch_us(try_strptime(trim(p.ts_raw, '[]'), '%d/%b/%Y:%H:%M:%S %z')) AS t
  FROM req JOIN parsed p USING (event_id)
),
evwin AS (
  SELECT url, (t // 60000000) * 60 - i * 60 AS window_start
  FROM evt, (SELECT unnest(range(0, 5)) AS i) r
  WHERE t IS NOT NULL
),
evcounts AS (
  SELECT window_start, window_start + 300 AS window_end, url, count(*) AS n
  FROM evwin GROUP BY window_start, url
)"""),
    "top_urls_per_window": _with("""
SELECT window_start, window_end, url, n, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE rank <= 10""", _sliding_url(86400, 21600).strip() + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, url ASC) AS rank
  FROM urlcounts
)"""),
    "status_totals": _with("SELECT window_start, window_end, success, failure, other FROM totals",
                           _STATUS_TOTALS),
    "error_alarm": _with("""
SELECT window_start, window_end, success, failure,
       CASE WHEN success > 0 THEN round(failure / success, 6) + 0.0 END AS ratio,
       CASE WHEN success + failure <= 100 THEN 'insufficient'
            WHEN failure > 0.5 * success THEN 'alarm' ELSE 'ok' END AS state
FROM totals""", _STATUS_TOTALS),
    "agent_counts_per_interval": _with("""
SELECT (epoch_us(ts) // 3600000000) * 3600 AS window_start,
       CASE WHEN matched THEN agent ELSE 'error' END AS agent, count(*) AS total
FROM req GROUP BY 1, 2"""),
    "requests_by_agent": _with("""
SELECT CASE WHEN matched THEN agent ELSE 'error' END AS agent, count(*) AS total
FROM req GROUP BY 1"""),
    "access_rows": _with("""
SELECT event_id, CASE WHEN matched THEN ip ELSE 'error' END AS ip, url_lenient AS url,
       CASE WHEN matched THEN status ELSE 0 END AS status,
       CASE WHEN matched THEN agent ELSE 'error' END AS agent
FROM req"""),
    "sessions_30m": _sessions(1800),
    "sessions_2d_first10": _sessions(2 * 86400),
    "latest_by_ip": _with("SELECT ip, event_id, url, status, agent FROM ranked WHERE rn = 1", """
rows AS (
  SELECT event_id, ts, CASE WHEN matched THEN ip ELSE 'error' END AS ip, url_lenient AS url,
         CASE WHEN matched THEN status ELSE 0 END AS status,
         CASE WHEN matched THEN agent ELSE 'error' END AS agent
  FROM req
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ip ORDER BY ts DESC, event_id DESC) AS rn
  FROM rows WHERE ip IS NOT NULL
)"""),
    "status_texts": """
SELECT conv_id, turn, text FROM conversations""",
}
