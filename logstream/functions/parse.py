"""Column functions: access-log parsing, URL rules, status classes, vectors.

All functions build JVM-side Catalyst expressions (no Python UDFs), so they run
inside whole-stage codegen and work the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
#   Apache access-log pattern, nine groups: ip (optional), client, user,
#   [datetime], "request", status, bytes, "referer", "agent".
ACCESS_LOG_PATTERN = (
    r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) '
    r'"(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)
#   URL / record sentinels and status classes.
URL_ERROR = "[error]"           # request without a URL part (both URL rules)
RECORD_ERROR = "error"          # unmatched line in record builders
STATUS_ERROR = "[error]"        # unmatched line in the status extractor
SUCCESS, FAILURE, OTHER = "Success", "Failure", "Other"
#   Log timestamp format inside the brackets, e.g. 10/Oct/2000:13:55:36 -0700
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
# ---------------------------------------------------------------------------

# Whole-line match (Java Matcher.matches): anchor at both ends; \z so that a
# trailing newline does not match.
_ANCHORED = "^" + ACCESS_LOG_PATTERN + r"\z"
_GROUP_NAMES = ["ip", "client", "user", "ts_raw", "request", "status_str",
                "bytes", "referer", "agent"]
_SEP = "\u0001"
_REPLACEMENT = _SEP.join(f"${i}" for i in range(1, 10))

ACCESS_LOG_COLUMNS = ["matched", "ip", "client", "user", "ts_raw", "event_time",
                      "request", "status", "bytes", "referer", "agent"]


def _groups_or_fallback(value: Column) -> Column:
    """The nine groups as array<string>; a non-9 array or NULL when no match.

    One regex pass per line: the anchored pattern rewrites the whole line into
    its groups joined by U+0001, then ``split``.  A line that does not match
    is left as is (one part).  Lines that already contain U+0001 (never seen
    in access logs) take the exact per-group path.
    """
    fast = F.split(F.regexp_replace(value, _ANCHORED, _REPLACEMENT), _SEP)
    # Rare path: one regexp_extract per group, looped in a lambda so the
    # generated code stays small (it runs only on this branch).
    slow = F.when(value.rlike(_ANCHORED),
                  F.transform(F.sequence(F.lit(1), F.lit(9)),
                              lambda i: F.call_function("regexp_extract", value,
                                                        F.lit(_ANCHORED), i)))
    return F.when(F.instr(value, _SEP) == 0, fast).otherwise(slow)


def parse_access_log(df: DataFrame, col: str = "value", keep: bool = True) -> DataFrame:
    """Add the ACCESS_LOG columns parsed from the line column ``col``.

    ``matched`` is false for lines that do not match the pattern; their
    parsed columns are NULL.  ``ip`` is NULL when the optional group is empty.
    ``event_time`` is the log's own time (NULL when unparseable).
    """
    carried = list(df.columns) if keep else []
    # A generator between the regex and everything that uses its groups: filters on
    # parsed columns stay above it, so the regex runs once per line (below a plain
    # projection Catalyst would copy it into every pushed filter).
    staged = df.select(*carried, F.explode(F.array(_groups_or_fallback(F.col(col)))).alias("_f"))
    staged = staged.select(*carried, F.when(F.size("_f") == 9, F.col("_f")).alias("_g"))
    g = F.col("_g")
    parts = {name: F.get(g, i) for i, name in enumerate(_GROUP_NAMES)}
    out = staged.select(
        *carried,
        g.isNotNull().alias("matched"),
        F.nullif(parts["ip"], F.lit("")).alias("ip"),
        parts["client"].alias("client"),
        parts["user"].alias("user"),
        parts["ts_raw"].alias("ts_raw"),
        F.try_to_timestamp(F.btrim(parts["ts_raw"], F.lit("[]")),
                           F.lit(LOG_TIME_FORMAT)).alias("event_time"),
        parts["request"].alias("request"),
        parts["status_str"].cast("int").alias("status"),
        parts["bytes"].alias("bytes"),
        parts["referer"].alias("referer"),
        parts["agent"].alias("agent"),
    )
    return out


def _request_fields(request: Column) -> Column:
    # Java's split(" ") drops trailing empty parts; Spark keeps them.
    return F.split(F.rtrim(request), " ")


def url_strict(request: Column, matched: Column | None = None) -> Column:
    """Exactly three space-separated request parts -> the middle one, else [error]."""
    fields = _request_fields(request)
    ok = F.size(fields) == 3
    if matched is not None:
        ok = matched & ok
    return F.when(ok, F.get(fields, 1)).otherwise(F.lit(URL_ERROR))


def url_lenient(request: Column) -> Column:
    """Second request part when present, else [error] (for matched lines)."""
    return F.coalesce(F.get(_request_fields(request), 1), F.lit(URL_ERROR))


def status_text(matched: Column, status: Column) -> Column:
    """Status as text for matched lines, the [error] sentinel otherwise."""
    return F.when(matched, status.cast("string")).otherwise(F.lit(STATUS_ERROR))


def status_code(text: Column) -> Column:
    """Safe integer status: anything that is not an int becomes 0."""
    return F.coalesce(text.try_cast("int"), F.lit(0))


def classify_status(code: Column) -> Column:
    """200-299 Success, 500-599 Failure, everything else Other."""
    return (F.when((code >= 200) & (code < 300), F.lit(SUCCESS))
            .when((code >= 500) & (code < 600), F.lit(FAILURE))
            .otherwise(F.lit(OTHER)))


def with_status_class(parsed: DataFrame) -> DataFrame:
    """Add ``status_class`` following the alarmer's rule (unmatched -> Other)."""
    code = status_code(status_text(F.col("matched"), F.col("status")))
    return parsed.withColumn("status_class", classify_status(code))


# ---------------------------------------------------------------------------
# Vectors and labeled points in the MLlib text forms:
#   dense  "[1.0,2.0]"          sparse "(3,[0,2],[1.0,4.0])"
#   labeled "(1.0,[2.0,3.0])"   or legacy "1.0,2.0 3.0"
# ---------------------------------------------------------------------------

def parsed_columns(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """The columns ``keep`` and the parsed ``columns``, each parsed once: a generator stands
    between the parser and what uses its columns, so a filter or an aggregate over them is not
    rewritten into copies of the parser."""
    held = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*keep, held.alias("_held")).select(*keep, "_held.*")


MAX_SPARSE_DIM = 65_536      # of sparse vectors whose dimension the caller does not name
_SPARSE = r"^\(\s*(\d+)\s*,\s*(\[[^\]]*\])\s*,\s*(\[[^\]]*\])\s*\)$"


def parse_vector(text: Column, dim: int | None = None) -> Column:
    """array<double> from a dense or sparse vector text; NULL on bad input.

    A sparse text names its own size, so it is read only when that is the
    expected ``dim``, or, with none given, at most MAX_SPARSE_DIM (else NULL): the
    input never chooses how large an array a row expands to.  (:func:`parse_sparse` keeps
    vectors of any size as they are.)  Indices must be distinct and inside the vector.
    """
    s = F.trim(text)
    dense = F.from_json(s, "array<double>")
    size = F.regexp_extract(s, _SPARSE, 1).try_cast("int")
    idx = F.from_json(F.regexp_extract(s, _SPARSE, 2), "array<int>")
    vals = F.from_json(F.regexp_extract(s, _SPARSE, 3), "array<double>")
    wanted = size <= MAX_SPARSE_DIM if dim is None else size == dim
    usable = (s.startswith("(") & wanted & (F.size(idx) == F.size(vals))
              & (F.size(F.array_distinct(idx)) == F.size(idx))
              & F.forall(idx, lambda i: i.isNotNull() & (i >= 0) & (i < size)))
    at = F.map_from_arrays(idx, vals)
    sparse = F.transform(F.sequence(F.lit(0), size - 1),
                         lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0.0)))
    return (F.when(s.startswith("["), dense)
            .when(usable & (size == 0), F.array().cast("array<double>"))
            .when(usable, sparse))


def parse_sparse(text: Column) -> Column:
    """struct<size, indices, values> (indices ascending) from a sparse vector text of any
    size, or from a dense one (its entries other than 0); NULL on bad input.  What a row takes
    depends on its entries, not on its size."""
    s = F.trim(text)
    dense = F.from_json(s, "array<double>")
    entries = F.filter(F.transform(dense, lambda v, i: F.struct(i.alias("i"), v.alias("v"))),
                       lambda e: e["v"] != 0)
    of_dense = F.when(F.forall(dense, lambda v: v.isNotNull()), F.struct(
        F.size(dense).alias("size"), entries.alias("e")))
    size = F.regexp_extract(s, _SPARSE, 1).try_cast("int")
    idx = F.from_json(F.regexp_extract(s, _SPARSE, 2), "array<int>")
    vals = F.from_json(F.regexp_extract(s, _SPARSE, 3), "array<double>")
    good = (size.isNotNull() & (F.size(idx) == F.size(vals))
            & (F.size(F.array_distinct(idx)) == F.size(idx))
            & F.forall(idx, lambda i: i.isNotNull() & (i >= 0) & (i < size))
            & F.forall(vals, lambda v: v.isNotNull()))
    pairs = F.zip_with(idx, vals, lambda i, v: F.struct(i.alias("i"), v.alias("v")))
    of_sparse = F.when(good, F.struct(size.alias("size"), F.array_sort(pairs).alias("e")))
    both = F.when(s.startswith("["), of_dense).when(s.startswith("("), of_sparse)
    return F.when(both.isNotNull(), F.struct(
        both["size"].alias("size"), F.transform(both["e"], lambda e: e["i"]).alias("indices"),
        F.transform(both["e"], lambda e: e["v"]).alias("values")))


_LABELED = r"^\(\s*([^,()\[\]]+?)\s*,\s*(.*\S)\s*\)$"


def parse_labeled(text: Column, dim: int | None = None) -> tuple[Column, Column]:
    """(label DOUBLE, features ARRAY<DOUBLE>) from a labeled-point text; features are
    NULL when one of them is not a number.  ``dim``: as in :func:`parse_vector`."""
    s = F.trim(text)
    tuple_form = s.startswith("(")
    label_t = F.regexp_extract(s, _LABELED, 1).try_cast("double")
    feats_t = parse_vector(F.regexp_extract(s, _LABELED, 2), dim)
    label_l = F.substring_index(s, ",", 1).try_cast("double")
    rest = F.trim(F.substr(s, F.instr(s, ",") + 1))
    numbers = F.transform(F.split(rest, " +"), lambda x: x.try_cast("double"))
    feats_l = F.when(F.forall(numbers, lambda x: x.isNotNull()), numbers)
    label = F.when(tuple_form, label_t).otherwise(label_l)
    feats = F.when(tuple_form, feats_t).otherwise(F.when(F.instr(s, ",") > 0, feats_l))
    return label, feats
