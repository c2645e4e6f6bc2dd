r"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item (a shorter item, but not an
empty one, is one window).  A document word inside any occurrence of a window is hit.

* Winnowing (Schleimer et al., 2003): of the ``window - gram + 1`` hashed k-grams of a
  window the smallest is its fingerprint, and neighbouring windows with the same
  fingerprint are one entry (fingerprint, first window, last window).  Equal windows have
  equal fingerprints whatever stands around them, so every span of ``window`` words or more
  that a document shares with an item is found.  Items shorter than a window have
  fingerprints of their own length, taken from documents at each such length that occurs.
* The fingerprints of documents are joined with the distinct ones of all items.
* A hit is extended: exactly the windows that its entry stands for are compared, word for
  word, with the windows of the items; overlapping equal windows grow into spans.

Two documents with the same text are compared once.  Items meet documents in classes: the
windows that occur in the same items are one class, and documents that hold the same classes
share one list of items, so a passage that many documents and many items hold never makes
document-item pairs.  Tables of fingerprints and windows grow with the benchmark; whether
they are broadcast is Spark's decision by the size of the written file.

DataFrame functions only.  Defined results: NULL and empty texts have no words; words are
those of the text with A-Z in lower case, split at every ASCII character that is no letter
or digit; a text of any length is one array of words, never cut; rows that repeat id and
text are rows of their own; items that repeat an id are one item with the windows of all of
them; items without an id hit words, but are in no list; empty tables give no rows, or
documents without hits; other columns are not read.  The list of items of one document is
one value, as its digest is that of one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, read_table, text_or_empty

WINDOW, GRAM = 10, 5

# Fixed values of the contract: separators of words, letters that are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def _kept(df: DataFrame, *, of: str = "", **columns: Column) -> DataFrame:
    """Add columns that later expressions read, not repeat: a generator stands between, so
    they are not copied into the lambdas that use them.  ``of``: only these columns stay."""
    stay = of.split() or df.columns
    held = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*stay, held.alias("__held")).select(*stay, "__held.*")


def _gram_of(length: int, window: int, gram: int) -> int:
    """Words per k-gram for windows of ``length`` words."""
    return gram if length == window else (length + 1) // 2


def _fingerprints(df: DataFrame, length: int, window: int, gram: int, keep: str) -> DataFrame:
    """Winnow the column __h (hashes of the words): one row per entry with the columns
    ``keep`` and __length, __print, __from, __to (first and last window)."""
    k = _gram_of(length, window, gram)
    n = F.size("__h")
    grams = F.slice(F.transform("__h", lambda x, i: F.xxhash64(
        F.lit(length), x, *[F.get("__h", i + j) for j in range(1, k)])),
        1, F.greatest(n - (k - 1), F.lit(0)))
    df = _kept(df, of=f"{keep} __h", __g=grams)
    least = F.transform("__g", lambda x, i: F.struct(i.alias("at"), F.least(
        x, *[F.get("__g", i + j) for j in range(1, length - k + 1)]).alias("print"))) \
        if length > k else F.transform("__g", lambda x, i: F.struct(i.alias("at"),
                                                                   x.alias("print")))
    least = F.slice(least, 1, F.greatest(n - (length - 1), F.lit(0)))
    df = _kept(df, of=keep, __m=least)
    turns = F.filter("__m", lambda x: (x["at"] == 0)
                     | (x["print"] != F.get("__m", x["at"] - 1)["print"]))
    df = _kept(df, of=keep, __turns=turns, __n=F.size("__m"))
    entries = F.transform("__turns", lambda x, j: F.struct(
        F.lit(length).alias("__length"), x["print"].alias("__print"), x["at"].alias("__from"),
        (F.coalesce(F.get("__turns", j + 1)["at"], F.col("__n")) - 1).alias("__to")))
    return df.select(*keep.split(), F.inline(entries))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(words: str, starts: Column, length: Column) -> Column:
    return F.transform(starts, lambda i: F.struct(
        i.alias("__start"), length.alias("__length"),
        F.array_join(F.slice(words, i + 1, length), " ").alias("__window")))


class Benchmark:
    """Windows and fingerprints of a table of items, written once.

    ``prints``   __length, __print: distinct fingerprints
    ``classes``  __window, __class: windows, and the class of those that occur in the same items
    ``members``  __in, __item: the items (as strings) of each class
    ``lengths``  window lengths that occur
    """

    def __init__(self, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW, gram: int = GRAM):
        if not 1 <= gram <= window:
            raise ValueError("1 <= gram <= window")
        self.window, self.gram = window, gram
        rows = _kept(items.select(F.col(id_col).cast("string").alias("__item"),
                                  text_or_empty(text_col).alias("__text")),
                     of="__item", __w=_words(F.col("__text"))).where(F.size("__w") > 0)
        rows = _kept(rows, __h=_hashed(F.col("__w")), __len=F.least(F.size("__w"), F.lit(window)))
        rows = materialise(rows, "bench-items")
        self.lengths = sorted(r[0] for r in rows.select("__len").distinct().collect())
        prints = [_fingerprints(rows.where(F.col("__len") == n), n, window, gram, "__item")
                  .select("__length", "__print") for n in self.lengths]
        empty = rows.sparkSession.createDataFrame([], "__length int, __print long")
        for p in prints:
            empty = empty.unionByName(p)
        self.prints = materialise(empty.distinct(), "bench-prints")

        starts = F.sequence(F.lit(0), F.size("__w") - F.col("__len"))
        found = rows.select("__item", F.inline(_windows("__w", starts, F.col("__len"))))
        found = materialise(found.select("__window", "__item").distinct(), "bench-windows")
        sets = found.groupBy("__window").agg(
            F.count("__item").alias("n"), F.bit_xor(F.xxhash64("__item")).alias("a"),
            F.bit_xor(F.xxhash64(F.lit(1), F.col("__item"))).alias("b"))
        sets = materialise(sets, "bench-sets")
        kinds = materialise(sets.groupBy("n", "a", "b").agg(F.min("__window").alias("__first"))
                            .withColumn("__class", F.monotonically_increasing_id()), "bench-kinds")
        self.classes = materialise(sets.join(kinds, ["n", "a", "b"]).select(
            "__window", "__class"), "bench-classes")
        self.members = materialise(
            kinds.join(found, F.col("__first") == F.col("__window")).where("__item IS NOT NULL")
            .select(F.col("__class").alias("__in"), "__item"), "bench-members")


def _entries(docs: DataFrame, text_col: str, bench: Benchmark) -> DataFrame:
    """__key (hash of the text), __entries: windows of the text that share a fingerprint
    with an item.  (Texts that share a key share entries: more windows to compare.)"""
    hashed = docs.select(text_or_empty(text_col).alias("__text"))
    hashed = hashed.select(F.xxhash64("__text").alias("__key"), "__text")
    hashed = _kept(hashed, of="__key", __w=_words(F.col("__text")))
    hashed = _kept(hashed, of="__key", __h=_hashed(F.col("__w")))
    found = None
    for n in bench.lengths:
        part = _fingerprints(hashed, n, bench.window, bench.gram, "__key")
        found = part if found is None else found.unionByName(part)
    prints = bench.prints.withColumnsRenamed({"__length": "__l", "__print": "__p"})
    hit = found.join(prints, (F.col("__print") == F.col("__p")) & (F.col("__length") == F.col("__l")),
                     "left_semi")
    return materialise(hit.groupBy("__key").agg(F.collect_set(F.struct(
        "__length", "__from", "__to")).alias("__entries")), "leak-entries")


def _spans(windows: Column) -> Column:
    """Sorted (start, length) of equal windows into maximal spans (start, end)."""
    merged = F.aggregate(
        windows,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["__start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["__start"] + x["__length"])
                .alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(
            x["__start"].alias("start"), (x["__start"] + x["__length"]).alias("end"))))))
    return merged


def leaks(docs: DataFrame, bench: Benchmark, text_col: str = "text") -> DataFrame:
    """One row per distinct text that holds a window: __leak (SHA-256 of the text), __spans
    (start, end of the hit words, apart from each other), __items (sorted ids)."""
    spark = docs.sparkSession
    if not bench.lengths:
        return spark.createDataFrame([], "__leak string, __spans array<struct<start:int,end:int>>,"
                                         " __items array<string>")
    entries = _entries(docs, text_col, bench)
    # merge: both sides grow with the corpus, so the join is the same at every size
    texts = docs.select(text_or_empty(text_col).alias("__text")).join(
        entries.hint("merge"), F.xxhash64("__text") == F.col("__key"))
    texts = texts.select(F.sha2("__text", 256).alias("__leak"), "__text", "__entries") \
        .dropDuplicates(["__leak"])
    texts = _kept(texts, of="__leak __entries", __w=_words(F.col("__text")))
    windows = F.flatten(F.transform("__entries", lambda e: _windows(
        "__w", F.sequence(e["__from"], e["__to"]), e["__length"])))
    compared = texts.select("__leak", F.inline(windows))
    classes = bench.classes.withColumnRenamed("__window", "__of")
    equal = compared.join(classes, F.col("__window") == F.col("__of")).select(
        "__leak", "__start", "__length", "__class")
    held = equal.groupBy("__leak").agg(
        F.array_sort(F.collect_set(F.struct("__start", "__length"))).alias("__at"),
        F.array_sort(F.collect_set("__class")).alias("__classes"))
    held = _kept(held, of="__leak __classes", __spans=_spans(F.col("__at")))
    held = materialise(held, "leak-texts")
    lists = held.select(F.col("__classes").alias("__list")).distinct()
    lists = lists.select("__list", F.explode("__list").alias("__class")) \
        .join(bench.members, F.col("__class") == F.col("__in")) \
        .groupBy("__list").agg(F.array_sort(F.collect_set("__item")).alias("__items"))
    lists = materialise(lists, "leak-lists")
    return materialise(held.join(lists, F.col("__classes") == F.col("__list"), "left").select(
        "__leak", "__spans",
        F.coalesce("__items", F.array().cast("array<string>")).alias("__items")), "leak-found")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: __id, __n_words, __spans, __n_hit, __items."""
    found = leaks(docs, Benchmark(items, item_id_col, item_text_col, window, gram), text_col)
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    rows = rows.select("__id", F.size(_words(F.col("__text"))).cast("long").alias("__n_words"),
                       F.sha2("__text", 256).alias("__sha"))
    out = rows.join(found, F.col("__sha") == F.col("__leak"), "left")
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"),
                        lambda n, s: n + (s["end"] - s["start"]))
    return out.select("__id", "__n_words", F.coalesce("__spans", F.array().cast(
        "array<struct<start:int,end:int>>")).alias("__spans"),
        F.coalesce(n_hit, F.lit(0).cast("long")).alias("__n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("__items"))


def op12_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    out = contamination(read_table(spark, sf_dir, "documents"),
                        read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("__id").alias("doc_id"), F.col("__n_words").alias("n_words"),
                      F.col("__n_hit").alias("n_hit"),
                      F.size("__items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
                      (F.col("__n_hit") > 0).alias("contaminated"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT l FROM bw),
dw AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS win
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens WHERE len(w) >= l)),
hit AS (SELECT DISTINCT dw.r, dw.l, dw.i, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.l = bw.l),
pos AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(pos.n_hit, 0)::BIGINT AS n_hit,
       coalesce(its.n_items, 0)::BIGINT AS n_items, sha256(coalesce(its.items, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON pos.r = d.r LEFT JOIN its ON its.r = d.r
"""
