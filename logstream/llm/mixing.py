"""Mixing sources to target weights: Efraimidis-Spirakis order, prefix sums, token budgets.

Every document gets the exponential key -ln(u) / w: u in (0, 1) from a hash of the
seed, its id and text, w its quality weight.  Sorted by key, the documents of a source
are a weighted sample without replacement of every length.  A source's budget is filled
by complete epochs (all its documents) first; what is left of the budget is a prefix of
the key order, found by prefix sums of the sizes.

Targets: the sources share the sum of all sizes in proportion to their weights, none
above ``max_epochs`` times its own size; what a capped source gives up is shared among
the others by weight until none is above.  With sources sorted by size/weight the capped
ones come first, so one pass of running sums finds the share per unit of weight.

DataFrame functions only.  Prefix sums run in two levels, over key ranges of a source and
then inside each range, so a source with a third of all rows is spread over tasks.

Defined results: NULL source is a source of its own, ordered last; NULL or empty text has
size 0 and is taken 0 words; a weight that is NULL, not finite or not positive counts as
the smallest allowed (1e-6); repeated rows are rows like any other (the one with the
larger position in the key order goes last, identical rows are interchangeable); an empty
table gives no rows; input columns besides those named are not read by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, read_table

SOURCE_WEIGHTS = (5, 2, 1)   # in code-point order of the sources, repeating
MAX_EPOCHS = 3
ROWS_PER_RANGE = 10_000      # rows of a source that one key range is meant to hold
MAX_RANGES = 1 << 20         # key ranges per source at most; ranges grow beyond it
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sizes``: one row per source (__source, __source_size).  Adds ``__target``.

    The two windows run over one row per source, not over documents.
    """
    by_name = W.orderBy(F.col("__source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("__source_size") * float(max_epochs)
    rows = sizes.withColumn("__weight", weight).withColumn("__cap", cap)
    by_cap = W.orderBy(F.col("__cap") / F.col("__weight"), F.col("__source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    after = by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("__source_size").over(everything)
    capped = F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    unit = (total - capped) / F.sum("__weight").over(after)
    # the first source that its share leaves below its cap fixes the share of all after it
    rows = rows.withColumn("__unit", unit).withColumn(
        "__open", F.when(F.col("__unit") * F.col("__weight") <= F.col("__cap"), F.col("__unit")))
    unit_at = F.first("__open", ignorenulls=True).over(everything)
    return rows.withColumn("__target", F.least(F.col("__cap"), F.coalesce(
        unit_at, F.col("__unit")) * F.col("__weight"))).select(
        "__source", "__source_size", "__target")


def mix(docs: DataFrame, size: Column, source: Column, weight: Column, identity: Column,
        carry: list[Column], seed: int = 0, weights=SOURCE_WEIGHTS,
        max_epochs: float = MAX_EPOCHS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per document: ``carry`` columns, __size, __source_size, __target and
    ``__copies`` (how often the mix takes it).

    ``identity``: text that names the row for the seeded hash, so reruns agree.
    """
    w = F.when(weight.isNull() | F.isnan(weight) | (weight <= 0)
               | (weight == float("inf")), 1e-6).otherwise(weight.cast("double"))
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), identity), 11)   # 53 bits
    u = (bits.cast("double") + 0.5) / float(1 << 53)
    rows = materialise(docs.select(
        *carry, size.alias("__size"), source.alias("__source"), w.alias("__w"),
        u.alias("__u"), (-F.log(u) / w).alias("__key")), "mix-rows")

    sources = rows.groupBy("__source").agg(
        F.sum("__size").alias("__source_size"), F.count(F.lit(1)).alias("__n"),
        F.max("__w").alias("__most"), F.min("__key").alias("__first"))
    plan = targets(sources.select("__source", "__source_size"), weights, max_epochs)
    left = F.col("__target") - F.floor(F.col("__target") / F.col("__source_size")) \
        * F.col("__source_size")
    empty = F.col("__source_size") == 0
    plan = plan.join(sources.select(F.col("__source").alias("__s"), "__n", "__most"),
                     F.col("__source").eqNullSafe(F.col("__s"))).select(
        F.col("__source").alias("__plan_source"), "__source_size", "__target", "__n", "__most",
        F.when(empty, 0).otherwise(F.floor(F.col("__target") / F.col("__source_size")))
        .cast("long").alias("__epochs"),
        F.when(empty, 0.0).otherwise(left).alias("__left"))

    # A key's range: monotone in the key and, for equal weights, even over the rows.
    ranges = F.least(F.lit(MAX_RANGES), F.ceil(F.col("__n") / rows_per_range)).cast("double")
    rows = rows.join(plan, F.col("__source").eqNullSafe(F.col("__plan_source"))).drop(
        "__plan_source").withColumn("__range", F.floor(
            ranges * (1 - F.exp(-F.col("__key") * F.col("__most")))).cast("long"))
    per_range = rows.groupBy("__source", "__range").agg(F.sum("__size").alias("__range_size"))
    upto = W.partitionBy("__source").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = per_range.select(
        F.col("__source").alias("__s"), F.col("__range").alias("__r"),
        F.coalesce(F.sum("__range_size").over(upto), F.lit(0)).alias("__before"))
    inside = W.partitionBy("__source", "__range").orderBy("__key", "__size", *[
        F.col(n) for n in _ties(rows)]).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    rows = rows.join(starts, F.col("__source").eqNullSafe(F.col("__s"))
                     & (F.col("__range") == F.col("__r")))
    # whole documents only: the one at the end of the budget goes in if more than half fits
    middle = F.col("__before") + F.col("__inside") + F.col("__size") / 2.0
    copies = F.col("__epochs") + F.when(
        (F.col("__size") > 0) & (middle <= F.col("__left")), 1).otherwise(0)
    return rows.withColumn("__copies", copies.cast("long"))


def _ties(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("__tie")]


def weighted(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Column]:
    """Quality weight of a document from ``labels``: 1.0 where some label calls its quality
    good, 0.25 where all call it bad, 0.5 where there is none."""
    best = labels.where(F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("__label_id")).agg(F.max("quality").alias("__quality"))
    joined = docs.join(best, F.col("__id") == F.col("__label_id"), "left")
    return joined, F.when(F.col("__quality") == 1, 1.0).when(
        F.col("__quality") == 0, 0.25).otherwise(0.5)


def _input(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").alias("__id"), F.col("source").alias("__src"),
                       word_count(text).alias("__words"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("__tie_text"))


def _mixed(spark, docs: DataFrame, sf_dir: str, seed: int) -> DataFrame:
    rows, weight = weighted(_input(docs), read_table(spark, sf_dir, "labels"))
    identity = F.concat_ws("/", F.coalesce(F.col("__id").cast("string"), F.lit("null")),
                           F.col("__tie_text").cast("string"))
    return mix(rows, F.col("__words"), F.col("__src"), weight, identity,
               [F.col("__id"), F.col("__tie_text")], seed)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted), copies."""
    out = _mixed(spark, read_table(spark, sf_dir, "documents"), sf_dir, seed=0)
    return out.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"),
                      F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"),
                      (F.col("__size") * F.col("__copies")).alias("taken"),
                      F.col("__copies").alias("copies"))


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, all input columns.
    Rows that repeat id and text stand as one row, as often as they are taken together."""
    decided = materialise(_mixed(spark, docs, sf_dir, seed=0).groupBy(
        F.col("__id").alias("__mix_id"), F.col("__tie_text").alias("__mix_text")).agg(
        F.sum("__copies").alias("__times"), F.count(F.lit(1)).alias("__rows")), "mix-decided")
    names = docs.columns
    keyed = docs.withColumns({"__row_id": F.col("doc_id"), "__row_text": F.xxhash64(
        F.coalesce(F.col("text").cast("string"), F.lit("")))})
    if not decided.where("__rows > 1").isEmpty():
        keyed = keyed.dropDuplicates(["__row_id", "__row_text"])
    out = keyed.join(decided.where("__times > 0"), F.col("__row_id").eqNullSafe(F.col("__mix_id"))
                     & (F.col("__row_text") == F.col("__mix_text")))
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__times"))) \
        .select(*names)
