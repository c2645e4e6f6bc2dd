r"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold a conversation several times, each time a few turns longer.  Every
conversation's turn prefixes get rolling hashes: the XOR of one 128-bit hash per turn,
salted with the turn's position, so each prefix hash follows from the one before.  A
conversation whose whole hash is a proper prefix hash of another one is a snapshot of it;
an anti-join on (length, hash) keeps the maximal ones.  Of equal conversations the one with
the smallest id stays.  What stays is rendered in the ChatML layout:

    <|im_start|>role\ntext<|im_end|>\n            per turn

A conversation is rendered in segments, one row each; joined in order they are the whole
conversation.  A segment holds SEGMENT_TURNS places of the conversation's order (the last one
what is left), whatever its turn numbers are, so many logs with a NULL conv_id or repeated turn
numbers make more segments, not larger ones.

Places are found without gathering a conversation: turns are range-partitioned by (conv_id,
turn, role, head of the text), and a turn's place is its row in its range plus the rows of
the conversation in earlier ranges.  Prefix hashes are XORs in three levels: inside pieces of
PIECE places, over the pieces of a block, over the blocks of a conversation.  (The range's
cuts see HEAD characters of a text; turns alike in all of that share a range.)

DataFrame functions only.  Defined results: turns are ordered by (turn, role, text), NULLs
first; rows that repeat all four columns are one turn; NULL role and text render as empty
(but hash apart from empty); NULL conv_id is one conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, read_table

SEGMENT_TURNS = 64        # turns per segment
PIECE = 64                # places per piece of the prefix hashes
BLOCK = 4_096             # pieces per block
HEAD = 256                # characters of a text that the cuts of the ranges see
START, END = "<|im_start|>", "<|im_end|>"    # fixed values of the layout


def _placed(turns: DataFrame) -> DataFrame:
    """Distinct turns with __position, their place in the conversation from 1 on."""
    order = ["conv_id", "turn", "role"]
    rows = turns.select(*order, "text").distinct()
    ranged = rows.repartitionByRange(*order, F.substring("text", 1, HEAD)) \
        .sortWithinPartitions(*order, "text")
    row = F.monotonically_increasing_id()
    rows = materialise(ranged.withColumns({"__range": F.spark_partition_id(), "__row": row}),
                       "chat-turns")
    held = rows.groupBy("conv_id", "__range").agg(F.min("__row").alias("__first"),
                                                  F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy("conv_id").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = held.select(
        F.col("conv_id").alias("__c"), F.col("__range").alias("__r"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__add"))
    same = F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("__range") == F.col("__r"))
    return materialise(rows.join(starts, same).select(
        *order, "text", (F.col("__row") + F.col("__add")).alias("__position")), "chat-placed")


def _before(df: DataFrame, level: str, within: list[str]) -> DataFrame:
    """Adds __ea, __eb: XOR of __sa, __sb over the earlier rows of the group in order."""
    w = W.partitionBy("conv_id", *within).orderBy(level).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumns({e: F.coalesce(F.bit_xor(x).over(w), F.lit(0))
                           for e, x in (("__ea", "__sa"), ("__eb", "__sb"))})


def _summed(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    return df.groupBy("conv_id", *keys).agg(
        F.bit_xor(a).alias("__sa"), F.bit_xor(b).alias("__sb"), F.max("__last").alias("__last"))


def maximal(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Turns of the conversations that no other one extends: conv_id, __segment, turn, role,
    text, and __turns (length of the conversation)."""
    rows = _placed(turns)
    by_place = F.floor((F.col("__position") - 1) / segment_turns).cast("long")
    piece = F.floor((F.col("__position") - 1) / PIECE)
    salted = materialise(rows.select(
        "conv_id", piece.alias("__piece"), F.col("__position").alias("__last"),
        F.xxhash64("__position", F.xxhash64(F.lit(1), *_named("role", "text"))).alias("__a"),
        F.xxhash64("__position", F.xxhash64(F.lit(2), *_named("role", "text"))).alias("__b")),
        "chat-hashes")

    # prefix hashes in three levels: blocks, pieces of a block, places of a piece
    pieces = _summed(salted, ["__piece"], "__a", "__b") \
        .withColumn("__block", F.floor(F.col("__piece") / BLOCK))
    blocks = _summed(pieces, ["__block"], "__sa", "__sb")
    whole = _summed(blocks, [], "__sa", "__sb").select(
        "conv_id", F.col("__last").alias("__turns"), F.col("__sa").alias("__wa"),
        F.col("__sb").alias("__wb"))
    whole = materialise(whole, "chat-whole")
    blocks = _before(blocks, "__block", []).select(
        F.col("conv_id").alias("__c"), F.col("__block").alias("__k"),
        F.col("__ea").alias("__ba"), F.col("__eb").alias("__bb"))
    earlier = _before(pieces, "__piece", ["__block"]).join(
        blocks, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("__block") == F.col("__k"))) \
        .select(F.col("conv_id").alias("__c"), F.col("__piece").alias("__p"),
                F.col("__ea").bitwiseXOR(F.col("__ba")).alias("__ea"),
                F.col("__eb").bitwiseXOR(F.col("__bb")).alias("__eb"))
    upto = W.partitionBy("conv_id", "__piece").orderBy("__last").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    prefixes = salted.select(
        "conv_id", "__piece", F.col("__last").alias("__length"),
        F.bit_xor("__a").over(upto).alias("__ia"), F.bit_xor("__b").over(upto).alias("__ib")) \
        .join(earlier, F.col("conv_id").eqNullSafe(F.col("__c"))
              & (F.col("__piece") == F.col("__p"))).select(
        "conv_id", "__length", F.col("__ia").bitwiseXOR(F.col("__ea")).alias("__pa"),
        F.col("__ib").bitwiseXOR(F.col("__eb")).alias("__pb"))
    lasts = whole.select(F.col("conv_id").alias("__c"), "__turns")
    proper = prefixes.join(lasts, F.col("conv_id").eqNullSafe(F.col("__c"))) \
        .where("__length < __turns").select("__length", "__pa", "__pb").distinct()

    unique = whole.groupBy("__turns", "__wa", "__wb").agg(F.min("conv_id").alias("conv_id"))
    stays = unique.join(proper, (F.col("__turns") == F.col("__length"))
                        & (F.col("__wa") == F.col("__pa"))
                        & (F.col("__wb") == F.col("__pb")), "left_anti")
    stays = stays.select(F.col("conv_id").alias("__c"), "__turns")
    return rows.join(stays, F.col("conv_id").eqNullSafe(F.col("__c"))).select(
        "conv_id", by_place.alias("__segment"), "turn", "role", "text", "__turns")


def _named(*names: str):
    """Columns with a mark that tells NULL from empty."""
    return [x for n in names for x in (F.col(n).isNull(), F.col(n))]


def render(turns: DataFrame) -> DataFrame:
    """conv_id, segment, n_turns (of the conversation), segment_turns, rendered."""
    one = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit("\n"),
                   F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text", one.alias("piece"))))
    return turns.groupBy("conv_id", "__segment", "__turns").agg(
        ordered.alias("__all"), F.count(F.lit(1)).alias("segment_turns")).select(
        "conv_id", F.col("__segment").alias("segment"), F.col("__turns").alias("n_turns"),
        "segment_turns", F.array_join(F.col("__all.piece"), "").alias("rendered"))


def op6_chat(spark, sf_dir: str) -> DataFrame:
    """Rendered segments of every maximal conversation, with the SHA-256 of the text."""
    out = render(maximal(read_table(spark, sf_dir, "conversations")))
    return out.withColumn("rendered_sha256", F.sha2("rendered", 256))


OP6_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (
  SELECT *, row_number() OVER w AS length, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(coalesce('r' || length(role) || ':' || role, 'n')
                    || coalesce('t' || length(text) || ':' || text, 'n'), '') OVER (
           w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                      text NULLS FIRST)),
h AS (SELECT conv_id, length, n_turns, sha256(prefix) AS hash FROM p),
u AS (SELECT min(conv_id) AS conv_id, n_turns, hash FROM h WHERE length = n_turns
      GROUP BY n_turns, hash),
m AS (SELECT u.* FROM u WHERE NOT EXISTS (
        SELECT 1 FROM h WHERE h.length = u.n_turns AND h.hash = u.hash AND h.n_turns > h.length)),
r AS (
  SELECT t.conv_id, CAST((t.length - 1) // {SEGMENT_TURNS} AS BIGINT) AS segment, m.n_turns,
         count(*) AS segment_turns,
         string_agg('{START}' || coalesce(role, '') || chr(10) || coalesce(text, '')
                    || '{END}' || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST,
                    text NULLS FIRST) AS rendered
  FROM p t JOIN m ON t.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY 1, 2, 3)
SELECT *, sha256(rendered) AS rendered_sha256 FROM r
"""
