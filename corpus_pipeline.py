"""Training-corpus pipeline: five operators of ``logstream.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of documents:

1. toxicity        documents that the classifier rejects go
2. exact_dedup     of equal texts (A-Z lower-cased) the row with the largest doc_id stays
3. near_dedup      one document of each near-duplicate class stays
4. mixing          each source is repeated or cut to its target share
5. bpe             byte-level BPE ids of every whole text are added (``ids``)

Each stage works on everything its predecessor kept.  NULL texts count as empty; extra
columns pass through every stage; an empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logstream.llm.bpe import bpe_stage
from logstream.llm.common import materialise, read_table
from logstream.llm.exact_dedup import dedup_stage
from logstream.llm.mixing import mixing_stage
from logstream.llm.near_dedup import near_dedup_stage
from logstream.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# Learned scores and sketches cannot be written in SQL: tests compare the stages with
# brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
