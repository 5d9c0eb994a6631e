"""A training corpus from `documents`: clean, deduplicate, decontaminate, mix, tokenize.

STAGES lists the stages.  Each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of `documents`.

Documents without text, or with nothing but white space in it, go in the first
stage; null ids, languages and sources stay as they are.  Repeated rows are exact
copies, of which one stays.  Columns beyond those of `documents` pass through all
stages but the last.  Empty tables of documents or items pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trawl.llm.decontamination import decontaminated
from trawl.llm.mixing import mixed
from trawl.llm.near_dedup import without_near_duplicates
from trawl.llm.quality import quality_rules
from trawl.llm.token_output import SHARD_SEQUENCES, token_output
from trawl.scratch import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cleaned texts; documents that lose too much go.  An empty table stays empty."""
    return quality_rules(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the least id."""
    return without_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of `benchmark` go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, file after file; sources below their share come in several epochs."""
    return mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences by slot, their shards written.

    Slots are permuted inside windows of one shard, so that the mixture holds from shard
    to shard: it is off by less than a block and a window anywhere.
    """
    return token_output(docs, window=SHARD_SEQUENCES)


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token output", token_stage),
]

#: Near-duplicate groups and byte-pair encoding are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
