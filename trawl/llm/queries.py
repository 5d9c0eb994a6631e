"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trawl.llm import decontamination, lines, lm, mixing, near_dedup, quality, sharding, suffix_array, token_counts, token_output


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1(spark, sf_dir):
    return token_output.token_output(_table(spark, sf_dir, "documents"))


def _op2(spark, sf_dir):
    return mixing.mixing_order(_table(spark, sf_dir, "documents"))


def _op3(spark, sf_dir):
    return suffix_array.repeated_passages(_table(spark, sf_dir, "documents"))


def _op4(spark, sf_dir):
    return lines.page_line_dedup(_table(spark, sf_dir, "pages"))


def _op5(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def _op6(spark, sf_dir):
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def _op7(spark, sf_dir):
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _op8(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def _op9(spark, sf_dir):
    return lm.lm_scores(_table(spark, sf_dir, "documents"))


def _op10(spark, sf_dir):
    return sharding.sharded(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_output": _op1,
    "op2_mixing": _op2,
    "op3_suffix_array": _op3,
    "op4_line_dedup": _op4,
    "op5_near_dedup": _op5,
    "op6_quality_rules": _op6,
    "op7_decontamination": _op7,
    "op8_token_counts": _op8,
    "op9_lm_scores": _op9,
    "op10_sharding": _op10,
}

_SHARDS = sharding.SHARD_BYTES
ORACLES = {
    "op2_mixing": mixing.ORDER_SQL,
    "op4_line_dedup": lines.PAGES_SQL,
    "op6_quality_rules": quality.DOCUMENTS_SQL,
    "op10_sharding": f"""
WITH sized AS (SELECT coalesce(doc_id, -9223372036854775808) AS k, sum(coalesce(strlen(text), 0)) AS b FROM documents GROUP BY 1),
placed AS (SELECT k, coalesce(sum(b) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(b) OVER () AS total FROM sized),
shards AS (SELECT *, greatest(1, (total + {_SHARDS - 1}) // {_SHARDS}) AS n FROM placed)
SELECT d.*, least(n - 1, below * n // greatest(total, 1))::BIGINT AS shard FROM documents d JOIN shards ON k = coalesce(doc_id, -9223372036854775808)
""",
}
