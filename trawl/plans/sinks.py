"""Writing results (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save(df: DataFrame, path: str, format: str = "parquet", coalesce: int | str = 0, gzip: bool | str = False, mode: str = "errorifexists") -> None:
    """text, json or parquet; `coalesce` 0 leaves the partitions as they are."""
    if format not in ("text", "json", "parquet"):
        raise ValueError(f"no format called {format!r}")
    out = df.coalesce(int(coalesce)) if int(coalesce) else df
    writer = out.write.mode(mode)
    if format != "parquet" and bool(int(gzip)):
        writer = writer.option("compression", "gzip")
    getattr(writer, format)(path)


def sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """A query over DataFrames by the names that it has in braces: sql(spark, "SELECT * FROM {t}", t=df)."""
    return spark.sql(query, **tables)
