"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64_000_000
SPREAD_BYTES = 32_000_000


def c(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A 64-bit key of a document row; rows of one id and text share it."""
    return F.xxhash64(c(doc_id), c(text))


def keep_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[c(name) for name in like.columns])


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of `df` has it."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def check_broadcast(n_bytes: int, what: str) -> None:
    if n_bytes > BROADCAST_BYTES:
        raise ValueError(f"{what} takes {n_bytes} bytes; at most {BROADCAST_BYTES} are sent to every worker")


def spread(docs: DataFrame) -> DataFrame:
    """`docs`, dealt out to all cores where it is a table of a few files and less than a split for each core.

    One row group is one task, however long its texts take; larger tables are read in splits as they are.
    """
    context = docs.sparkSession.sparkContext
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < context.defaultParallelism * SPREAD_BYTES and len(docs.inputFiles()) < context.defaultParallelism:
        return docs.repartition(context.defaultParallelism)
    return docs
