"""Operator 10: shards of equal bytes by histogram sort.

Candidate boundaries are probed in rounds: each round counts the exact bytes at
or below every probe over all partitions and narrows each splitter's interval,
until every splitter meets the tolerance.  Then the rows move once.  The probes of
a round that are too many to send at once are counted in groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm import common
from trawl.llm.common import c, check_broadcast
from trawl.scratch import written

SHARD_BYTES = 64_000_000
PROBES = 15
LOWEST = -(1 << 63)
U = np.uint64
SIGN = U(1 << 63)


def bytes_below(sizes: DataFrame, probes: np.ndarray) -> np.ndarray:
    """For each probe the bytes of the rows whose key is at most the probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(probes) + 1, dtype=np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column(0).to_numpy(), side="left")
            np.add.at(found, at, batch.column(1).to_numpy())
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["at", "bytes"])

    found = np.zeros(len(probes) + 1, dtype=np.int64)
    for row in sizes.mapInArrow(run, "at long, bytes long").groupBy("at").agg(F.sum("bytes").alias("bytes")).collect():
        found[row["at"]] = row["bytes"]
    return np.cumsum(found)[:-1]


def _keys(unsigned: np.ndarray) -> np.ndarray:
    return (unsigned ^ SIGN).view(np.int64)


def splitters(sizes: DataFrame, lowest: int, highest: int, total: int, shards: int, tolerance: float, probes: int = PROBES) -> np.ndarray:
    """Keys after which the shards end; with tolerance 0 the smallest that reach each share of the bytes."""
    goal = np.array([-(-i * total // shards) for i in range(1, shards)], dtype=np.int64)
    slack = tolerance * total / shards
    # Keys are worked with as unsigned numbers of the same order, so that no difference overflows.
    low = np.full(len(goal), lowest, dtype=np.int64).view(U) ^ SIGN
    high = np.full(len(goal), highest, dtype=np.int64).view(U) ^ SIGN
    part = np.arange(probes, dtype=U)
    while len(todo := np.flatnonzero(low < high)):
        gap = (high - low)[todo, None]
        step, rest = gap // U(probes + 1), gap % U(probes + 1)
        tried = np.unique(low[todo, None] + step * part + rest * part // U(probes + 1))
        group = max(1, common.BROADCAST_BYTES // 8)
        new_low, new_high = low[todo], high[todo]
        for a in range(0, len(tried), group):
            few = tried[a : a + group]
            below = bytes_below(sizes, _keys(few))
            k = np.searchsorted(below, goal[todo])
            reaches, falls = k < len(few), k > 0
            at, back = np.minimum(k, len(few) - 1), np.maximum(k - 1, 0)
            new_high = np.where(reaches, np.minimum(new_high, few[at]), new_high)
            new_low = np.where(falls, np.maximum(new_low, few[back] + U(1)), new_low)
            if slack:
                near = np.where(np.abs(below[at] - goal[todo]) <= np.abs(below[back] - goal[todo]), at, back)
                met = (np.abs(below[near] - goal[todo]) <= slack) & (new_low < new_high)
                new_low, new_high = np.where(met, few[near], new_low), np.where(met, few[near], new_high)
        low[todo], high[todo] = new_low, np.maximum(new_high, new_low)
    return _keys(high)


def sharded(docs: DataFrame, key: str = "doc_id", shard_bytes: int = SHARD_BYTES, tolerance: float = 0.0) -> DataFrame:
    """All rows and columns with their `shard`, sorted by key inside each; the bytes are those of `text`.

    Rows of one key stay in one shard, however many they are: a shard is a range of
    keys.  A null key sorts first; a null text has no bytes.  Repeated rows stay.  A
    column called `shard` in the input is replaced.  An empty table gives no rows.
    The key is a whole number.
    """
    sizes = written(
        docs.select(F.coalesce(c(key).cast("long"), F.lit(LOWEST)).alias("key"), F.coalesce(F.octet_length(c("text")), F.lit(0)).cast("long").alias("bytes")),
        "sizes",
    )
    lowest, highest, total = sizes.agg(F.min("key"), F.max("key"), F.sum("bytes")).first()
    shards = max(1, -(-(total or 0) // shard_bytes))
    ends = splitters(sizes, lowest, highest, total, shards, tolerance) if shards > 1 else np.zeros(0, np.int64)
    check_broadcast(ends.nbytes, "the table of splitters")

    @F.pandas_udf("long")
    def shard_of(value: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, value.to_numpy(), side="left"))

    return (
        docs.select(*[c(name) for name in docs.columns if name.lower() != "shard"], shard_of(F.coalesce(c(key).cast("long"), F.lit(LOWEST))).alias("shard"))
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions(c(key))
    )
