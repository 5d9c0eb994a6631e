"""Operator 2: mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of documents.  With target share w, its i-th block
is released at slot floor(i / w) and due by slot ceil((i + 1) / w); in every slot
the released block with the earliest deadline runs.  After any number of slots a
source is less than one block from its share.

Weights are whole numbers of any size and are not rounded: the schedule runs over
all slots, not over a period that repeats.  It ends when every block of every
source has run; a source that is below its share runs through its blocks again
(`epoch`), none is left out.  With `resolution`, shares are rounded to multiples of
1 / resolution first, and a source is less than one block from its rounded share.

A null source is a source of its own.  Repeated rows are documents of their own.
An empty table gives no slots.  Weights under 1 are refused, as a source without a
share has no slot; leave its documents out instead.  Weights count documents.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator, Mapping
from itertools import islice
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import BROADCAST_BYTES, c, row_key

BLOCK_DOCS = 64
#: Rows of a task that writes documents in training order.
TASK_DOCS = 50_000
SEED = 7
SCALE = 1_000_000


def tempered(n: int) -> int:
    """n ** 0.875 in millionths, in whole numbers so that any engine gets the same."""
    half = isqrt(n * SCALE**2)
    quarter = isqrt(half * SCALE)
    eighth = isqrt(quarter * SCALE)
    return half * quarter * eighth // SCALE**2


def shares(weights: Mapping[str, int], resolution: int) -> dict[str, int]:
    """Whole shares that sum to `resolution`, at least one each, by largest remainder."""
    spare, total = resolution - len(weights), sum(weights.values())
    if spare < 0:
        raise ValueError("more sources than the resolution can tell apart")
    out = {s: 1 + w * spare // total for s, w in weights.items()}
    by_remainder = sorted(weights, key=lambda s: (-(weights[s] * spare % total), s))
    for s in by_remainder[: resolution - sum(out.values())]:
        out[s] += 1
    return out


def slots_of(weights: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot without end, earliest deadline first; weights are whole and over 0."""
    total = sum(weights.values())
    due: list[tuple[int, str, int]] = []
    waiting = [(0, s, 0) for s in weights]
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(due, (-(-(i + 1) * total // weights[s]), s, i))
        _, s, i = heapq.heappop(due)
        yield s
        slot += 1
        heapq.heappush(waiting, ((i + 1) * total // weights[s], s, i + 1))


def period(share: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period, earliest deadline first."""
    out: dict[str, list[int]] = {s: [] for s in share}
    for slot, s in enumerate(islice(slots_of(share), sum(share.values()))):
        out[s].append(slot)
    return out


def schedule(weights: Mapping[str, int], blocks: Mapping[str, int]) -> dict[str, array]:
    """The slots of each source until every source has run all its blocks."""
    out = {s: array("q") for s in weights}
    left = len(weights)
    for slot, s in enumerate(slots_of(weights)):
        out[s].append(slot)
        left -= len(out[s]) == blocks[s]
        if not left:
            break
    return out


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), c(source)), F.lit(""))


def slim(docs: DataFrame, source: str, *more: Column) -> DataFrame:
    """doc_id, source and _key: the columns that the schedule works with, whatever others `docs` has."""
    return docs.select(c("doc_id").alias("doc_id"), c(source).alias("source"), row_key().alias("_key"), *more)


def ranked(docs: DataFrame, seed: int) -> DataFrame:
    """`docs` (slim) with _source and _rank, a seeded order inside each source.

    Ranks come from counts of 4096 hash ranges a source, so that a hot source is
    sorted in as many pieces.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = docs.withColumns({"_source": _source_key("source"), "_order": order, "_range": F.substring(order, 1, 3)})
    ranges = keyed.groupBy("_source", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_source").orderBy("_range")) - F.col("_n")
    inner = F.row_number().over(Window.partitionBy("_source", "_range").orderBy("_order", "doc_id", "_key"))
    return (
        keyed.join(ranges.select("_source", "_range", before.alias("_before")), ["_source", "_range"])
        .withColumn("_rank", F.col("_before") + inner - 1)
        .drop("_range", "_order", "_before")
    )


def plan(docs: DataFrame, source: str, block_docs: int, resolution: int | None, weights: Mapping[str | None, int] | None) -> tuple[DataFrame, int]:
    """One row a run of a block with its slot, and the number of slots."""
    spark = docs.sparkSession
    sizes = {r["s"]: r["n"] for r in docs.groupBy(_source_key(source).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "_source string, _block long, _epoch long, _slot long"), 0
    if weights is None:
        target = {s: tempered(n) for s, n in sizes.items()}
    else:
        target = {("" if s is None else "=" + s): w for s, w in weights.items()}
        if missing := sizes.keys() - target.keys():
            raise ValueError(f"no weight for {sorted(missing)}")
        target = {s: target[s] for s in sizes}
    if resolution is not None:
        target = shares(target, max(resolution, 4 * len(sizes)))
    elif least := sorted(s for s, w in target.items() if w < 1):
        raise ValueError(f"weights under 1 for {least}")
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    slots = schedule(target, blocks)
    names = list(slots)
    runs = [np.arange(len(slots[s])) for s in names]
    numbers = np.repeat(np.arange(len(names), dtype="i4"), [len(x) for x in runs])
    table = pa.table({
        "_source": pa.array(names, pa.string()).take(pa.array(numbers)),
        "_block": np.concatenate([x % blocks[s] for s, x in zip(names, runs)]),
        "_epoch": np.concatenate([x // blocks[s] for s, x in zip(names, runs)]),
        "_slot": np.concatenate([np.frombuffer(slots[s], "i8") for s in names]),
    })
    df = spark.createDataFrame(table)
    return (F.broadcast(df) if 2 * table.nbytes + 64 * len(table) <= BROADCAST_BYTES else df.hint("merge")), len(table)


def scheduled(docs: DataFrame, block_docs: int = BLOCK_DOCS, resolution: int | None = None, weights: Mapping[str | None, int] | None = None, seed: int = SEED) -> tuple[DataFrame, int]:
    """`docs` (slim), a row for each run of its block, with _slot, _block, _epoch and _at (place in the block)."""
    table, slots = plan(docs, "source", block_docs, resolution, weights)
    placed = ranked(docs, seed).withColumns({"_block": F.expr(f"_rank div {block_docs}"), "_at": F.expr(f"_rank % {block_docs}")})
    return placed.join(table, ["_source", "_block"]).drop("_rank"), slots


def mixing_order(docs: DataFrame, source: str = "source", **options) -> DataFrame:
    """The training order: slot, place in the slot, doc_id, source, block and epoch of every run."""
    runs, _ = scheduled(slim(docs, source), **options)
    return runs.select(F.col("_slot").alias("slot"), F.col("_at").alias("place"), "doc_id", "source", F.col("_block").alias("block"), F.col("_epoch").alias("epoch"))


def mixed(docs: DataFrame, source: str = "source", **options) -> DataFrame:
    """The documents in training order, as often as their blocks run; the columns of `docs`.

    Partition after partition, and so file after file where it is written, holds the order.
    """
    runs, slots = scheduled(slim(docs, source, F.struct(*[c(name) for name in docs.columns]).alias("_doc")), **options)
    spark = docs.sparkSession
    tasks = max(1, min(slots, max(int(spark.conf.get("spark.sql.shuffle.partitions")), slots * BLOCK_DOCS // TASK_DOCS)))
    laid = runs.repartitionById(tasks, F.expr(f"cast(_slot * {tasks} div {max(1, slots)} as int)")).sortWithinPartitions("_slot", "_at")
    return laid.select("_doc.*")


#: DuckDB: the default order, by recursion over the slots.
ORDER_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, source, coalesce('=' || source, '') AS s, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY o, doc_id) - 1 AS r FROM docs),
sizes AS (SELECT s, count(*) AS n, (count(*) + {BLOCK_DOCS - 1}) // {BLOCK_DOCS} AS blocks FROM docs GROUP BY s),
weights AS (SELECT s, blocks, w, sum(w) OVER () AS total FROM (
  SELECT s, blocks, ((h::HUGEINT * q::HUGEINT * e::HUGEINT) // {SCALE**2}::HUGEINT) AS w FROM (
    SELECT *, floor(sqrt(q * {SCALE}.0))::BIGINT AS e FROM (
      SELECT *, floor(sqrt(h * {SCALE}.0))::BIGINT AS q FROM (SELECT *, floor(sqrt(n * {SCALE**2}.0))::BIGINT AS h FROM sizes))))),
run(slot, s, blocks, w, total, i, hit, going) AS (
  SELECT -1::BIGINT, s, blocks, w::HUGEINT, total::HUGEINT, 0::HUGEINT, FALSE, TRUE FROM weights
  UNION ALL
  SELECT slot, s, blocks, w, total, ran, hit, NOT bool_and(ran >= blocks) OVER () FROM (
    SELECT *, i + hit::INT AS ran FROM (
      SELECT slot + 1 AS slot, s, blocks, w, total, i,
        row_number() OVER (ORDER BY i * total // w > slot + 1, ((i + 1) * total + w - 1) // w, s) = 1 AS hit FROM run WHERE going)))
SELECT slot, (r % {BLOCK_DOCS})::BIGINT AS place, doc_id, source, (r // {BLOCK_DOCS})::BIGINT AS block, ((i - 1) // blocks)::BIGINT AS epoch
FROM ranked JOIN run USING (s) WHERE hit AND (i - 1) % blocks = r // {BLOCK_DOCS}
"""
