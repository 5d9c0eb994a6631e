import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import common, sharding

pick = random.Random(8)
SETS = {
    "spread": [(pick.randrange(-(1 << 63), 1 << 63), pick.randint(0, 400)) for _ in range(500)],
    "dense": [(k, pick.randint(0, 50)) for k in range(-200, 300)],
    "hot": [(7 if i % 2 else pick.randrange(10**6), pick.randint(1, 9)) for i in range(500)],
    "ends": [(-(1 << 63), 50), ((1 << 63) - 1, 50), (0, 10), (5, 10)],
}


def table(spark, rows):
    return spark.createDataFrame(rows, "key long, bytes long").repartition(3)


@pytest.mark.parametrize("name", SETS)
def test_splitters_are_the_smallest_keys_that_reach_each_share(spark, monkeypatch, name):
    rows = sorted(SETS[name])
    total = sum(b for _, b in rows)
    keys, below = [k for k, _ in rows], np.cumsum([b for _, b in rows])
    df = table(spark, rows)
    for shards, limit in ((9, 64_000_000), (4, 8 * 20)):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        got = sharding.splitters(df, keys[0], keys[-1], total, shards, 0.0).tolist()
        assert got == [keys[int(np.searchsorted(below, -(-i * total // shards)))] for i in range(1, shards)]


@pytest.mark.parametrize("limit", [64_000_000, 8 * 20])
def test_tolerance_saves_rounds_and_is_met(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rows, rounds = SETS["dense"] * 4, []
    total = sum(b for _, b in rows)
    counted = sharding.bytes_below
    monkeypatch.setattr(sharding, "bytes_below", lambda *a: rounds.append(1) or counted(*a))
    ends = {}
    for tolerance in (0.0, 0.1):
        rounds.clear()
        ends[tolerance] = (sharding.splitters(table(spark, rows), -200, 299, total, 8, tolerance), len(rounds))
    for i, end in enumerate(ends[0.1][0].tolist(), 1):
        assert abs(sum(b for k, b in rows if k <= end) - i * total / 8) <= 0.1 * total / 8 + 1
    assert ends[0.1][1] <= ends[0.0][1]


def test_hot_keys_nulls_and_clashing_columns(spark):
    rows = [(1, "x" * 10)] * 300 + [(None, "n"), (2, None), (3, ""), (4, "y" * 5000)] + [(i, "z" * 9) for i in range(5, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"Shard": F.lit("old"), "key": F.lit(1), "a.b": F.lit(2)})
    got = sharding.sharded(df, shard_bytes=1000).collect()
    assert len(got) == len(rows) and len({r.shard for r in got if r.doc_id == 1}) == 1 and set(got[0].asDict()) == {"doc_id", "text", "key", "a.b", "shard"}
    assert {r.shard for r in got if r.doc_id is None} == {0}
    assert sharding.sharded(df.where("false")).collect() == []
