import math
from collections import Counter

import numpy as np

from trawl.llm import mixing


def expected(weights, blocks):
    """Pfair by the definition: of all released blocks, the one due first."""
    total, done, slot = sum(weights.values()), Counter(), 0
    out = {s: [] for s in weights}
    while any(done[s] < n for s, n in blocks.items()):
        free = [(-(-(done[s] + 1) * total // w), s) for s, w in weights.items() if done[s] * total // w <= slot]
        s = min(free)[1]
        out[s].append(slot)
        done[s] += 1
        slot += 1
    return out


def test_long_schedules_stay_within_a_block_of_the_target_weights(spark):
    sizes = {"hot": 60_000, **{f"s{i}": 2_000 for i in range(20)}}
    ends, names = np.cumsum(list(sizes.values())), list(sizes)
    source = "CASE " + " ".join(f"WHEN id < {e} THEN '{n}'" for e, n in zip(ends, names)) + " END AS source"
    docs = spark.range(sum(sizes.values()), numPartitions=4).selectExpr("id AS doc_id", "'t' AS text", source)
    rows = mixing.mixing_order(docs).groupBy("slot", "source", "block", "epoch").count().collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    weights = {s: mixing.tempered(n) for s, n in sizes.items()}
    for s, w in weights.items():
        own = sorted((r.slot, r.epoch, r.block) for r in rows if r.source == s)
        n_blocks = math.ceil(sizes[s] / mixing.BLOCK_DOCS)
        assert [(e, b) for _, e, b in own] == [divmod(i, n_blocks) for i in range(len(own))] and len(own) >= n_blocks
        have = np.searchsorted([x for x, _, _ in own], np.arange(len(rows) + 1))
        assert np.abs(have - np.arange(len(rows) + 1) * (w / sum(weights.values()))).max() < 1


def test_schedule_is_earliest_deadline_first():
    for weights, blocks in (({"a": 5, "b": 3, "c": 1}, {"a": 40, "b": 1, "c": 7}), ({f"s{i}": 10**12 + 7**i for i in range(9)}, {f"s{i}": 30 + i for i in range(9)})):
        assert {s: list(x) for s, x in mixing.schedule(weights, blocks).items()} == expected(weights, blocks)
