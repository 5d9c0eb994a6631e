import random

import numpy as np
import pytest

from trawl.llm import lm

pick = random.Random(6)
WORDS = ["".join(pick.choice("aeiourstnlm") for _ in range(pick.randint(2, 7))) for _ in range(80)]


def prose(n):
    return " ".join(pick.choice(WORDS) for _ in range(n))


def test_a_token_that_holds_half_of_the_trigrams_is_split(spark, monkeypatch):
    rows = [(i, " ".join(w for x in prose(40).split() for w in ("the", x, "the"))) for i in range(60)] + [(99, "the unseen the"), (100, None), (101, ""), (None, "the"), (102, "the " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS tokens", "2 AS `a.b`").repartition(5)
    got, layouts = {}, []
    made = lm.layout_of
    monkeypatch.setattr(lm, "layout_of", lambda *a: layouts.append(made(*a)) or layouts[-1])
    for size, most in ((10**9, 1), (300, 20_000), (300, 64)):
        monkeypatch.setattr(lm, "TOKENS_A_PART", size)
        monkeypatch.setattr(lm, "MOST_PARTS", most)
        got[size, most] = {r.doc_id: (r.n_tokens, r.log_prob) for r in lm.lm_scores(df).collect()}
    assert [x.parts for x in layouts][0] == 1 and layouts[1].splits.max() > 20 and layouts[2].splits.max() > 5
    whole = got.pop((10**9, 1))
    assert len(whole) == len(rows) and whole[100] == whole[101] == (0, None)
    for other in got.values():
        assert other.keys() == whole.keys()
        for i, (n, p) in whole.items():
            assert other[i][0] == n and other[i][1] == (p if p is None else pytest.approx(p, rel=1e-5))
    assert lm.lm_scores(df.where("false")).collect() == []


def test_layouts_keep_the_order_of_keys():
    for counts in (np.zeros(65536, np.int64), np.random.default_rng(1).zipf(1.3, 65536) % 10**9, np.eye(1, 65536, 77, dtype=np.int64)[0] * 1000):
        for parts in (1, 7, 500):
            layout = lm.layout_of(counts, parts)
            keys = np.sort(np.random.default_rng(2).integers(0, 1 << 48, 50_000, dtype=np.uint64))
            part = layout.part_of(keys)
            assert (np.diff(part) >= 0).all() and part.min() >= 0 and part.max() < layout.parts <= 2 * parts + 1
