import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trawl.llm import suffix_array as suffix_array_module
from trawl.llm.suffix_array import repeated_passages, suffix_array

WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array_is_the_sorted_order(text):
    assert suffix_array(np.array(text, dtype=np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, k):
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    first, whole, out, seen = {}, {}, set(), []
    for doc_id, text in rows:
        found = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text or "")]
        if len(found) < k:
            continue
        words = tuple(w for w, _, _ in found)
        if words in whole:
            seen.append((doc_id, whole[words], [(found[0][1], found[-1][2])]))
            continue
        whole[words] = doc_id
        spans = {}
        for i in range(len(words) - k + 1):
            at = first.setdefault(words[i : i + k], (doc_id, i))
            if at != (doc_id, i):
                spans.setdefault(at[0], []).append((found[i][1], found[i + k - 1][2]))
        seen += [(doc_id, f, s) for f, s in spans.items()]
    for doc_id, f, spans in seen:
        start, end = spans[0]
        for a, b in spans[1:]:
            if a > end:
                out.add((doc_id, f, start, end))
                start, end = a, b
            end = max(end, b)
        out.add((doc_id, f, start, end))
    return out


def test_repeats_are_those_of_brute_force(spark, monkeypatch):
    pick = random.Random(3)
    words = ["wörd", "Tea", "b", "C9", "longer", "x"] + [f"w{i}" for i in range(40)]
    prose = lambda n: "".join(pick.choice(words) + pick.choice([" ", ", ", "\n", ". é "]) for _ in range(n))
    passages = [prose(pick.randint(9, 30)) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [prose(pick.randint(0, 25)) for _ in range(pick.randint(0, 4))] + pick.sample(passages, pick.randint(0, 3))
        pick.shuffle(parts)
        rows.append((i, " ".join(parts)))
    rows += [(500 + i, rows[i][1]) for i in range(20)] + [(600, None), (601, ""), (602, "a " * 300), (None, passages[0]), (603, prose(20) * 5), (604, passages[1] + " " + passages[1])]
    rows += rows[:10]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS row", "2 AS key", "3 AS wanted")
    for hot in (suffix_array_module.HOT_TEXTS, 6, 1):
        monkeypatch.setattr(suffix_array_module, "HOT_TEXTS", hot)
        got = [tuple(r) for r in repeated_passages(df.repartition(5), 10).collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute(rows, 10)


def test_a_passage_in_half_of_all_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_array_module, "HOT_TEXTS", 50)
    pick = random.Random(9)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(16)
    rows = [(i, f"{prose(pick.randint(0, 12))} {passage} {prose(pick.randint(0, 12))}" if i % 2 else prose(30)) for i in range(400)]
    rows += [(i, "x y " * 15) for i in range(400, 480)] + [(480, passage + " " + passage)]
    got = {tuple(r) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 12).collect()}
    assert got == brute(rows, 12) and len(got) > 270


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_passages(df).collect() == []
