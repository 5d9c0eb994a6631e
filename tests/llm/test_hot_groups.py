"""One band, host, token or key that holds half of the rows."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from trawl.llm import near_dedup
from trawl.llm.hashing import SLICE_ROWS, Words, slices, utf8

WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
pick = random.Random(11)
VOCABULARY = ["".join(pick.choice("aeioutnshrdl") for _ in range(pick.randint(3, 8))) for _ in range(900)]


def prose(n):
    return [pick.choice(VOCABULARY) for _ in range(n)]


def changed(words, n):
    own = list(words)
    for _ in range(n):
        own[pick.randrange(len(own))] = pick.choice(VOCABULARY)
    return own


def bag(words):
    return Counter(zip(words, words[1:]))


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


# 5


def classes(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def rows_of_a_template():
    """Half are copies of one text with a few changes; a quarter share a template and differ in the rest."""
    base, template = prose(120), prose(70)
    rows = [changed(base, pick.randint(0, 6)) for _ in range(120)]
    own = [prose(pick.randint(18, 45)) for _ in range(12)]
    rows += [template + changed(pick.choice(own), pick.randint(0, 3)) for _ in range(60)]
    rows += [prose(90) for _ in range(60)]
    return rows


def test_hot_bands_lose_no_link(spark, monkeypatch):
    rows = rows_of_a_template()
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(4)
    bags = [bag(w) for w in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if similarity(bags[i], bags[j]) >= near_dedup.THRESHOLD]
    true = classes(links, range(len(rows)))
    assert max(Counter(true.values()).values()) == 120 and len(set(true.values())) > 64
    for sizes in ({}, {"PART": 16, "REST": 8, "LARGE": 20}):
        for name, value in sizes.items():
            monkeypatch.setattr(near_dedup, name, value)
        # Bands of one register: nearly every similar pair, and many that aren't, share one.
        got = {r.doc_id: r.dup_of for r in near_dedup.near_duplicates(df, bands=60, rows=1).collect()}
        assert {i: got.get(i, i) for i in range(len(rows))} == true
    got = {r.doc_id: r.dup_of for r in near_dedup.near_duplicates(df).collect()}
    assert sum(got.get(i, i) == got.get(j, j) for i, j in links) >= 0.9 * len(links) and all(true[i] == true[d] for i, d in got.items())


def test_rare_pairs_hold_every_similar_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LARGE", 20)
    rows = rows_of_a_template()
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "key long, text string")
    roots = [0 if i < 60 else 60 if i < 120 else i for i in range(len(rows))]
    nodes = spark.createDataFrame(list(enumerate(roots)), "key long, root long")
    got = {(r.a, r.b) for r in near_dedup.rare_pairs(nodes, texts, 0.6).collect()}
    bags = [bag(w) for w in rows]
    true = {(i, j) for j in range(len(rows)) for i in range(j) if roots[i] != roots[j] and similarity(bags[i], bags[j]) >= 0.6}
    assert len(true) > 3600 and true <= got and all(roots[i] != roots[j] for i, j in got) and len(got) < 1.5 * len(true)


def test_batches_of_very_many_short_texts(spark):
    texts = ["a b c"] * 70_000 + ["x y z", "x y z"]
    column = pa.array(texts)
    found = defaultdict(set)
    _, offsets = utf8(column)
    for a, b in slices(offsets):
        data, own = utf8(column.slice(a, b - a))
        for doc, element in zip(*[x.tolist() for x in near_dedup.multisets(Words(data, own))[:2]]):
            found[element].add(a + doc)
    assert SLICE_ROWS <= 65536 and sorted(map(len, found.values())) == [2, 2, 70_000, 70_000]


def test_rows_that_repeat(spark):
    rows = [(1, "one two three four")] * 2500 + [(2, "one two three four"), (3, "five six seven eight"), (None, "five six seven eight"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.dup_of) for r in near_dedup.near_duplicates(df).collect())
    assert got == {(1, 1): 2499, (2, 1): 1, (3, None): 1}
    assert Counter(r.doc_id for r in near_dedup.without_near_duplicates(df).collect()) == {1: 1, None: 1, 4: 1}
