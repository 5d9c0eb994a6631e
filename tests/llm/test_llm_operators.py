import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import decontamination, lines, lm, mixing, near_dedup, quality, sharding, token_output
from trawl.llm.bpe import encoder
from trawl.llm.hashing import Words, utf8

WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
pick = random.Random(5)
VOCABULARY = ["".join(pick.choice("aeiourstnlmé") for _ in range(pick.randint(2, 9))) for _ in range(700)]


def prose(n):
    return " ".join(pick.choice(VOCABULARY) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


ODD = [(None, "a null id", None), (900, None, "s"), (901, "", "s"), (902, "x " * 20_000, "s"), (903, "\n \t", None), (904, "same row", "s"), (904, "same row", "s")]
APPLIED = {
    "tokens": token_output.token_output,
    "mixed": mixing.mixed,
    "near": near_dedup.without_near_duplicates,
    "quality": quality.quality_rules,
    "sharded": sharding.sharded,
    "scores": lm.lm_scores,
    "leaks": lambda d: decontamination.decontaminated(d, d.sparkSession.createDataFrame([(1, None), (2, ""), (None, "same row")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", APPLIED)
def test_odd_rows_and_empty_tables(spark, name):
    df = table(spark, ODD).withColumns({k: F.lit(1) for k in ("key", "row", "seq", "part", "shard", "node", "_rank", "a.b")})
    out = APPLIED[name](df)
    rows = out.collect()
    n = len(rows)
    if name == "tokens":
        assert {i for r in rows for i in r.doc_ids} == {None, 902, 903, 904} and sum(r.n_tokens for r in rows) == sum(len(encoder().encoding.encode_ordinary(t)) + 1 for _, t, _ in ODD if t)
    if name == "mixed":
        # Sources of one block run as often as their share asks for.
        assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in df.collect()} and n >= 7
    assert n == {"near": 6, "quality": 0, "sharded": 7, "scores": 7, "leaks": 5}.get(name, n)
    assert APPLIED[name](df.where("false")).collect() == []


# 1


def test_slots_are_a_permutation_and_tokens_come_back(spark):
    for size in (1, 2, 3, 100, 1000):
        assert sorted(token_output.feistel(np.arange(size), size, 7).tolist()) == list(range(size))
    rows = [(i, prose(pick.randint(0, 90)), "s") for i in range(60)]
    out = token_output.token_output(table(spark, rows).repartition(3), 64, 8)
    found = out.collect()
    assert sorted(r.slot for r in found) == list(range(len(found))) and all(r.shard == r.slot // 8 for r in found)
    assert all(len(r.tokens) == 128 for r in found)
    expected = Counter(t for _, text, _ in rows if text for t in [*encoder().encoding.encode_ordinary(text), encoder().end_id])
    assert Counter(t for r in found for t in np.frombuffer(r.tokens, "<u2")[: r.n_tokens].tolist()) == expected
    assert all(r.file == f"shard-{r.shard:08d}.bin" for r in found)


# 2


def test_sources_stay_within_a_block_of_their_share():
    share = mixing.shares({"a": 70, "b": 20, "c": 9, "d": 1}, 1000)
    slots = mixing.period(share)
    for s, own in slots.items():
        have = np.searchsorted(own, np.arange(1001))
        assert np.abs(have - np.arange(1001) * share[s] / 1000).max() < 1


def test_mixing_leaves_nothing_out(spark):
    rows = [(i, f"t{i}", "hot" if i % 5 else "cold") for i in range(300)] + [(500, "n", None)]
    order = mixing.mixing_order(table(spark, rows), block_docs=8, resolution=40).collect()
    assert {r.doc_id for r in order} == {i for i, _, _ in rows}
    slots = Counter(r.slot for r in order)
    assert len({(r.slot, r.place) for r in order}) == len(order) and set(slots) == set(range(max(slots) + 1))


# 4


def test_lines_of_a_site(spark):
    rows = [(i, f"http://h.org/{i}", f"menu\nown line {i}\nfoot") for i in range(9)] + [(20, "http://other.org/", "menu"), (21, None, "menu\nmenu"), (22, "http://h.org/x", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, t string")
    got = {r.page_id: r for r in lines.line_dedup(df, lines.host_of(F.col("url")), F.col("t")).collect()}
    assert [got[i].text for i in range(9)] == [f"own line {i}" for i in range(9)]
    assert (got[20].text, got[21].text, got[22].text) == ("menu", "menu\nmenu", "") and got[0].n_dropped == 2


# 5


def bag(text):
    words = [w.lower() for w in WORD.findall(text)]
    return Counter(zip(words, words[1:])) if len(words) > 1 else Counter(words)


def test_registers_agree_as_often_as_the_weighted_jaccard():
    a = prose(300) + " tick tock" * 60
    b = " ".join(w for k, w in enumerate(a.split()) if k % 9)
    x, y = bag(a), bag(b)
    true = sum((x & y).values()) / sum((x | y).values())
    import pyarrow as pa

    words = Words(*utf8(pa.array([a, b])))
    s = near_dedup.bag_minhash(*near_dedup.multisets(words), 2, 4000)
    assert abs((s[0] == s[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / 4000)


def test_near_duplicates_against_all_pairs(spark):
    rows = []
    for g in range(40):
        base = prose(80).split()
        rows.append((g * 10, " ".join(base), "s"))
        for k in range(1, pick.randint(1, 5)):
            own = list(base)
            for _ in range(pick.randint(0, 6)):
                own[pick.randrange(len(own))] = pick.choice(VOCABULARY)
            rows.append((g * 10 + k, " ".join(own), "s"))
    bags = {i: bag(t) for i, t, _ in rows}
    true = {(i, j) for i in bags for j in bags if i < j and sum((bags[i] & bags[j]).values()) >= near_dedup.THRESHOLD * sum((bags[i] | bags[j]).values())}
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    root = {r.doc_id: r.dup_of for r in got}
    same = {(i, j) for i, j in true if root.get(i, i) == root.get(j, j)}
    assert len(same) >= 0.9 * len(true) > 30
    assert all(r.dup_of // 10 == r.doc_id // 10 and r.dup_of < r.doc_id for r in got)
    kept = {r.doc_id for r in near_dedup.without_near_duplicates(table(spark, rows)).collect()}
    assert kept == {i for i, _, _ in rows} - root.keys()


# 6


def test_lines_go_first_and_then_documents(spark):
    good = "This is a sentence that has enough words to stay."
    rows = [(1, f"Home\n{good}\na | b | c\n{good}", "s"), (2, "Home\nAbout\nContact\n" + good[:9], "s"), (3, good + "\nAll rights reserved by somebody or other, whoever it may be.", "s")]
    got = {r.doc_id: r.text for r in quality.quality_rules(table(spark, rows)).collect()}
    assert got[1] == f"{good}\n{good}" and 2 not in got


# 7


def edits(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for ch in text:
        new = [0]
        for k, x in enumerate(item, 1):
            new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (x != ch)))
        row = new
        best = min(best, row[-1])
    return best


def test_leaks_against_brute_force(spark):
    normal = lambda t: " ".join(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))).encode()
    items = [(i, prose(pick.randint(12, 25))) for i in range(8)] + [(98, "ab c"), (99, None)]
    rows = []
    for i in range(40):
        text = prose(40)
        if i % 2:
            item = list(items[pick.randrange(8)][1])
            for _ in range(pick.randint(0, 8)):
                item[pick.randrange(len(item))] = pick.choice("xyz")
            text += ". " + re.sub("[a-z]", lambda m: m.group().upper(), "".join(item)) + "! " + prose(20)
        rows.append((i, text, "s"))
    rows.append((77, prose(9) + " AB, c " + prose(3), "s"))
    true = {}
    for item_id, item in items:
        for i, text, _ in rows:
            if item is None:
                continue
            x, y = normal(item), normal(text)
            e = (0 if x in y else 99) if len(x) < decontamination.Q else edits(x, y)
            if e <= int(len(x) * decontamination.EDIT_SHARE):
                true[i, item_id] = e
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(table(spark, rows), benchmark).collect()}
    assert len(true) > 5 and found == true
    assert {r.doc_id for r in decontamination.decontaminated(table(spark, rows), benchmark).collect()} == {i for i, _, _ in rows} - {i for i, _ in true}


# 9


def test_kneser_ney_against_brute_force(spark):
    rows = [(i, prose(pick.randint(3, 30)), "s") for i in range(60)]
    encode = encoder().encoding.encode_ordinary
    grams = {i: [tuple(x) for t in [[lm.START, lm.START, *encode(text), lm.END]] for x in zip(t, t[1:], t[2:])] for i, text, _ in rows}
    c3 = Counter(g for x in grams.values() for g in x)
    c2 = Counter()
    for (a, b, w), n in c3.items():
        c2[b, w] += n if b == lm.START else 1
    c1 = Counter(w for _, w in c2)

    def discounts(counts):
        n = [sum(v == k for v in counts.values()) for k in range(1, 5)]
        if not all(n):
            return [0, 0.5, 1, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *[min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)]]

    d1, d2, d3 = discounts(c1), discounts(c2), discounts(c3)
    size = encoder().end_id + 1
    total = sum(c1.values())
    p1 = lambda w: (c1[w] - d1[min(c1[w], 3)]) / total + sum(d1[min(v, 3)] for v in c1.values()) / total / size

    def level(counts, d, context, w, lower):
        own = {k: v for k, v in counts.items() if k[:-1] == context}
        n = sum(own.values())
        v = own.get((*context, w), 0)
        return (v - d[min(v, 3)]) / n + sum(d[min(x, 3)] for x in own.values()) / n * lower

    got = {r.doc_id: r for r in lm.lm_scores(table(spark, rows)).collect()}
    for i in (0, 7, 30):
        expected = sum(math.log(level(c3, d3, (a, b), w, level(c2, d2, (b,), w, p1(w)))) for a, b, w in grams[i])
        assert got[i].log_prob == pytest.approx(expected, rel=1e-5) and got[i].n_tokens == len(grams[i])
        assert got[i].perplexity == pytest.approx(math.exp(-expected / len(grams[i])), rel=1e-4)


# 10


def test_shards_hold_equal_bytes(spark):
    rows = [(pick.randrange(10**9), "x" * pick.randint(0, 400), "s") for _ in range(800)]
    got = sharding.sharded(table(spark, rows), shard_bytes=10_000).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert len(got) == 800 and set(by) == set(range(len(by)))
    sizes = [sum(len(r.text) for r in by[s]) for s in sorted(by)]
    assert max(sizes) - min(sizes) <= 800
    assert all(max(r.doc_id for r in by[s]) < min(r.doc_id for r in by[s + 1]) for s in range(len(by) - 1))
