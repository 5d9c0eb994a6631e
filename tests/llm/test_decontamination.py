import random
import re

import pyarrow as pa

from trawl.llm import decontamination
from trawl.llm.decontamination import Q, Index, contaminated, decontaminated, fewest_edits

pick = random.Random(2)


def cut(n):
    text = ""
    while len(text) < n:
        text += "".join(pick.choice("abcdef") for _ in range(pick.randint(2, 7))) + " "
    return text[:n].strip().ljust(n, "z")


def edited(text, n):
    out = list(text)
    for _ in range(n):
        at = pick.randrange(len(out))
        out[at : at + pick.randint(0, 1)] = pick.choice(["x", "y", ""])
    return "".join(out)


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


def normal(text):
    return " ".join(re.findall(r"[0-9a-z]+", text.lower())).encode()


def brute(items, texts, share):
    found = {}
    for r, text in enumerate(texts):
        for k, item in items:
            x, y = normal(item), normal(text)
            if (e := edits(x, y)) <= int(len(x) * share):
                found[r, k] = e
    return found


def test_items_of_every_length_and_budget(monkeypatch):
    for share, postings in ((0.05, 4_000_000), (0.1, 50), (0.2, 4_000_000)):
        monkeypatch.setattr(decontamination, "POSTINGS", postings)
        items = list(enumerate(cut(m) for m in [*range(12, 41), 60, 90] * 2))
        texts = []
        for _ in range(120):
            parts = [cut(pick.randint(1, 40))]
            for _ in range(pick.randint(0, 2)):
                item = pick.choice(items)[1]
                parts += [edited(item, pick.randint(0, int(len(item) * share) + 1)), cut(pick.randint(1, 30))]
            texts.append(" ".join(parts))
        true = brute(items, texts, share)
        assert len(true) > 60 and {(r, k): e for r, k, e in Index(items, Q, share).rows(pa.array(texts))} == true


def test_one_edit_in_the_middle_of_a_short_item():
    for n in range(20, 25):
        item = cut(n)
        text = "before " + item[: n // 2] + "#" + item[n // 2 + 1 :] + " after"
        assert [(r, e) for r, _, e in Index([(1, item.replace(" ", "q"))], Q, 0.05).rows(pa.array([text.replace(" ", "q").replace("#", "w")]))] == [(0, 1)]


def test_the_band_holds_the_best_alignment():
    for _ in range(300):
        item, budget = cut(pick.randint(5, 60)).encode(), pick.randint(1, 6)
        region = (cut(pick.randint(1, 20)) + edited(item.decode(), pick.randint(0, budget + 1)) + cut(pick.randint(1, 20))).encode()
        assert fewest_edits(item, region, budget, -len(item), len(region)) == min(budget + 1, edits(item, region))


def test_very_many_items_and_rows():
    items = [(i, cut(30)) for i in range(60_000)]
    texts = ["short"] * 10_000
    texts[9990], texts[5] = f"xx {items[59_999][1]} yy", items[3][1]
    assert {(r, i) for r, i, _ in Index(items, Q, 0.05).rows(pa.array(texts))} >= {(5, 3), (9990, 59_999)}


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 5000)
    items = [(i, cut(50)) for i in range(40)] + [(98, None), (None, "x " * 30)]
    texts = [cut(20) + " " + items[i % 40][1] + " " + cut(20) for i in range(0, 80, 2)] + [cut(30) for _ in range(20)] + ["", None, "word " * 100_000 + items[7][1], "x " * 40]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontamination.indexes(benchmark, Q, 0.05))) > 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'e' AS edits", "1 AS `a.b`")
    expected = {(r, i % 40) for r, i in enumerate(range(0, 80, 2))} | {(62, 7), (63, None)}
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()} == expected
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(64)) - {r for r, _ in expected}
    empty = benchmark.where("false")
    assert contaminated(docs, empty).collect() == [] == contaminated(docs.where("false"), benchmark).collect() and decontaminated(docs, empty).count() == 64
