"""The corpus pipeline's stages, each against brute force, on documents with planted cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trawl.llm import mixing, token_output
from trawl.llm.bpe import encoder
from trawl.scratch import written

pick = random.Random(21)
WORDS = ["".join(pick.choice("aeioutnshrdlmp") for _ in range(pick.randint(3, 8))) for _ in range(1500)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return " ".join(pick.choice(WORDS) for _ in range(n)) + "."


def planted():
    """Rows by case: clean, exact and near copies, leaks, junk, odd rows."""
    clean = {i: prose(60) + "\n" + prose(40) for i in range(120)}
    items = {k: prose(30) for k in range(5)}
    rows = {"clean": list(clean.items())}
    rows["exact"] = [(1000 + i, clean[i]) for i in range(30)]
    rows["near"] = [(2000 + i, clean[i].replace(" ", " zzz ", 1)) for i in range(20, 50)]
    rows["leaks"] = [(3000 + k, prose(40) + "\n" + items[k].upper() + "\n" + prose(40)) for k in items]
    rows["junk"] = [(4000 + i, "Home\nAbout us\nContact\n" + "a | b | c | d\n" * 5 + "Menu") for i in range(10)]
    rows["cleaned"] = [(5000 + i, "Home\nLog in\n" + prose(50) + "\nx | y | z\n" + prose(50)) for i in range(10)]
    rows["odd"] = [(6000, None), (6001, ""), (6002, " \n "), (None, prose(70)), (6003, prose(20_000)), (6004, prose(80)), (6004, None)]
    return rows, items


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    rows, items = planted()
    path = str(tmp_path_factory.mktemp("pipeline"))
    full = [(i, t, "en", None if i == 6004 else f"s{(i or 0) % 3}" if (i or 0) % 2 else "hot", None if t is None else len(t)) for own in rows.values() for i, t in own]
    repeated = [x for x in full if x[0] == 6004 and x[1]]
    spark.createDataFrame(full + repeated, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*items.items(), (98, None), (None, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, path), "test")
        out.append(docs)
    return rows, items, path, dict(zip([n for n, _ in corpus_pipeline.STAGES], out))


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_keep_the_columns(spark, ran):
    *first, last = ran[3].values()
    assert all(df.schema.simpleString() == spark.read.parquet(f"{ran[2]}/documents.parquet").schema.simpleString() for df in first)
    assert last.columns[0] == "slot" and len(ran[3]) == 5


def test_quality_rules_drop_lines_and_junk(ran):
    rows, _, _, out = ran
    expected = Counter()
    for name, own in rows.items():
        for i, text in own:
            if text is None or not text.strip() or name == "junk":
                continue
            lines = [x.strip(" ") for x in text.split("\n")]
            expected[i, "\n".join(x for x in lines if len(x.split(" ")) >= 6 and "|" not in x)] += 2 if i == 6004 else 1
    assert texts(out["quality rules"]) == expected


def test_one_of_each_group_stays(ran):
    rows, _, _, out = ran
    before, after = texts(out["quality rules"]), texts(out["near-duplicates"])
    bag = lambda t: Counter(zip(*[(w := re.findall(r"[a-z0-9]+", t.lower())), w[1:]]))
    bags = {k: bag(k[1]) for k in before}
    root = {k: k for k in before}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    order = sorted(before, key=lambda k: (k[0] is not None, k[0] or 0))
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if sum((bags[a] & bags[b]).values()) >= 0.6 * sum((bags[a] | bags[b]).values()):
                root[find(b)] = find(a)
    assert set(after.values()) == {1} and set(after) == {find(k) for k in before}
    assert {i for i, _ in rows["exact"] + rows["near"]}.isdisjoint({i for i, _ in after})


def test_leaks_go_and_nothing_else(ran):
    rows, _, _, out = ran
    before, after = texts(out["near-duplicates"]), texts(out["decontamination"])
    assert before - after == Counter({k: 1 for k in before if k[0] in {i for i, _ in rows["leaks"]}}) and not after - before


def test_mixture_is_in_order_and_within_a_block(ran):
    out = ran[3]
    docs = out["decontamination"].collect()
    sizes = Counter(r.source for r in docs)
    target = {s: mixing.tempered(n) for s, n in sizes.items()}
    blocks = {s: -(-n // mixing.BLOCK_DOCS) for s, n in sizes.items()}
    slots = mixing.schedule({("" if s is None else "=" + s): w for s, w in target.items()}, {("" if s is None else "=" + s): n for s, n in blocks.items()})
    of = dict(sorted((slot, s) for s, own in slots.items() for slot in own))
    mixed = out["mixing"].withColumns({"f": F.input_file_name(), "n": F.monotonically_increasing_id()}).orderBy("f", "n").collect()
    assert {(r.doc_id, r.text) for r in mixed} == {(r.doc_id, r.text) for r in docs}
    # Walk the files: each slot's documents are those of one block of the source that the schedule names.
    at = 0
    for slot, s in of.items():
        source = s[1:] if s else None
        n = sizes[source]
        block = sum(1 for x in slots[s] if x < slot) % blocks[source]
        size = min(mixing.BLOCK_DOCS, n - block * mixing.BLOCK_DOCS)
        assert [r.source for r in mixed[at : at + size]] == [source] * size
        at += size
        for other, w in target.items():
            have = sum(1 for x in slots["" if other is None else "=" + other] if x <= slot)
            assert abs(have - (slot + 1) * w / sum(target.values())) < 1
    assert at == len(mixed)


def test_tokens_keep_the_order_of_the_mixture(spark, ran):
    own = encoder()
    mixed = ran[3]["mixing"].withColumns({"f": F.input_file_name(), "b": F.input_file_block_start(), "n": F.monotonically_increasing_id()}).orderBy("f", "b", "n").collect()
    n, expected = token_output.SEQUENCE_TOKENS, []
    for split in dict.fromkeys((r.f, r.b) for r in mixed):
        ids = [t for r in mixed if (r.f, r.b) == split for t in [*own.encoding.encode_ordinary(r.text), own.end_id]]
        expected += [ids[i : i + n] + [own.end_id] * max(0, i + n - len(ids)) for i in range(0, len(ids), n)]
    rows = sorted(ran[3]["token output"].collect(), key=lambda r: r.slot)
    slots = token_output.slots_of(np.arange(len(expected)), len(expected), 2024, token_output.SHARD_SEQUENCES)
    assert len(rows) == len(expected) and all(np.frombuffer(rows[s].tokens, "<u2").tolist() == e for s, e in zip(slots.tolist(), expected))


def test_documents_of_final_windows_follow_the_weights(spark):
    """Any number of whole windows of slots holds a source's documents to less than a block and a window's documents."""
    sizes = {"hot": 6000, "a": 800, "b": 400}
    ends = np.cumsum(list(sizes.values()))
    source = "CASE " + " ".join(f"WHEN id < {e} THEN '{s}'" for e, s in zip(ends, sizes)) + " END AS source"
    docs = spark.range(int(ends[-1]), numPartitions=4).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text", source)
    of = {r.doc_id: r.source for r in docs.collect()}
    mixed = written(mixing.mixed(docs), "mixture")
    rows = sorted(token_output.token_output(mixed, 64, 16, window=16).collect(), key=lambda r: r.slot)
    weights = {s: mixing.tempered(n) for s, n in sizes.items()}
    begun = [[d for d, start in zip(r.doc_ids, r.doc_starts)] for r in rows]
    most = max(sum(map(len, begun[i : i + 16])) for i in range(0, len(begun), 16))
    have, total = Counter(), 0
    for i in range(0, len(begun) - len(begun) % 16, 16):
        for ids in begun[i : i + 16]:
            have.update(of[d] for d in ids)
            total += len(ids)
        for s, w in weights.items():
            # Documents that go on in a second sequence count twice, and a source's last block may be short.
            assert abs(have[s] - total * w / sum(weights.values())) < 2 * mixing.BLOCK_DOCS + most + 0.05 * total


def test_run_is_the_stages_and_takes_empty_tables(spark, ran, tmp_path):
    path, out = ran[2], ran[3]
    assert Counter(r.tokens for r in corpus_pipeline.run(spark, path).collect()) == Counter(r.tokens for r in out["token output"].collect())
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_extra_columns_pass_through(spark, ran):
    docs = spark.read.parquet(f"{ran[2]}/documents.parquet").withColumns({k: F.lit(1) for k in ("key", "row", "node", "_key", "_rank", "_clean", "a.b")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, ran[2]).select(*[F.col(f"`{k}`") for k in docs.columns]), "extra")
        assert out.columns == docs.columns and out.count() > 0
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, ran[2]).count() > 0
