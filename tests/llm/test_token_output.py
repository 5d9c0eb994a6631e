import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trawl.llm import token_output
from trawl.llm.bpe import encoder

pick = random.Random(3)
WORDS = ["".join(pick.choice("aeiourstnlm") for _ in range(pick.randint(2, 9))) for _ in range(200)]


def prose(n):
    return " ".join(pick.choice(WORDS) for _ in range(n))


def sequences(splits, n):
    """The sequences of brute force: tokens, doc ids and starts, split by split."""
    own, out = encoder(), []
    for rows in splits:
        held = [(t, doc_id, k == 0) for doc_id, text in rows if text for k, t in enumerate([*own.encoding.encode_ordinary(text), own.end_id])]
        for at in range(0, len(held), n):
            few = held[at : at + n]
            ids, starts = [], []
            for k, (_, doc_id, first) in enumerate(few):
                if k == 0 or first:
                    ids.append(doc_id)
                    starts.append(k)
            out.append((len(few), ids, starts, [t for t, _, _ in few] + [own.end_id] * (n - len(few))))
    return out


def test_every_sequence_of_files_by_brute_force(spark, tmp_path):
    # Files of which the tenth comes after the ninth, with all odd rows.
    files = [[(pick.randrange(10**6), prose(pick.randint(0, 60))) for _ in range(12)] for _ in range(11)]
    files[3] += [(None, "a null id"), (1, None), (2, ""), (3, "x " * 3000), (4, "same"), (4, "same")]
    for i, rows in enumerate(files):
        ids, texts = zip(*rows)
        pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "seq": ["s"] * len(rows), "part": [1] * len(rows)}), f"{tmp_path}/part-{i}-x.parquet")
    df = spark.read.parquet(str(tmp_path))
    expected = sequences(files, 32)
    for name, window in (("whole", None), ("windows", 16)):
        out = token_output.token_output(df, 32, 8, window=window, folder=f"{tmp_path}/{name}_")
        rows = sorted(out.collect(), key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(expected)))
        slots = token_output.slots_of(np.arange(len(expected)), len(expected), 2024, window)
        assert sorted(slots.tolist()) == list(range(len(expected)))
        for n, slot in enumerate(slots.tolist()):
            r = rows[slot]
            assert (r.n_tokens, r.doc_ids, r.doc_starts, np.frombuffer(r.tokens, "<u2").tolist()) == expected[n]
            assert r.shard == slot // 8 and r.file == f"shard-{r.shard:08d}.bin"
        if window:
            assert all(slot // window == n // window for n, slot in enumerate(slots.tolist()))
        assert sorted(os.listdir(f"{tmp_path}/{name}_")) == sorted({r.file for r in rows})
        assert [x.tobytes() for x in token_output.read_slots(f"{tmp_path}/{name}_", 3, 20, 32, 8)] == [r.tokens for r in rows[3:23]]
        assert [x.tobytes() for x in token_output.read_slots(f"file://{tmp_path}/{name}_", len(rows) - 2, 2, 32, 8)] == [r.tokens for r in rows[-2:]]


def test_the_order_is_the_same_however_the_files_are_read(spark, tmp_path):
    df = spark.range(300, numPartitions=6).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    df.write.parquet(f"{tmp_path}/d")
    found = []
    for open_cost, tasks in (("4194304", "4"), ("67108864", "2")):
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            found.append(sorted((r.slot, r.doc_ids) for r in token_output.token_output(spark.read.parquet(f"{tmp_path}/d"), 64, 4).collect()))
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] and len(found[0]) > 10


@pytest.mark.parametrize("size", [1, 2, 3, 63, 64, 65, 1000])
def test_windows_are_permuted_each_in_its_way(size):
    slots = token_output.slots_of(np.arange(size), size, 7, 32)
    assert sorted(slots.tolist()) == list(range(size)) and (slots // 32 == np.arange(size) // 32).all()
    if size == 1000:
        assert len({tuple((slots[i : i + 32] % 32).tolist()) for i in range(0, 992, 32)}) == 31


def test_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_output.token_output(df, folder=str(tmp_path)).collect() == [] and not os.listdir(tmp_path)
