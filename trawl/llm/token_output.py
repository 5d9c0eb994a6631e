"""Operator 1: training-order materialisation of token sequences.

Texts are tokenized, joined with an end id and cut into sequences of fixed
length.  A keyed Feistel network, walked until it falls inside the range,
permutes the sequence numbers: every sequence gets one global slot, computable
from its number alone.  Range partitions of the slots write one shard file a
stride, in which every sequence takes the same room, so that a reader finds any
slot by arithmetic and resumes anywhere.

Sequences are numbered by the files of the input, in the order of their names, and
the places in them, not by the tasks that read them: the order depends on the files
and the split size alone.  With `window`, slots are permuted inside windows of as
many sequences, so that the order of the input is kept from window to window.

Null and empty texts give no tokens.  The last sequence of each split of the
input is padded with the end id; `n_tokens` counts what is not padding.  Repeated
rows are tokenized each, other columns are ignored, an empty table gives no rows
and no shard.  `doc_id` is a whole number or null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.bpe import DEFAULT_VOCABULARY, encoder
from trawl.llm.common import c, check_broadcast
from trawl.llm.hashing import U, mix
from trawl.scratch import new_path, written

SEQUENCE_TOKENS = 2048
SHARD_SEQUENCES = 4096
ROUNDS = 6
#: Bytes of tokens that one task writes, where there are as many.
TASK_BYTES = 256_000_000
PACKED = "part long, file string, block long, seq long, n_tokens int, doc_ids array<long>, doc_starts array<int>, tokens binary"
KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
NAMES = ("part", "file", "block", "seq", "n_tokens", "doc_ids", "doc_starts", "tokens")
SLOTS = "slot long, shard long, file string, n_tokens int, doc_ids array<long>, doc_starts array<int>, tokens binary"


def feistel(index: np.ndarray, size: int, key: int, tweak: np.ndarray | None = None) -> np.ndarray:
    """A keyed permutation of range(size), evaluated at `index`; another one for each tweak."""
    if size <= 1:
        return np.zeros(len(index), dtype=np.int64)
    half = U(max(1, (int(size - 1).bit_length() + 1) // 2))
    mask = (U(1) << half) - U(1)
    keys = mix(np.arange(ROUNDS, dtype=U) + U(key % (1 << 63)))
    own = np.zeros(len(index), dtype=U) if tweak is None else mix(tweak.astype(U) + U(1))
    out = index.astype(U)
    todo = np.arange(len(out))
    while len(todo):
        left, right, salt = out[todo] >> half, out[todo] & mask, own[todo]
        for k in keys:
            left, right = right, left ^ (mix(right ^ k ^ salt) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= U(size)]
    return out.astype(np.int64)


def slots_of(index: np.ndarray, total: int, key: int, window: int | None = None) -> np.ndarray:
    """The slot of each sequence number."""
    if window is None:
        return feistel(index, total, key)
    nth, out = index // window, np.empty(len(index), dtype=np.int64)
    whole = (nth + 1) * window <= total
    for these, size in ((whole, window), (~whole, total % window)):
        out[these] = nth[these] * window + feistel(index[these] % window, size, key, nth[these])
    return out


def packed(docs: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Sequences numbered within each split of the input's files, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        width, end = own.width, own.end_id.to_bytes(own.width, "little")
        size, seq = sequence_tokens * own.width, 0
        held, ids, starts, rows = bytearray(), [], [], []
        current: tuple = ()

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), KINDS)], NAMES)

        def close() -> None:
            nonlocal held, ids, starts, seq
            if held:
                n = len(held) // width
                rows.append((*current, seq, n, ids, starts, bytes(held) + end * (sequence_tokens - n)))
            held, ids, starts, seq = bytearray(), [], [], 0

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                few = batch.slice(at, 128)
                few = few.filter(pc.greater(pc.binary_length(few.column(1)), 0))
                places = zip(*[few.column(k).to_pylist() for k in (2, 3, 4)])
                for place, doc_id, tokens in zip(places, few.column(0).to_pylist(), own.encode_all(few.column(1).to_pylist())):
                    if place != current:
                        close()
                        current = place
                    ids.append(doc_id)
                    starts.append(len(held) // width)
                    held += tokens
                    held += end
                    used = 0
                    while len(held) - used >= size:
                        rows.append((*current, seq, sequence_tokens, ids, starts, bytes(held[used : used + size])))
                        seq += 1
                        used += size
                        ids, starts = ([doc_id], [0]) if len(held) > used else ([], [])
                    del held[:used]
                while len(rows) >= 256:
                    yield batch_of(rows[:256])
                    rows = rows[256:]
        close()
        if rows:
            yield batch_of(rows)

    file, block = F.input_file_name(), F.input_file_block_start()
    # Rows of no file are numbered by the task that has them.
    part = F.when(file == "", F.spark_partition_id().cast("long")).otherwise(F.xxhash64(file, block))
    name = F.when(file == "", "").otherwise(F.substring_index(file, "/", -1))
    place = F.when(file == "", F.spark_partition_id().cast("long")).otherwise(block)
    return docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").alias("text"), part.alias("part"), name.alias("file"), place.alias("block")).mapInArrow(run, PACKED)


def _natural(name: str) -> list:
    """A key by which file 10 comes after file 9."""
    return [int(x) if k % 2 else x for k, x in enumerate(re.split(r"(\d+)", name))]


def token_output(
    docs: DataFrame,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_sequences: int = SHARD_SEQUENCES,
    key: int = 2024,
    vocabulary: str = DEFAULT_VOCABULARY,
    window: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """One row per slot: slot, shard, file, n_tokens, doc_ids, doc_starts, tokens.

    Rows are range-partitioned by shard and sorted.  As they come out, their shards are
    written to `folder`, a new one in the shared folder by default; `file` is a shard's name in it.
    """
    spark = docs.sparkSession
    # The table is as large as all tokens and read once: it is worth packing well.
    table = written(packed(docs, sequence_tokens, vocabulary), "packed", compression="zstd", **{"parquet.compression.codec.zstd.level": "6", "parquet.page.size": "8388608"})
    counted = table.groupBy("part").agg(F.first("file").alias("file"), F.first("block").alias("block"), F.count(F.lit(1)).alias("n")).collect()
    counted.sort(key=lambda r: (_natural(r.file), r.block, r.part))
    parts = np.array([r.part for r in counted], dtype=np.int64)
    sizes = np.array([r.n for r in counted], dtype=np.int64)
    order = np.argsort(parts)
    parts, before = parts[order], (np.cumsum(sizes) - sizes)[order]
    check_broadcast(parts.nbytes * 2, "the table of sequence numbers")
    total = int(sizes.sum())

    @F.arrow_udf("long")
    def slot(part: pa.Array, seq: pa.Array) -> pa.Array:
        return pa.array(slots_of(before[np.searchsorted(parts, part.to_numpy())] + seq.to_numpy(), total, key, window))

    @F.arrow_udf("binary")
    def small(tokens: pa.Array) -> pa.Array:
        return pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in tokens.to_pylist()], pa.binary())

    sequence_bytes = sequence_tokens * encoder(vocabulary).width
    shards = max(1, -(-total // shard_sequences))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, total * sequence_bytes // TASK_BYTES)
    tasks = max(1, min(shards, tasks))
    laid = (
        table.withColumn("slot", slot("part", "seq"))
        .withColumn("shard", F.expr(f"slot div {shard_sequences}"))
        .select("slot", "shard", "n_tokens", "doc_ids", "doc_starts", small("tokens").alias("tokens"))
        .repartitionById(tasks, F.expr(f"cast(shard * {tasks} div {shards} as int)"))
        .sortWithinPartitions("slot")
    )
    return _stored(laid, folder or new_path(spark, "shards"), sequence_bytes)


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _stored(sequences: DataFrame, folder: str, sequence_bytes: int) -> DataFrame:
    """The sequences with their file, each shard written as its rows pass.

    A file appears under its name only when whole, so a task that runs twice leaves one good file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        tail = f".part-{TaskContext.get().taskAttemptId()}"
        out, current = None, None

        def close() -> None:
            out.close()
            name = f"{root}/{_shard_name(current)}"
            if store.type_name != "local" and store.get_file_info(name).type.name != "NotFound":
                store.delete_file(name + tail)
            else:
                store.move(name + tail, name)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                few = batch.slice(at, 1024)
                shards = few.column(1).to_pylist()
                tokens = [pa.decompress(x, decompressed_size=sequence_bytes, codec="zstd", asbytes=True) for x in few.column(5).to_pylist()]
                begin = 0
                for shard, own in groupby(shards):
                    if shard != current:
                        if out is not None:
                            close()
                        current = shard
                        out = store.open_output_stream(f"{root}/{_shard_name(shard)}{tail}")
                    n = len(list(own))
                    out.write(b"".join(tokens[begin : begin + n]))
                    begin += n
                names = pa.array([_shard_name(shard) for shard in shards])
                yield pa.RecordBatch.from_arrays([few.column(0), few.column(1), names, few.column(2), few.column(3), few.column(4), pa.array(tokens, pa.binary())], ["slot", "shard", "file", "n_tokens", "doc_ids", "doc_starts", "tokens"])
        if out is not None:
            close()

    return sequences.mapInArrow(run, SLOTS)


def read_slots(folder: str, first: int, n: int, sequence_tokens: int = SEQUENCE_TOKENS, shard_sequences: int = SHARD_SEQUENCES, width: int = 2) -> Iterator[np.ndarray]:
    """The sequences of slots first .. first + n - 1, by seeking in the shard files."""
    size = sequence_tokens * width
    store, root = _store(folder)
    for shard, slots in groupby(range(first, first + n), lambda slot: slot // shard_sequences):
        with store.open_input_file(f"{root}/{_shard_name(shard)}") as handle:
            for slot in slots:
                handle.seek(slot % shard_sequences * size)
                yield np.frombuffer(handle.read(size), dtype=np.uint16 if width == 2 else np.uint32)
