"""Operator 9: an interpolated modified Kneser-Ney model of token trigrams.

Spark counts the trigrams of all documents once.  They are partitioned by their
middle token, so a partition has all it needs for contexts (w1 w2), continuations
(. w2 w3) and the lower order.  A middle token of more trigrams than a partition
should hold is split by the token before it: contexts stay whole, and the counts of
its continuations, no more than the vocabulary, are added in a second small
exchange.  The number of partitions follows the number of tokens.  A partition's
trigrams are one sorted array of 48-bit keys with their log-probabilities; the
partitions follow the order of the keys.  Workers map the arrays into memory and
look tokens up in sorted batches.  (Where the shared folder is not a mounted one, a
worker reads arrays whole and holds CACHE_BYTES of them.)

Texts begin with two start marks and end with an end mark, which is scored.
Null and empty texts are not counted; they score zero tokens and no perplexity.
Repeated rows count, and score, each.  Other columns are ignored.  An empty table
gives no rows.  `doc_id` is a whole number or null.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.bpe import DEFAULT_VOCABULARY, encoder
from trawl.llm.common import c, spread
from trawl.llm.hashing import U
from trawl.scratch import new_path, written

START, END = 65534, 65535
CHUNK = 4_000_000
TOKENS_A_PART = 4_000_000
MOST_PARTS = 20_000
CACHE_BYTES = 256_000_000
SCATTER = U(40503)


class Layout(NamedTuple):
    """For each scattered middle token its first partition and its number of partitions."""

    base: np.ndarray
    splits: np.ndarray
    parts: int

    def part_of(self, key: np.ndarray) -> np.ndarray:
        middle = (key >> U(32)).astype(np.int64)
        return self.base[middle] + ((key >> U(16) & U(0xFFFF)).astype(np.int64) * self.splits[middle] >> 16)

    def group_of(self, key: np.ndarray) -> np.ndarray:
        """The partition that has a middle token's continuations."""
        return self.base[(key >> U(32)).astype(np.int64)]


class Model(NamedTuple):
    """Where a model lies, its layout and its unigram level."""

    folder: str
    layout: Layout
    vocabulary_size: int
    discounts: tuple[tuple[float, float, float], ...]
    unigram: np.ndarray


def layout_of(counts: np.ndarray, parts: int) -> Layout:
    """About `parts` partitions of equal counts, given those of the middle tokens."""
    spread = np.zeros(65536, dtype=np.int64)
    spread[scatter(np.arange(65536)).astype(np.int64)] = counts
    most = max(1, -(-int(spread.sum()) // parts))
    base, splits = np.zeros(65536, np.int64), np.ones(65536, np.int64)
    part = held = 0
    for i, n in enumerate(spread.tolist()):
        if held and held + n > most:
            part, held = part + 1, 0
        base[i] = part
        if n > most:
            splits[i] = -(-n // most)
            part += int(splits[i])
        else:
            held += n
    last = part + 1 if held or not part else part
    return Layout(np.minimum(base, last - 1), splits, last)


def scatter(token: np.ndarray) -> np.ndarray:
    """A bijection of 16-bit ids that spreads the frequent ones."""
    return token.astype(U) * SCATTER & U(0xFFFF)


def keys_of(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> np.ndarray:
    return scatter(w2) << U(32) | scatter(w1) << U(16) | w3.astype(U)


def tokens_of(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id and its token ids, two bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        if own.width != 2:
            raise ValueError("the model takes vocabularies of fewer than 65,534 tokens")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = own.encode_all(pc.fill_null(part.column(1), "").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["doc_id", "tokens"])

    return spread(docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").alias("text"))).mapInArrow(run, "doc_id long, tokens binary")


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all scored positions of the texts that have tokens, and each text's number of them."""
    marks = np.array([END, START, START], dtype=np.uint16).tobytes()
    full = [t for t in texts if t]
    ids = np.frombuffer(marks[2:] + marks.join(full) + marks[:2] if full else b"", dtype=np.uint16)
    lengths = np.array([len(t) // 2 + 1 if t else 0 for t in texts], dtype=np.int64)
    if not full:
        return np.zeros(0, U), lengths
    keys = keys_of(ids[:-2], ids[1:-1], ids[2:])
    scored = np.ones(len(keys), dtype=bool)
    ends = np.cumsum(lengths[lengths > 0] + 2)[:-1]
    for back in (1, 2):
        scored[ends - back] = False
    return keys[scored], lengths


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


@lru_cache(maxsize=8)
def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def save(folder: str, name: str, **arrays: np.ndarray) -> None:
    """One file an array, each put in place when whole."""
    from pyspark import TaskContext

    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    tail = f".{TaskContext.get().taskAttemptId()}"
    for kind, array in arrays.items():
        held = io.BytesIO()
        np.save(held, array)
        with store.open_output_stream(f"{root}/{name}-{kind}.npy{tail}") as out:
            out.write(held.getbuffer())
        store.move(f"{root}/{name}-{kind}.npy{tail}", f"{root}/{name}-{kind}.npy")


@lru_cache(maxsize=10_000)
def _mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


_HELD: dict[str, np.ndarray] = {}


def load(folder: str, name: str, kind: str) -> np.ndarray:
    """A stored array, mapped where the folder is a mounted one."""
    store, root = _store(folder)
    path = f"{root}/{name}-{kind}.npy"
    if store.type_name == "local":
        return _mapped(path)
    if path not in _HELD:
        with store.open_input_file(path) as handle:
            _HELD[path] = np.load(io.BytesIO(handle.read()))
        while len(_HELD) > 1 and sum(x.nbytes for x in _HELD.values()) > CACHE_BYTES:
            del _HELD[next(iter(_HELD))]
    return _HELD[path]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts from the numbers of things seen once to four times."""
    if min(n[:4]) == 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.0), k + 1.0) for k in range(3))


def discounted(count: np.ndarray, d: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Counts less their discounts, and the discounts."""
    off = np.array([0.0, *d])[np.minimum(count, 3)]
    return count - off, off


def level(group: np.ndarray, count: np.ndarray, d: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For counts sorted by group: each one's own share, its group's index, the groups and their left-over shares."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(group)), dtype=bool), group[1:] != group[:-1]]))
    nth = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
    own, off = discounted(count, d)
    total = np.bincount(nth, weights=count, minlength=len(first))
    return own / total[nth], nth, group[first], np.bincount(nth, weights=off, minlength=len(first)) / total


def middles(tokens: DataFrame) -> np.ndarray:
    """How many trigrams each token is the middle of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(65536, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(at, 256).to_pylist()
                found += np.bincount(np.frombuffer(b"".join(texts), np.uint16), minlength=65536)
                found[START] += sum(map(bool, texts))
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["at", "n"])

    out = np.zeros(65536, dtype=np.int64)
    for at, n in tokens.select("tokens").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out


STATS = "kind long, at long, value long, bucket int, pairs binary, before binary"


def _stats(pairs: np.ndarray | None, before: np.ndarray | None, counts: np.ndarray | None) -> pa.RecordBatch:
    """Numbers of continuations by last token (kind 1), and of counts of one to four (kinds 2 and 3)."""
    kind, at, value = [], [], []
    if pairs is not None:
        last, types = np.unique(pairs & U(0xFFFF), return_counts=True)
        kind, at, value = [np.full(len(last), 1)], [last.astype(np.int64)], [types]
    for k, x in ((2, before), (3, counts)):
        if x is not None:
            kind.append(np.full(4, k))
            at.append(np.arange(1, 5))
            value.append([np.count_nonzero(x == n) for n in range(1, 5)])
    columns = [pa.array(np.concatenate(x), pa.int64()) for x in (kind, at, value)]
    n = len(columns[0])
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], ["kind", "at", "value", "bucket", "pairs", "before"])


def _bytes(x: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes()], pa.large_binary()).cast(pa.binary())


def build(tokens: DataFrame, vocabulary_size: int) -> Model:
    """Count, discount and store the model below the shared folder."""
    spark = tokens.sparkSession
    folder = new_path(spark, "trigrams")
    n_middle = middles(tokens)
    layout = layout_of(n_middle, min(MOST_PARTS, max(spark.sparkContext.defaultParallelism, int(n_middle.sum()) // TOKENS_A_PART)))
    hot = np.flatnonzero(layout.splits > 1)
    split = {int(p): int(layout.base[i]) for i in hot for p in range(layout.base[i], layout.base[i] + layout.splits[i])}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done = [], 0, []

        def close() -> None:
            if held:
                done.append(summed(np.concatenate(held)))
                held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, _ = trigrams(batch.column(0).slice(at, 256).to_pylist())
                held.append(keys)
                size += len(keys)
                if size > CHUNK:
                    close()
                    size = 0
        close()
        if not done:
            return
        keys, counts = summed(np.concatenate([k for k, _ in done]), np.concatenate([n for _, n in done]))
        part = layout.part_of(keys)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(first, [*first[1:], len(keys)]):
            yield pa.RecordBatch.from_arrays([pa.array([int(part[a])], pa.int32()), _bytes(keys[a:b].astype("<u8")), _bytes(counts[a:b].astype("<i8"))], ["part", "keys", "counts"])

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The summed arrays of each partition; what comes in is added up before it takes twice the room."""
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        grown: dict[int, int] = {}

        def add_up(part: int) -> tuple[np.ndarray, np.ndarray]:
            return summed(np.concatenate([k for k, _ in held[part]]), np.concatenate([n for _, n in held[part]]))

        for batch in batches:
            for part, keys, counts in zip(*[x.to_pylist() for x in batch.columns]):
                held.setdefault(part, []).append((np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<i8")))
                grown[part] = grown.get(part, 0) + len(keys) // 8
                if grown[part] > max(CHUNK, 2 * len(held[part][0][0])):
                    held[part] = [add_up(part)]
                    grown[part] = len(held[part][0][0])
        for part in held:
            yield part, *add_up(part)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, counts in collected(batches):
            tail = keys >> U(32) << U(16) | keys & U(0xFFFF)
            starts = keys >> U(32) == scatter(np.array([START]))[0]
            pairs, before = summed(tail, np.where(starts, counts, 1))
            save(folder, f"{part:06d}", keys=keys, counts=counts)
            if part not in split:
                save(folder, f"{part:06d}", pairs=pairs, before=before)
                yield _stats(pairs, before, counts)
                continue
            yield _stats(None, None, counts)
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array([split[part]], pa.int32()), _bytes(pairs), _bytes(before.astype("<i8"))], ["kind", "at", "value", "bucket", "pairs", "before"])

    def continued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, pairs, before in collected(batches):
            save(folder, f"{bucket:06d}", pairs=pairs, before=before)
            yield _stats(pairs, before, None)

    laid = tokens.select("tokens").mapInArrow(count, "part int, keys binary, counts binary").repartitionById(layout.parts, F.col("part"))
    stats = written(laid.mapInArrow(merge, STATS), "counts")
    seen = stats
    if split:
        seen = seen.unionByName(stats.where("bucket is not null").select("bucket", "pairs", "before").repartition(len(hot), "bucket").mapInArrow(continued, STATS))
    unigrams, times = np.zeros(65536, dtype=np.int64), {2: [0] * 4, 3: [0] * 4}
    for kind, at, value in seen.where("kind is not null").groupBy("kind", "at").agg(F.sum("value").alias("value")).collect():
        if kind == 1:
            unigrams[at] = value
        else:
            times[kind][at - 1] = value
    d1 = discounts([int(np.count_nonzero(unigrams == k)) for k in range(1, 5)])
    d2, d3 = discounts(times[2]), discounts(times[3])
    own, off = discounted(unigrams, d1)
    total = max(1, unigrams.sum())
    unigram = own / total + (off.sum() / total if unigrams.any() else 1.0) / (vocabulary_size + 1)

    def finish(ids: list[int], second_level: bool) -> None:
        """The probabilities of partitions: those of continuations, and those of trigrams where their continuations are done."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in [ids[i] for i in batch.column(0).to_pylist()]:
                    name, of = f"{part:06d}", f"{split.get(part, part):06d}"
                    store, root = _store(folder)
                    if store.get_file_info(f"{root}/{of}-pairs.npy").type.name == "NotFound" or store.get_file_info(f"{root}/{name}-keys.npy").type.name == "NotFound" and not second_level:
                        continue
                    pairs = load(folder, of, "pairs")
                    if second_level:
                        before = load(folder, of, "before")
                        share, nth, heads, left = level(pairs >> U(16), before, d2)
                        second = share + left[nth] * unigram[(pairs & U(0xFFFF)).astype(np.int64)]
                        save(folder, name, second=second, heads=heads, left=left)
                        if part in split:
                            continue
                    else:
                        second = load(folder, of, "second")
                    keys, counts = load(folder, name, "keys"), load(folder, name, "counts")
                    share, nth, contexts, rest = level(keys >> U(16), counts, d3)
                    tail = keys >> U(32) << U(16) | keys & U(0xFFFF)
                    third = share + rest[nth] * second[np.searchsorted(pairs, tail)]
                    save(folder, name, logs=np.log(third).astype(np.float32), contexts=contexts, rest=rest)
                yield pa.RecordBatch.from_arrays([batch.column(0)], ["id"])

        if ids:
            spark.range(0, len(ids), 1, len(ids)).mapInArrow(run, "id long").count()

    finish([p for p in range(layout.parts) if split.get(p, p) == p], True)
    finish(sorted(split), False)
    return Model(folder, layout, vocabulary_size, (d1, d2, d3), unigram)


def _found(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, wanted)
    at[at == len(table)] = 0
    return at, table[at] == wanted if len(table) else np.zeros(len(wanted), dtype=bool)


def _loaded(model: Model, part: int, kind: str) -> np.ndarray | None:
    try:
        return load(model.folder, f"{part:06d}", kind)
    except FileNotFoundError:
        return None


def backed_off(model: Model, part: int, group: int, keys: np.ndarray) -> np.ndarray:
    """Log-probabilities of trigrams that the model doesn't hold."""
    p = model.unigram[(keys & U(0xFFFF)).astype(np.int64)]
    if (heads := _loaded(model, group, "heads")) is not None:
        at, hit = _found(heads, keys >> U(32))
        p = np.where(hit, load(model.folder, f"{group:06d}", "left")[at] * p, p)
        at, hit = _found(load(model.folder, f"{group:06d}", "pairs"), keys >> U(32) << U(16) | keys & U(0xFFFF))
        p = np.where(hit, load(model.folder, f"{group:06d}", "second")[at], p)
    if (contexts := _loaded(model, part, "contexts")) is not None:
        at, hit = _found(contexts, keys >> U(16))
        p = np.where(hit, load(model.folder, f"{part:06d}", "rest")[at] * p, p)
    return np.log(p)


def log_probabilities(model: Model, keys: np.ndarray) -> np.ndarray:
    """The natural log-probability of each trigram."""
    out = np.empty(len(keys))
    for a in range(0, len(keys), 65536):
        # Sorted queries go through the mapped arrays from front to back.
        packed = np.sort(keys[a : a + 65536] << U(16) | np.arange(min(65536, len(keys) - a), dtype=U))
        wanted, place = packed >> U(16), a + (packed & U(0xFFFF)).astype(np.int64)
        part, group = model.layout.part_of(wanted), model.layout.group_of(wanted)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        for i, j in zip(first, [*first[1:], len(wanted)]):
            own, logs = wanted[i:j], None
            if (table := _loaded(model, int(part[i]), "keys")) is not None:
                at, hit = _found(table, own)
                logs = load(model.folder, f"{part[i]:06d}", "logs")[at].astype(float)
            else:
                hit, logs = np.zeros(len(own), dtype=bool), np.zeros(len(own))
            if not hit.all():
                logs[~hit] = backed_off(model, int(part[i]), int(group[i]), own[~hit])
            out[place[i:j]] = logs
    return out


def scores(tokens: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens (the end mark included), log_prob and perplexity of each document."""
    sent = tokens.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys, lengths = trigrams(part.column(1).to_pylist())
                sums = np.zeros(len(keys) + 1)
                np.cumsum(log_probabilities(sent.value, keys), out=sums[1:])
                ends = np.cumsum(lengths)
                total = sums[ends] - sums[ends - lengths]
                none = lengths == 0
                perplexity = np.exp(-total / np.maximum(lengths, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lengths), pa.array(total, mask=none), pa.array(perplexity, mask=none)], ["doc_id", "n_tokens", "log_prob", "perplexity"])

    return tokens.select("doc_id", "tokens").mapInArrow(run, "doc_id long, n_tokens long, log_prob double, perplexity double")


def lm_scores(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """A model of all documents, and each document's score by it."""
    tokens = written(tokens_of(docs, vocabulary), "tokens")
    return scores(tokens, build(tokens, encoder(vocabulary).end_id))
