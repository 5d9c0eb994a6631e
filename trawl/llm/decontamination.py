"""Operator 7: benchmark decontamination by the q-gram lemma.

A passage that equals a benchmark item of length m but for e edits shares at
least m + 1 - q (e + 1) q-grams with it, on diagonals that differ by e at most.
Shared q-grams are counted in overlapping diagonal bands; a band that meets the
bound is a candidate region, and a banded alignment decides.

Both sides are compared in lower case (ASCII) with each run of other characters
than letters and digits as one space.  The edit budget is `edit_share` of an
item's length in bytes; an item too short for one edit matches where it occurs as
it is.  Items for which q-grams of q bytes leave no bound take shorter ones, so
that no item within its budget is missed.

Null and empty texts, on either side, match nothing.  Repeated rows are found
alike; an item stands once a document, with its fewest edits.  Empty tables of
documents or items give no matches; `doc_id` and `item_id` are whole numbers or
null.  `contaminated` ignores other columns, `decontaminated` keeps them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import BROADCAST_BYTES, c, spread
from trawl.llm.hashing import FOLD, SLICE_BYTES, U, WORD_BYTE, slices, utf8

Q = 12
#: Sizes of q-grams for items that are too short for those of q.
QS = (1, 2, 3, 4, 6, 8, 10)
EDIT_SHARE = 0.05
POSTINGS = 4_000_000
KEY = np.dtype([("row", np.int64), ("item", np.int64), ("band", np.int64), ("n", np.int64)])
TO_SPACE = np.where(WORD_BYTE, FOLD, np.uint8(32)).astype(np.uint8)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, one space for each run of other bytes; the texts' new offsets."""
    word = WORD_BYTE[data]
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[offsets[(offsets < len(data)) & (offsets > 0)]] = True
    at = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(keep, out=at[1:])
    return TO_SPACE[data[keep]], at[offsets]


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q bytes (1 <= q <= 16): its first and last eight, or all of fewer."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    if q < 8:
        out = np.zeros(n, dtype=U)
        for k in range(q):
            out = out << U(8) | data[k : k + n]
        return out
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    return eight[:n] * U(0x9E3779B97F4A7C15) + (eight[q - 8 :] ^ (eight[q - 8 :] >> U(29))) * U(0xBF58476D1CE4E5B9)


def fewest_edits(item: bytes, region: bytes, budget: int, low: int, high: int) -> int:
    """Edits between the item and its best place in the region, budget + 1 if more than the budget.

    The alignment keeps to a band: its cells lie on the diagonals low .. high (place in the region less place in the item).
    """
    if item in region:
        return 0
    if budget == 0:
        return 1
    width, steps, far = high - low + 1, np.arange(high - low + 1), budget + 1
    # text[j + len(item) + width] is the region's byte j; beyond it stands what no byte equals.
    pad = len(item) + width
    text = np.full(len(region) + 2 * pad, -1, dtype=np.int16)
    text[pad : pad + len(region)] = np.frombuffer(region, dtype=np.uint8)
    place = low + steps
    row = np.where((place >= 0) & (place <= len(region)), 0, far)
    for i, ch in enumerate(item, 1):
        # Row i: cell k stands for i bytes of the item and low + k + i of the region.
        first = pad + low + i - 1
        if first < 0 or first + width > len(text):
            return far
        new = row + (text[first : first + width] != ch)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        place += 1
        new[(place < 0) | (place > len(region))] = far
        row = np.minimum.accumulate(new - steps) + steps
        row[(place < 0) | (place > len(region))] = far
        if row.min() > budget:
            return far
    return int(row.min())


class Grams:
    """The q-grams of those items whose bound holds for one q, with their places."""

    def __init__(self, texts: list[bytes], budget: np.ndarray, own: np.ndarray, q: int):
        self.q = q
        lengths = np.array([len(text) for text in texts], dtype=np.int64)
        self.bound = lengths + 1 - q * (budget + 1)
        found = [grams(np.frombuffer(texts[i], np.uint8), q) for i in own.tolist()]
        gram = np.concatenate(found)
        order = np.argsort(gram, kind="stable")
        self.item = np.repeat(own, [len(g) for g in found])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in found])[order]
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.first = np.append(self.first, len(gram))
        self.bits = max(16, int(16 * len(gram) + 1).bit_length())

    @cached_property
    def table(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=bool)
        out[self._slot(self.gram)] = True
        return out

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram ^ (gram >> U(32))) * U(0xD6E8FEB86659FD93) >> U(64 - self.bits)

    def bands(self, data: np.ndarray, offsets: np.ndarray, budget: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row, item and band of every diagonal band that shares as many q-grams with an item as the bound asks for."""
        own = grams(data, self.q)
        at = np.flatnonzero(self.table[self._slot(own)])
        nth = np.searchsorted(self.gram, own[at])
        nth[nth == len(self.gram)] = 0
        real = self.gram[nth] == own[at]
        at, nth = at[real], nth[real]
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + self.q <= offsets[row + 1]
        at, nth, row = at[inside], nth[inside], row[inside]
        times = self.first[nth + 1] - self.first[nth]
        # A gram of very many items is taken part by part: only counts by band are kept.
        cuts = np.searchsorted(np.cumsum(times), np.arange(POSTINGS, times.sum() + 1, POSTINGS), side="left").tolist()
        kept: list[np.ndarray] = []
        for i, j in zip([0, *cuts], [*cuts, len(at)]):
            n = times[i:j]
            if not n.sum():
                continue
            post = np.repeat(self.first[nth[i:j]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item, diagonal, of = self.item[post], np.repeat(at[i:j], n) - self.place[post], np.repeat(row[i:j], n)
            band = diagonal // (budget[item] + 1)
            # Two halves make a band: any budget + 1 consecutive diagonals lie in one.
            keys = np.empty(2 * len(post), dtype=KEY)
            keys["row"], keys["item"] = np.concatenate([of, of]), np.concatenate([item, item])
            keys["band"], keys["n"] = np.concatenate([band, band - 1]), 1
            kept.append(counted(keys))
        keys = counted(np.concatenate(kept)) if kept else np.empty(0, dtype=KEY)
        keys = keys[keys["n"] >= self.bound[keys["item"]]]
        return keys["row"], keys["item"], keys["band"]


def counted(keys: np.ndarray) -> np.ndarray:
    """One key of each row, item and band, with the sum of their counts."""
    keys = keys[np.lexsort((keys["band"], keys["item"], keys["row"]))]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys["row"][1:] != keys["row"][:-1]) | (keys["item"][1:] != keys["item"][:-1]) | (keys["band"][1:] != keys["band"][:-1])
    first = np.flatnonzero(new)
    out = keys[first]
    out["n"] = np.add.reduceat(keys["n"], first) if len(first) else 0
    return out


class Index:
    """The items' q-grams.

    The lemma asks for a bound of one shared q-gram at least, so an item of m bytes and
    e edits takes q-grams of at most m / (e + 1) bytes: the largest of QS that is.
    """

    def __init__(self, items: list[tuple[int, str]], q: int, edit_share: float):
        data, offsets = utf8(pa.array([text for _, text in items], pa.string()))
        data, offsets = normalised(data, offsets)
        texts = [data[a:b].tobytes().strip() for a, b in zip(offsets, offsets[1:])]
        items = [(item_id, text) for (item_id, _), text in zip(items, texts) if text]
        self.ids = [item_id for item_id, _ in items]
        self.texts = [text for _, text in items]
        lengths = np.array([len(text) for text in self.texts], dtype=np.int64)
        self.budget = np.minimum((lengths * edit_share).astype(np.int64), np.maximum(lengths - 1, 0))
        sizes = np.array(sorted({q, *[x for x in QS if x < q]}))
        own = sizes[np.searchsorted(sizes, np.minimum(q, lengths // (self.budget + 1)), side="right") - 1] if items else lengths
        self.levels = [Grams(self.texts, self.budget, np.flatnonzero(own == x), int(x)) for x in np.unique(own)]

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], int]:
        """(row, item) -> fewest edits, over a slice of texts."""
        data, offsets = normalised(data, offsets)
        out: dict[tuple[int, int], int] = {}
        for level in self.levels:
            for r, i, band in zip(*[x.tolist() for x in level.bands(data, offsets, self.budget)]):
                budget = int(self.budget[i])
                if out.get((r, i), budget + 1) == 0:
                    continue
                # The band's diagonals, as places in the data, and as far on each side as the edits may lead.
                low, high = band * (budget + 1) - budget, (band + 2) * (budget + 1) - 1 + budget
                start = max(int(offsets[r]), low)
                end = min(int(offsets[r + 1]), high + len(self.texts[i]))
                edits = fewest_edits(self.texts[i], data[start:end].tobytes(), budget, low - start, high - start)
                if edits <= budget:
                    out[r, i] = min(edits, out.get((r, i), edits))
        return out

    def rows(self, column: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item id, edits) for a column of texts."""
        data, offsets = utf8(column)
        for a, b in slices(offsets, SLICE_BYTES):
            found = self.matches(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for (r, i), edits in sorted(found.items()):
                yield a + r, self.ids[i], edits


def indexes(benchmark: DataFrame, q: int, edit_share: float) -> Iterator[Index]:
    """Indexes of the items, each small enough to send to every worker; large benchmarks take several."""
    held, size = [], 0
    for row in benchmark.select(c("item_id").cast("long").alias("item_id"), c("text").alias("text")).where("text is not null").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += 32 * len(row["text"])
        if size > BROADCAST_BYTES:
            yield Index(held, q, edit_share)
            held, size = [], 0
    if held:
        yield Index(held, q, edit_share)


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_share: float = EDIT_SHARE) -> DataFrame:
    """doc_id, item_id and edits of every document that holds a benchmark item."""
    spark = docs.sparkSession
    out = None
    for index in indexes(benchmark, q, edit_share):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(sent.value.rows(batch.column(1)))
                ids = batch.column(0).take(pa.array([r for r, _, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([i for _, i, _ in found], pa.int64()), pa.array([e for _, _, e in found], pa.int64())], ["doc_id", "item_id", "edits"])

        found = spread(docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").alias("text"))).mapInArrow(run, "doc_id long, item_id long, edits long")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "doc_id long, item_id long, edits long") if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_share: float = EDIT_SHARE) -> DataFrame:
    """The documents that hold no benchmark item, all columns; nothing moves between executors."""
    for index in indexes(benchmark, q, edit_share):
        docs = docs.where(~_leaks(docs.sparkSession.sparkContext.broadcast(index))(c("text")))
    return docs


def _leaks(sent):
    def leaks(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), dtype=bool)
        out[[r for r, _, _ in sent.value.rows(text)]] = True
        return pa.array(out)

    return F.arrow_udf(leaks, "boolean")
