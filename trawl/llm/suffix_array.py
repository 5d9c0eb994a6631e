"""Operator 3: repeated passages by suffix arrays built by linear grouping.

`suffix_array` sorts suffixes in two passes and without renaming.  First, groups
of suffixes that share a Lyndon prefix are processed in descending order; each
suffix points to the nearest earlier one in a smaller group, and the suffixes
pointed to move into a new group right above their old one.  Second, the sorted
order is emitted from the front: once a suffix has its place, those whose Lyndon
prefix ends where it begins take the next places of their groups.

The corpus is laid out so that equal windows of `min_words` words meet: a
window's key is the least hash of the runs of half its length in it, which
depends on nothing but its words, and consecutive windows of one key form a
segment.  A key that occurs once holds no repeat.  The segments of the other
keys are sorted, key by key; neighbours in the suffix array that share
`min_words` words are repeats.  So each repeat of that length is found.  Equal
segments, and documents of equal words, are sorted once and reported each.  A key
of more than HOT_TEXTS texts is split by longer runs first (`_hot_runs`), so that
no task takes all texts that share a passage.

Words are runs of letters and digits, compared in lower case (ASCII).  A passage
may repeat across documents or inside one.  The first occurrence, by doc_id and
place, is the one that is kept; a document whose words all stand in an earlier
one is one passage.  Words compare by 64-bit hashes.  Null texts and texts
shorter than `min_words` have no repeats.  Rows equal in id and text count as
one document; a null id sorts first.  Other columns are ignored.  An empty table
gives no rows.  `doc_id` is a whole number or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import c, row_key, spread
from trawl.llm.hashing import U, Words, char_positions, mix, prefix, range_hash, slices, utf8
from trawl.scratch import written

MIN_WORDS = 50
BATCH_BYTES = 1_000_000
HOT_TEXTS = 20_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The sorted order of the suffixes of an array of whole numbers; a prefix sorts first."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(text, kind="stable")
    ranks = text[order]
    heads = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
    sizes = np.diff(np.append(heads, n))
    at = np.empty(n, dtype=np.int64)
    at[order] = np.repeat(np.arange(len(heads)), sizes)
    group, order = at.tolist(), order.tolist()
    members = [order[a : a + k] for a, k in zip(heads.tolist(), sizes.tolist())]
    # The groups from high to low; a new one goes right above the one that it leaves.
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    alive = sizes.tolist()
    final = []
    done = bytearray(n)
    pointer, jump = [-1] * n, [-1] * n
    top = len(members) - 1
    while top >= 0:
        if not alive[top]:
            top = below[top]
            continue
        own = members[top]
        if len(own) != alive[top]:
            own = members[top] = [i for i in own if group[i] == top]
        final.append(top)
        for i in own:
            done[i] = 1
        # Pointers never fall along a group, so equal ones follow one another.
        times: dict[int, list[int]] = {}
        last, run = -1, 0
        for i in own:
            j = i - 1
            if j >= 0 and done[j]:
                path = []
                while j >= 0 and done[j]:
                    path.append(j)
                    j = jump[j]
                for x in path:
                    jump[x] = j
            pointer[i] = jump[i] = j
            if j != last:
                if last >= 0 and alive[group[last]] > 1:
                    times.setdefault(run, []).append(last)
                last, run = j, 0
            run += 1
        if last >= 0 and alive[group[last]] > 1:
            times.setdefault(run, []).append(last)
        for run in sorted(times, reverse=True) if len(times) > 1 else times:
            made: dict[int, int] = {}
            for j in times[run]:
                old = group[j]
                new = made.get(old)
                if new is None:
                    new = made[old] = len(members)
                    members.append([])
                    alive.append(0)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    below[up] = new
                members[new].append(j)
                alive[old] -= 1
                alive[new] += 1
                group[j] = new
        top = below[top]
    place = [0] * len(members)
    start = 0
    for g in reversed(final):
        place[g] = start
        start += len(members[g])
    out = [-1] * n
    put = bytearray(n)
    for k in range(-1, n):
        j = (n if k < 0 else out[k]) - 1
        while j >= 0 and not put[j]:
            put[j] = 1
            g = group[j]
            out[place[g]] = j
            place[g] += 1
            j = pointer[j]
    return np.array(out, dtype=np.int64)


def half_runs(words: Words, min_words: int) -> np.ndarray:
    """Hashes of all runs of half the length of a window, those across texts included."""
    starts = np.arange(max(0, len(words) - min_words // 2 + 1))
    return range_hash(prefix(words.hash), starts, starts + min_words // 2)


def window_keys(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of `min_words` words its key and its first word's index; no run crosses texts."""
    span = min_words - min_words // 2 + 1
    if len(words) < min_words:
        return np.zeros(0, U), np.zeros(0, np.int64)
    least, width = half_runs(words, min_words), 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = np.arange(len(words))[words.left() >= min_words]
    return least[at], at


def segments(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first words and ends (in words) of the longest runs of windows that share a key."""
    keys, at = window_keys(words, min_words)
    if not len(keys):
        return keys, at, at
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return keys[first], at[first], at[np.append(first[1:], len(keys)) - 1] + min_words


def twice(words: Words, keys: np.ndarray, first: np.ndarray, last: np.ndarray, min_words: int) -> np.ndarray:
    """Whether a segment holds its key at two places, as it does when two of its windows are equal."""
    if not len(keys):
        return np.zeros(0, dtype=bool)
    runs, n = half_runs(words, min_words), last - first - min_words // 2 + 1
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
    return np.add.reduceat((runs[at] == np.repeat(keys, n)).astype(np.int32), np.cumsum(n) - n) > 1


def _signed(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, row key, content hashes, bounds in characters, segment keys of every text of `min_words` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                own = data[offsets[a] : offsets[b]]
                words = Words(own, offsets[a : b + 1] - offsets[a])
                has = np.flatnonzero(words.counts >= min_words)
                if not len(has):
                    continue
                keys, first, last = segments(words, min_words)
                again = 1 + twice(words, keys, first, last, min_words)
                keys, first = np.repeat(keys, again), np.repeat(first, again)
                cuts = np.searchsorted(first, words.first)
                sums = np.zeros(len(words) + 1, dtype=U)
                np.cumsum(mix(words.hash ^ U(0x5851F42D4C957F2D)), out=sums[1:])
                head, tail = words.first[:-1][has], words.first[1:][has]
                whole = range_hash(prefix(words.hash), head, tail)
                chars = char_positions(own)
                base = chars[offsets[a : b + 1] - offsets[a]][:-1][has]
                lists = pa.ListArray.from_arrays(pa.array(np.append(cuts[has], cuts[-1]), pa.int32()), pa.array(keys.view(np.int64)))
                part = batch.slice(a, b - a).take(pa.array(has))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(whole.view(np.int64)), pa.array((sums[tail] - sums[head]).view(np.int64)), pa.array(chars[words.start[head]] - base), pa.array(chars[words.end[tail - 1]] - base), lists],
                    ["doc_id", "row", "content", "content2", "start", "end", "keys"],
                )

    return spread(docs.select(c("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), c("text").alias("text"))).mapInArrow(run, "doc_id long, row long, content long, content2 long, start long, end long, keys array<long>")


class _Chosen:
    """The segments of the wanted keys in a slice of texts: `key`, `first` and `last` (words), `text` (row of the slice)."""

    def __init__(self, part: pa.RecordBatch, own: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, ends: np.ndarray, min_words: int):
        self.part, self.own, self.words = part, own, Words(own, offsets)
        keys, first, last = segments(self.words, min_words)
        text = np.searchsorted(self.words.first, first, side="right") - 1
        # A text's keys are matched as pairs of text and key.
        ours = np.repeat(np.arange(part.num_rows), np.diff(ends))
        take = np.flatnonzero(np.isin(mix(keys + mix(text.astype(U))), mix(wanted.view(U) + mix(ours.astype(U)))))
        self.key, self.first, self.last, self.text = keys[take], first[take], last[take], text[take]
        self.chars = char_positions(own) if len(take) else None
        self.base = self.chars[offsets] if len(take) else None


def _chosen(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[_Chosen]:
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        lists = batch.column(3)
        wanted, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        for a, b in slices(offsets):
            found = _Chosen(batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], wanted[ends[a] : ends[b]], ends[a : b + 1], min_words)
            if len(found.key):
                yield found


def _cut(texts: DataFrame, min_words: int) -> DataFrame:
    """The segments of the wanted keys: key, doc_id, row, place (characters before it) and its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _chosen(batches, min_words):
            begin, end, raw = x.words.start[x.first], x.words.end[x.last - 1], x.own.tobytes()
            for i in range(0, len(begin), 20_000):
                few = slice(i, i + 20_000)
                part = x.part.take(pa.array(x.text[few]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.key[few].view(np.int64)), part.column(0), part.column(1), pa.array(x.chars[begin[few]] - x.base[x.text[few]]), pa.array([raw[a:b] for a, b in zip(begin[few].tolist(), end[few].tolist())], pa.binary())],
                    ["key", "doc_id", "row", "place", "segment"],
                )

    return texts.select("doc_id", "row", "text", "wanted").mapInArrow(run, "key long, doc_id long, row long, place long, segment binary")


def _windows(texts: DataFrame, min_words: int) -> DataFrame:
    """The windows of the wanted keys' segments: hash, doc_id, row, start and end (characters)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _chosen(batches, min_words):
            n = x.last - x.first - min_words + 1
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - x.first, n)
            of = np.repeat(x.text, n)
            whole = range_hash(prefix(x.words.hash), at, at + min_words)
            start, end = x.chars[x.words.start[at]] - x.base[of], x.chars[x.words.end[at + min_words - 1]] - x.base[of]
            for i in range(0, len(at), 100_000):
                few = slice(i, i + 100_000)
                part = x.part.take(pa.array(of[few]))
                yield pa.RecordBatch.from_arrays([pa.array(whole[few].view(np.int64)), part.column(0), part.column(1), pa.array(start[few]), pa.array(end[few])], ["window", "doc_id", "row", "start", "end"])

    return texts.select("doc_id", "row", "text", "wanted").mapInArrow(run, "window long, doc_id long, row long, start long, end long")


def _hot_runs(texts: DataFrame, min_words: int) -> DataFrame:
    """The repeats of keys that very many texts have.

    Their segments are split by the longest run that a repeat must have, the window
    itself.  What shares that is equal, so there is nothing left to sort: the first
    place of each window is a least value, and no task takes all rows of a key.
    """
    windows = written(_windows(texts, min_words), "windows")
    first = windows.groupBy("window").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = windows.join(first.hint("merge"), "window").where("row <> first.row or start <> first.start")
    return again.select("doc_id", "row", F.col("first.doc_id").alias("first_doc_id"), "start", "end")


def repeats_of(ids: np.ndarray, rows: np.ndarray, places: np.ndarray, texts: pa.Array, min_words: int) -> list[tuple]:
    """(segment, first segment's index, start, end in characters) of each run of repeated windows.

    `ids`, `rows`, `places` order the segments' documents and places.
    """
    data, offsets = utf8(texts)
    words = Words(data, offsets)
    chars = char_positions(data)
    shift = places - chars[offsets[:-1]]
    whole = range_hash(prefix(words.hash), words.first[:-1], words.first[1:])
    order = np.lexsort((places, rows, ids))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    _, inverse = np.unique(whole, return_inverse=True)
    least = np.full(inverse.max() + 1, len(order))
    np.minimum.at(least, inverse, rank)
    leader = order[least[inverse]]
    kept = np.flatnonzero(leader == np.arange(len(order)))
    # One text of the distinct segments, each ended by a mark of its own.
    lengths = words.counts[kept]
    starts = np.cumsum(lengths + 1) - lengths - 1
    of = np.repeat(np.arange(len(kept)), lengths)
    source = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + words.first[:-1][kept][of]
    values = np.unique(words.hash[source], return_inverse=True)[1]
    text = np.empty(int((lengths + 1).sum()), dtype=np.int64)
    spot = np.arange(len(source)) + of
    text[spot] = values + len(kept)
    text[starts + lengths] = np.arange(len(kept))
    array = suffix_array(text)
    owner = np.full(len(text), -1)
    owner[spot] = of
    left = np.zeros(len(text), dtype=np.int64)
    left[spot] = lengths[of] - (spot - starts[of])
    array = array[left[array] >= min_words]
    equal = np.ones(max(0, len(array) - 1), dtype=bool)
    for k in range(min_words):
        equal &= text[array[1:] + k] == text[array[:-1] + k]
    run = np.cumsum(np.concatenate([np.zeros(min(1, len(array)), dtype=bool), ~equal]))
    nth = rank[kept[owner[array]]] * (1 << 32) + (array - starts[owner[array]])
    first = np.full(int(run[-1]) + 1 if len(run) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, run, nth)
    # The first place of each window of the distinct segments.
    origin = np.zeros(len(text), dtype=np.int64)
    origin[array] = first[run]
    origin_rank = origin >> 32
    position = {int(s): int(p) for s, p in zip(kept, starts)}
    out = []
    for s in range(len(order)):
        p, n = position[int(leader[s])], int(words.counts[s]) - min_words + 1
        source_of = origin_rank[p : p + n]
        own = (origin[p : p + n] == rank[s] * (1 << 32) + np.arange(n)) if leader[s] == s else np.zeros(n, dtype=bool)
        if own.all():
            continue
        mark = np.where(own, -1, source_of)
        cuts = np.flatnonzero(np.diff(mark, prepend=-2))
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), n]):
            if mark[i] >= 0:
                w = words.first[s]
                out.append((s, int(order[mark[i]]), int(chars[words.start[w + i]] + shift[s]), int(chars[words.end[w + j + min_words - 2]] + shift[s])))
    return out


def _sorted_runs(cut: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def close(table: pa.Table) -> pa.RecordBatch | None:
            ids = np.array([-(1 << 63) if x is None else x for x in table.column("doc_id").to_pylist()], dtype=np.int64)
            found = repeats_of(ids, table.column("row").to_numpy(), table.column("place").to_numpy(), table.column("segment").combine_chunks().cast(pa.string()), min_words)
            if not found:
                return None
            s, f, a, b = (pa.array(x, pa.int64()) for x in zip(*found))
            return pa.RecordBatch.from_arrays([table.column(k).take(i).combine_chunks() for k, i in (("doc_id", s), ("row", s), ("doc_id", f))] + [a, b], ["doc_id", "row", "first_doc_id", "start", "end"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < BATCH_BYTES:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            borders = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            rows, done = max(1, BATCH_BYTES * len(keys) // size), 0
            while len(borders) and done < borders[-1]:
                # The last key's rows may go on in the next batch.
                end = int(borders[min(len(borders) - 1, np.searchsorted(borders, done + rows))])
                if (out := close(table.slice(done, end - done))) is not None:
                    yield out
                done = end
            held = table.slice(done).combine_chunks().to_batches()
            size = sum(x.nbytes for x in held)
        if held and (out := close(pa.Table.from_batches(held))) is not None:
            yield out

    return cut.mapInArrow(run, "doc_id long, row long, first_doc_id long, start long, end long")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, first_doc_id, start and end (characters) of each passage that stands earlier."""
    signs = written(_signed(docs, min_words), "signed")
    least = signs.groupBy("content", "content2").agg(F.min(F.struct("doc_id", "row")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    alike = signs.select("doc_id", "row", "content", "content2", "start", "end").join(least.hint("merge"), ["content", "content2"]).where("row <> least.row")
    copies = written(alike.dropDuplicates(["row"]).select("doc_id", "row", F.col("least.doc_id").alias("first_doc_id"), "start", "end"), "copies")
    keyed = signs.join(copies.select("row").hint("merge"), "row", "left_anti").select("row", F.explode(F.array_distinct("keys")).alias("key"), F.size("keys").alias("n"), F.size(F.array_distinct("keys")).alias("m"))
    # A key that stands twice in one text can be a repeat inside it.
    inside = F.max((F.col("n") > F.col("m")).cast("int"))
    shared = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("times"), inside.alias("inside")).where("times > 1 or inside = 1").select("key", "times"), "shared")
    repeated = not _unrepeated(signs)

    def holding(keys: DataFrame) -> DataFrame:
        """The texts that have some of the keys, and those."""
        wanted = keyed.join(keys.hint("merge"), "key").groupBy("row").agg(F.collect_set("key").alias("wanted"))
        texts = docs.select(c("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), c("text").alias("text")).join(wanted.hint("merge"), "row")
        return texts.dropDuplicates(["row"]) if repeated else texts

    laid = _cut(holding(shared.where(F.col("times") <= HOT_TEXTS).select("key")), min_words).repartition(F.col("key")).sortWithinPartitions("key")
    runs = _sorted_runs(laid, min_words).unionByName(copies)
    hot = shared.where(F.col("times") > HOT_TEXTS).select("key")
    if not hot.isEmpty():
        runs = runs.unionByName(_hot_runs(holding(hot), min_words))
    own = Window.partitionBy("row", "doc_id", "first_doc_id").orderBy("start", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((before < F.col("start")).cast("int"), F.lit(1))
    merged = runs.withColumn("_new", begins).withColumn("_nth", F.sum("_new").over(own))
    return merged.groupBy("row", "doc_id", "first_doc_id", "_nth").agg(F.min("start").alias("start"), F.max("end").alias("end")).select("doc_id", "first_doc_id", "start", "end")


def _unrepeated(signs: DataFrame) -> bool:
    return signs.groupBy("row").count().where("count > 1").isEmpty()
