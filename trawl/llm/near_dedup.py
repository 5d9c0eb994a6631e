"""Operator 5: near-duplicates by BagMinHash over multisets of word pairs.

Every (element, weight level) runs a Poisson process of unit rate a unit of
weight; its points fall on random registers, and a register keeps its least
point.  Levels are dyadic, so an element of weight w takes log2(w) processes,
and a process is followed only to the bound below which all registers are
filled.  Two registers agree with the probability of the weighted Jaccard
similarity.  Registers are banded; pairs that share a band are verified by the
exact similarity of their multisets, and groups are connected components.

Equal word sequences are one node from the start.  In a band each member is
compared with the least one, in parts of PART members, so that a band that holds
a third of all texts is the work of many tasks.  What a band still holds outside
its largest component is compared with the members of other components; where
that is more than REST texts, the pairs to compare come from rare elements
instead (`rare_pairs`), which no pair of the threshold can lack.  So no link is
left out, and no band emits all its pairs.

A pair of similarity 0.6 shares a band with probability 0.91, one of 0.7 with
0.995.  Null texts and texts without words are in no group.  Rows equal in id and
text are exact copies of one another.  The document of the least id stays, a null
id first.  `doc_id` is a whole number or null.  `near_duplicates` ignores other
columns, `without_near_duplicates` keeps them all.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import c, fresh, row_key, spread
from trawl.llm.hashing import U, Words, mix, prefix, range_hash, slices, utf8
from trawl.scratch import written

BANDS = 30
ROWS = 5
THRESHOLD = 0.6
#: Pairs of one text that a task compares; texts outside the largest component of a band that meet all others in it; texts of a large component.
PART, REST, LARGE = 2048, 64, 1000
LOW48 = U((1 << 48) - 1)
EPSILON = 1e-6
SIGNED = "doc_id long, key long, content long, content2 long, bands array<long>"


def multisets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, weight) of the word pairs of each text; a lone word is its own element."""
    pairs, at = words.grams(2)
    doc = words.document()
    lone = np.flatnonzero(words.counts == 1)
    element = np.concatenate([pairs, mix(words.hash[words.first[lone]])]) & LOW48
    owner = np.concatenate([doc[at], lone]).astype(U)
    key, weight = np.unique((owner << U(48)) | element, return_counts=True)
    return (key >> U(48)).astype(np.int64), key & LOW48, weight


def bag_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Least points by text and register; infinite where a text has no elements."""
    out = np.full((docs, registers), np.inf)
    if not len(doc):
        return out
    total = np.bincount(doc, weights=weight, minlength=docs)
    level = [(np.arange(len(doc)), 0.0, 1.0)]
    k = 0
    while len(more := np.flatnonzero(weight > (1 << k))):
        level.append((more, float(1 << k), float(1 << k)))
        k += 1
    process = np.concatenate([e for e, _, _ in level])
    low = np.concatenate([np.full(len(e), lo) for e, lo, _ in level])
    length = np.concatenate([np.full(len(e), n) for e, _, n in level])
    nth = np.concatenate([np.full(len(e), i, dtype=U) for i, (e, _, _) in enumerate(level)])
    seed = mix(element[process] + (nth << U(56)))
    owner, most = doc[process], weight[process].astype(float)
    todo = total > 0
    bound = np.where(todo, registers * (np.log(registers) + 3) / np.maximum(total, 1), 0)
    while todo.any():
        alive = np.flatnonzero(todo[owner])
        out[todo] = np.inf
        flat = out.reshape(-1)
        time, step = np.zeros(len(alive)), 0
        while len(alive):
            block = int(np.clip(200_000 // len(alive), 1, 64))
            drawn = mix(seed[alive, None] + U(0x9E3779B97F4A7C15) * np.arange(step, step + block, dtype=U))
            gap = -np.log(((drawn >> U(11)).astype(float) + 1) * 2.0**-53) / length[alive, None]
            at = time[:, None] + np.cumsum(gap, axis=1)
            row, col = np.nonzero(at <= bound[owner[alive], None])
            place = mix(drawn[row, col] ^ U(0xA5A5A5A55A5A5A5A))
            who = alive[row]
            taken = low[who] + (place >> U(32)).astype(float) * 2.0**-32 * length[who] < most[who]
            row, col, place, who = row[taken], col[taken], place[taken], who[taken]
            register = ((place & U(0xFFFFFFFF)) * U(registers) >> U(32)).astype(np.int64)
            np.minimum.at(flat, owner[who] * registers + register, at[row, col])
            time, step = at[:, -1], step + block
            going = time <= bound[owner[alive]]
            alive, time = alive[going], time[going]
        todo = todo & np.isinf(out).any(axis=1)
        bound[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(U).reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=U), bits.shape[:2]).copy()
    for r in range(rows):
        out = mix(out * U(0x100000001B3) + bits[:, :, r])
    return out


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Key, content hashes and band keys of every document that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                has = np.flatnonzero(words.counts > 0)
                if not len(has):
                    continue
                signature = bag_minhash(*multisets(words), b - a, bands * rows)[has]
                keys = band_keys(signature, bands, rows).view(np.int64)
                sums = np.zeros(len(words) + 1, dtype=U)
                np.cumsum(mix(words.hash ^ U(0x5851F42D4C957F2D)), out=sums[1:])
                first, last = words.first[:-1][has], words.first[1:][has]
                whole = range_hash(prefix(words.hash), first, last)
                part = batch.slice(a, b - a).take(pa.array(has))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(whole.view(np.int64)),
                        pa.array((sums[last] - sums[first]).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1) * bands, pa.int32()), pa.array(keys.ravel())),
                    ],
                    ["doc_id", "key", "content", "content2", "bands"],
                )

    return spread(docs.select(c("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), c("text").alias("text"))).mapInArrow(run, SIGNED)


def similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b and the weighted Jaccard similarity of pairs (a, b, n), n being a bound of the pairs that share a.

    A text a is hashed once for each part of its pairs.  Texts are joined by merging
    at every size: the pairs grow with the corpus, so they are never broadcast.
    """
    parted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / PART)).alias("part"))
    heads = texts.join(parted.select(F.col("a").alias("key"), "part").distinct().hint("merge"), "key").select(F.col("key").alias("a"), F.lit(None).cast("long").alias("b"), "text", "part")
    tails = parted.hint("merge").join(texts.withColumnRenamed("key", "b"), "b").select("a", "b", "text", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_key = None, None
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in slices(offsets):
                words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                doc, element, weight = multisets(words)
                ends = np.searchsorted(doc, np.arange(j - i + 1))
                found = []
                for r in range(i, j):
                    own = slice(ends[r - i], ends[r - i + 1])
                    if b[r] is None:
                        head, head_key = (element[own].copy(), weight[own].copy()), a[r]
                        continue
                    if head_key != a[r]:
                        raise AssertionError("a pair came without its first text")
                    _, x, y = np.intersect1d(head[0], element[own], assume_unique=True, return_indices=True)
                    shared = int(np.minimum(head[1][x], weight[own][y]).sum())
                    found.append((a[r], b[r], shared / (int(head[1].sum()) + int(weight[own].sum()) - shared)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "similarity"])

    both = heads.unionByName(tails).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return both.select("a", "b", "text").mapInArrow(run, "a long, b long, similarity double")


def elements(texts: DataFrame) -> DataFrame:
    """A row for each element of each text: key, root, total weight, element, weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                doc, element, weight = multisets(words)
                total = np.bincount(doc, weights=weight, minlength=b - a).astype(np.int64)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), pa.array(total[doc]), pa.array(element.view(np.int64)), pa.array(weight.astype(np.int64))],
                    ["key", "root", "total", "element", "weight"],
                )

    return texts.select("key", "root", "text").mapInArrow(run, "key long, root long, total long, element long, weight long")


def rare_pairs(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of all pairs of nodes (key, root) of different roots that may be as similar as the threshold.

    Elements are ordered by the number of texts that have them.  Texts of weights
    m <= n can only meet the threshold t when, in that order, the first m - 2tm / (1 + t)
    of the one and the first n - tn of the other share an element behind which both
    have enough weight left.  The texts of one large component never meet one another.
    """
    all_rows = written(elements(texts.join(nodes.hint("merge"), "key")), "elements")
    spread = all_rows.groupBy("element").agg(F.count(F.lit(1)).alias("in_texts"))
    order = Window.partitionBy("key").orderBy("in_texts", "element")
    before = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("weight")
    first = all_rows.join(spread.hint("merge"), "element").withColumn("before", before)
    large = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LARGE).select("root", F.lit(True).alias("large"))
    kept = first.where(F.col("before") <= F.col("total") * (1 - threshold) + EPSILON).join(large, "root", "left")
    short = F.col("before") <= F.col("total") * (1 - 2 * threshold / (1 + threshold)) + EPSILON
    rows = written(kept.select("element", "key", "root", "total", "before", F.coalesce("large", F.lit(False)).alias("large"), short.alias("short")), "rare")
    x = rows.where("short").select("element", *[F.col(k).alias(f"x_{k}") for k in ("key", "root", "total", "before", "large")])
    y = rows.select("element", *[F.col(k).alias(f"y_{k}") for k in ("key", "root", "total", "before", "large")])
    # Rows of large components meet those of one other component at a time.
    others = x.where("x_large").select("element", "x_root").distinct()
    toward = y.where("y_large").join(others.hint("merge"), "element").where("x_root <> y_root")
    met = (
        x.where("not x_large").join(y.hint("merge"), "element").where("x_root <> y_root")
        .unionByName(x.where("x_large").join(y.where("not y_large").hint("merge"), "element"))
        .unionByName(x.where("x_large").join(toward.hint("merge"), ["element", "x_root"]))
    )
    left = F.least(F.col("x_total") - F.col("x_before"), F.col("y_total") - F.col("y_before"))
    may = (
        ((F.col("x_total") < F.col("y_total")) | ((F.col("x_total") == F.col("y_total")) & (F.col("x_key") < F.col("y_key"))))
        & (F.col("x_total") >= F.col("y_total") * threshold - EPSILON)
        & (left >= (F.col("x_total") + F.col("y_total")) * (threshold / (1 + threshold)) - EPSILON)
    )
    return met.where(may).select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, root the least of its component.

    Large-star and small-star steps in turn until nothing changes.
    """
    star = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    now = _checksum(star)
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lower, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = written(small, "star")
        was, now = now, _checksum(new)
        if was == now:
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        star = new


def _checksum(star: DataFrame) -> tuple:
    """The number of edges and two sums over them: equal for equal sets of edges."""
    sums = [F.sum(F.xxhash64(F.lit(k), "u", "v").cast("decimal(38,0)")) for k in (1, 2)]
    return tuple(star.agg(F.count(F.lit(1)), *sums).first())


def linked(heads: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of the heads (node, bands) that are linked to another."""
    band = heads.select("node", F.explode("bands").alias("band"))
    shared = written(band.groupBy("band").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    member = written(band.join(shared.hint("merge"), "band"), "members")
    texts = written(
        docs.select(row_key().alias("key"), c("text").alias("text")).join(member.select(F.col("node").alias("key")).distinct().hint("merge"), "key", "left_semi").dropDuplicates(["key"]), "texts"
    )
    pairs = member.where("node <> first").groupBy(F.col("first").alias("a"), F.col("node").alias("b")).agg(F.max("n").alias("n"))
    close = written(similarities(pairs, texts), "pairs")
    root = components(close.where(F.col("similarity") >= threshold))

    # The bands that still hold several components.
    labelled = member.select("band", "node").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = labelled.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most")).where("n > most.n").select("band", "n", F.col("most.root").alias("main"), (F.col("n") - F.col("most.n")).alias("rest"))
    inside = written(labelled.join(several.hint("merge"), "band"), "open")
    few = inside.where(F.col("rest") <= REST)
    x = few.where("root <> main").select("band", F.col("node").alias("x"), F.col("root").alias("x_root"))
    met = few.select("band", "node", "root", "n").join(x.hint("merge"), "band").where("root <> x_root")
    late = met.groupBy(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).agg(F.max("n").alias("n"))
    many = inside.where(F.col("rest") > REST)
    if not many.isEmpty():
        rare = rare_pairs(many.select(F.col("node").alias("key"), "root").distinct(), texts, threshold)
        late = late.unionByName(rare.withColumn("n", F.lit(64 * PART).cast("long"))).groupBy("a", "b").agg(F.max("n").alias("n"))
    more = written(similarities(late.join(close.hint("merge"), ["a", "b"], "left_anti"), texts), "pairs")
    return components(close.unionByName(more).where(F.col("similarity") >= threshold).select("a", "b"))


def groups(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, key, keep_id, keep_key of every document in a group of two or more; the one of keep_key stays.

    Nothing but counts and least values is worked out a group, so its size is no matter; what is joined to
    the rows of a group is one row, and adaptive execution splits the rows of a large one.
    """
    signs = written(signed(docs, bands, rows), "signatures")
    heads = written(signs.groupBy("content", "content2").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")), "heads")
    root = linked(heads.select("node", "bands"), docs, threshold)
    of = heads.select("content", "content2", "node", "n").join(root, "node", "left").where("n > 1 or root is not null").select("content", "content2", F.coalesce("root", "node").alias("root"))
    members = written(signs.select("doc_id", "key", "content", "content2").join(of.hint("merge"), ["content", "content2"]).select("doc_id", "key", "root"), "grouped")
    least = members.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("least")).select("root", F.col("least.doc_id").alias("keep_id"), F.col("least.key").alias("keep_key"))
    return members.join(least.hint("merge"), "root").select("doc_id", "key", "keep_id", "keep_key")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id and dup_of: every document that goes, and the one of its group that stays."""
    found = written(groups(docs, **options), "groups")
    again = found.where("key = keep_key").groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A kept row that the table repeats goes n - 1 times.
    thousands = again.select("doc_id", F.col("n") - 1, F.explode(F.sequence(F.lit(0), F.expr("(n - 2) div 1000"))).alias("k")).toDF("doc_id", "n", "k")
    repeats = thousands.select("doc_id", F.col("doc_id").alias("dup_of"), F.explode(F.sequence(F.lit(1), F.least(F.lit(1000), F.col("n") - F.col("k") * 1000))).alias("_")).drop("_")
    return found.where("key <> keep_key").select("doc_id", F.col("keep_id").alias("dup_of")).unionByName(repeats)


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each group and all others; the columns of `docs`."""
    by_key = written(groups(docs, **options).groupBy("key").agg(F.first("keep_key").alias("keep_key"), F.count(F.lit(1)).alias("copies")), "keys")
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, row_key())
    gone = by_key.where("key <> keep_key or copies > 1").select(F.col("key").alias(key))
    kept = keyed.join(gone.hint("merge"), key, "left_anti")
    # A kept row that the table repeats stays once.
    repeated = by_key.where("key = keep_key and copies > 1").select(F.col("key").alias(key))
    if not repeated.isEmpty():
        kept = kept.unionByName(keyed.join(repeated.hint("merge"), key, "left_semi").dropDuplicates([key]))
    return kept.select(*[c(name) for name in docs.columns])
