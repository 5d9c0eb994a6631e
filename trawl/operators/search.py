"""Ranked full-text search over documents.

The index is one row a (document, field, term) with its frequency.  A query reads
the postings of its own terms only: they are partitioned by a hash of the term,
so that the scan prunes to as many files as the query has terms.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.scratch import exists, move, written

#: field -> (boost, k1, b)
FIELDS = {"title": (3.0, 1.0, 0.75), "body": (1.0, 1.2, 0.75), "url_words": (2.0, 1.0, 0.75), "domain_words": (4.0, 1.0, 0.75), "paid_domain_words": (8.0, 1.0, 0.75)}
TIE, OTHER_LANGUAGE, SIZE = 0.5, 0.002, 50
BUCKETS, BUCKET_POSTINGS, SPREAD, FILE_POSTINGS = 64, 5_000_000, 16, 1_000_000


def query_terms(query: str) -> list[str]:
    """Distinct lower-case terms in order."""
    return list(dict.fromkeys(w for w in re.split(r"[^\w]+", query.lower()) if w))


def site_of(query: str, domain: str | None = None) -> tuple[str, str | None]:
    """The query without its `site:` words, and the domain (Q1)."""
    if domain is not None:
        return query, domain
    words, kept = query.split(" "), []
    for word in words:
        if word.startswith("site:"):
            domain = word[5:]
        else:
            kept.append(word)
    return " ".join(kept), domain


def least_matches(n: int) -> int:
    """Terms that must match: a quarter may be missing (Q3)."""
    return n - n // 4


def postings(docs: DataFrame) -> DataFrame:
    """id, field, term, tf, length of documents with the columns of FIELDS.

    A field is text or an array of words; an array is taken as it is (Q9).
    """
    return _terms(docs).groupBy("id", "field", "term", "length").agg(F.sum("tf").alias("tf"))


def _fields(docs: DataFrame) -> DataFrame:
    """id, field, length and words of the documents' fields."""
    kinds = dict(docs.dtypes)
    words = {}
    for field in FIELDS:
        if field in kinds:
            found = F.split(F.lower(F.col(field)), r"[^\p{L}\p{N}_]+") if kinds[field] == "string" else F.col(field)
            words[field] = F.filter(found, lambda x: x != "")
    rows = docs.select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.coalesce(w, F.array().cast("array<string>")).alias("words")) for k, w in words.items()])).alias("f"))
    return rows.select("id", "f.field", F.size("f.words").alias("length"), "f.words")


def _frequencies(words: Column) -> Column:
    """The distinct words of an array with their numbers, counted in the row: a run of the sorted words each."""
    starts = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    runs = lambda s, b: F.transform(b, lambda at, k: F.struct(F.get(s, at).alias("term"), (F.coalesce(F.get(b, k + 1), F.size(s)) - at).cast("long").alias("tf")))
    # Arrays of one element give names to what is computed once.
    counted = F.get(F.transform(F.array(F.sort_array(words)), lambda s: F.get(F.transform(F.array(starts(s)), lambda b: runs(s, b)), 0)), 0)
    return F.when(F.size(words) > 0, counted)


def _terms(docs: DataFrame) -> DataFrame:
    """The postings of each row; rows of one id are not put together."""
    rows = _fields(docs).select("id", "field", "length", F.explode(_frequencies(F.col("words"))).alias("t"))
    return rows.select("id", "field", "t.term", "length", "t.tf")


def document_stats(docs: DataFrame) -> DataFrame:
    """`field_stats` from the documents, with the postings of each field and the most rows of one id."""
    return _stats(_lengths(docs))


def _lengths(docs: DataFrame) -> DataFrame:
    own = _fields(docs).where("length > 0").select("id", "field", "length", F.size(F.array_distinct("words")).cast("long").alias("postings"))
    return own.groupBy("id", "field").agg(F.first("length").alias("length"), F.sum("postings").alias("postings"), F.count(F.lit(1)).alias("rows"))


def _stats(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("length").alias("mean_length"), F.sum("postings").alias("postings"), F.max("rows").alias("rows"))


def field_stats(docs_postings: DataFrame) -> DataFrame:
    """Documents and mean length of each field."""
    lengths = docs_postings.groupBy("id", "field").agg(F.first("length").alias("length"))
    return lengths.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("length").alias("mean_length"))


def write_index(docs: DataFrame, path: str, add: bool = False) -> None:
    """Postings by term bucket, statistics and documents as three tables, put in place when all are whole.

    With `add`, the documents of the index stay but for those of the same id.  The number
    of buckets, and of the files that a bucket's postings are spread over, follow the
    number of postings, so that a frequent term is the work of many tasks.
    """
    spark = docs.sparkSession
    lengths, stored, before = _lengths(docs), docs.drop("body"), None
    if add and exists(spark, f"{path}/docs"):
        own = stored.select("id")
        before = spark.read.parquet(f"{path}/postings").drop("bucket").join(own, "id", "left_anti")
        kept = before.groupBy("id", "field").agg(F.first("length").alias("length"), F.count(F.lit(1)).alias("postings"), F.lit(1).cast("long").alias("rows"))
        lengths = lengths.unionByName(kept)
        stored = stored.unionByName(spark.read.parquet(f"{path}/docs").join(own, "id", "left_anti"), allowMissingColumns=True)
    stats = written(_stats(lengths), "stats")
    n, rows = stats.agg(F.coalesce(F.sum("postings"), F.lit(0)), F.coalesce(F.max("rows"), F.lit(0))).first()
    # Rows of one id are put together where there are any; else the postings move once, to their buckets.
    found = postings(docs) if rows > 1 else _terms(docs)
    found = found if before is None else found.unionByName(before)
    buckets = max(BUCKETS, -(-n // BUCKET_POSTINGS))
    spread = F.pmod(F.xxhash64("id"), F.lit(min(SPREAD, max(1, -(-n // (buckets * FILE_POSTINGS))))))
    laid = found.withColumn("bucket", (F.crc32("term") % buckets).cast("int")).repartition("bucket", spread).sortWithinPartitions("bucket", "term")
    laid.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/.next/postings")
    stats.select("field", "n_docs", "mean_length").withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/.next/stats")
    stored.write.mode("overwrite").parquet(f"{path}/.next/docs")
    for name in ("postings", "stats", "docs"):
        move(spark, f"{path}/.next/{name}", f"{path}/{name}")


def search_index(spark: SparkSession, path: str, query: str, **options) -> DataFrame:
    terms = query_terms(site_of(query)[0])
    stats = spark.read.parquet(f"{path}/stats")
    first = stats.agg(F.max("buckets")).first()[0] or BUCKETS
    buckets = sorted({zlib.crc32(t.encode()) % first for t in terms}) or [-1]
    found = spark.read.schema("id long, field string, term string, length int, tf long, bucket int").parquet(f"{path}/postings").where(F.col("bucket").isin(buckets))
    return search(spark.read.parquet(f"{path}/docs"), found, query, stats=stats, **options)


def term_scores(found: DataFrame, stats: DataFrame) -> DataFrame:
    """id, field, term and its boosted BM25 score (Q6), with document frequencies over the whole index (Q7).

    As the fields are searched as if they were one, a term has the frequency of its most frequent field.
    """
    df = found.groupBy("term", "field").agg(F.count(F.lit(1)).alias("n")).groupBy("term").agg(F.max("n").alias("df"))
    total = stats.agg(F.max("n_docs").alias("total"))
    constants = F.create_map(*[x for k, v in FIELDS.items() for x in (F.lit(k), F.struct(*[F.lit(y).alias(n) for y, n in zip(v, ("boost", "k1", "b"))]))])
    joined = found.join(F.broadcast(df), "term").join(F.broadcast(stats.select("field", "mean_length")), "field").crossJoin(F.broadcast(total)).withColumn("_c", constants[F.col("field")])
    idf = F.ln(F.lit(1.0) + (F.col("total") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("_c.k1") * (F.lit(1.0) - F.col("_c.b") + F.col("_c.b") * F.col("length") / F.col("mean_length"))
    return joined.select("id", "field", "term", (F.col("_c.boost") * idf * F.col("tf") * (F.col("_c.k1") + 1.0) / (F.col("tf") + norm)).alias("score"))


def search(docs: DataFrame, docs_postings: DataFrame, query: str, lang: str | None = None, domain: str | None = None, size: int = SIZE, stats: DataFrame | None = None, explain: bool = False) -> DataFrame:
    """id, score and rank of the best documents.

    Per term the best field counts whole and the others by half (Q3); the sum is
    multiplied by the document's rank (Q4) and by the weight of the language (Q5).
    `docs` may have rank, langs (a map) and domain.  With `explain` the parts of the
    score come as an array (X32).
    """
    query, domain = site_of(query, domain)
    terms = query_terms(query)
    stats = field_stats(docs_postings) if stats is None else stats
    found = docs_postings.where(F.col("term").isin(*terms) if terms else F.lit(False))
    scored = term_scores(found, stats)
    best = F.max("score")
    by_term = scored.groupBy("id", "term").agg((best + F.lit(TIE) * (F.sum("score") - best)).alias("score"), F.sort_array(F.collect_list(F.struct("field", "score"))).alias("fields"))
    matched = by_term.groupBy("id").agg(F.sum("score").alias("text_score"), F.count(F.lit(1)).alias("matched"), F.sort_array(F.collect_list(F.struct("term", "score", "fields"))).alias("explain")).where(F.col("matched") >= least_matches(len(terms)))
    own = docs.select("id", *[c for c in ("rank", "langs", "domain") if c in docs.columns])
    if domain is not None:
        own = own.where(F.col("domain") == domain)
    joined = matched.join(own, "id")
    score = F.col("text_score")
    if "rank" in own.columns:
        score = score * F.coalesce(F.col("rank").cast("double"), F.lit(0.0))
    if lang is not None and "langs" in own.columns:
        score = score * F.coalesce(F.try_element_at("langs", F.lit(lang)).cast("double"), F.lit(OTHER_LANGUAGE))
    out = joined.withColumn("score", score).orderBy(F.col("score").desc(), "id").limit(size)
    keep = ["id", "score", *(["rank"] if "rank" in own.columns else []), *(["explain"] if explain else [])]
    return out.select(*keep).orderBy(F.col("score").desc(), "id")


def with_documents(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """The hits with url, title and summary, best first."""
    return hits.join(docs.select("id", "url", "title", "summary"), "id").orderBy(F.col("score").desc(), "id")
