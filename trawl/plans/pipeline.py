"""Pages to ranked, indexed documents: one lazy DataFrame.

source -> URL filters -> parse (the one crossing to Python) -> language, words,
title, summary -> URL records -> rank -> plugins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trawl import sources
from trawl.functions import html, ids, language, text, urls
from trawl.operators import filters, lookup, search, signals
from trawl.plans.plugins import Plugin, act, load, parse_spec
from trawl.plans.sinks import save
from trawl.scratch import page_batches, written

BASE = ("id", "url", "rank", "error")


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with `parsed` and their canonical `url`; the address they came from is `source_url`."""
    source = urls.quoted(F.col("url"))
    content_type = F.try_element_at("headers", F.lit("content-type"))
    doc = pages.withColumn("source_url", source).withColumn("parsed", F.when(F.col("doc_type") == "html", html.parse_bytes("body", "source_url", content_type)))
    return doc.withColumn("url", F.coalesce("parsed.canonical_href", "source_url")).drop("body")


def parsed_text(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """The same for a table whose pages are text already."""
    doc = pages.withColumn("source_url", urls.quoted(F.col(url)))
    return doc.withColumn("parsed", html.parse_text(page, "source_url")).withColumn("url", F.coalesce("parsed.canonical_href", "source_url"))


def enriched(docs: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """id, langs, words, title, summary, inferred words, meta and rank of parsed documents."""
    return ranked(described(docs), records)


def described(docs: DataFrame) -> DataFrame:
    """What comes from the page alone: id, langs, words, title, summary and inferred words."""
    url, source, p = F.col("url"), F.col("source_url"), F.col("parsed")
    body = F.array_join(F.transform(p["word_groups"], lambda g: g["words"]), " ")
    df = docs.withColumns(
        {
            "id": ids.url_id(url),
            "error": p["error"],
            "body": body,
            "langs": language.weights(F.concat_ws(" ", p["title"], body)),
            "domain": urls.normalized_domain(url),
            "title": text.title(p["title"], p["head_metas"], source),
            "summary": text.summary(p["head_metas"], p["word_groups"]),
            "url_words": F.slice(urls.path_words(url), 1, 50),
            "domain_words": urls.last(urls.domain_words(source), 10),
            "paid_domain_words": urls.last(urls.paid_words(source), 10),
        }
    )
    seen = F.concat_ws(" ", "title", "summary")
    inferred = {f"{k}_inferred": text.infer_subwords(F.col(k), seen) for k in ("url_words", "domain_words", "paid_domain_words")}
    df = df.withColumns(inferred)
    return df.withColumns({k: F.when(F.col(k) != F.col(k.removesuffix("_inferred")), F.col(k)) for k in inferred})


def ranked(df: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """The records of the URL's variants and the rank; `override` has values that take the place of a record's or the rank."""
    url = F.col("url")
    if records is None:
        df = df.withColumn("meta", F.struct(*[F.lit(None).cast(lookup.RECORD).alias(k) for k in lookup.VARIANTS]))
    else:
        df = lookup.looked_up(df, records)
    rank = None
    if "overrides" in df.columns:
        df = df.withColumn("meta", lookup.overridden(F.col("meta"), F.col("overrides")))
        rank = F.try_element_at("overrides", F.lit("url.rank")).cast("double")
    return df.withColumn("rank", signals.global_rank(url, F.col("meta"), rank).cast("float"))


def index_docs(df: DataFrame) -> DataFrame:
    """The stored documents, of index level 1 and more."""
    return df.where("index_level >= 1").select("id", "url", "title", "summary")


def index_text(df: DataFrame) -> DataFrame:
    """What is searched; bodies at level 2 only, inferred words behind the others."""
    words = {k: F.concat(F.col(k), F.coalesce(F.col(f"{k}_inferred"), F.array().cast("array<string>"))).alias(k) for k in ("url_words", "domain_words", "paid_domain_words")}
    body = F.when(F.col("index_level") >= 2, F.col("body")).alias("body")
    return df.where("index_level >= 1").select("id", "url", "title", "summary", "domain", "rank", "langs", body, *words.values())


def metadata(df: DataFrame, plugins: Sequence[Plugin]) -> DataFrame:
    """id, url, rank, what went wrong in parsing, and the plugins' columns."""
    for plugin in plugins:
        df = plugin.columns(df)
    return df.select(*BASE, *dict.fromkeys(c for p in plugins for c in p.added))


def documents(spark: SparkSession, name: str, args: dict, plugins: Sequence[Plugin], records: DataFrame | None = None) -> DataFrame:
    """The enriched documents of one source.  Parsed pages are written once; what follows reads them (with `persist=0`, nothing is)."""
    options = {k: v for k, v in args.items() if k not in ("block", "persist")}
    pages = sources.read(spark, name, options)
    for plugin in plugins:
        pages = plugin.before(pages)
    chain = [f for p in plugins if (f := p.url_filter()) is not None]
    if "forced_level" in pages.columns:
        pages = pages.withColumn("index_level", F.col("forced_level"))
    else:
        pages = filters.filtered(pages, chain)
    docs = described(parsed(pages))
    if str(args.get("persist", "1")) == "1":
        with page_batches(docs):
            docs = written(docs, "parsed")
    return ranked(docs, records)


def run(spark: SparkSession, source_specs: Sequence[str | tuple[str, dict]], plugin_specs: Sequence[str | Plugin] = (), records: DataFrame | None = None, index: str | None = None) -> DataFrame:
    """Read the sources, index below `index`, run the plugins' actions; the metadata table.

    Later sources win over earlier ones in the index (S11).  A source with `block=1` is
    read, indexed and done with before those behind it begin.
    """
    plugins = [load(p) for p in plugin_specs]
    tables, texts, indexed = [], [], False
    specs = [parse_spec(spec) if isinstance(spec, str) else spec for spec in source_specs]
    for name, args in specs:
        if name in sources.PARSED:
            tables.append(sources.read(spark, name, args))
            continue
        docs = documents(spark, name, args, plugins, records)
        if records is not None and str(args.get("persist", "1")) == "1":
            docs = written(docs, "documents")
        texts.append(index_text(docs))
        tables.append(metadata(docs, plugins))
        if str(args.get("block")) == "1":
            tables[-1] = written(tables[-1], "block")
            if index is not None:
                search.write_index(sources.later_wins(texts), index, add=indexed)
                texts, indexed = [], True
    df = tables[0]
    for other in tables[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    if index is not None and texts:
        search.write_index(sources.later_wins(texts), index, add=indexed)
    act(plugins, df)
    return df


def add_to_index(spark: SparkSession, source_specs: Sequence[str | tuple[str, dict]], index: str, records: DataFrame | None = None, plugin_specs: Sequence[str | Plugin] = ()) -> None:
    """A later batch: its documents take the place of those of the same id (K7)."""
    plugins = [load(p) for p in plugin_specs]
    specs = [parse_spec(spec) if isinstance(spec, str) else spec for spec in source_specs]
    texts = [index_text(documents(spark, name, args, plugins, records)) for name, args in specs]
    search.write_index(sources.later_wins(texts), index, add=True)


def popular_index(spark: SparkSession, popularity_path: str, index: str, n: int | None = None) -> None:
    """A small index for development: the pages of the n most popular hosts, ranked 0.5 - 0.0001 * place."""
    from trawl.sources.datasets import popularity

    listed = popularity(spark, popularity_path).where("key is not null")
    if n is not None:
        listed = listed.where(F.col("alexa_top1m") <= n)
    address = F.concat(F.lit("http://"), "key", F.lit("/"))
    docs = described(parsed_text(listed.select(address.alias("url"), F.lit("").alias("html"), "alexa_top1m", F.lit(2).alias("index_level"))))
    place = F.greatest(F.lit(0.0), F.lit(0.5) - F.lit(0.0001) * F.col("alexa_top1m"))
    search.write_index(index_text(docs.withColumn("rank", place.cast("float"))), index)


def observed(df: DataFrame, name: str = "documents") -> tuple[DataFrame, Observation]:
    """`df` and an observation that counts its rows as they pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def explain_url(spark: SparkSession, url: str, page: str, records: DataFrame | None = None) -> DataFrame:
    """One page as the pipeline sees it, with every signal."""
    docs = enriched(parsed_text(spark.createDataFrame([(url, page)], "url string, html string").withColumn("index_level", F.lit(2))), records)
    return docs.select("id", "url", "title", "summary", "langs", "rank", signals.breakdown(F.col("url"), F.col("meta")).alias("signals"), html.hyperlinks(F.col("parsed"), F.col("source_url")).alias("links"), "url_words", "domain_words", "paid_domain_words")


def search_debug(spark: SparkSession, index: str, query: str, lang: str | None = None) -> DataFrame:
    """The hits of a query with documents and the parts of their scores."""
    hits = search.search_index(spark, index, query, lang=lang, explain=True)
    return search.with_documents(hits, spark.read.parquet(f"{index}/docs"))


def reset(spark: SparkSession, index: str) -> None:
    """An empty index."""
    empty = spark.createDataFrame([], "id long, url string, title string, summary string, domain string, rank float, langs map<string,double>, body string, url_words array<string>, domain_words array<string>, paid_domain_words array<string>")
    search.write_index(empty, index)


__all__ = ["documents", "enriched", "explain_url", "index_docs", "index_text", "metadata", "observed", "parsed", "parsed_text", "reset", "run", "save", "search_debug"]
