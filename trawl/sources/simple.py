"""Inline corpora, tables, fetched URLs, repository records, entities, metadata dumps."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice
from urllib.parse import quote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.sources import PAGE, per_source

DOCS = "url string, content string, headers map<string,string>, rank double, index_level int"


def _overrides(extra: dict | None) -> dict[str, str] | None:
    return {f"{v}.{k}": x if isinstance(x, str) else json.dumps(x) for v, own in extra.items() for k, x in own.items()} if extra else None


def corpus(spark: SparkSession, docs: list[dict] | str | None = None, path: str | None = None, maxdocs: int | str | None = None, corpus: str | None = None, persist=None, block=None) -> DataFrame:
    """Documents with url, content, optional headers and metadata overrides.

    `docs` is a list (each document a source of its own), `path` a JSON array file.
    """
    if docs is None:
        read = spark.read.schema("url string, content string, headers map<string,string>, url_metadata_extra map<string,map<string,string>>").option("multiLine", True).json(path or corpus)
        pairs = F.flatten(F.transform(F.map_entries("url_metadata_extra"), lambda v: F.transform(F.map_entries(v["value"]), lambda f: F.struct(F.concat(v["key"], F.lit("."), f["key"]).alias("key"), f["value"]))))
        rows = read.select("url", "content", "headers", F.map_from_entries(pairs).alias("overrides"), F.lit(path or corpus).alias("source_path"), F.monotonically_increasing_id().alias("pos"))
    else:
        docs = json.loads(docs) if isinstance(docs, str) else docs
        data = [(d["url"], d["content"], d.get("headers"), _overrides(d.get("url_metadata_extra")), str(n), 0) for n, d in enumerate(docs)]
        rows = spark.createDataFrame(data, "url string, content string, headers map<string,string>, overrides map<string,string>, source_path string, pos long")
    whole = rows.select("url", "headers", F.lit("html").alias("doc_type"), F.encode("content", "UTF-8").alias("body"), "source_path", "pos", "overrides")
    return per_source(whole, maxdocs)


def table(spark: SparkSession, path: str, url: str = "url", html: str = "html", format: str = "parquet", maxdocs: int | str | None = None) -> DataFrame:
    """Pages of a table; the text column is taken as UTF-8."""
    df = spark.read.format(format).load(path)
    rows = df.select(F.col(url).alias("url"), F.lit(None).cast("map<string,string>").alias("headers"), F.lit("html").alias("doc_type"), F.encode(html, "UTF-8").alias("body"), F.col("_metadata.file_path").alias("source_path"), F.monotonically_increasing_id().alias("pos"))
    return per_source(rows, maxdocs)


def _fetch(url: str) -> tuple[int, dict[str, str], bytes]:
    from urllib.request import urlopen

    with urlopen(url, timeout=30) as answer:  # noqa: S310
        return answer.status, {k.lower(): v for k, v in answer.headers.items()}, answer.read()


def fetched(spark: SparkSession, url: str | None = None, urls: list[str] | None = None, fetch=_fetch, partitions: int = 8) -> DataFrame:
    """Pages by HTTP; only answers of status 200, always fully indexed."""
    wanted = [url] if url is not None else list(urls or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u in batch.column(0).to_pylist():
                try:
                    status, headers, body = fetch(u)
                except OSError:
                    continue
                if status == 200:
                    rows.append((u, list(headers.items()), "html", body, u, 0))
            if rows:
                kinds = (pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["url", "headers", "doc_type", "body", "source_path", "pos"])

    listed = spark.createDataFrame([(u,) for u in wanted], "url string")
    return listed.repartition(min(partitions, max(1, len(wanted)))).mapInArrow(run, PAGE).withColumn("forced_level", F.lit(2))


REGISTRY = "http://www.openarchives.org/pmh/registry/ListFriends"
_RECORD = re.compile(r"<record\b.*?</record>", re.S)
_TOKEN = re.compile(r"<resumptionToken[^>]*>\s*([^<\s]+)\s*</resumptionToken>")
DUBLIN_CORE = "header struct<_status:string>, metadata struct<`oai_dc:dc`:struct<`dc:identifier`:array<string>,`dc:title`:array<string>,`dc:description`:array<string>>>"


def registered(text: str) -> list[str]:
    """The endpoints that a registry's XML lists."""
    root = ElementTree.fromstring(text)
    return [x.text.strip() for x in root if x.tag == "baseURL" and x.text] if root.tag == "BaseURLs" else []


def harvested(endpoint: str, fetch) -> Iterator[str]:
    """The record elements of an endpoint, answer by answer until there is no resumption token."""
    ask = "verb=ListRecords&metadataPrefix=oai_dc"
    while ask:
        status, _, body = fetch(f"{endpoint}?{ask}")
        if status != 200:
            raise OSError(f"{endpoint} answered {status}")
        answer = body.decode("utf-8", "replace")
        yield from _RECORD.findall(answer)
        token = _TOKEN.search(answer)
        ask = f"verb=ListRecords&resumptionToken={quote(token.group(1))}" if token else None


def oai_records(
    spark: SparkSession,
    path: str | None = None,
    url: str | None = None,
    urls: list[str] | None = None,
    list: str | None = None,
    oai: str | None = None,
    maxdocs: int | str | None = None,
    fetch=_fetch,
) -> DataFrame:
    """Records of a repository's dumps in Dublin Core XML, or of its endpoints.

    `path` is a dump; `url` and `urls` are endpoints, `list` the address of a registry of
    them, or `openarchives`.  A task harvests one endpoint.  Deleted records and those
    without a URL as identifier are skipped; the page is made of title and description.
    """
    endpoints = [url] if url else urls
    if list:
        endpoints = registered(fetch(REGISTRY if list == "openarchives" else list)[2].decode("utf-8", "replace"))
    if endpoints is not None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for endpoint in batch.column(0).to_pylist():
                    found = harvested(endpoint, fetch)
                    while some := [*islice(found, 500)]:
                        yield pa.RecordBatch.from_arrays([pa.array([endpoint] * len(some)), pa.array(some)], ["endpoint", "record"])

        asked = spark.createDataFrame([(x,) for x in endpoints], "endpoint string").repartition(max(1, len(endpoints)))
        df = asked.mapInArrow(run, "endpoint string, record string").select("endpoint", F.from_xml("record", F.lit(DUBLIN_CORE), {"rowTag": "record"}).alias("r")).select("endpoint", "r.*")
    else:
        df = spark.read.format("xml").option("rowTag", "record").schema(DUBLIN_CORE).load(path or oai).withColumn("endpoint", F.lit(path or oai))
    dc = F.col("metadata.`oai_dc:dc`")
    address = F.get(F.filter(dc["dc:identifier"], lambda x: x.rlike("^https?://")), 0)
    plain = lambda x: F.replace(F.replace(F.coalesce(F.array_join(x, " "), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><title>"), plain(dc["dc:title"]), F.lit("</title></head><body><p>"), plain(dc["dc:description"]), F.lit("</p></body></html>"))
    rows = df.where(F.coalesce(F.col("header._status"), F.lit("")) != "deleted").select(
        address.alias("url"), F.lit(None).cast("map<string,string>").alias("headers"), F.lit("html").alias("doc_type"), F.encode(page, "UTF-8").alias("body"), F.col("endpoint").alias("source_path"), F.monotonically_increasing_id().alias("pos")
    )
    return per_source(rows.where("url is not null"), maxdocs).withColumn("forced_level", F.lit(2))


def entities(spark: SparkSession, path: str | None = None, wikidata: str | None = None, maxdocs: int | str | None = None) -> DataFrame:
    """Documents without bodies, one an entity with a website."""
    from trawl.sources.datasets import entity_dump

    rows = entity_dump(spark, path or wikidata).select(
        F.concat(F.lit("http://"), "key").alias("url"), F.lit(None).cast("map<string,string>").alias("headers"), F.lit("html").alias("doc_type"), F.lit(b"").alias("body"), F.lit("entities").alias("source_path"), F.monotonically_increasing_id().alias("pos")
    )
    return per_source(rows, maxdocs)


def metadata(spark: SparkSession, path: str | None = None, format: str = "parquet", maxdocs: int | str | None = None, fields: str | None = None, metadata: str | None = None) -> DataFrame:
    """A dump of the metadata table, parsed already; `maxdocs` counts all of it."""
    df = spark.read.format(format).load(path or metadata)
    df = df if maxdocs is None else df.limit(int(maxdocs))
    return df if not fields else df.select(*fields.split("+"))
