"""Static URL datasets and their merge into one record a key.

Each reader gives `key` (a normalized URL or host) and its own fields of the
record.  Files may be plain or gzip, which Spark reads itself; members of zip
files are unpacked by `zip_lines`.
"""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions import urls
from trawl.operators.lookup import merged

ENTITY = "labels struct<en:struct<value:string>>, descriptions struct<en:struct<value:string>>, claims struct<P856:array<struct<mainsnak:struct<datavalue:struct<value:string>>>>>, sitelinks map<string,string>"


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """`value`, a line of any member of the zip files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        with archive.open(name) as member:
                            while lines := member.readlines(4_000_000):
                                yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace").rstrip("\r\n") for x in lines])], ["value"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "value string")


def _csv(spark: SparkSession, path: str, sep: str, schema: str) -> DataFrame:
    if path.endswith(".zip"):
        return zip_lines(spark, path).select(F.from_csv("value", F.lit(schema), {"sep": sep}).alias("r")).select("r.*")
    return spark.read.schema(schema).csv(path, sep=sep)


def popularity(spark: SparkSession, path: str) -> DataFrame:
    """rank,domain lines."""
    return _csv(spark, path, ",", "rank int, domain string").select(F.col("domain").alias("key"), F.col("rank").alias("alexa_top1m"))


def host_pagerank(spark: SparkSession, path: str) -> DataFrame:
    """"host rank" lines."""
    return _csv(spark, path, " ", "host string, rank double").select(F.col("host").alias("key"), F.col("rank").cast("float").alias("host_pagerank"))


def harmonic_centrality(spark: SparkSession, path: str) -> DataFrame:
    """host<TAB>value lines (D3)."""
    return _csv(spark, path, "\t", "host string, value double").select(F.col("host").alias("key"), F.col("value").cast("float").alias("webdatacommons_hc"))


def directory(spark: SparkSession, path: str) -> DataFrame:
    """ExternalPage elements of an RDF dump."""
    df = spark.read.format("xml").option("rowTag", "ExternalPage").schema("_about string, `d:Title` string, `d:Description` string").load(path)
    empty = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(""))
    return df.where("_about is not null").select(urls.normalized(urls.quoted(F.col("_about"))).alias("key"), empty("d:Title").alias("dmoz_title"), empty("d:Description").alias("dmoz_description"))


def tar_lines(spark: SparkSession, path: str) -> DataFrame:
    """`value` and `file`, a line of any member of tar files, packed or plain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                    for member in archive:
                        if not member.isfile():
                            continue
                        handle = archive.extractfile(member)
                        while lines := handle.readlines(4_000_000):
                            values = pa.array([x.decode("utf-8", "replace").rstrip("\r\n") for x in lines])
                            yield pa.RecordBatch.from_arrays([values, pa.array([member.name] * len(lines))], ["value", "file"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "value string, file string")


def categories(spark: SparkSession, path: str) -> DataFrame:
    """Folders of `domains` and `urls` files, each folder a category, or a tar file of them."""
    if re.search(r"\.(tar|tar\.gz|tgz)$", path):
        lines = tar_lines(spark, path).where(F.col("file").rlike("(^|/)(domains|urls)$"))
    else:
        lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "{domains,urls}").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    key = urls.normalized(urls.quoted(F.concat(F.lit("http://"), F.trim("value"))))
    named = lines.where("trim(value) <> ''").select(key.alias("key"), F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("category"))
    return named.groupBy("key").agg(F.array_sort(F.collect_set("category")).alias("ut1_blacklist"))


def entity_dump(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a line, with a comma after it; the last website counts."""
    lines = spark.read.text(path).where("value like '{%'").select(F.from_json(F.regexp_replace("value", r",\s*$", ""), ENTITY).alias("e"))
    sites = F.filter(F.transform("e.claims.P856", lambda x: x["mainsnak"]["datavalue"]["value"]), lambda x: x.isNotNull())
    named = lines.select(F.element_at(F.when(F.size(sites) > 0, sites), -1).alias("site"), "e").where("site is not null")
    empty = lambda name: F.coalesce(F.col(name), F.lit(""))
    return named.select(
        urls.normalized(urls.quoted(F.col("site"))).alias("key"),
        empty("e.labels.en.value").alias("wikidata_title"),
        empty("e.descriptions.en.value").alias("wikidata_description"),
        F.coalesce(F.size("e.sitelinks"), F.lit(0)).alias("wikidata_sitelinks"),
    )


PROVIDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "alexa_top1m": popularity,
    "ut1_blacklist": categories,
    "dmoz": directory,
    "webdatacommons_hc": harmonic_centrality,
    "host_pagerank": host_pagerank,
    "wikidata": entity_dump,
}


def imported(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The merged records of the datasets, in the providers' order."""
    if unknown := paths.keys() - PROVIDERS.keys():
        raise ValueError(f"no dataset called {sorted(unknown)}; known: {sorted(PROVIDERS)}")
    return merged(*[read(spark, paths[name]) for name, read in PROVIDERS.items() if name in paths])
