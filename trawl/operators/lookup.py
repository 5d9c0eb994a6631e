"""The join of documents to the static URL records by four variants of their URL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions import urls

RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("alexa_top1m", T.IntegerType()),
        T.StructField("dmoz_title", T.StringType()),
        T.StructField("dmoz_description", T.StringType()),
        T.StructField("ut1_blacklist", T.ArrayType(T.StringType())),
        T.StructField("webdatacommons_hc", T.FloatType()),
        T.StructField("wikidata_title", T.StringType()),
        T.StructField("wikidata_description", T.StringType()),
        T.StructField("wikidata_sitelinks", T.IntegerType()),
        T.StructField("host_pagerank", T.FloatType()),
    ]
)
VARIANTS = {"url": urls.normalized, "url_without_query": urls.normalized_without_query, "domain": urls.normalized_domain, "pld": urls.pld}


def merged(*datasets: DataFrame) -> DataFrame:
    """One record a key from datasets that hold some of its fields.

    A field that several rows give takes the value of the last dataset, and of the
    greatest value inside it; categories add up without repeats.
    """
    aligned = []
    for n, df in enumerate(datasets):
        own = set(df.columns)
        aligned.append(df.select(*[F.col(f.name).cast(f.dataType) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD], F.lit(n).alias("_n")))
    rows = aligned[0]
    for df in aligned[1:]:
        rows = rows.unionByName(df)
    aggregates = []
    for f in RECORD.fields[1:]:
        if isinstance(f.dataType, T.ArrayType):
            found = F.array_sort(F.array_distinct(F.flatten(F.collect_list(f.name))))
            aggregates.append(F.when(F.size(found) > 0, found).alias(f.name))
        else:
            latest = F.max(F.when(F.col(f.name).isNotNull(), F.struct("_n", F.col(f.name).alias("v"))))
            aggregates.append(latest["v"].alias(f.name))
    return rows.where("key is not null").groupBy("key").agg(*aggregates)


def looked_up(docs: DataFrame, records: DataFrame, url: str = "url", key: str = "id") -> DataFrame:
    """`docs` with `meta`, a struct of the four records; null where a key has none.

    The variants of all documents are joined in one exchange and packed again by
    document; a table that fits is broadcast by the optimizer's own size check.
    """
    variants = F.array(*[F.struct(F.lit(name).alias("variant"), f(F.col(url)).alias("key")) for name, f in VARIANTS.items()])
    keys = docs.select(F.col(key).alias("_doc"), F.explode(variants).alias("_v")).select("_doc", "_v.variant", "_v.key")
    fields = F.struct(*[F.col(f.name) for f in RECORD])
    found = keys.join(records.select(*RECORD.names), "key").groupBy("_doc").agg(*[F.first(F.when(F.col("variant") == name, fields), ignorenulls=True).alias(name) for name in VARIANTS])
    packed = found.select("_doc", F.struct(*VARIANTS).alias("meta"))
    empty = F.struct(*[F.lit(None).cast(RECORD).alias(name) for name in VARIANTS])
    return docs.join(packed, docs[key] == packed["_doc"], "left").drop("_doc").withColumn("meta", F.coalesce("meta", empty))


def _begins(text: str) -> Callable[[Column], Column]:
    return lambda key: key.startswith(text)


def overridden(meta: Column, overrides: Column) -> Column:
    """`meta` with the values of a map of "variant.field" in place of its own."""
    variants = []
    for name in VARIANTS:
        fields = []
        for f in RECORD:
            own = F.try_element_at(overrides, F.lit(f"{name}.{f.name}"))
            value = F.from_json(own, f.dataType) if isinstance(f.dataType, T.ArrayType) else own.cast(f.dataType)
            fields.append(F.coalesce(value, meta[name][f.name]).alias(f.name))
        touched = F.exists(F.coalesce(F.map_keys(overrides), F.array().cast("array<string>")), _begins(f"{name}."))
        variants.append(F.when(touched, F.struct(*fields)).otherwise(meta[name]).alias(name))
    return F.struct(*variants)
