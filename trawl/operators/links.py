"""Links, backlinks and the domain graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import html, ids, text, urls


def external(parsed: Column, exclude_nofollow: bool = True) -> Column:
    """Distinct (normalized href, text) of a page, in order (A7); null for a page without any."""
    links = F.array_distinct(F.transform(html.external_links(parsed, exclude_nofollow), lambda x: F.struct(urls.normalized(x["href"]).alias("href"), x["text"].alias("text"))))
    return F.when(F.size(links) > 0, links)


def internal(parsed: Column) -> Column:
    """Distinct (path without fragment, text) of a page, in order."""
    return F.array_distinct(F.transform(html.internal_links(parsed), lambda x: F.struct(urls.without_fragment(x["path"]).alias("path"), x["text"].alias("text"))))


def grep(df: DataFrame, title: Column, groups: Column, wanted: list[str]) -> DataFrame:
    """`df` with grep_words, those of the wanted words that a page holds (U4)."""
    return df.withColumn("grep_words", F.array_intersect(F.array(*[F.lit(w) for w in wanted]), text.all_words(title, groups)))


def grep_lines(df: DataFrame) -> DataFrame:
    """P1: "w1,w2 url" of the pages that hold a word."""
    return df.where(F.size("grep_words") > 0).select(F.concat_ws(" ", F.concat_ws(",", F.sort_array("grep_words")), "url").alias("r"))


def host(url: Column) -> Column:
    return urls.domain(url)


def pairs(df: DataFrame) -> DataFrame:
    """One row a page and external link: url, link (G1)."""
    return df.select("url", F.explode("external_links.href").alias("link"))


def backlinks(df: DataFrame, domain: str, limit: int | None = None) -> DataFrame:
    """A domain's pages by the number of links from elsewhere; `sources` in order."""
    found = (
        df.where(F.size("external_links") > 0)
        .select(F.col("url").alias("url_from"), F.explode("external_links.href").alias("url_to"))
        .where(F.regexp_extract("url_to", r"^([^/?#]*)", 1).endswith(domain))
        .groupBy(urls.without_scheme(F.col("url_to")).alias("url_to"))
        .agg(F.count(F.lit(1)).alias("links"), F.sort_array(F.collect_list("url_from")).alias("sources"))
        .orderBy(F.col("links").desc(), "url_to")
    )
    return found if limit is None else found.limit(limit)


def domain_pairs(df: DataFrame) -> DataFrame:
    """Distinct host pairs, self pairs included."""
    return pairs(df).select(host(F.col("url")).alias("d1"), F.regexp_extract("link", r"^([^/?#]*)", 1).alias("d2")).where("d1 <> '' and d2 <> ''").distinct()


def domain_lines(df: DataFrame) -> DataFrame:
    return domain_pairs(df).select(F.concat_ws(" ", "d1", "d2").alias("r"))


def vertices(df: DataFrame) -> DataFrame:
    """Id and domain of every host of a page or link; an id is computed once a host."""
    own = df.select(host(F.col("url")).alias("domain"))
    linked = pairs(df).select(F.regexp_extract("link", r"^([^/?#]*)", 1).alias("domain"))
    names = own.unionByName(linked).select(urls.normalized_host(F.trim("domain")).alias("domain")).where("domain <> ''").distinct()
    return names.select(ids.host_id(F.col("domain")).alias("id"), "domain").where("id is not null")


def edges(df: DataFrame) -> DataFrame:
    """Src, dst and weight 1 / out-degree; no self loops."""
    named = domain_pairs(df).select(urls.normalized_host(F.col("d1")).alias("a"), urls.normalized_host(F.col("d2")).alias("b")).where("a <> b").distinct()
    linked = named.select(ids.host_id(F.col("a")).alias("src"), ids.host_id(F.col("b")).alias("dst")).where("src <> dst").distinct()
    return weighted(linked)


def weighted(linked: DataFrame, kind: str = "float") -> DataFrame:
    """Degrees are counted before they are shuffled, and joined; a hub's edges are split where they are many."""
    degrees = linked.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
    return linked.join(degrees, "src").withColumn("weight", (F.lit(1.0) / F.col("_n")).cast(kind)).select(*linked.columns, "weight")


def vertex_lines(v: DataFrame) -> DataFrame:
    """K5."""
    return v.select(F.concat_ws(" ", F.col("id").cast("string"), "domain").alias("r"))


def edge_lines(e: DataFrame) -> DataFrame:
    return e.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("r"))
