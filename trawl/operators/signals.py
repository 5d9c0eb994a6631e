"""Ranking signals, the global rank and the blacklist factor (R1-R14, A13), all Column arithmetic.

`meta` is a struct with the fields url, url_without_query, domain and pld, each
the metadata record of that variant of the URL or null.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions import urls

WEIGHTS = {
    "url_total_length": 0.01,
    "url_path_length": 0.01,
    "url_subdomain": 0.1,
    "alexa_top1m": 5.0,
    "wikidata_url": 3.0,
    "dmoz_domain": 1.0,
    "dmoz_url": 1.0,
    "webdatacommons_hc": 1.0,
    "host_pagerank": 1.0,
}
FACTORS = {"adult": 0.01, "agressif": 0.001, "dangerous_material": 0.001, "phishing": 0.001, "malware": 0.001, "ddos": 0.001}
LISTED = 1_000_001.0
HC_MOST, HOST_RANK_MOST = 26214400.0, 244660.58


def clamped(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def url_total_length(url: Column) -> Column:
    """R1."""
    return clamped((F.lit(111) - F.octet_length(urls.normalized(url))) / 100.0)


def url_path_length(url: Column) -> Column:
    """R2."""
    n = sum((F.octet_length(f(url)) for f in (urls.path, urls.query, urls.fragment)), F.lit(0))
    return clamped((F.lit(101) - n) / 100.0)


def url_subdomain(url: Column) -> Column:
    """R3."""
    return F.when(urls.normalized_subdomain(url) == "", 1.0).otherwise(0.0)


def popularity(rank: Column) -> Column:
    """1 - log(rank)^2 in the base of the list's length."""
    return F.when(rank > 0, F.lit(1.0) - F.pow(F.ln(rank) / F.ln(F.lit(LISTED)), F.lit(2.0)))


def alexa_top1m(meta: Column) -> Column:
    """A hit on the pay-level domain alone counts 0.7."""
    return F.coalesce(popularity(meta["domain"]["alexa_top1m"]), F.lit(0.7) * popularity(meta["pld"]["alexa_top1m"]))


def wikidata_url(meta: Column) -> Column:
    """R5."""
    links = F.greatest(*[F.coalesce(meta[k]["wikidata_sitelinks"], F.lit(0)) for k in ("url", "url_without_query")])
    return F.least(F.lit(1.0), F.sqrt(links / 200.0))


def _titled(meta: Column, key: str) -> Column:
    return (F.coalesce(meta[key]["dmoz_title"], F.lit("")) != "").cast("double")


def dmoz_domain(meta: Column) -> Column:
    """R6."""
    return _titled(meta, "domain")


def dmoz_url(meta: Column) -> Column:
    """R7."""
    return F.greatest(_titled(meta, "url"), _titled(meta, "url_without_query"))


def webdatacommons_hc(meta: Column) -> Column:
    """R8."""
    v = meta["domain"]["webdatacommons_hc"].cast("double")
    return F.when(v != 0, clamped(v / HC_MOST))


def host_pagerank(meta: Column) -> Column:
    """R9."""
    v = meta["domain"]["host_pagerank"].cast("double")
    return F.when(v != 0, clamped(v / HOST_RANK_MOST))


def categories(meta: Column) -> Column:
    """The blacklist categories of all four variants."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.flatten(F.array(*[F.coalesce(meta[k]["ut1_blacklist"], none) for k in ("url", "url_without_query", "domain", "pld")])))


def all_signals(url: Column, meta: Column) -> dict[str, Column]:
    return {
        "url_total_length": url_total_length(url),
        "url_path_length": url_path_length(url),
        "url_subdomain": url_subdomain(url),
        "alexa_top1m": alexa_top1m(meta),
        "wikidata_url": wikidata_url(meta),
        "dmoz_domain": dmoz_domain(meta),
        "dmoz_url": dmoz_url(meta),
        "webdatacommons_hc": webdatacommons_hc(meta),
        "host_pagerank": host_pagerank(meta),
    }


def weighted_rank(values: Mapping[str, Column]) -> Column:
    """The weighted mean; a missing signal still counts in the denominator."""
    return reduce(add, [F.lit(w) * F.coalesce(values[k], F.lit(0.0)) for k, w in WEIGHTS.items() if k in values]) / F.lit(sum(WEIGHTS.values()))


def blacklist_factor(found: Column) -> Column:
    """The least factor of the categories."""
    cases = [F.when(F.array_contains(found, k), f) for k, f in FACTORS.items()]
    return F.coalesce(F.least(*cases), F.lit(1.0))


def global_rank(url: Column, meta: Column, override: Column | None = None) -> Column:
    """R11 times R12; an override takes the place of both."""
    rank = weighted_rank(all_signals(url, meta)) * blacklist_factor(categories(meta))
    return rank if override is None else F.coalesce(override, rank)


def breakdown(url: Column, meta: Column) -> Column:
    """A struct of every signal."""
    return F.struct(*[v.alias(k) for k, v in all_signals(url, meta).items()])
