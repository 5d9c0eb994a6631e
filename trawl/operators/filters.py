"""URL filters and index levels (F1-F5): one Column, decided before anything is parsed."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import urls


@dataclass(frozen=True)
class UrlFilter:
    """What to do with the URLs that match: parse them, index them, index their bodies."""

    index: bool = False
    index_body: bool = False
    skip: bool = False

    @classmethod
    def from_args(cls, args: dict):
        on = lambda k: bool(int(args.get(k, 0)))
        return cls(on("index"), on("index_body"), on("skip"))

    def decision(self) -> tuple[bool, int]:
        level = 2 if self.index_body else int(self.index)
        return not self.skip or level > 0, level

    def matches(self, url: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class All(UrlFilter):
    """F2."""

    def matches(self, url: Column) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class Homepages(UrlFilter):
    """the path is a lone slash."""

    def matches(self, url: Column) -> Column:
        return (urls.path(url) == "/") & (urls.query(url) == "")


@dataclass(frozen=True)
class Domains(UrlFilter):
    """the authority ends in one of the names; no dot is asked for before it."""

    domains: tuple[str, ...] = ()

    @classmethod
    def from_args(cls, args: dict):
        base = UrlFilter.from_args(args)
        return cls(base.index, base.index_body, base.skip, tuple(str(args["domains"]).split(" ")))

    def matches(self, url: Column) -> Column:
        return urls.domain(url).rlike("|".join(f"(?:{re.escape(d)}$)" for d in self.domains))


def decided(url: Column, filters: Sequence[UrlFilter]) -> Column:
    """struct<parse, level> of a URL; the last filter that matches decides (F1)."""
    cases = [F.when(f.matches(url), F.struct(F.lit(p).alias("parse"), F.lit(n).alias("level"))) for f in reversed(filters) for p, n in [f.decision()]]
    return F.coalesce(*cases, F.struct(F.lit(True).alias("parse"), F.lit(0).alias("level")))


def filtered(pages: DataFrame, filters: Sequence[UrlFilter], url: str = "url") -> DataFrame:
    """The pages to parse, with their `index_level`."""
    found = pages.withColumn("_decided", decided(F.col(url), filters))
    return found.where("_decided.parse").withColumn("index_level", F.col("_decided.level")).drop("_decided")
