"""Plugins: filters, columns added to the metadata table, and actions on it."""

from __future__ import annotations

import importlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from trawl.operators import filters, links
from trawl.plans.sinks import save

ABORT = object()


def parse_spec(spec: str) -> tuple[str, dict]:
    """`name`, `name:k=v,k=v`, `name:{json}` or `name:value`."""
    name, colon, raw = spec.partition(":")
    if not colon:
        return name, {}
    if raw.startswith("{"):
        return name, json.loads(raw)
    if re.match(r"[a-zA-Z0-9_]+=", raw):
        return name, dict(item.split("=", 1) for item in raw.split(","))
    return name, {name: raw}


class Plugin:
    """Overrides what it needs; `before` sees unparsed pages, `columns` parsed ones, `action` the metadata table."""

    def __init__(self, args: dict):
        self.args = args

    def url_filter(self) -> filters.UrlFilter | None:
        return None

    def before(self, pages: DataFrame) -> DataFrame:
        return pages

    def columns(self, df: DataFrame) -> DataFrame:
        return df

    added: tuple[str, ...] = ()

    def action(self, df: DataFrame):
        """True when it ran the pipeline, ABORT when no later action may."""
        return False

    def save(self, df: DataFrame, format: str, ordered: bool = False) -> None:
        """In `coalesce` files, 1 by default.  The work before is done by all tasks; only an ordered result is gathered as it is."""
        options = {k: self.args[k] for k in ("gzip",) if k in self.args}
        parts = int(self.args.get("coalesce", 1))
        if parts and not ordered:
            df = df.repartition(parts)
        save(df, self.args["output"], format, parts if ordered else 0, **options)


class Filter(Plugin):
    kind: type[filters.UrlFilter] = filters.All

    def url_filter(self) -> filters.UrlFilter:
        return self.kind.from_args(self.args)


class FilterAll(Filter):
    kind = filters.All


class FilterHomepages(Filter):
    kind = filters.Homepages


class FilterDomains(Filter):
    kind = filters.Domains


class GrepWords(Plugin):
    """P1; args: words, output."""

    added = ("grep_words",)

    def columns(self, df: DataFrame) -> DataFrame:
        return links.grep(df, df["parsed"]["title"], df["parsed"]["word_groups"], self.args["words"].split(" "))

    def action(self, df: DataFrame) -> bool:
        self.save(links.grep_lines(df), "text")
        return True


class ExternalLinks(Plugin):
    added = ("external_links",)

    def columns(self, df: DataFrame) -> DataFrame:
        follow = str(self.args.get("include_nofollow")) == "1"
        return df.withColumn("external_links", links.external(df["parsed"], not follow))


class Backlinks(ExternalLinks):
    """P2; args: domain, limit, output."""

    def action(self, df: DataFrame) -> bool:
        found = links.backlinks(df, self.args["domain"], int(self.args["limit"]) if "limit" in self.args else None)
        self.save(found.selectExpr("concat_ws(' ', url_to, cast(links AS string), array_join(sources, ',')) AS r"), "text", ordered=True)
        return True


class DomainToDomain(ExternalLinks):
    """P3."""

    def action(self, df: DataFrame) -> bool:
        self.save(links.domain_lines(df), "text")
        return True


class DomainToDomainParquet(ExternalLinks):
    """P4, K4; args: output, coalesce, coalesce_vertices, coalesce_edges."""

    added = ("external_links", "internal_links")

    def columns(self, df: DataFrame) -> DataFrame:
        return super().columns(df).withColumn("internal_links", links.internal(df["parsed"]))

    def action(self, df: DataFrame) -> bool:
        for name, made in (("vertices", links.vertices), ("edges", links.edges)):
            parts, out = int(self.args.get(f"coalesce_{name}", self.args.get("coalesce", 1))), made(df)
            save(out.repartition(parts) if parts else out, f"{self.args['output']}/{name}", "parquet", mode="overwrite")
        return True


class DocumentMetadata(Plugin):
    """P5; args: output, format, abort."""

    def action(self, df: DataFrame):
        self.save(df, self.args.get("format", "parquet"))
        return ABORT if str(self.args.get("abort")) == "1" else True


NAMES: dict[str, type[Plugin]] = {
    "plugins.filter.All": FilterAll,
    "plugins.filter.Homepages": FilterHomepages,
    "plugins.filter.Domains": FilterDomains,
    "plugins.grep.Words": GrepWords,
    "plugins.backlinks.MostExternallyLinkedPages": Backlinks,
    "plugins.webgraph.DomainToDomain": DomainToDomain,
    "plugins.webgraph.DomainToDomainParquet": DomainToDomainParquet,
    "plugins.dump.DocumentMetadata": DocumentMetadata,
}


def load(spec: str | Plugin) -> Plugin:
    """A plugin by name, by its name without "plugins.", or by a dotted class path."""
    if isinstance(spec, Plugin):
        return spec
    name, args = parse_spec(spec)
    kind: Callable | None = NAMES.get(name) or NAMES.get(f"plugins.{name}")
    if kind is None:
        module, _, attribute = name.rpartition(".")
        if not module:
            raise ValueError(f"no plugin called {name!r}; known: {sorted(NAMES)}")
        kind = getattr(importlib.import_module(module), attribute)
    return kind(args)


def act(plugins: list[Plugin], df: DataFrame) -> bool:
    """Run the actions in order until one aborts (E2, E7); whether any ran the pipeline."""
    ran = False
    for plugin in plugins:
        said = plugin.action(df)
        ran = ran or bool(said)
        if said is ABORT:
            break
    return ran
