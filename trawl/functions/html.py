"""One Arrow UDF from a page to what the pipeline needs of it.

A page is parsed once; everything derived from the struct is Column expressions.
A page that can't be parsed gives the struct of an empty page and its `error`,
so one page never costs a partition.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import quote, urljoin, urlsplit, urlunsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from trawl.functions.encoding import decode

IGNORED = frozenset("noindex button input script style iframe noscript svg canvas".split())
IGNORED_CLASSES = frozenset("nocontent robots-nocontent".split())
IGNORED_IDS = frozenset("notice-cookie-block cookiebar cookies_consent".split())
FRAME = frozenset("nav header footer".split())
FRAME_IDS = frozenset("navigation nav footer header expanded-nav mobile-nav sign_in user-bar".split())
FRAME_CLASSES = frozenset("twitter-follow-button sharetools login".split())
FRAME_ROLES = frozenset("navigation search button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HIDDEN_CLASSES = frozenset("visually-hidden visuallyhidden hidden invisible element-invisible element-hidden hide cookie-message cookieNoticeTxt cookiebar g-cookiebar cookieContainer".split())
HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
BORDERS = frozenset("body p pre blockquote ul ol li dl dt dd figure figcaption br img h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What may stand in a head; anything else begins the body, whose tags a page may leave out.
HEAD_PARTS = frozenset("html head title meta base link script style noscript template".split())
METAS = frozenset(("description", "og:description", "og:title"))
NESTING = 300
#: A batch is worked on in slices of so many rows or bytes, so that its Python objects are not there at once.
SLICE_ROWS, SLICE_BYTES = 256, 1_000_000
NETLOC = re.compile(r"^[a-zA-Z0-9-]+\.[a-zA-Z0-9.:-]+$")

LINKS = pa.list_(pa.struct([("href", pa.string()), ("text", pa.string()), ("rel", pa.string())]))
PARSED = pa.struct(
    [
        ("title", pa.string()),
        ("head_metas", pa.map_(pa.string(), pa.string())),
        ("canonical_href", pa.string()),
        ("base_url", pa.string()),
        ("word_groups", pa.list_(pa.struct([("words", pa.string()), ("tag", pa.string())]))),
        ("internal_hyperlinks", LINKS),
        ("external_hyperlinks", LINKS),
        ("error", pa.string()),
    ]
)
TYPE = from_arrow_type(PARSED)


class _Page(HTMLParser):
    """Collects while it reads; `stack` holds (tag, ignored, hidden, boilerplate, bypass)."""

    def __init__(self, url: str):
        super().__init__(convert_charrefs=True)
        self.url = url
        self.titles: list[str] = []
        self.in_title = False
        self.metas: dict[str, str] = {}
        self.canonical: str | None = None
        self.base: str | None = None
        self.groups: list[dict[str, str]] = []
        self.links: list[dict] = []
        self.words: list[str] = []
        self.stack: list[tuple[str, bool, bool, bool, bool]] = []
        self.link: dict | None = None

    def _close_group(self, tag: str | None = None) -> None:
        words = " ".join("".join(self.words).split())
        self.words.clear()
        if words:
            self.groups.append({"words": words, "tag": tag or self._tag()})

    def _tag(self) -> str:
        return next((x[0] for x in reversed(self.stack) if x[0] in BORDERS), "body")

    def _end_head(self) -> None:
        for i, x in enumerate(self.stack[:2]):
            if x[0] == "head":
                del self.stack[i:]
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in reversed(attrs)}
        if tag not in HEAD_PARTS:
            self._end_head()
        if tag in BORDERS:
            self._close_group()
        if tag == "title":
            self.in_title = not self.titles
        elif tag == "meta":
            name = (a.get("name") or a.get("property") or "").lower()
            if name in METAS:
                self.metas.setdefault(name, a.get("content", ""))
        elif tag == "base" and self.base is None:
            self.base = a.get("href")
        elif tag == "link" and self.canonical is None and a.get("rel", "").lower() == "canonical":
            self.canonical = a.get("href", "")
        if tag in VOID:
            return
        before = self.stack[-1] if self.stack else ("", False, False, False, False)
        classes = set(a.get("class", "").split())
        ignored = before[1] or tag in IGNORED or bool(classes & IGNORED_CLASSES) or a.get("id") in IGNORED_IDS
        hidden = before[2] or "hidden" in a or a.get("aria-hidden") == "true" or bool(classes & HIDDEN_CLASSES) or bool(HIDDEN_STYLE.search(a.get("style", "")))
        frame = before[3] or tag in FRAME or a.get("id") in FRAME_IDS or bool(classes & FRAME_CLASSES) or a.get("role") in FRAME_ROLES
        if tag == "a" and not ignored and a.get("href"):
            self.link = {"href": a["href"].strip(), "text": "", "rel": a.get("rel") or None}
            self.links.append(self.link)
        if tag == "p" and before[0] == "p":
            self.stack.pop()
        if len(self.stack) < NESTING:
            self.stack.append((tag, ignored, hidden, frame, before[4] or tag in HEADINGS))

    def handle_endtag(self, tag: str) -> None:
        if tag in BORDERS:
            self._close_group(tag)
        if tag == "title":
            self.in_title = False
        if tag == "a":
            self.link = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.titles.append(data)
            return
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._end_head()
        _, ignored, hidden, frame, bypass = self.stack[-1] if self.stack else ("", False, False, False, False)
        if ignored:
            return
        if self.link is not None:
            self.link["text"] += data
        if not hidden and (not frame or bypass) and not any(x[0] in ("head", "title") for x in self.stack[:2]):
            self.words.append(data)


def quoted(url: str) -> str:
    """X1 for one URL."""
    if url.isascii():
        return url
    p = urlsplit(url)
    return urlunsplit((p.scheme, p.netloc, quote(p.path, safe="/"), quote(p.query, safe="&?="), quote(p.fragment)))


def valid_link(url: str, href: str) -> bool:
    """F10, but for nofollow."""
    p = urlsplit(url)
    return "@" not in p.path and not href.startswith("<") and bool(NETLOC.match(p.netloc))


def canonical(href: str | None, url: str) -> str | None:
    """Absolute, on the page's own host, else None."""
    if not href:
        return None
    href = quoted(href)
    p = urlsplit(href)
    if not p.netloc or not p.scheme:
        return urljoin(url, href)
    return href if not url or p.netloc == urlsplit(url).netloc else None


def parse(text: str, url: str | None) -> dict:
    url = url or ""
    page = _Page(url)
    page.feed(text)
    page.close()
    page._close_group()
    base = urljoin(url, page.base) if page.base else url
    host = urlsplit(url).netloc.lower()
    internal, external = [], []
    for link in page.links:
        link["text"] = link["text"].strip()
        try:
            whole = quoted(urljoin(base, link["href"]))
            p = urlsplit(whole)
        except ValueError:
            continue
        if not link["href"] or p.scheme not in ("http", "https"):
            continue
        if p.netloc.lower() == host:
            if urlsplit(link["href"]).netloc:
                link["href"] = urlunsplit(("", "", p.path, p.query, p.fragment))
            internal.append(link)
        elif valid_link(whole, link["href"]):
            external.append(link | {"href": urlunsplit(p._replace(netloc=p.netloc.lower()))})
    return {
        "title": page.titles and " ".join("".join(page.titles).split()) or None,
        "head_metas": list(page.metas.items()),
        "canonical_href": canonical(page.canonical, url),
        "base_url": page.base,
        "word_groups": page.groups,
        "internal_hyperlinks": internal,
        "external_hyperlinks": external,
        "error": None,
    }


EMPTY = {"title": None, "head_metas": [], "canonical_href": None, "base_url": None, "word_groups": [], "internal_hyperlinks": [], "external_hyperlinks": []}


def _slices(first: pa.Array) -> Iterator[slice]:
    sizes = np.zeros(len(first), np.int64) if pa.types.is_list(first.type) else pc.fill_null(pc.binary_length(first), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(first):
        full = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE_BYTES, "right"))
        end = min(max(full, start + 1), start + SLICE_ROWS, len(first))
        yield slice(start, end)
        start = end


def _sliced(made: Callable[..., list], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """The array of what `made` makes of the columns' lists, slice by slice."""
    parts = [pa.array(made(*[column[at].to_pylist() for column in columns]), kind) for at in _slices(columns[0])]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _parsed(texts: list, links: list) -> list[dict]:
    out = []
    for text, url in zip(texts, links):
        try:
            out.append(EMPTY | {"error": None} if text is None else parse(text, url))
        except Exception as error:  # noqa: BLE001 - one bad page must not end the partition (E13)
            out.append(EMPTY | {"error": f"{type(error).__name__}: {error}"})
    return out


@F.arrow_udf(TYPE)
def parse_text(html: pa.Array, url: pa.Array) -> pa.Array:
    return _sliced(_parsed, PARSED, html, url)


@F.arrow_udf(TYPE)
def parse_bytes(body: pa.Array, url: pa.Array, content_type: pa.Array) -> pa.Array:
    made = lambda bodies, links, types: _parsed([None if b is None else decode(b, t) for b, t in zip(bodies, types)], links)
    return _sliced(made, PARSED, body, url, content_type)


def internal_links(parsed: Column, exclude_nofollow: bool = False) -> Column:
    """Unresolved paths and texts."""
    return F.transform(_followed(parsed["internal_hyperlinks"], exclude_nofollow), lambda x: F.struct(x["href"].alias("path"), x["text"].alias("text")))


def external_links(parsed: Column, exclude_nofollow: bool = False) -> Column:
    """G3."""
    return F.transform(_followed(parsed["external_hyperlinks"], exclude_nofollow), lambda x: F.struct(x["href"].alias("href"), x["text"].alias("text")))


def _followed(links: Column, exclude_nofollow: bool) -> Column:
    return F.filter(links, lambda x: F.coalesce(x["rel"], F.lit("")) != "nofollow") if exclude_nofollow else links


@F.arrow_udf(T.ArrayType(T.StringType()))
def resolve(base: pa.Array, hrefs: pa.Array) -> pa.Array:
    """X12 for arrays of references."""
    made = lambda links, bases: [None if h is None else [quoted(urljoin(b or "", x)) for x in h] for h, b in zip(links, bases)]
    return _sliced(made, pa.list_(pa.string()), hrefs, base)


def hyperlinks(parsed: Column, url: Column, exclude_nofollow: bool = False) -> Column:
    """All valid links resolved, internal ones first."""
    own, other = (_followed(parsed[k], exclude_nofollow) for k in ("internal_hyperlinks", "external_hyperlinks"))
    base = F.coalesce(parsed["base_url"], url)
    whole = F.arrays_zip(resolve(base, own["href"]).alias("href"), own["text"].alias("text"))
    host = lambda x: F.regexp_extract(x["href"], r"^(?:[^:/?#]+:)?//([^/?#]*)", 1)
    pathed = lambda x: F.regexp_extract(x["href"], r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    good = F.filter(whole, lambda x: ~pathed(x).contains("@") & host(x).rlike(NETLOC.pattern))
    return F.concat(F.transform(good, lambda x: F.struct(x["href"].alias("href"), x["text"].alias("text"))), F.transform(other, lambda x: F.struct(x["href"].alias("href"), x["text"].alias("text"))))
