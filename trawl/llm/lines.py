"""Operator 4: line dedup by site-relative frequency.

Pages are grouped by host.  A line that stands on more than `ratio` of a host's
pages (and on `min_pages` at least, so that the only page of a host keeps its
lines) is boilerplate of that host and is dropped from its pages.  Hosts and lines
are counted before they are shuffled, and pages don't move: the boilerplate lines,
at most (lines a page) / ratio a host, are broadcast where they fit, else pages
are joined to them in parts of a host.

A page without a host keeps all its lines.  A null text gives an empty one.
Repeated rows are pages of their own; lines compare without outer white space.
Of the columns only `keep` stay.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import BROADCAST_BYTES, c
from trawl.scratch import written

RATIO = 0.3
MIN_PAGES = 2
PART_PAGES = 100_000
WHITE = " \t\r\f\v\u00a0"
HOST = r"^(?:[^:/?#]+:)?//(?:[^/?#@]*@)?([^/?#:]+)"
HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>|<!--.*?-->"
BLOCK = r"(?i)</?(address|article|aside|blockquote|body|br|button|caption|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|legend|li|link|main|meta|nav|noscript|ol|option|p|pre|section|select|summary|table|tbody|td|textarea|tfoot|th|thead|title|tr|ul)\b[^>]*>"
TAG = r"<[^>]*>"
#: Character references that pages write for plain characters; `&amp;` last, so that none is read twice.
REFERENCES = {"&nbsp;": "\u00a0", "&#160;": "\u00a0", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """The text of a page, a line for each block element."""
    text = F.regexp_replace(html, HIDDEN, "\n")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    for reference, plain in REFERENCES.items():
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def line_dedup(pages: DataFrame, host: Column, text: Column, keep: tuple[str, ...] = ("page_id", "url"), ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """`keep`, host, the kept text, the numbers of lines and of dropped lines."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(WHITE))), lambda x: x != "")
    cut = pages.select(*[c(name).alias(f"_keep{i}") for i, name in enumerate(keep)], host.alias("_host"), lines.alias("_lines"))
    shown = cut.where("_host is not null").select("_host", F.explode(F.array_distinct(F.transform("_lines", lambda x: F.xxhash64(x)))).alias("_line"))
    counted = shown.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_pages)
    totals = pages.select(host.alias("_host")).where("_host is not null").groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    dropped = counted.join(totals, "_host").where(F.col("_n") > F.lit(ratio) * F.col("_pages")).groupBy("_host", "_pages").agg(F.collect_set("_line").alias("_common"))
    common = written(dropped, "common")
    size = common.agg(F.sum(F.octet_length("_host") + 8 * F.size("_common") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = cut.join(F.broadcast(common), "_host", "left")
    else:
        joined = _joined_in_parts(cut, common)
    kept = F.filter("_lines", lambda x: ~F.array_contains("_common", F.xxhash64(x)))
    joined = joined.withColumn("_kept", F.when(F.col("_common").isNull(), F.col("_lines")).otherwise(kept))
    return joined.select(
        *[F.col(f"_keep{i}").alias(name) for i, name in enumerate(keep)],
        F.col("_host").alias("host"),
        F.array_join("_kept", "\n").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    )


def _joined_in_parts(cut: DataFrame, common: DataFrame) -> DataFrame:
    """Pages with their host's lines, a host of very many pages in parts of about PART_PAGES.

    The numbers of parts are few enough to broadcast: only hosts of more pages than
    PART_PAGES (more for more hosts) have one.
    """
    least, size = PART_PAGES, None
    while size is None or size > BROADCAST_BYTES:
        parts = common.where(F.col("_pages") > least).select("_host", F.ceil(F.col("_pages") / PART_PAGES).alias("_parts"))
        size = parts.agg(F.sum(F.octet_length("_host") + 64)).first()[0] or 0
        least *= 2
    parts = F.broadcast(parts)
    part = F.pmod(F.xxhash64(*[F.col(k) for k in cut.columns if k.startswith("_keep")], F.size("_lines")), F.coalesce("_parts", F.lit(1)))
    pages = cut.join(parts, "_host", "left").withColumn("_part", part).drop("_parts")
    each = common.join(parts, "_host", "left").select("_host", "_common", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1).cast("long")) - 1)).alias("_part"))
    return pages.join(each.hint("merge"), ["_host", "_part"], "left").drop("_part")


def page_line_dedup(pages: DataFrame, **options) -> DataFrame:
    return line_dedup(pages, host_of(c("url")), html_lines(c("html")), **options)


_SQL_TEXT = f"regexp_replace(regexp_replace(regexp_replace(html, '{HIDDEN}', chr(10), 'g'), '{BLOCK}', chr(10), 'g'), '{TAG}', '', 'g')"
for _reference, _plain in REFERENCES.items():
    _SQL_TEXT = f"replace({_SQL_TEXT}, '{_reference}', chr({ord(_plain)}))"
_SQL_WHITE = " || ".join(f"chr({ord(x)})" for x in WHITE)
PAGES_SQL = f"""
WITH cut AS (SELECT row_number() OVER () AS k, page_id, url, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
  list_filter(list_transform(string_split(coalesce({_SQL_TEXT}, ''), chr(10)), lambda x: trim(x, {_SQL_WHITE})), lambda x: x <> '') AS lines FROM pages),
counted AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM cut WHERE host IS NOT NULL) GROUP BY ALL HAVING count(*) >= {MIN_PAGES}),
totals AS (SELECT host, count(*) AS pages FROM cut WHERE host IS NOT NULL GROUP BY host),
common AS (SELECT host, list(line) AS common FROM counted JOIN totals USING (host) WHERE n > {RATIO} * pages GROUP BY host),
kept AS (SELECT cut.*, CASE WHEN common IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(common, x)) END AS kept FROM cut LEFT JOIN common USING (host))
SELECT page_id, url, host, array_to_string(kept, chr(10)) AS text, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped FROM kept
"""
