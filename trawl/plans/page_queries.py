"""Registered queries of parsed pages, links, sources, sinks and whole runs, with their SQL.

The pages of the tables link within their hosts only.  `_linked` gives each page links
to the pages of the next two ids besides, one of them written twice, so that there is
a graph of hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import sources
from trawl.functions import html, text
from trawl.operators import links, search
from trawl.plans import pipeline
from trawl.plans.plugins import load
from trawl.plans.queries import _ALL_URLS, _HOST, _LENGTH, _NORMALIZED, _RANK, _SUBDOMAIN, _TOTAL, _p, _search_docs, _search_sql, _t, _url_quote, _url_words
from trawl.plans.sinks import save
from trawl.scratch import new_path, page_batches, written
from trawl.sources import archives, datasets


def _linked(spark: SparkSession, d: str) -> DataFrame:
    """url and html of all pages, two links to other pages behind their texts."""
    pages = _t(spark, d, "pages")
    targets = pages.select("page_id", F.col("url").alias("to"))
    out = pages
    for k in (1, 2):
        out = out.join(targets.select((F.col("page_id") - k).alias("page_id"), F.col("to").alias(f"to{k}")), "page_id", "left")
    link = lambda name, words: F.coalesce(F.concat(F.lit(' <a href="'), F.col(name), F.lit(f'">{words}</a>')), F.lit(""))
    return out.select("page_id", "url", F.concat("html", link("to1", "next"), link("to1", "next"), link("to2", "the one behind")).alias("html"))


def _parsed(spark, d) -> DataFrame:
    """The linked pages, parsed once, with their distinct links."""
    pages = _linked(spark, d).select("page_id", "url", html.parse_text("html", "url").alias("p"))
    found = pages.select("page_id", "url", links.external(F.col("p")).alias("external_links"), links.internal(F.col("p")).alias("internal_links"))
    with page_batches(found):
        return written(found, "links")


def page_parse(spark, d):
    """Title, number of word groups and their text, as the parser finds them."""
    parsed = _t(spark, d, "pages").select("page_id", html.parse_text("html", "url").alias("p"))
    return parsed.select("page_id", F.col("p.title").alias("title"), F.size("p.word_groups").cast("long").alias("n_groups"), F.array_join(F.transform("p.word_groups", lambda g: g["words"]), "\n").alias("text"))


def page_summary(spark, d):
    """Title and summary of the parsed pages, for display."""
    parsed = _t(spark, d, "pages").select("page_id", "url", html.parse_text("html", "url").alias("p"))
    return parsed.select("page_id", text.title(F.col("p.title"), F.col("p.head_metas"), F.col("url")).alias("title"), text.summary(F.col("p.head_metas"), F.col("p.word_groups")).alias("summary"))


def page_titles(spark, d):
    """Titles and numbers of links."""
    parsed = _linked(spark, d).select("page_id", html.parse_text("html", "url").alias("p"))
    return parsed.select("page_id", F.col("p.title").alias("title"), F.size("p.internal_hyperlinks").cast("long").alias("n_internal"), F.size("p.external_hyperlinks").cast("long").alias("n_external"))


def internal_links(spark, d):
    return _parsed(spark, d).select("page_id", F.explode("internal_links").alias("l")).select("page_id", "l.path", "l.text")


def external_links(spark, d):
    return _parsed(spark, d).where(F.size("external_links") > 0).select("page_id", F.explode("external_links").alias("l")).select("page_id", "l.href", "l.text")


def page_link_pairs(spark, d):
    return links.pairs(_parsed(spark, d))


def link_counts_topk(spark, d):
    found = internal_links(spark, d).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("page_id")), ",").alias("pages"))
    return found.orderBy(F.col("n").desc(), "path").limit(20)


def resolved_links(spark, d):
    """All valid links of the pages as they are in the tables, resolved."""
    parsed = _t(spark, d, "pages").select("page_id", "url", html.parse_text("html", "url").alias("p"))
    return parsed.select("page_id", F.explode(html.hyperlinks(F.col("p"), F.col("url"))).alias("l")).select("page_id", "l.href", "l.text")


def backlinks(spark, d):
    """The pages of one domain by the number of links from elsewhere."""
    found = links.backlinks(_parsed(spark, d), "example.org")
    return found.select("url_to", "links", F.array_join("sources", ",").alias("sources"))


def backlinks_topk(spark, d):
    found = links.backlinks(_parsed(spark, d), "example.com", 25)
    return found.select("url_to", "links", F.array_join("sources", ",").alias("sources"))


def domain_pairs(spark, d):
    return links.domain_pairs(_parsed(spark, d))


def domain_lines(spark, d):
    return links.domain_lines(_parsed(spark, d))


def domain_graph_vertices(spark, d):
    """The hosts of pages and links, and whether each has an id of its own."""
    found = links.vertices(_parsed(spark, d))
    return found.groupBy("domain").agg(F.countDistinct("id").alias("ids"))


def domain_graph_edges(spark, d):
    """The weighted host graph, by the names of its vertices."""
    own = _parsed(spark, d)
    names = links.vertices(own)
    found = links.edges(own)
    for end in ("src", "dst"):
        found = found.join(names.select(F.col("id").alias(end), F.col("domain").alias(f"{end}_domain")), end)
    return found.select("src_domain", "dst_domain", F.round(F.col("weight").cast("double"), 6).alias("weight"))


def dump_roundtrip(spark, d):
    """Documents saved as JSON and Parquet, and both read again as metadata tables."""
    docs, out = _t(spark, d, "documents"), None
    for kind in ("json", "parquet"):
        path = new_path(spark, "dump")
        save(docs.select("doc_id", "source", "n_chars"), path, kind, gzip=1)
        again = sources.read(spark, "metadata", {"path": path, "format": kind, "fields": "doc_id+source+n_chars"}).withColumn("kind", F.lit(kind))
        out = again if out is None else out.unionByName(again)
    return out


def text_roundtrip(spark, d):
    """Lines saved as gzipped text."""
    path = new_path(spark, "lines")
    save(_t(spark, d, "documents").select(F.concat_ws(" ", F.col("doc_id").cast("string"), "source").alias("r")), path, "text", coalesce=2, gzip="1")
    return spark.read.text(path).withColumnRenamed("value", "r")


def table_source(spark, d):
    pages = sources.read(spark, "table", {"path": f"{d}/pages.parquet"})
    return pages.select("url", F.octet_length("body").cast("long").alias("n_bytes"))


def archive_source(spark, d):
    """The pages written as gzipped archives, one a task, and read by the archive source."""
    folder = new_path(spark, "archives").removeprefix("file://").removeprefix("file:")

    def write(batches):
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        rows = ({"url": r["url"], "content": r["html"]} for batch in batches for r in batch.to_pylist())
        archives.write_archive(rows, name)
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["path"])

    paths = [r.path for r in _t(spark, d, "pages").select("url", "html").mapInArrow(write, "path string").collect()]
    found = sources.read(spark, "webarchive", {"paths": paths})
    return found.select("url", "doc_type", F.octet_length("body").cast("long").alias("n_bytes"))


def imported_datasets(spark, d):
    """Files of every line format written from the tables, read and merged to one record a key."""
    customers = _t(spark, d, "customer").select("c_custkey", F.concat(F.lit("d"), F.col("c_custkey").cast("string"), F.lit(".com")).alias("host"))
    n, folder = F.col("c_custkey"), new_path(spark, "datasets")
    lines = {
        "alexa_top1m": F.concat_ws(",", n.cast("string"), "host"),
        "host_pagerank": F.concat_ws(" ", "host", (n % 97).cast("string")),
        "webdatacommons_hc": F.concat_ws("\t", "host", (n % 89).cast("string")),
        "wikidata": F.concat(F.lit('{"labels":{"en":{"value":"L'), n.cast("string"), F.lit('"}},"claims":{"P856":[{"mainsnak":{"datavalue":{"value":"http://'), F.col("host"), F.lit('/"}}}]},"sitelinks":{"a":"1","b":"2"}},')),
    }
    for name, line in lines.items():
        save(customers.select(line.alias("r")), f"{folder}/{name}", "text")
    paths = {name: f"{folder}/{name}" for name in lines}
    records = datasets.imported(spark, paths)
    return records.select("key", F.col("alexa_top1m").cast("long").alias("alexa"), F.col("host_pagerank").cast("double").alias("host_rank"), F.col("webdatacommons_hc").cast("double").alias("hc"), "wikidata_title", F.col("wikidata_sitelinks").cast("long").alias("sitelinks"))


def pipeline_metadata(spark, d):
    """A whole run: source, filters, parsing, ranks, the metadata table."""
    df = pipeline.run(spark, [("table", {"path": f"{d}/pages.parquet"})], ["filter.All:index_body=1", "filter.Domains:domains=example.net"])
    return df.select("url", F.round(F.col("rank").cast("double"), 5).alias("rank"), "error")


def pipeline_index_levels(spark, d):
    """What a run stores in the index: pages of level 1 and more."""
    plugins = [load(x) for x in ("filter.All:skip=1", "filter.Domains:index_body=1,domains=example.com", "filter.Domains:index=1,domains=example.org")]
    docs = pipeline.documents(spark, "table", {"path": f"{d}/pages.parquet"}, plugins)
    stored = pipeline.index_text(docs).select("url", F.col("body").isNotNull().alias("has_body"))
    return pipeline.index_docs(docs).select("url", "title").join(stored, "url")


def plugin_outputs(spark, d):
    """The text outputs of three plugins of one run over the linked pages."""
    path, out = new_path(spark, "plugins"), None
    _linked(spark, d).select("url", "html").write.parquet(f"{path}/pages")
    names = ("grep", "graph", "back")
    specs = [f"grep.Words:words=the und les,output={path}/grep", f"webgraph.DomainToDomain:output={path}/graph,coalesce=2", f"backlinks.MostExternallyLinkedPages:domain=example.org,output={path}/back"]
    pipeline.run(spark, [("table", {"path": f"{path}/pages"})], specs)
    for name in names:
        own = spark.read.schema("value string").text(f"{path}/{name}").select(F.lit(name).alias("plugin"), F.col("value").alias("r"))
        out = own if out is None else out.unionByName(own)
    return out


def metadata_rescan(spark, d):
    """A run's dump, read again by a second run that makes the host graph of it."""
    path = new_path(spark, "rescan")
    _linked(spark, d).select("url", "html").write.parquet(f"{path}/pages")
    pipeline.run(spark, [("table", {"path": f"{path}/pages"})], ["webgraph.DomainToDomainParquet:output=" + f"{path}/graph", f"dump.DocumentMetadata:output={path}/dump,abort=1", f"webgraph.DomainToDomain:output={path}/never"])
    pipeline.run(spark, [f"metadata:path={path}/dump"], [f"webgraph.DomainToDomain:output={path}/lines"])
    return spark.read.text(f"{path}/lines").withColumnRenamed("value", "r")


def observed_rows(spark, d):
    """The number of documents that passed, as an observation of the run that wrote them."""
    df, seen = pipeline.observed(_t(spark, d, "documents"))
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"],)], "n long")


def _indexed(spark, d) -> str:
    path = new_path(spark, "index")
    search.write_index(_search_docs(spark, d).drop("langs").withColumns({"url": F.col("title"), "summary": F.lit("")}), path)
    return path


def search_site(spark, d):
    """A query with a site, over a written index."""
    hits = search.search_index(spark, _indexed(spark, d), "the and blees site:src1")
    return hits.select("id", F.round("score", 6).alias("score"))


def search_documents(spark, d):
    """Hits with their documents."""
    path = _indexed(spark, d)
    hits = search.with_documents(search.search_index(spark, path, "the and blees"), spark.read.parquet(f"{path}/docs"))
    return hits.select("id", F.round("score", 6).alias("score"), "url", "title")


def search_explained(spark, d):
    """The parts of the scores of the hits."""
    hits = search.search_index(spark, _indexed(spark, d), "the and blees", explain=True)
    return hits.select("id", F.explode("explain").alias("e")).select("id", "e.term", F.round("e.score", 6).alias("score"))


def search_url_words(spark, d):
    """Pages by the words of their addresses: fields that are arrays of words."""
    from trawl.functions import urls

    u = F.col("url")
    docs = _t(spark, d, "pages").select(F.col("page_id").alias("id"), urls.path_words(u).alias("url_words"), urls.domain_words(u).alias("domain_words"), urls.paid_words(u).alias("paid_domain_words"))
    hits = search.search(docs, search.postings(docs), "example en html", stats=search.document_stats(docs))
    return hits.select("id", F.round("score", 6).alias("score"))


def streamed_pages(spark, d):
    """The pages as a stream of files through the plan."""
    from trawl import streaming

    path = new_path(spark, "stream")
    _t(spark, d, "pages").select("url", "html").write.parquet(f"{path}/in")
    streaming.ingest(streaming.page_stream(spark, f"{path}/in", 2), f"{path}/out", f"{path}/check").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("url", "title")


# The linked pages: no link leads to the page's own host unless both hosts are the same.
_TARGETS = """(SELECT p.page_id, p.url, q.url AS target, CASE WHEN q.page_id = p.page_id + 1 THEN 'next' ELSE 'the one behind' END AS text
  FROM pages p JOIN pages q ON q.page_id IN (p.page_id + 1, p.page_id + 2))"""
_OUT = f"(SELECT * FROM {_TARGETS} WHERE lower({_p(2)}) <> lower({_p(2, 'target')}))"
_HREFS = """(SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS text FROM pages)"""
_OWN = f"""(SELECT page_id, href, text FROM {_HREFS} UNION ALL
  SELECT page_id, {_p(3, 'target')} || CASE WHEN {_p(4, 'target')} = '' THEN '' ELSE '?' || {_p(4, 'target')} END AS href, text FROM {_TARGETS} WHERE lower({_p(2)}) = lower({_p(2, 'target')}))"""
_TARGET = _NORMALIZED.replace("(url,", "(target,")
_LINKS = f"(SELECT DISTINCT page_id, url, {_TARGET} AS href, text FROM {_OUT})"
_HREF_HOST = "regexp_extract(href, '^([^/?#]*)', 1)"
_PAIRS = f"(SELECT DISTINCT {_p(2)} AS d1, {_HREF_HOST} AS d2 FROM {_LINKS})"
_BARE = lambda x: f"trim(regexp_replace(regexp_replace(trim({x}, '.'), '^(?:www\\.)+', ''), ':(?:80|443)$', ''), '.')"
_VERTICES = f"(SELECT DISTINCT {_BARE('h')} AS domain FROM (SELECT {_p(2)} AS h FROM pages UNION ALL SELECT {_HREF_HOST} FROM {_LINKS}) WHERE {_BARE('h')} <> '')"
_EDGES = f"(SELECT DISTINCT {_BARE('d1')} AS src_domain, {_BARE('d2')} AS dst_domain FROM {_PAIRS} WHERE {_BARE('d1')} <> {_BARE('d2')})"


def _backlinks(domain: str) -> str:
    return f"SELECT href AS url_to, count(*) AS links, array_to_string(list_sort(list(url)), ',') AS sources FROM {_LINKS} WHERE ends_with({_HREF_HOST}, '{domain}') GROUP BY href"


_UNESCAPED = "replace(replace(replace(replace(replace(replace(replace({}, '&quot;', '\"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
_CLEAN = r"trim(regexp_replace({}, '\s+', ' ', 'g'), ' ')"
_TITLED = _CLEAN.format(_UNESCAPED.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))
_SEEN = "html"
for _gone in ("(?is)<head>.*?</head>", "(?is)<nav>.*?</nav>", "(?is)<footer>.*?</footer>", "(?is)<script>.*?</script>", "(?is)<style>.*?</style>", "(?s)<!--.*?-->"):
    _SEEN = f"regexp_replace({_SEEN}, '{_gone}', '', 'g')"
_SEEN = f"regexp_replace(regexp_replace(regexp_replace({_SEEN}, '\\n', ' ', 'g'), '(?i)</?(?:body|p|pre|blockquote|ul|ol|li|dl|dt|dd|figure|figcaption|br|img|h[1-6])(?: [^>]*)?/?>', chr(10), 'g'), '<[^>]*>', '', 'g')"
#: Texts outside headings and paragraphs, which are no summaries: the notices before the first heading.
_BODY = _SEEN.replace("regexp_replace(html,", "regexp_replace(regexp_replace(html, '<div class=\"ad\">[^<]*</div>', '', 'g'),", 1)
_GROUPS = f"list_filter(list_transform(string_split({_UNESCAPED.format(_SEEN)}, chr(10)), lambda x: {_CLEAN.format('x')}), lambda x: x <> '')"
_CUT = r"CASE WHEN length({0}) <= {1} THEN {0} ELSE substr(regexp_replace(substr({0}, 1, {2}), '\s(\S*)$', ''), 1, {1}) || '...' END"
_PLAIN_RANK = f"(0.01::DOUBLE * {_TOTAL} + 0.01::DOUBLE * {_LENGTH} + CASE WHEN {_SUBDOMAIN} = '' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END) / 12.12::DOUBLE"


def _address_search(query: str) -> str:
    terms = search.query_terms(query)
    fields = {"url_words": _url_words(_p(3)), "domain_words": _url_words(_HOST), "paid_domain_words": _url_words(f"regexp_extract({_HOST}, '([^.]+)[.][^.]+$', 1)")}
    constants = ", ".join(f"('{k}', {search.FIELDS[k][0]}::DOUBLE, {search.FIELDS[k][1]}::DOUBLE, {search.FIELDS[k][2]}::DOUBLE)" for k in fields)
    return f"""
WITH w AS ({' UNION ALL '.join(f"SELECT page_id AS id, '{k}' AS field, {v} AS words FROM pages" for k, v in fields.items())}),
stats AS (SELECT field, avg(len(words)) AS mean_length, count(*) AS n_docs FROM w WHERE len(words) > 0 GROUP BY field),
tf AS (SELECT id, field, length, term, count(*) AS tf FROM (SELECT id, field, len(words) AS length, unnest(words) AS term FROM w) WHERE term IN ({', '.join(f"'{t}'" for t in terms)}) GROUP BY ALL),
df AS (SELECT term, max(n) AS df FROM (SELECT term, field, count(*) AS n FROM tf GROUP BY ALL) GROUP BY term), k(field, boost, k1, b) AS (VALUES {constants}),
s AS (SELECT id, term, boost * ln(1.0::DOUBLE + ((SELECT max(n_docs) FROM stats) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean_length)) AS score
  FROM tf JOIN df USING (term) JOIN stats USING (field) JOIN k USING (field)),
t AS (SELECT id, term, max(score) + {search.TIE} * (sum(score) - max(score)) AS score FROM s GROUP BY ALL),
m AS (SELECT id, sum(score) AS score FROM t GROUP BY id HAVING count(*) >= {search.least_matches(len(terms))})
SELECT id, round(score, 6) AS score FROM m ORDER BY m.score DESC, id LIMIT 50"""


_FOUND = _search_sql("the and blees", f"text_score * {_RANK}")
ORACLES = {
    "page_parse": f"SELECT page_id, {_TITLED} AS title, len({_GROUPS})::BIGINT AS n_groups, array_to_string({_GROUPS}, chr(10)) AS text FROM pages",
    "page_summary": f"""SELECT page_id, {_CUT.format('t', text.TITLE_CHARS, text.TITLE_CHARS + 1)} AS title, {_CUT.format('s', text.SUMMARY_CHARS, text.SUMMARY_CHARS + 1)} AS summary
  FROM (SELECT page_id, {_TITLED} AS t, coalesce(list_filter({_GROUPS.replace(_SEEN, _BODY)}, lambda x: strlen(x) > {text.LONG_GROUP_BYTES})[1], '') AS s FROM pages)""",
    "page_titles": f"""SELECT page_id, {_TITLED} AS title, (SELECT count(*) FROM {_HREFS} h WHERE h.page_id = pages.page_id) + (SELECT coalesce(sum(CASE WHEN text = 'next' THEN 2 ELSE 1 END), 0)::BIGINT FROM {_TARGETS} t WHERE t.page_id = pages.page_id AND lower({_p(2, 't.url')}) = lower({_p(2, 'target')})) AS n_internal,
  (SELECT coalesce(sum(CASE WHEN text = 'next' THEN 2 ELSE 1 END), 0)::BIGINT FROM {_OUT} o WHERE o.page_id = pages.page_id) AS n_external FROM pages""",
    "internal_links": f"SELECT DISTINCT page_id, regexp_replace(href, '#.*', '') AS path, text FROM {_OWN}",
    "external_links": f"SELECT page_id, href, text FROM {_LINKS}",
    "page_link_pairs": f"SELECT url, href AS link FROM {_LINKS}",
    "link_counts_topk": f"SELECT path, count(*) AS n, array_to_string(list(page_id ORDER BY page_id), ',') AS pages FROM (SELECT DISTINCT page_id, regexp_replace(href, '#.*', '') AS path, text FROM {_OWN}) GROUP BY path ORDER BY n DESC, path LIMIT 20",
    "resolved_links": f"SELECT page_id, {_p(1)} || '://' || {_p(2)} || CASE WHEN regexp_full_match(href, '[\\x00-\\x7F]*') THEN href ELSE {_url_quote('href', '/')} END AS href, text FROM {_HREFS}",
    "backlinks": _backlinks("example.org"),
    "backlinks_topk": _backlinks("example.com") + " ORDER BY links DESC, url_to LIMIT 25",
    "domain_pairs": f"SELECT * FROM {_PAIRS}",
    "domain_lines": f"SELECT d1 || ' ' || d2 AS r FROM {_PAIRS}",
    "domain_graph_vertices": f"SELECT domain, 1::BIGINT AS ids FROM {_VERTICES}",
    "domain_graph_edges": f"SELECT src_domain, dst_domain, round((1.0::DOUBLE / count(*) OVER (PARTITION BY src_domain))::FLOAT::DOUBLE, 6) AS weight FROM {_EDGES}",
    "dump_roundtrip": "SELECT doc_id, source, n_chars, unnest(['json', 'parquet']) AS kind FROM documents",
    "text_roundtrip": "SELECT doc_id || ' ' || source AS r FROM documents",
    "table_source": "SELECT url, strlen(html)::BIGINT AS n_bytes FROM pages",
    "archive_source": "SELECT url, 'html' AS doc_type, strlen(html)::BIGINT AS n_bytes FROM pages",
    "imported_datasets": "SELECT 'd' || c_custkey || '.com' AS key, c_custkey AS alexa, (c_custkey % 97)::DOUBLE AS host_rank, (c_custkey % 89)::DOUBLE AS hc, 'L' || c_custkey AS wikidata_title, 2::BIGINT AS sitelinks FROM customer",
    "pipeline_metadata": f"SELECT url, round(({_PLAIN_RANK})::FLOAT::DOUBLE, 5) AS rank, NULL::VARCHAR AS error FROM pages",
    "pipeline_index_levels": f"SELECT url, {_CUT.format(_TITLED, text.TITLE_CHARS, text.TITLE_CHARS + 1)} AS title, ends_with({_p(2)}, 'example.com') AS has_body FROM pages WHERE ends_with({_p(2)}, 'example.com') OR ends_with({_p(2)}, 'example.org')",
    "plugin_outputs": f"""SELECT 'graph' AS plugin, d1 || ' ' || d2 AS r FROM {_PAIRS}
  UNION ALL SELECT 'back', url_to || ' ' || links || ' ' || sources FROM ({_backlinks("example.org")})
  UNION ALL SELECT 'grep', array_to_string(w, ',') || ' ' || url FROM (SELECT url, list_sort(list_filter(['the', 'und', 'les'], lambda x: list_contains(ws, x))) AS w
    FROM (SELECT url, regexp_split_to_array(lower({_TITLED} || ' ' || array_to_string({_GROUPS}, ' ') || CASE WHEN page_id + 2 IN (SELECT page_id FROM pages) THEN ' the' ELSE '' END), '[\\s\\v\\W]+') AS ws FROM pages)) WHERE len(w) > 0""",
    "metadata_rescan": f"SELECT d1 || ' ' || d2 AS r FROM {_PAIRS}",
    "observed_rows": "SELECT count(*) AS n FROM documents",
    "search_site": _search_sql("the and blees", f"text_score * {_RANK}", "source = 'src1'"),
    "search_documents": f"SELECT f.id, f.score, source AS url, source AS title FROM ({_FOUND}) f JOIN documents ON doc_id = f.id",
    "search_explained": _FOUND.replace("m AS (SELECT", "m AS MATERIALIZED (SELECT").rsplit("SELECT id, round", 1)[0] + f"SELECT t.id, term, round(t.score, 6) AS score FROM t WHERE t.id IN (SELECT id FROM (SELECT id, text_score * {_RANK} AS score FROM m JOIN documents ON doc_id = id) ORDER BY score DESC, id LIMIT 50)",
    "search_url_words": _address_search("example en html"),
    "streamed_pages": f"SELECT url, {_CUT.format(_TITLED, text.TITLE_CHARS, text.TITLE_CHARS + 1)} AS title FROM pages",
}
QUERIES = {name: globals()[name] for name in ORACLES}
