import glob
import json

import pytest
from pyspark.sql import functions as F

from trawl import sources
from trawl.__main__ import main
from trawl.functions import html
from trawl.operators import filters, links, lookup, search, signals
from trawl.operators import pagerank as pr
from trawl.operators.pagerank import diff_stats, named, pagerank, step, top_diffs, unweighted, with_inlinks
from trawl.plans import pipeline, sinks
from trawl.plans.plugins import load, parse_spec
from trawl.sources import archives, datasets

A, B, C, D = (f"http://example-{x}.com/page1" for x in "abcd")
GRAPH_DOCS = [
    {"url": A, "content": '<html><title>Page A1</title> <a href="http://example-b.com/">to b</a></html>'},
    {"url": A.replace("1", "2"), "content": '<html><title>Page A2</title> <a href="/page1">own</a> <a href="http://example-b.com/">to b</a></html>'},
    {"url": B, "content": '<html><title>Page B1</title> <a href="http://example-c.com/">to c</a></html>'},
    {"url": C, "content": '<html><title>Page C1</title> <a href="http://example-b.com/">to b</a></html>'},
    {"url": D, "content": "<html><title>Page D1</title> Brave new world</html>"},
]


def lines(path):
    return sorted(line for name in glob.glob(f"{path}/part-*") for line in open(name).read().splitlines())


def test_specs():
    assert parse_spec("corpus") == ("corpus", {})
    assert parse_spec("crawl:limit=1,skip=3") == ("crawl", {"limit": "1", "skip": "3"})
    assert parse_spec("url:http://a.org/p") == ("url", {"url": "http://a.org/p"})
    assert parse_spec('url:{"url": "http://a.org/p"}') == ("url", {"url": "http://a.org/p"})


def test_the_last_filter_that_matches_decides(spark):
    specs = ["plugins.filter.All:skip=1", "plugins.filter.Homepages:index=1", "plugins.filter.Domains:domains=example2.com,index_body=1", "plugins.filter.Domains:domains=example3.com,index=0"]
    rows = ["http://www.example.com/", "http://www.example.com/page1", "http://example2.com/page2", "http://example3.com/", "http://x.com", "http://notexample2.com/", "http://example2.com:80/"]
    df = spark.createDataFrame([(u,) for u in rows], "url string")
    got = {r.url: r.index_level for r in filters.filtered(df, [load(s).url_filter() for s in specs]).collect()}
    assert got == {"http://www.example.com/": 1, "http://example2.com/page2": 2, "http://example3.com/": 0, "http://notexample2.com/": 2, "http://example2.com:80/": 1}


def test_pipeline_plugins(spark, tmp_path):
    out = str(tmp_path)
    df = pipeline.run(
        spark,
        [("corpus", {"docs": GRAPH_DOCS})],
        [f"grep.Words:words=c1 d1 world,output={out}/grep", f"webgraph.DomainToDomain:output={out}/text", f"webgraph.DomainToDomainParquet:output={out}/graph", f"backlinks.MostExternallyLinkedPages:domain=example-b.com,output={out}/back"],
    )
    assert lines(f"{out}/grep") == [f"c1 {C}", f"d1,world {D}"]
    assert lines(f"{out}/text") == ["example-a.com example-b.com", "example-b.com example-c.com", "example-c.com example-b.com"]
    assert lines(f"{out}/back") == [f"example-b.com 3 {A},{A.replace('1', '2')},{C}"]
    vertices, edges = (spark.read.parquet(f"{out}/graph/{x}") for x in ("vertices", "edges"))
    assert sorted(r.domain for r in vertices.collect()) == [f"example-{x}.com" for x in "abcd"]
    assert sorted((r.src, r.dst, r.weight) for r in edges.collect()) == sorted([(-1190043290, 1880738170, 1.0), (1880738170, 1615450887, 1.0), (1615450887, 1880738170, 1.0)])
    assert df.columns[:3] == ["id", "url", "rank"] and df.count() == 5
    main(["webgraph", "--input_parquet", f"{out}/graph", "--output_txt", f"{out}/export"])
    assert "347623043 example-d.com" in lines(f"{out}/export/vertices")


def test_dump_aborts_and_is_read_again(spark, tmp_path):
    out = str(tmp_path)
    pipeline.run(spark, [("corpus", {"docs": GRAPH_DOCS})], [load(f"webgraph.DomainToDomain:output={out}/first")][:0] + [f"dump.DocumentMetadata:output={out}/dump,abort=1", f"webgraph.DomainToDomain:output={out}/graph"])
    assert not glob.glob(f"{out}/graph/*")
    pipeline.run(spark, [f"metadata:path={out}/dump"], [f"webgraph.DomainToDomain:output={out}/graph"])
    assert len(lines(f"{out}/graph")) == 3


def test_archives(spark, tmp_path):
    paths = [archives.write_archive([{"url": f"http://a{n}.org/{i}", "content": f"<p>text {i}"} for i in range(5)] + [{"url": "http://a.org/i", "content": "x", "headers": {"Content-Type": "image/png"}}], f"{tmp_path}/{n}.warc{gz}") for n, gz in ((1, ""), (2, ".gz"))]
    assert sources.read(spark, "webarchive", {"paths": paths}).count() == 10
    assert sorted(r.url for r in sources.read(spark, "webarchive", {"paths": paths, "maxdocs": 3}).collect()) == [f"http://a{n}.org/{i}" for n in (1, 2) for i in range(3)]
    (tmp_path / "all.paths").write_text("1.warc\n2.warc.gz\n")
    args = {"manifest": f"{tmp_path}/all.paths", "root": str(tmp_path), "skip": 1, "limit": 1}
    assert {r.url[:10] for r in sources.read(spark, "commoncrawl", args).collect()} == {"http://a2."}
    df = pipeline.run(spark, [("webarchive", {"paths": paths, "maxdocs": 3})])
    assert df.count() == 6


def test_damaged_archives_are_told_and_cut_ones_are_read(spark, tmp_path):
    docs = [{"url": f"http://a.org/{i}", "content": f"<p>text {i}" * 50} for i in range(6)]
    whole = open(archives.write_archive(docs, f"{tmp_path}/whole.warc.gz"), "rb").read()
    read = lambda name, data, **o: ((tmp_path / name).write_bytes(data), sources.read(spark, "webarchive", {"path": f"{tmp_path}/{name}", **o}).count())[1]
    assert read("cut.warc.gz", whole[: len(whole) * 3 // 4]) == 4
    damaged = whole + b"no member of an archive"
    with pytest.raises(Exception, match="damaged.warc.gz, behind 6 pages"):
        read("damaged.warc.gz", damaged)
    assert read("damaged.warc.gz", damaged, skip_damaged=1) == 6
    with pytest.raises(Exception, match="begins with"):
        read("text.warc", b"plain text")

    class Failing:
        def readline(self):
            raise OSError("storage is gone")

    with pytest.raises(OSError, match="storage"):
        list(archives.records(Failing()))
    assert archives.matching(f"{tmp_path}/*.gz") == [f"{tmp_path}/{x}.warc.gz" for x in ("cut", "damaged", "whole")]
    assert archives.matching(f"file://{tmp_path}/*.gz") == [f"file://{tmp_path}/{x}.warc.gz" for x in ("cut", "damaged", "whole")]


def test_fetched_pages_and_repository_records(spark, tmp_path):
    answers = {"http://a.org/": (200, {"content-type": "text/html"}, b"<p>a"), "http://b.org/": (404, {}, b"")}
    got = sources.read(spark, "url", {"urls": list(answers), "fetch": lambda u: answers[u]}).collect()
    assert [(r.url, r.body, r.forced_level) for r in got] == [("http://a.org/", b"<p>a", 2)]
    record = lambda status, ident: f'<record><header{status}><identifier>x</identifier></header><metadata><oai_dc:dc xmlns:oai_dc="o" xmlns:dc="d"><dc:title>T &amp; U</dc:title><dc:identifier>{ident}</dc:identifier><dc:description>D</dc:description></oai_dc:dc></metadata></record>'
    (tmp_path / "r.xml").write_text("<OAI-PMH><ListRecords>" + record("", "http://r.org/1") + record(' status="deleted"', "http://r.org/2") + record("", "doi:3") + "</ListRecords></OAI-PMH>")
    rows = sources.read(spark, "oai", {"path": str(tmp_path / "r.xml")}).collect()
    assert [r.url for r in rows] == ["http://r.org/1"] and b"T &amp; U" in rows[0].body


def test_datasets_merge_and_lookup(spark, tmp_path):
    p = lambda name, text: ((tmp_path / name).parent.mkdir(parents=True, exist_ok=True), (tmp_path / name).write_text(text), str(tmp_path / name))[2]
    paths = {
        "alexa_top1m": p("top.csv", "1,a.com\n100,b.com\n"),
        "host_pagerank": p("ranks.txt", "a.com 122330.29\n"),
        "webdatacommons_hc": p("hc.tsv", "a.com\t2.62144E7\nsub.b.com\t0\n"),
        "dmoz": p("d.rdf", '<RDF><ExternalPage about="http://www.a.com/"><d:Title>A</d:Title></ExternalPage><ExternalPage about="http://c.com/x?q"><d:Title>C</d:Title><d:Description>d</d:Description></ExternalPage></RDF>'),
        "wikidata": p("w.json", '[\n{"labels":{"en":{"value":"B"}},"claims":{"P856":[{"mainsnak":{"datavalue":{"value":"http://old.com/"}}},{"mainsnak":{"datavalue":{"value":"http://www.b.com"}}}]},"sitelinks":{"a":1,"b":2}},\n{"claims":{}}\n]\n'),
        "ut1_blacklist": str(tmp_path / "cat"),
    }
    p("cat/adult/domains", "b.com\n")
    p("cat/malware/domains", "x.com\n")
    p("cat/malware/urls", "b.com/bad\n")
    records = datasets.imported(spark, paths)
    found = {r.key: r for r in records.collect()}
    assert (found["a.com"].alexa_top1m, found["a.com"].dmoz_title, found["a.com"].webdatacommons_hc) == (1, "A", 26214400.0)
    assert (found["b.com"].wikidata_title, found["b.com"].wikidata_sitelinks, found["b.com"].ut1_blacklist) == ("B", 2, ["adult"]) and "old.com" not in found
    again = lookup.merged(*[read(spark, paths[n]) for n, read in datasets.PROVIDERS.items() for _ in (1, 2)])
    assert {r.key: r for r in again.collect()} == found
    docs = spark.createDataFrame(list(enumerate(["http://a.com/p", "http://sub.b.com/", "http://b.com/bad?x", "http://none.org/", "http://b.com/"])), "id long, url string")
    df = lookup.looked_up(docs, records).withColumns({"alexa": signals.alexa_top1m(F.col("meta")), "cats": F.array_sort(signals.categories(F.col("meta"))), "wiki": signals.wikidata_url(F.col("meta")), "hc": signals.webdatacommons_hc(F.col("meta")), "dmoz": signals.dmoz_domain(F.col("meta")), "host": signals.host_pagerank(F.col("meta")), "rank": signals.global_rank(F.col("url"), F.col("meta"))})
    rows = {r.id: r for r in df.collect()}
    assert rows[0].alexa == 1.0 and rows[0].hc == 1.0 and rows[0].dmoz == 1.0 and rows[0].host == pytest.approx(0.5)
    assert rows[1].alexa == pytest.approx(0.7 * 0.88888890, abs=1e-7) and rows[1].hc is None
    assert rows[2].cats == ["adult", "malware"] and rows[3].cats == [] and rows[3].alexa is None
    assert rows[4].wiki == pytest.approx(0.1) and rows[2].wiki == 0.0
    assert rows[0].rank > rows[4].rank > rows[2].rank


GRAPHS = {
    "pair": ({"a": "b", "b": "a"}, {"a": 1, "b": 1}),
    "four": ({"a": "b c", "b": "c", "c": "a", "d": "c"}, {"a": 1.49, "b": 0.78, "c": 1.58, "d": 0.15}),
    "star": ({"home": "about product more", "about": "home", "product": "home", "more": "home"}, {"home": 1.92, "more": 0.69}),
}


@pytest.mark.parametrize("name, full", [(n, f) for n in GRAPHS for f in (False, True) if not f or n == "four"])
def test_pagerank_of_known_graphs(spark, name, full):
    out, expected = GRAPHS[name]
    nodes = sorted({*out, *(d for x in out.values() for d in x.split())})
    at = {n: i for i, n in enumerate(nodes)}
    vertices = spark.createDataFrame([(i, n) for n, i in at.items()], "id long, domain string")
    edges = unweighted(spark.createDataFrame([(at[s], at[d]) for s, x in out.items() for d in x.split()], "src long, dst long"))
    found = pagerank(vertices, edges, 60, 0.0, 1e-4, 5, include_orphans=True, all_vertices=full)
    ranks = {r.domain: r.rank for r in named(found.ranks, vertices).collect()}
    assert len(ranks) == len(nodes) and all(ranks[k] == pytest.approx(v, abs=0.01) for k, v in expected.items())


def test_differences(spark):
    vertices = spark.createDataFrame([(i, f"d{i}") for i in range(4)], "id long, domain string")
    edges = unweighted(spark.createDataFrame([(0, 1), (1, 2), (0, 2)], "src long, dst long"))
    diffs = step(edges, with_inlinks(vertices, edges).select("id", F.lit(1.0).alias("rank")))
    stats = diff_stats(diffs).first()
    assert stats.count_diff == 2 and stats.max_diff == pytest.approx(0.85 - 0.06375)
    assert [r.domain for r in top_diffs(diffs, vertices, 1).collect()] == ["d1"]


def corpus_index(spark, docs, path):
    pipeline.run(spark, [("corpus", {"docs": docs})], ["filter.All:index_body=1"], index=path)
    at = {r.url: r.id for r in spark.read.parquet(f"{path}/docs").collect()}
    return {at[d["url"]]: n for n, d in enumerate(docs)}


def hits(spark, path, order, query, **options):
    return [order[r.id] for r in search.search_index(spark, path, query, **options).collect()]


def test_search_one_and_many(spark, tmp_path):
    path = str(tmp_path / "i")
    docs = [
        {"url": "http://example.com/", "content": "<html><title>Hello</title> Hello, this page is the homepage</html>"},
        {"url": "http://example.com/some-page", "content": "<html><title>Hello</title> Hello world</html>"},
        {"url": "http://example.com/some-page-two", "content": "<html><title>Hello</title> Hello world, second.</html>"},
        {"url": "http://other.net/some-page-three", "content": "<html><title>Hello second</title> Hello world.</html>"},
    ]
    order = corpus_index(spark, docs, path)
    assert hits(spark, path, order, "unrelated query") == hits(spark, path, order, "") == hits(spark, path, order, "html") == []
    assert set(hits(spark, path, order, "hello")) == {0, 1, 2, 3}
    assert hits(spark, path, order, "second") == [3, 2] and hits(spark, path, order, "homepage") == [0]
    assert set(hits(spark, path, order, "example")) == {0, 1, 2}
    assert hits(spark, path, order, "world site:other.net") == [3] and hits(spark, path, order, "world", domain="other.net") == [3]
    shown = pipeline.search_debug(spark, path, "second").collect()
    assert shown[0].title == "Hello second" and shown[0].explain[0].term == "second"


def test_search_prefers_the_language(spark, tmp_path):
    path = str(tmp_path / "i")
    docs = [
        {"url": "http://example.com/newspaper", "content": "<html><title>The paper Le Monde</title> Le Monde is a daily evening newspaper that was founded in Paris and it is read all over the world.</html>"},
        {"url": "http://example.com/", "content": "<html><title>Pas dans le titre</title> Le Monde est un des quotidiens du soir, qui est en ligne dans une version pour les lecteurs.</html>"},
    ]
    order = corpus_index(spark, docs, path)
    assert hits(spark, path, order, "monde", lang="fr") == [1, 0] and hits(spark, path, order, "monde", lang="en") == [0, 1]
    assert hits(spark, path, order, "newspaper", lang="fr") == [0]


def test_a_quarter_of_the_terms_may_be_missing():
    assert [search.least_matches(n) for n in range(1, 9)] == [1, 2, 3, 3, 4, 5, 6, 6]
    assert search.site_of("a site:b.org c site:d.org") == ("a c", "d.org")


def test_later_sources_win(spark, tmp_path):
    (tmp_path / "w.json").write_text('{"labels":{},"claims":{"P856":[{"mainsnak":{"datavalue":{"value":"http://example.com/"}}}]}}\n')
    out = str(tmp_path / "i")
    pipeline.run(spark, [("wikidata", {"path": str(tmp_path / "w.json")}), ("corpus", {"docs": [{"url": "http://example.com/", "content": "<title>New</title>"}]})], ["filter.All:index=1"], index=out)
    assert [r.title for r in spark.read.parquet(f"{out}/docs").collect()] == ["New"]


def test_explained_url(spark):
    row = pipeline.explain_url(spark, "http://www.example.com/a", "<title>Hi</title><a href='/b'>b</a>").first()
    assert row.title == "Hi" and row.links[0].href == "http://www.example.com/b" and row.signals.url_subdomain == 1.0


def test_streamed_pages(spark, tmp_path):
    from trawl import streaming

    spark.createDataFrame([("http://a.org/", "<title>A</title>")], "url string, html string").write.parquet(f"{tmp_path}/in")
    streaming.ingest(streaming.page_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination(120)
    assert [r.title for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["A"]


def test_links_dedupe(spark):
    page = '<a href="http://b.net/x">b</a><a href="https://www.b.net/x#f">b</a><a href="/y#1">y</a><a href="/y#2">y</a>'
    df = spark.createDataFrame([(page, "http://a.org/")], "html string, url string").select(html.parse_text("html", "url").alias("p"))
    row = df.select(links.external(F.col("p")).alias("e"), links.internal(F.col("p")).alias("i")).first()
    assert [x.href for x in row.e] == ["b.net/x"] and [x.path for x in row.i] == ["/y"]


def test_steps_move_no_edges(spark):
    edges = spark.range(3000).selectExpr("id % 60 AS src", "id % 997 AS dst", "0.5D AS weight")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laid, hubs = pr.laid_out(edges)
        assert hubs is None
        found = pr.step(laid, spark.range(997).selectExpr("id", "1.0D AS rank"))
        plan = found._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # From the scan of the edges to their join there is a sort at most.
    scan = plan.index("FileScan parquet")
    assert "Bucketed: true" in plan and "Exchange" not in plan[plan.rindex("SortMergeJoin", 0, scan) : scan]


def test_hubs_are_ranked_alike(spark, monkeypatch):
    edges = unweighted(spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 40 END AS src", "id % 101 AS dst"))
    vertices = edges.selectExpr("src AS id").union(edges.selectExpr("dst AS id")).distinct()
    found = []
    for hub in (10_000_000, 20):
        monkeypatch.setattr(pr, "HUB_EDGES", hub)
        for full in (False, True):
            found.append({r.id: pytest.approx(r.rank) for r in pagerank(vertices, edges, 4, 0.0, all_vertices=full).ranks.collect()})
    assert pr.laid_out(edges)[1].agg(F.max("parts")).first()[0] >= 3
    assert found[0] == found[2] and found[1] == found[3] and len(found[0]) == 101


def test_bare_edges_are_read_twice_at_most(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    # A hub, repeats, and a source that is null.
    edges = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id = 1 THEN NULL ELSE id % 40 END AS src", "id % 101 AS dst").unionAll(spark.range(50).selectExpr("id % 40", "id % 101"))
    passed, found = edges.mapInArrow(counted, "src long, dst long"), []
    for full in (False, True):
        found.append({r.id: pytest.approx(r.rank) for r in pr.pagerank_unweighted(passed, 4, full, precision=0.0).ranks.collect()})
    assert 0 < read.value <= 2 * 2 * 950
    monkeypatch.setattr(pr, "HUB_EDGES", 20)
    weighted = unweighted(edges)
    vertices = weighted.selectExpr("src AS id").union(weighted.selectExpr("dst AS id")).distinct()
    for full in (False, True):
        assert {r.id: r.rank for r in pr.pagerank_unweighted(edges, 4, full, precision=0.0).ranks.collect()} == found[full]
        assert {r.id: r.rank for r in pagerank(vertices, weighted, 4, 0.0, all_vertices=full).ranks.collect()} == found[full]


def test_terms_are_counted_without_moving_them(spark):
    docs = spark.createDataFrame([(1, "b a b", "x"), (2, "", None), (3, "Z z,z y", "x")], "id long, body string, title string")
    assert {tuple(r) for r in search._terms(docs).collect()} == {(1, "body", "a", 3, 1), (1, "body", "b", 3, 2), (1, "title", "x", 1, 1), (3, "body", "z", 4, 3), (3, "body", "y", 4, 1), (3, "title", "x", 1, 1)}
    assert "Exchange" not in search._terms(docs)._jdf.queryExecution().executedPlan().toString()
    assert {r.field: (r.n_docs, r.mean_length, r.postings) for r in search.document_stats(docs).collect()} == {"body": (2, 3.5, 4), "title": (2, 1.0, 2)}


def test_rows_of_one_id_are_put_together_in_an_index(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a c"), (2, "a")], "id long, body string")
    search.write_index(docs, f"{tmp_path}/i")
    found = spark.read.parquet(f"{tmp_path}/i/postings").select("id", "term", "tf", "length")
    assert sorted(map(tuple, found.collect())) == [(1, "a", 2, 2), (1, "b", 1, 2), (1, "c", 1, 2), (2, "a", 1, 1)]
    search.write_index(spark.createDataFrame([(2, "d d e")], "id long, body string"), f"{tmp_path}/i", add=True)
    found = spark.read.parquet(f"{tmp_path}/i/postings").select("id", "term", "tf", "length")
    assert sorted(map(tuple, found.collect())) == [(1, "a", 2, 2), (1, "b", 1, 2), (1, "c", 1, 2), (2, "d", 2, 3), (2, "e", 1, 3)]
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/i/stats").select("field", "n_docs", "mean_length").collect()] == [("body", 2, 2.5)]


def test_ranks_are_printed_whole(spark, tmp_path, capsys):
    spark.range(80).selectExpr("id", "concat('d', id) AS domain").write.parquet(f"{tmp_path}/g/vertices")
    unweighted(spark.range(160).selectExpr("id % 80 AS src", "(id * 7 + 1) % 80 AS dst")).write.parquet(f"{tmp_path}/g/edges")
    for kind in ("delta", "unweighted"):
        main(["pagerank", "--webgraph", f"{tmp_path}/g", "--maxiter", "2", "--stats", "1", "--top_diffs", "3", "--implementation", kind])
        assert {line.split("\t")[0] for line in capsys.readouterr().out.splitlines()} >= {f"d{i}" for i in range(80)}
    main(["pagerank", "--webgraph", f"{tmp_path}/g", "--maxiter", "2", "--output", f"{tmp_path}/out", "--gzip"])
    assert glob.glob(f"{tmp_path}/out/*.gz") and spark.read.text(f"{tmp_path}/out").count() == 80


def parse_stages(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("parse_bytes") + plan.count("parse_text")


def test_pages_are_parsed_once(spark, tmp_path):
    records = datasets.imported(spark, {"alexa_top1m": str((tmp_path / "top.csv").write_text("1,example-a.com\n") and tmp_path / "top.csv")})
    docs = pipeline.documents(spark, "corpus", {"docs": GRAPH_DOCS}, [], records)
    assert parse_stages(docs) == 0 and {r.url: round(r.meta.domain.alexa_top1m) for r in docs.where("meta.domain is not null").collect()} == {A: 1, A.replace("1", "2"): 1}
    assert parse_stages(pipeline.documents(spark, "corpus", {"docs": GRAPH_DOCS, "persist": "0"}, [])) == 1


def test_blocks_and_later_batches_reach_the_index(spark, tmp_path):
    path = str(tmp_path / "i")
    first = {"url": "http://a.org/1", "content": "<title>First</title> apple words"}
    second = {"url": "http://a.org/2", "content": "<title>Second</title> pear words"}
    df = pipeline.run(spark, [("corpus", {"docs": [first], "block": "1"}), ("corpus", {"docs": [second]})], ["filter.All:index_body=1"], index=path)
    titles = lambda q: sorted(r.title for r in pipeline.search_debug(spark, path, q).collect())
    assert df.count() == 2 and titles("words") == ["First", "Second"]
    again = {"url": "http://a.org/1", "content": "<title>Again</title> plum words"}
    pipeline.add_to_index(spark, [("corpus", {"docs": [again]})], path, plugin_specs=["filter.All:index_body=1"])
    assert titles("words") == ["Again", "Second"] and titles("apple") == [] and titles("plum") == ["Again"]
    pipeline.reset(spark, path)
    assert titles("words") == []


def test_overrides_take_the_place_of_records(spark, tmp_path):
    docs = [
        {"url": "http://a.org/", "content": "<title>A</title>", "url_metadata_extra": {"url": {"rank": 0.25}}},
        {"url": "http://b.org/", "content": "<title>B</title>", "url_metadata_extra": {"domain": {"alexa_top1m": 1}, "url": {"ut1_blacklist": ["malware"]}}},
        {"url": "http://c.org/", "content": "<title>C</title>"},
    ]
    (tmp_path / "c.json").write_text(json.dumps(docs))
    for args in ({"docs": docs}, {"path": f"{tmp_path}/c.json"}):
        rows = {r.url: r for r in pipeline.documents(spark, "corpus", args, []).collect()}
        assert rows["http://a.org/"].rank == 0.25 and rows["http://b.org/"].meta.domain.alexa_top1m == 1 and rows["http://b.org/"].meta.url.ut1_blacklist == ["malware"]
        assert rows["http://c.org/"].meta.url is None and rows["http://b.org/"].rank == pytest.approx(rows["http://c.org/"].rank * 0.001 + 0.001 * 5 / sum(signals.WEIGHTS.values()), rel=1e-3)


def test_pages_that_fail_are_told(spark, monkeypatch, tmp_path):
    df = pipeline.run(spark, [("corpus", {"docs": GRAPH_DOCS[:1]})], [f"dump.DocumentMetadata:output={tmp_path}/d"])
    assert df.columns[:4] == ["id", "url", "rank", "error"] and df.first().error is None


def test_endpoints_and_registries(spark, tmp_path):
    record = lambda n: f'<record><header><identifier>{n}</identifier></header><metadata><oai_dc:dc xmlns:oai_dc="o" xmlns:dc="d"><dc:title>T{n}</dc:title><dc:identifier>http://r.org/{n}</dc:identifier></oai_dc:dc></metadata></record>'
    answers = {
        "http://list/": "<BaseURLs><baseURL>http://one/oai</baseURL><baseURL>http://two/oai</baseURL></BaseURLs>",
        "http://one/oai?verb=ListRecords&metadataPrefix=oai_dc": f"<OAI-PMH><ListRecords>{record(1)}{record(2)}<resumptionToken>a|b</resumptionToken></ListRecords></OAI-PMH>",
        "http://one/oai?verb=ListRecords&resumptionToken=a%7Cb": f"<OAI-PMH><ListRecords>{record(3)}<resumptionToken/></ListRecords></OAI-PMH>",
        "http://two/oai?verb=ListRecords&metadataPrefix=oai_dc": f"<OAI-PMH><ListRecords>{record(4)}</ListRecords></OAI-PMH>",
    }
    fetch = lambda u: (200, {}, answers[u].encode())
    for args, expected in (({"list": "http://list/"}, {1, 2, 3, 4}), ({"url": "http://two/oai"}, {4}), ({"urls": ["http://one/oai"]}, {1, 2, 3})):
        rows = sources.read(spark, "oai", {**args, "fetch": fetch}).collect()
        assert {r.url for r in rows} == {f"http://r.org/{n}" for n in expected} and all(b"<title>T" in r.body for r in rows)


def test_packed_categories_listings_and_tables(spark, tmp_path):
    import gzip
    import tarfile

    (tmp_path / "b" / "adult").mkdir(parents=True)
    (tmp_path / "b" / "adult" / "domains").write_text("x.com\ny.com\n")
    (tmp_path / "b" / "adult" / "usage").write_text("no list\n")
    with tarfile.open(f"{tmp_path}/lists.tar.gz", "w:gz") as out:
        out.add(f"{tmp_path}/b", "blacklists")
    for path in (f"{tmp_path}/lists.tar.gz", f"{tmp_path}/b"):
        assert {r.key: r.ut1_blacklist for r in datasets.categories(spark, path).collect()} == {"x.com": ["adult"], "y.com": ["adult"]}
    archives.write_archive([{"url": "http://a.org/", "content": "a"}], f"{tmp_path}/1.warc.gz")
    (tmp_path / "crawl-data" / "V-1").mkdir(parents=True)
    (tmp_path / "crawl-data" / "V-1" / "warc.paths.gz").write_bytes(gzip.compress(b"1.warc.gz\n"))
    assert [r.url for r in sources.read(spark, "commoncrawl", {"root": str(tmp_path), "version": "V-1"}).collect()] == ["http://a.org/"]
    assert sinks.sql(spark, "SELECT count(*) AS n FROM {t} JOIN {u} USING (id)", t=spark.range(5), u=spark.range(3)).first().n == 3


def test_index_of_popular_hosts(spark, tmp_path):
    (tmp_path / "top.csv").write_text("1,example.com\n2,example.org\n300,example.net\n")
    pipeline.popular_index(spark, f"{tmp_path}/top.csv", f"{tmp_path}/i", 100)
    assert [(r.url, round(r.rank, 4)) for r in pipeline.search_debug(spark, f"{tmp_path}/i", "example").collect()] == [("http://example.com/", 0.4999), ("http://example.org/", 0.4998)]
