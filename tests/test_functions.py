import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trawl.functions import encoding, html, ids, language, text, urls
from trawl.scratch import PAGES_BYTES, page_batches

URLS = [
    ("https://www.test.com", "normalized", "test.com"),
    ("https://www.test.com?", "normalized", "test.com"),
    ("https://www.test.com?", "domain", "www.test.com"),
    ("https://www.test.com?", "normalized_domain", "test.com"),
    ("https://.test.com.", "domain", ".test.com."),
    ("https://.www.www.test.com", "normalized_domain", "test.com"),
    ("https://.example.test.com", "normalized_subdomain", "example"),
    ("http://sub.test.com/?x=a#b", "normalized", "sub.test.com/?x=a"),
    ("http://sub.test.co.uk?x=a#b", "normalized", "sub.test.co.uk/?x=a"),
    ("http://sub.test.co.uk?x=a#b", "normalized_without_query", "sub.test.co.uk"),
    ("http://sub.test.co.uk?x=a#b", "suffix", "co.uk"),
    ("http://sub.test.co.uk?x=a#b", "pld", "test.co.uk"),
    ("http://sub.test.co.uk/page1/?x=a#b", "normalized", "sub.test.co.uk/page1/?x=a"),
    ("http://www.sub.test.co.uk?x=a#b", "subdomain", "www.sub"),
    ("http://www.sub.test.co.uk?x=a#b", "normalized_subdomain", "sub"),
    ("http://sub.test.co.uk/azerza/azer.html?x=a#b", "homepage", "http://sub.test.co.uk"),
    ("http://example.org:8080/foo", "normalized_domain", "example.org:8080"),
    ("http://example.org:8080/foo", "normalized", "example.org:8080/foo"),
    ("http://example.org:80/foo", "normalized", "example.org/foo"),
    ("https://example.org:443", "normalized", "example.org"),
    ("http://foo_bar.com/x", "domain", "foo_bar.com"),
]


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first()["x"]


def test_url_attributes(spark):
    names = sorted({name for _, name, _ in URLS})
    df = spark.createDataFrame([(u,) for u in {u for u, _, _ in URLS}], "url string")
    rows = {r["url"]: r for r in df.select("url", *[getattr(urls, n)(F.col("url")).alias(n) for n in names]).collect()}
    assert [(u, n, rows[u][n]) for u, n, _ in URLS] == URLS


def test_normalizing_twice_changes_nothing(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in URLS], "url string")
    once = df.select(urls.normalized(F.col("url")).alias("n"))
    assert once.where(urls.normalized(F.concat(F.lit("http://"), "n")) != F.col("n")).count() == 0


def test_words_of_urls_and_quoting(spark):
    url = "https://en.wikipedia.org/wiki/Nine_Inch_Nails"
    assert one(spark, urls.all_url_words(F.col("u")), u=("string", url)) == ["en", "wikipedia", "org", "wiki", "nine", "inch", "nails"]
    assert one(spark, urls.paid_words(F.col("u")), u=("string", "http://www.bbc.co.uk/news")) == ["bbc"]
    assert one(spark, urls.quoted(F.col("u")), u=("string", "http://a.org/é/b?q=ü&x=1#ö")) == "http://a.org/%C3%A9/b?q=%C3%BC&x=1#%C3%B6"
    assert one(spark, urls.filename_words(F.col("u")), u=("string", "/a/b/my-file.tar.html")) == ["my", "file", "tar"]


def test_parts_are_quoted_before_they_are_joined(spark):
    made = urls.quoted_from(F.lit("http://a.org"), F.concat(F.lit("/a/"), F.col("w")), F.concat(F.lit("q="), F.col("w"), F.lit("&x=1")))
    for word, quoted in (("é##", "http://a.org/a/%C3%A9%23%23?q=%C3%A9%23%23&x=1"), ("é?b", "http://a.org/a/%C3%A9%3Fb?q=%C3%A9?b&x=1"), ("b#", "http://a.org/a/b#?q=b#&x=1")):
        assert one(spark, made, w=("string", word)) == quoted


def test_pages_are_parsed_slice_by_slice(monkeypatch):
    alive, seen = [], html._parsed
    monkeypatch.setattr(html, "_parsed", lambda texts, links: alive.append(sum(len(t or "") for t in texts)) or seen(texts, links))
    pages = [f"<title>t{n}</title>" + "x" * 300_000 for n in range(10)] + [None, "y" * 3_000_000, ""] + ["<p>z"] * 600
    found = html.parse_text.func(pa.array(pages), pa.array(["http://a.org/"] * len(pages))).to_pylist()
    assert [x["title"] for x in found[:10]] == [f"t{n}" for n in range(10)] and len(found) == len(pages) and found[-1]["word_groups"][0]["words"] == "z"
    assert sum(alive) == sum(len(p or "") for p in pages) and sorted(alive)[-2] <= html.SLICE_BYTES and len(alive) >= 8


def test_whole_pages_go_to_python_in_batches_of_few_bytes(spark):
    @F.arrow_udf("long")
    def together(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts))

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    pages = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    with page_batches(pages):
        assert pages.select(together("t").alias("n")).agg(F.max("n")).first()[0] < 2 * PAGES_BYTES
    assert spark.conf.get(key) == before


def test_murmur_vectors_and_ids(spark):
    values = [b"hello", b"hello, world", b"The quick brown fox jumps over the lazy dog", b"test.com", b"wordpress.org", b"en"]
    signed = lambda x: x - (1 << 32) if x >> 31 else x
    assert ids.murmur3(values).tolist() == [signed(0x248BFA47), signed(0x149BBB7F), signed(0x2E4FF723), 240685418, 1846549694, 1972196547]
    df = spark.createDataFrame([(h,) for h in ("example-a.com", "example-b.com", "example-c.com", "example-d.com", "en.wordpress.org")], "h string")
    assert [r.x for r in df.select(ids.host_id(F.col("h")).alias("x")).collect()] == [-1190043290, 1880738170, 1615450887, 347623043, 8470519672495676606]
    df = spark.createDataFrame([(u,) for u in ("http://wordpress.org/index.html", "http://en.wordpress.org/new_unknown_url2.html")], "u string")
    assert [r.x for r in df.select(ids.url_id(F.col("u")).alias("x")).collect()] == [6141516990, 5941369193165233342]


def test_ids_ignore_scheme_www_slash_and_fragment(spark):
    same = ["http://wordpress.org", "https://www.wordpress.org/", "http://wordpress.org/?", "http://wordpress.org/#x"]
    other = ["http://en.wordpress.org/", "http://wordpress.org/a", "http://wordpress.org/?q"]
    df = spark.createDataFrame([(u,) for u in same + other], "u string")
    found = [r.x for r in df.select(ids.url_id(F.col("u")).alias("x")).collect()]
    assert len(set(found[:4])) == 1 and len(set(found)) == 4
    assert found[0] == df.limit(1).select(ids.domain_id(F.col("u")).alias("x")).first().x


def test_titles(spark):
    def title(raw, metas=None, url="http://www.example.com/x"):
        return one(spark, text.title(F.col("r"), F.col("m"), F.col("u")), r=("string", raw), m=("map<string,string>", metas or {}), u=("string", url))

    assert title("  A  \n Title\t \t!  ") == "A Title !"
    assert title("a" * 100) == "a" * 70 + "..."
    assert title("a" * 60 + " 2345678 1234567") == "a" * 60 + " 2345678..."
    assert title("a" * 60 + " 2345678901 1234567") == "a" * 60 + "..."
    assert title("😋 Menu") == "Menu"
    assert title(" ") == title("home") == title(None) == "Example"
    assert title("", {"og:title": "Other"}) == "Other"


def test_summaries(spark):
    def summary(metas, groups):
        return one(spark, text.summary(F.col("m"), F.col("g")), m=("map<string,string>", metas), g=("array<struct<words:string,tag:string>>", groups))

    short, long, heading = ("word", "p"), ("t" * 20 + " " + "u" * 25, "td"), ("h" * 45, "h2")
    assert summary({"description": " a \n b "}, [heading]) == "a b"
    assert summary({"og:description": "c", "description": "default"}, []) == "c"
    assert summary({}, [short, long, heading]) == heading[0]
    assert summary({}, [short, long]) == long[0]
    assert summary({}, [short]) == ""


def test_subwords():
    def cut(words, seen):
        return [x for w in words for x in text.segmented(w, seen.lower().replace(":", "").split())]

    assert cut(["lemonde", "fr"], "Le Monde: French daily") == ["le", "monde", "fr"]
    assert cut(["lemonde", "x"], "LeMonde: French daily") == ["lemonde", "x"]
    assert cut(["nomatch", "com"], "Le Monde: French daily") == ["nomatch", "com"]


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=12), st.lists(st.text("abc", min_size=1, max_size=3), max_size=4))
def test_subwords_lose_nothing(word, vocabulary):
    assert "".join(text.segmented(word, vocabulary)) == word


def test_hidden_and_framed_text_is_left_out():
    page = html.parse(
        "<html><head><title>T</title><style>no</style></head><body><script>no()</script><!-- no --> seen <p>para</p><div style='color:red;display:none'>no</div>"
        "<div hidden>no</div><div aria-hidden='true'>no</div><div aria-hidden='false'>aria</div><nav>no <a href='/m'>menu</a><h1>head</h1></nav><div class='x hide'>no</div>"
        "<footer id=z>no</footer><span class=nocontent>no</span></body></html>",
        "http://a.org/",
    )
    assert [g["words"] for g in page["word_groups"]] == ["seen", "para", "aria", "head"]
    assert page["title"] == "T" and page["internal_hyperlinks"] == [{"href": "/m", "text": "menu", "rel": None}]


def test_links_are_split_and_checked(spark):
    page = """<base href="http://a.org/d/"><a href="http://A.org/one">x </a><a href="/two#f">2</a><a href="three?q">3</a><a href="http://B.net/P?Q#r" rel="nofollow">b</a><a href="//c.net/">c</a>
    <a name="x">n</a><a href="">e</a><a href="ftp://a.net">f</a><a href="javascript:f()">j</a><a href="http://u@d.net/">u</a><a href="http://e.net/m@f.net">m</a><a href="http://com/">t</a><a href="http://[x">k</a><a href="<object">o</a>"""
    df = spark.createDataFrame([(page, "http://a.org/p.html")], "html string, url string").select("url", html.parse_text("html", "url").alias("p"))
    row = df.select(
        html.internal_links(F.col("p")).alias("i"), html.external_links(F.col("p")).alias("e"), html.external_links(F.col("p"), True).alias("f"), html.hyperlinks(F.col("p"), F.col("url")).alias("h")
    ).first()
    assert [(x.path, x.text) for x in row.i if not x.path.startswith("<")] == [("/one", "x"), ("/two#f", "2"), ("three?q", "3")]
    assert [x.href for x in row.e] == ["http://b.net/P?Q#r", "http://c.net/"] and [x.href for x in row.f] == ["http://c.net/"]
    assert [x.href for x in row.h if "object" not in x.href] == ["http://a.org/one", "http://a.org/two#f", "http://a.org/d/three?q", "http://b.net/P?Q#r", "http://c.net/"]


@pytest.mark.parametrize(
    "href, found",
    [(None, None), ("", None), ("http://b.org/x", None), ("/x", "http://a.org/x"), ("//a.org/x", "http://a.org/x"), ("x", "http://a.org/d/x"), ("http://a.org/y", "http://a.org/y")],
)
def test_canonical_urls(href, found):
    tag = "" if href is None else f'<link REL="Canonical" href="{href}">'
    assert html.parse(f"<head>{tag}</head>", "http://a.org/d/p")["canonical_href"] == found


def test_a_broken_page_costs_itself_alone(spark, monkeypatch):
    df = spark.createDataFrame([("<p>fine", "http://a.org"), (None, None), ("", ""), ("<p>" * 5000 + "deep", "http://[bad")], "html string, url string")
    rows = df.select(html.parse_text("html", "url").alias("p")).collect()
    assert len(rows) == 4 and rows[0].p.word_groups[0].words == "fine" and rows[3].p.error


def test_encodings():
    assert encoding.detect(b"\xff\xfea\x00") == "utf-16-le"
    assert encoding.detect(b"<p>", "text/html; charset=ISO-8859-15") == "iso8859-15"
    assert encoding.detect(b'<meta charset="tis-620">') == encoding.detect(b'<meta charset="windows-874">') == "cp874"
    assert encoding.detect(b'<meta http-equiv=Content-Type content="text/html; charset=utf-8">') == "utf-8"
    assert encoding.detect(b'<?xml version="1.0" encoding="shift_jis"?>') == "shift_jis"
    assert encoding.detect(b"caf\xe9") == "cp1252" and encoding.detect("café".encode()) is None
    assert encoding.decode("prix 5 €".encode("iso8859-15"), "text/html; charset=iso-8859-15") == "prix 5 €"


UNDECLARED = {
    "shift_jis": "これは日本語の文章です。文字コードを判定します。",
    "euc_jp": "これは日本語の文章です。文字コードを判定します。",
    "gb18030": "这是一个中文网页，我们在这里说明不同的编码。他们来到中国的时候",
    "big5": "這是一個中文網頁，我們在這裡說明不同的編碼。他們來到中國的時候",
    "cp949": "이것은 한국어 문장입니다. 인코딩을 확인합니다.",
    "cp1251": "Это русский текст, который написан без объявления кодировки.",
    "koi8_r": "Это русский текст, который написан без объявления кодировки.",
    "iso8859_7": "Αυτό είναι ένα ελληνικό κείμενο χωρίς δήλωση",
    "cp1255": "זהו טקסט בעברית ללא הצהרת קידוד",
    "cp1256": "هذا نص عربي بدون إعلان الترميز",
    "cp874": "นี่คือข้อความภาษาไทย",
    "cp1252": "Déjà vu à l'été, l'hôtel où nous étions çà et là",
}


@pytest.mark.parametrize("name", UNDECLARED)
def test_undeclared_encodings_are_guessed(name):
    for before in ("", "<html><body>some plain words before it "):
        assert encoding.detect((before + UNDECLARED[name]).encode(name)) == name


def test_a_declaration_counts_wherever_it_stands():
    page = b"<html><head><script>" + b"x" * 20_000 + b'</script><meta charset="koi8-r"></head><body>'
    assert encoding.detect(page + "привет".encode("koi8-r")) == "koi8-r"


@pytest.mark.parametrize(
    "page, title, groups",
    [
        ("<html><head><title>T</title><body><p>hello there", "T", ["hello there"]),
        ("<head><title>T</title>hello <b>you</b>", "T", ["hello you"]),
        ("<title>T</title><p>one<p>two", "T", ["one", "two"]),
        ("<html><head><title>T</title><script>no</script><meta name=description content=d></head><body>yes</body>", "T", ["yes"]),
        ("<html><head> \n <title>T</title> \n </head>yes", "T", ["yes"]),
    ],
)
def test_a_head_ends_where_its_elements_do(page, title, groups):
    found = html.parse(page, "http://a.org/")
    assert (found["title"], [g["words"] for g in found["word_groups"]]) == (title, groups)


def test_languages_of_plain_sentences():
    for code, sentence in {
        "en": "The quick brown fox jumps over the lazy dog near the river bank",
        "fr": "Le chat dort devant la fenêtre pendant que les enfants jouent dehors",
        "es": "El gato duerme delante de la ventana mientras los niños juegan afuera",
        "de": "Die Katze schläft vor dem Fenster, während die Kinder draußen spielen",
        "it": "Il gatto è seduto sulla finestra e guarda fuori",
        "pt": "O gato está sentado na janela e olha para fora",
        "nl": "De kat zit op de mat en kijkt naar buiten",
    }.items():
        assert language.detected(sentence) == {code: pytest.approx(1.0)}, sentence
    assert language.detected("Привет мир") == language.detected("12 34 !!") == language.detected("") == {}


def test_languages(spark):
    texts = ["This is obviously an english text", "Ceci est du francais, bien sur.", "Esto es espanol, por seguro", "Deutsch ist die Muttersprache von vielen", "zzz qqq", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(language.weights(F.col("t")).alias("w")).collect()
    assert [sorted(r.w) for r in rows] == [["en"], ["fr"], ["es"], ["de"], [], []]
    both = "Die Sprache ist die der Stadt und sie wird von den Leuten nicht nur im Land gesprochen. Ceci est du francais et cela suffit."
    w = one(spark, language.weights(F.col("t")), t=("string", both))
    assert sorted(w) == ["de", "fr"] and w["de"] > w["fr"]
    json.dumps(w)


def test_public_suffixes(spark):
    expected = {
        "http://www.bbc.co.uk/": ("www", "bbc", "co.uk", "bbc.co.uk"),
        "http://a.b.shop.com.qa/x": ("a.b", "shop", "com.qa", "shop.com.qa"),
        "https://news.gov.mt:8080/": ("", "news", "gov.mt", "news.gov.mt"),
        "http://firm.co.tz": ("", "firm", "co.tz", "firm.co.tz"),
        "http://com.de/": ("", "com", "de", "com.de"),
        "http://x.example.dev/": ("x", "example", "dev", "example.dev"),
        "http://localhost/": ("", "localhost", "", "localhost."),
    }
    u = F.col("u")
    df = spark.createDataFrame([(x,) for x in expected], "u string").select("u", urls.subdomain(u).alias("a"), urls.domain_without_suffix(urls.domain(u)).alias("b"), urls.suffix(u).alias("c"), urls.pld(u).alias("d"))
    assert {r.u: (r.a, r.b, r.c, r.d) for r in df.collect()} == expected
