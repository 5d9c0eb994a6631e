"""Orders that a search should give: small corpora, each about one influence on the score."""

import pytest

from trawl.operators import search
from trawl.plans import pipeline


def page(title, body):
    return f"<html><title>{title}</title> {body}</html>"


LONG = " ".join(["apple"] * 9)
POPULAR = {1: "A red apple of the garden with bread.", 2: "A red apple of the garden.", 3: "A red apple of the garden with no further words behind."}
CORPORA = {
    # A host's own name counts for its pages, and most where the title has it too.
    "host_or_title": (
        [("http://apple.com/", page("A wide headline of the front", "Front words")), ("http://apple.com/inner", page("Apple", "Inner words")), ("http://fruit.com/apple", page("Headline", "Inner words"))],
        {"apple": [1, 0, 2]},
    ),
    "www_before_other_short_hosts": (
        [(f"http://{sub}.apple.com/", page("Headline", "Front words")) for sub in ("www", "ww", "w")],
        {"apple": [0, 2, 1]},
    ),
    "several_words": (
        [
            ("http://sub.apple.com/1", page("Apple", "Here is a fine apple of bread.")),
            ("http://sub.apple.com/2", page("Apple bread", "Here is a fine apple.")),
            ("http://sub.apple.com/bread", page("Apple bread", "Here is a fine apple.")),
            ("http://sub.bread.apple.com/", page("Apple bread", "Here is a fine apple.")),
            ("http://sub.a-wider-apple-name.com/", page("Poor good headline", "Here is a fine apple bread.")),
            ("http://sub.a-wider-aaaa-name.com/", page("Nothing at all", "Here is a fine aaaa dddd.")),
        ],
        {"apple bread": [3, 2, 1, 0, 4], "bread apple": [3, 2, 1, 0, 4], "bread": {0, 1, 2, 3, 4}},
    ),
    "words_of_host_and_body": (
        [
            ("http://www.aaaa.bbbb.com/", page("headline", "Words cccc")),
            ("http://www.eeee.ddd.bbbb.qc.ca/", page("Headline aaaa", "Words cccc dddd aaaa")),
            ("http://zzzz.bbbb.com/", page("headline", "Words cccc")),
            ("http://yyyy.bbbb.com/2", page("headline", "Words dddd")),
        ],
        {"aaaa bbbb": [0, 1], "aaaa bbbb headline words cccc": [0, 1, 2]},
    ),
    "repeated_words": (
        [
            ("http://apple.com/0-apple-abcdefg", page("Apple headline", "Here is a fine apple of bread.")),
            ("http://apple.com/1-apple-abcdefg", page("Apple headline", "Here is a fine apple of bread. Apple - ary!")),
            ("http://apple.com/2-apple-apple-abcdefg-abcdefg", page("Apple headline", "Here is a fine apple of bread. Apple - ary!")),
            ("http://apple.com/3-apple-apple-apple-apple", page("Apple apple headline", "Here is a fine abcdefg of bread. abcdefg - ary!")),
            ("http://apple.com/4-apple-abcdefg-abcdefg-abcdefg", page("Headline", f"Here is a fine apple of bread. apple - ary! {LONG}")),
        ],
        {"apple": {0, 1, 2, 3, 4}},
    ),
    "popular_hosts": (
        [(f"http://abcde-apple.com/{n}", page("Apple" + " red" * (k == 2), POPULAR[k]), {"domain": {"alexa_top1m": rank}}) for n, (k, rank) in enumerate([(1, 1), (2, 100), (2, 10_000), (2, 100_000), (3, 1)])],
        {"apple": [0, 4, 1, 2, 3]},
    ),
    "parts_of_addresses": (
        [
            (url, page("Other headline" if url.endswith("efgf") else "Apple Bread!", "Words"))
            for url in (
                "http://www.sub.apple.com/0-page-link",
                "http://sub.bread.apple.com/1-page-link",
                "http://sub.breadapple.com/2-abcd-efgh",
                "http://sub.mybreadapple.com/3-abcd-efgh",
                "http://sub.mybreadnapple.com/4-abcd-efgh",
                "http://sub.fruit.com/5-bread-apple.html",
                "http://sub.fruit.com/6-breadapple.html",
                "http://sub.breadapple.com/7-abcd-efgf",
            )
        ],
        {"apple": {0, 1, 2, 3, 4, 5, 6}, "apple bread": {0, 1, 2, 3, 4, 5, 6}},
    ),
}
#: Orders that another engine's scores give; crossed fields are scored otherwise here.
OTHERWISE = {
    "several_words": {"bread": [3, 2, 1, 0, 4]},
    "repeated_words": {"apple": [1, 0, 2, 3, 4]},
    "popular_hosts": {"apple red": [1, 2, 0, 3]},
    "parts_of_addresses": {"apple": [0, 1, 2, 3, 4, 5, 6], "apple bread": [2, 3, 4, 1, 0, 5, 6]},
}


def found_orders(spark, path, docs, queries):
    corpus = [{"url": d[0], "content": d[1], "url_metadata_extra": d[2] if len(d) > 2 else None} for d in docs]
    pipeline.run(spark, [("corpus", {"docs": corpus})], ["filter.All:index_body=1"], index=path)
    at = {r.url: r.id for r in spark.read.parquet(f"{path}/docs").collect()}
    order = {at[d["url"]]: n for n, d in enumerate(corpus)}
    return {q: [order[r.id] for r in search.search_index(spark, path, q).collect()] for q in queries}


@pytest.mark.parametrize("name", CORPORA)
def test_order(spark, tmp_path, name):
    docs, searches = CORPORA[name]
    found = found_orders(spark, str(tmp_path / "index"), docs, searches)
    assert {q: set(x) if isinstance(searches[q], set) else x for q, x in found.items()} == searches


@pytest.mark.xfail(reason="scores over crossed fields differ from the other engine's", strict=False)
@pytest.mark.parametrize("name", OTHERWISE)
def test_order_of_another_engine(spark, tmp_path, name):
    assert found_orders(spark, str(tmp_path / "index"), CORPORA[name][0], OTHERWISE[name]) == OTHERWISE[name]
