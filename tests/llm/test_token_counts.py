import random

from hypothesis import given, settings
from hypothesis import strategies as st

from trawl.llm.bpe import encoder
from trawl.llm.token_counts import count_at, counter, longest_prefix, token_counts

TEXTS = ["", "a", "Hello, world", "it's  we'll\n\nthey've 's", "naïve çédille 東京タワー 😀😀", "tab\there \n  x", "a" * 36, "x1y22z333 $$$ ... !?", "\u0085   end ", "don't stop 'tis I'd", "ab*** été, x?! (a) b--c d_e f_ g.h. i&&& \nab, c"]


def brute(text):
    encode = encoder().encoding.encode_ordinary
    return [len(encode(text[:k])) for k in range(len(text) + 1)]


def prefixes(text):
    width, deltas = counter().encode(text)
    return [count_at(deltas, k, width) for k in range(len(text) + 1)]


def test_every_prefix_of_known_texts():
    for text in TEXTS:
        assert prefixes(text) == brute(text), text


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abtheing'sdrve THE,.\n\t 1é東"), max_size=40))
def test_every_prefix_of_any_text(text):
    assert prefixes(text) == brute(text)


def test_budgets_nulls_and_long_texts(spark):
    pick = random.Random(1)
    long = " ".join("".join(pick.choice("aeioutnshrd") for _ in range(pick.randint(1, 12))) for _ in range(3000))
    rows = [(1, long), (2, None), (3, ""), (4, "one two"), (4, "one two"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens")
    got = token_counts(df, budgets=[1, 500]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got)[1] == (False, 2, None) or len(got) == 6
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[2].budget_cuts is None and (by[3].n_tokens, by[3].budget_cuts) == (0, [0, 0])
    counts = brute(long[:3000])
    assert [count_at(by[1].prefix_deltas, k, by[1].delta_bytes) for k in range(3001)] == counts
    assert by[1].budget_cuts[1] == max(k for k in range(3001) if counts[k] <= 500) == longest_prefix(by[1].prefix_deltas, 500, by[1].delta_bytes)
    assert token_counts(df.where("false")).collect() == []


def test_long_white_space():
    pick = random.Random(4)
    for _ in range(300):
        text = "".join(pick.choice(" \n\t\x1c\x85 　 ab'st.,1é") for _ in range(pick.randint(0, 30)))
        assert prefixes(text) == brute(text), text
    text = "x" + " \n" * 200 + " " * 150 + "\n" * 300 + " y" + " " * 200
    assert prefixes(text) == brute(text)
    long = "\n" * 1_000_000
    width, deltas = counter().encode("a" + long + "b")
    assert [count_at(deltas, k, width) for k in (1, 2, 1000, 500_001)] == [len(encoder().encoding.encode_ordinary("a" + long[: k - 1])) for k in (1, 2, 1000, 500_001)]
