"""Words, titles and summaries as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions import urls

TITLE_CHARS = 70
SUMMARY_CHARS = 160
LONG_GROUP_BYTES = 40
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p")
#: Unassigned code points and the pictographs that were unassigned when the rule was made.
UNASSIGNED = r"[\p{Cn}\x{1F300}-\x{1FAFF}]"


def words(text: Column) -> Column:
    """Distinct lower-case words; a word is a run of ASCII letters, digits and underscores."""
    return F.array_distinct(F.split(F.lower(text), r"[\s\W]+"))


def all_words(title: Column, groups: Column) -> Column:
    """Title words and the words of all groups."""
    return F.array_union(words(F.coalesce(title, F.lit(""))), F.array_distinct(F.flatten(F.transform(groups, lambda g: F.split(F.lower(g["words"]), r"[\s\W]+")))))


def split_words(text: Column) -> Column:
    """White-space words."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def truncated(text: Column, n: int, keep_words: bool = True, ellipsis: str = "...") -> Column:
    """X21."""
    cut = F.regexp_replace(F.substring(text, 1, n + 1), r"\s(\S*)$", "") if keep_words else text
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.substring(cut, 1, n), F.lit(ellipsis)))


def _valid(text: Column, useless: Sequence[str]) -> Column:
    bare = F.lower(F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")))
    return F.when(~bare.isin("", *useless), text)


def _cleaned(text: Column, n: int) -> Column:
    return truncated(F.trim(F.regexp_replace(text, r"\s+", " ")), n)


def title(raw: Column, metas: Column, url: Column) -> Column:
    """X22."""
    paid = F.array_join(urls.paid_words(url), " ")
    found = F.coalesce(_valid(raw, ("home", "default")), _valid(metas["og:title"], ("home", "default")), F.initcap(paid), F.lit(""))
    return _cleaned(F.regexp_replace(found, UNASSIGNED, ""), TITLE_CHARS)


def summary(metas: Column, groups: Column) -> Column:
    """X23."""
    long = F.filter(groups, lambda g: F.octet_length(g["words"]) > LONG_GROUP_BYTES)
    heading = F.filter(long, lambda g: g["tag"].isin(*HEADINGS))
    # `get` gives null for an empty array.
    found = F.coalesce(
        _valid(metas["description"], ("default",)),
        _valid(metas["og:description"], ("default",)),
        _valid(F.get(heading, 0)["words"], ("default",)),
        _valid(F.get(long, 0)["words"], ("default",)),
        F.lit(""),
    )
    return _cleaned(found, SUMMARY_CHARS)


def segmented(text: str, vocabulary: Sequence[str]) -> list[str]:
    """One word cut by the vocabulary's words, in the order of their first places."""
    text = text.lower()
    found = sorted(((text.find(v), k, v) for k, v in enumerate(vocabulary) if v and v in text), key=lambda m: m[:2])
    out, at = [], 0
    for place, _, v in found:
        if place < at:
            continue
        if place > at:
            out.append(text[at:place])
        out.append(v)
        at = place + len(v)
    return out + [text[at:]] * (at < len(text))


@F.arrow_udf(T.ArrayType(T.StringType()))
def infer_subwords(parts: pa.Array, vocabulary: pa.Array) -> pa.Array:
    """`vocabulary` is the text whose words cut the parts."""
    import re

    split = re.compile(r"[\s\W]+", re.ASCII).split
    out = []
    for own, text in zip(parts.to_pylist(), vocabulary.to_pylist()):
        known = split((text or "").lower())
        out.append(None if own is None else [w for x in own for w in segmented(x, known)])
    return pa.array(out, pa.list_(pa.string()))
