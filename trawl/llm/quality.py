"""Operator 6: line-first quality rules.

Each line is judged by itself.  A line is dropped that
- is short and does not end in punctuation (a heading or navigation),
- is a row of cells (bars between its words),
- has many runs of symbols,
- repeats its words one after the other, or
- holds a boilerplate phrase.
A document stays when the kept lines hold at least `min_kept` of its characters;
its text is then the kept lines.

A null, empty or blank text is rejected.  Repeated rows are judged alike.
All columns stay; `text` is cleaned and `n_chars`, where present, follows it.
An empty table stays empty.  Lines are cut at line feeds, and words at spaces.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import c, fresh

SHORT_WORDS = 6
MAX_BARS = 0.2
MAX_SYMBOL_RUNS = 0.2
MAX_REPEATS = 0.3
MIN_KEPT = 0.5
ENDING = r"""[.!?…:;。！？]["'”’»)\]]*$"""
SYMBOL_RUN = r"[^\p{L}\p{N}\s]{2,}"
REPEAT = r"(?:^| )([^ ]++)(?= \1(?: |$))"
#: In the languages of the corpus: English, French, German, Spanish.
BOILERPLATE = (
    "licensed under", "released under the", "all rights reserved", "copyright (c)", "©", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies", "javascript", "lorem ipsum",
    "tous droits réservés", "mentions légales", "politique de confidentialité", "utilisation de cookies",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "verwendung von cookies",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "uso de cookies",
)


def good_line(line: Column) -> Column:
    """Whether a line passes the rules: a struct of `x` (trimmed), `low` (in lower case) and `words`."""
    x, words = line["x"], line["words"]
    return (
        (x != "")
        & ((words >= SHORT_WORDS) | x.rlike(ENDING))
        & (F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) <= words * MAX_BARS)
        & ~reduce(or_, [line["low"].contains(phrase) for phrase in BOILERPLATE])
        & (F.regexp_count(x, F.lit(SYMBOL_RUN)) <= words * MAX_SYMBOL_RUNS)
        & (F.regexp_count(x, F.lit(REPEAT)) <= words * MAX_REPEATS)
    )


def quality_rules(docs: DataFrame, min_kept: float = MIN_KEPT) -> DataFrame:
    """The documents that pass, with cleaned text."""
    trimmed = F.transform(F.split(c("text"), "\n"), lambda x: F.trim(x))
    words = lambda x: (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("double")
    lines = F.transform(trimmed, lambda x: F.struct(x.alias("x"), F.lower(x).alias("low"), words(x).alias("words")))
    clean = F.array_join(F.filter(lines, good_line)["x"], "\n")
    passes = lambda x: (F.length(x) > 0) & (F.length(x) >= F.lit(min_kept) * F.length(F.trim(c("text"))))
    # A generator keeps the optimizer from working the text out again for the condition.
    name = fresh(docs, "_clean")
    passed = docs.withColumn(name, F.explode(F.filter(F.array(clean), passes)))
    out = {"text": F.col(name), "n_chars": F.length(name).cast("long")}
    return passed.select(*[out[name.lower()].alias(name) if name.lower() in out else c(name) for name in docs.columns])


_WORDS = "(length(x) - length(replace(x, ' ', '')) + 1)"
_LINE = f"""(x <> ''
  AND ({_WORDS} >= {SHORT_WORDS} OR regexp_matches(x, '{ENDING.replace("'", "''")}'))
  AND length(x) - length(replace(x, '|', '')) <= {_WORDS} * {MAX_BARS}::DOUBLE
  AND len(regexp_extract_all(x, '{SYMBOL_RUN}')) <= {_WORDS} * {MAX_SYMBOL_RUNS}::DOUBLE
  AND len(list_filter(list_zip(string_split(x, ' ')[:-2], string_split(x, ' ')[2:]), lambda p: p[1] = p[2] AND p[1] <> '')) <= {_WORDS} * {MAX_REPEATS}::DOUBLE
  AND NOT ({' OR '.join(f"contains(lower(x), '{phrase}')" for phrase in BOILERPLATE)}))"""
DOCUMENTS_SQL = f"""
SELECT doc_id, clean AS text, lang, source, length(clean)::BIGINT AS n_chars FROM (
  SELECT *, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: {_LINE}), chr(10)) AS clean FROM documents)
WHERE length(clean) > 0 AND length(clean) >= {MIN_KEPT} * length(trim(text, ' '))
"""
