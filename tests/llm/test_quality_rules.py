import random
import re

from pyspark.sql import functions as F

from trawl.llm import quality

pick = random.Random(14)
WORDS = ["".join(pick.choice("aeioutnshrdlé") for _ in range(pick.randint(2, 8))) for _ in range(60)]


def good(line):
    """The rules, written out."""
    x = line.strip(" ")
    if not x:
        return False
    words = len(x.split(" "))
    repeats = sum(a == b and a != "" for a, b in zip(x.split(" "), x.split(" ")[1:]))
    ends = re.search(r"""[.!?…:;。！？]["'”’»)\]]*$""", x)
    symbols = len(re.findall(r"[^\w\s]{2,}", x.replace("_", "-")))
    return (words >= 6 or bool(ends)) and x.count("|") <= words * 0.2 and symbols <= words * 0.2 and repeats <= words * 0.3 and not any(p in x.lower() for p in quality.BOILERPLATE)


def line():
    words = [pick.choice(WORDS) for _ in range(pick.randint(0, 14))]
    for _ in range(pick.choice([0, 0, 0, 2, 5])):
        words.insert(pick.randint(0, len(words)), pick.choice(["|", "***", "##", "a--", words[0] if words else "x", "", "Privacy Policy", "Alle Rechte vorbehalten"]))
    if pick.random() < 0.3 and words:
        words[1:3] = [words[0]] * 2
    return " ".join(words) + pick.choice(["", ".", "!", '."', " "])


def test_documents_against_the_rules_written_out(spark):
    rows = [(i, "\n".join(line() for _ in range(pick.randint(0, 8)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, " \n \n"), (903, "A whole sentence of more than six words. " * 4000), (904, "One whole sentence that repeats as a row."), (904, "One whole sentence that repeats as a row."), (None, "A null id has a sentence that is whole.")]
    expected = []
    for i, text in rows:
        kept = "\n".join(x.strip(" ") for x in (text or "").split("\n") if good(x))
        if kept and len(kept) >= 0.5 * len(text.strip(" ")):
            expected.append((i, kept, len(kept)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"N_chars": F.lit(0).cast("long"), "_clean": F.lit("kept"), "a.b": F.lit(1)})
    out = quality.quality_rules(df)
    got = out.collect()
    assert sorted([(r.doc_id, r.text, r.N_chars) for r in got], key=lambda x: (x[0] is None, x[0] or 0, x[1])) == sorted(expected, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert 100 < len(expected) < 380 and out.columns == df.columns and {r["_clean"] for r in got} == {"kept"}
    assert quality.quality_rules(df.where("false")).collect() == []
