"""Small documents with the awkward cases every operator must take, and brute-force twins."""

import re

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EN = "the cat sat on the mat and it was a warm day for all of them in the old town by the river with no wind at all"
DE = "der hund und die katze sind mit dem kind in das haus gegangen und es war ein tag ohne wind für alle"

EDGE = [
    (None, None, None, None), (None, "null id text", "en", "s"), (1, None, "en", "s"), (2, "", "de", "s"),
    (3, " \t\n ", None, "s"), (4, "one", "en", None), (5, "a b", "en", "s"), (6, "\x00odd\x1f ü漢字😀 İ ſ", "fr", "s"),
    (7, EN, "en", "s"), (7, EN, "en", "s"), (8, EN, "en", "s"), (9, "!!! ??? 123 $$$", "en", "s"),
    (10, " ".join([EN] * 40), "en", "s"), (11, "line\nline\n\nline  x", "en", "s"), (12, DE, "de", "s"),
    (13, "tie tie tie tie tie tie", "en", "s"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def edge_docs(spark, extra=True):
    df = spark.createDataFrame(EDGE, SCHEMA)
    if not extra:
        return df
    # names an operator might use inside
    for c in ("score", "key", "node", "fp", "comp", "at", "part", "block", "kinds", "_key", "_t", "_w", "label", "n", "h"):
        df = df.selectExpr("*", f"'clash' AS `{c}`")
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
