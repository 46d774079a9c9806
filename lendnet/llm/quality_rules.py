"""Quality rules: a threshold table compiled into one Spark projection (no user functions).

Words are runs of characters other than space and U+0009-U+000D. Every measure is a built-in
expression over one row's text, so a document never leaves its scan task: no shuffle, no Python.

Cases: null or empty text has zero words and fails the base rule (too few words); repeated rows and
repeated ids are judged row by row; very long texts cost n log n in their words; columns of the
input other than ``doc_id`` and ``text`` are dropped, so clashing names cannot arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PCT = 50

# fixed values: frequent function words of the four corpus languages
STOP_WORDS = (
    "the of and to in a is that for it was with as on be by this from at an are or have not "
    "der die das und ist von den mit zu sich auf ein eine im dem nicht des es auch als "
    "le la les de des et en un une du que qui est dans pour sur pas par au avec il "
    "el los las y del se por con para una su al lo como no"
).split()

# (measure, lowest allowed, highest allowed); None leaves that side open
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 14.0),
    ("symbol_word_ratio", None, 0.25),
    ("stop_word_ratio", 0.03, None),
    ("dup_line_ratio", None, 0.4),
    ("repeat_word_ratio", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` (a lambda variable is not re-evaluated)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Number of words lying in a 3-word window that occurs at least twice in ``words``.

    Windows are 64-bit hashes. Only where some hash repeats are they sorted with their positions:
    equal neighbours are repeated windows, and the union of the intervals [p, p + 2] is counted in
    one pass over the sorted positions. ``words`` must be a plain column.
    """
    n = F.size(words)
    triples = F.arrays_zip(F.slice(words, F.lit(1), n - 2).alias("a"), F.slice(words, F.lit(2), n - 2).alias("b"),
                           F.slice(words, F.lit(3), n - 2).alias("c"))
    hashes = F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"]))

    def positions(a: Column) -> Column:
        m = F.size(a)
        same = lambda x, k: ((k > 0) & (F.get(a, k - 1)["h"] == x["h"])) | (
            (k < m - 1) & (F.get(a, k + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(F.filter(a, same), lambda x: x["p"]))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))

    def covered(h: Column) -> Column:
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.aggregate(
            _let(keyed, positions), start,
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    zero = F.lit(0).cast("long")
    return F.when(n < 4, zero).otherwise(
        _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(covered(h))))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id plus the raw counts of every document (null text counts as empty)."""
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    split = base.select(
        "doc_id", "_t",
        F.array_remove(F.split("_t", "[ \\t-\\r]+"), "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("_l"))
    stops = list(dict.fromkeys(STOP_WORDS))
    return split.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: w.isin(*stops))).cast("long").alias("n_stop_words"),
    )


RATIOS = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "mean_word_chars": lambda: F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    "symbol_word_ratio": lambda: F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1)),
    "stop_word_ratio": lambda: F.col("n_stop_words") / F.greatest(F.col("n_words"), F.lit(1)),
    "dup_line_ratio": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "repeat_word_ratio": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
}


def compile_rules(thresholds=THRESHOLDS) -> tuple[Column, Column]:
    """(passes all rules, names of the failed rules) as Columns over ``measures``."""
    ok = F.lit(True)
    failed = []
    for name, low, high in thresholds:
        value = RATIOS[name]()
        holds = F.lit(True)
        if low is not None:
            holds = holds & (value >= F.lit(float(low)))
        if high is not None:
            holds = holds & (value <= F.lit(float(high)))
        ok = ok & holds
        failed.append(F.when(~holds, F.lit(name)))
    return ok, F.array_compact(F.array(*failed))


def quality_rules(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept`` and the list of failed rules."""
    m = measures(docs)
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    ok, failed = compile_rules(thresholds)
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed.alias("base_failed"), (~base_failed & ok).alias("kept"),
                    F.array_join(failed, ",").alias("failed_rules"), "n_lines", "n_stop_words")
