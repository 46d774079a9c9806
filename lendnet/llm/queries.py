"""Registered queries of the training-data operators: name -> (builder, DuckDB oracle SQL or None).

Each ``opN_*`` query applies its operator, with production parameters, to the whole table and
derives the contract's digest columns. ``pipeline`` lives in ``corpus_pipeline.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lendnet.llm.alignment import alignment_report
from lendnet.llm.common import table
from lendnet.llm.curves import nearest
from lendnet.llm.decontam import contamination
from lendnet.llm.html_text import extract_text
from lendnet.llm.langid import language_id
from lendnet.llm.neardup import near_duplicates
from lendnet.llm.packing import pack
from lendnet.llm.quality_rules import STOP_WORDS, quality_rules
from lendnet.llm.runs import periodic_runs
from lendnet.llm.secrets import scan
from lendnet.llm.substring import substring_dedup
from lendnet.llm.tokenfile import token_files
from lendnet.llm.toxicity import toxicity

REGISTRY: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, [x FOR x IN string_split_regex(t, '[ \t-\r]+') IF x <> ''] AS w,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^ \t-\r]')] AS l FROM d),
tri AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
        FROM s, unnest(range(1, len(w) - 1)) AS r(p)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
m AS (SELECT s.doc_id, len(w)::BIGINT AS n_words,
             coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
             len([x FOR x IN w IF x IN ({_STOPS})]) AS n_stop
      FROM s LEFT JOIN cov ON cov.doc_id = s.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND word_chars / greatest(n_words, 1)::DOUBLE BETWEEN 2.0 AND 14.0
        AND n_symbols / greatest(n_words, 1)::DOUBLE <= 0.25
        AND n_stop / greatest(n_words, 1)::DOUBLE >= 0.03
        AND n_dup_lines / greatest(n_lines, 1)::DOUBLE <= 0.4
        AND n_repeat_words / greatest(n_words, 1)::DOUBLE <= 0.5) AS kept
FROM m
"""


@query("op10_quality_rules", OP10_SQL)
def op10_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).drop("failed_rules", "n_lines", "n_stop_words")


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query("op2_packing")
def op2_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op6_token_files")
def op6_token_files(spark, sf_dir):
    return token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


@query("op7_html_text")
def op7_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


@query("op8_near_duplicates")
def op8_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))


# op13: every tenth document (by crc32 of its id) repeats a stretch of its own words from word a on
def cycled(docs):
    """doc_id and text, with the words of every tenth document made periodic from word g % n on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"))
    # only the chosen documents' words become arrays
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda x: x != ""))
    d = d.withColumn("w", words).withColumn("n", F.size("w").cast("long"))
    d = d.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.col("g") % F.col("n"))
    d = d.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    text = F.expr("array_join(transform(sequence(0L, n - 1), "
                  "i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    runs = periodic_runs(cycled(table(spark, sf_dir, "documents")))
    # greatest length / period as whole numbers; runs come by start, then period, so the first of equals stays
    best = F.expr("aggregate(runs, get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (runs.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    return alignment_report(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                            tokenizer_file("piece_bpe_32k.model"))


@query("op12_nearest_vectors")
def op12_nearest_vectors(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)
