"""Every operator on null, empty, odd, repeated and clashing input, and on an empty table."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from helpers import EDGE, edge_docs, empty_docs
from lendnet.llm.common import fold_remainder
from lendnet.llm.decontam import contamination, decontaminate
from lendnet.llm.html_text import extract_text
from lendnet.llm.langid import language_id
from lendnet.llm.neardup import deduplicate, near_duplicates
from lendnet.llm.packing import pack
from lendnet.llm.quality_rules import quality_rules
from lendnet.llm.secrets import redact, scan
from lendnet.llm.substring import substring_dedup
from lendnet.llm.tokenfile import token_files
from lendnet.llm.toxicity import reject, toxicity

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD_BPE = str(public_tokenizers.path("word_bpe_49k.json"))


def labels(spark):
    return spark.createDataFrame([(7, 0, 1), (12, 0, 0), (None, 1, 1), (10, 0, 0), (4, 0, None)],
                                 "doc_id long, quality int, toxic int")


def bench(spark):
    return spark.createDataFrame([(1, "the cat sat on the mat and it was a warm day for all of them"), (2, None),
                                  (3, ""), (4, "zz"), (None, "x y z")], "item_id long, text string")


ROWWISE = {
    "langid": lambda s, d: language_id(d), "scan": lambda s, d: scan(d), "redact": lambda s, d: redact(d),
    "substring": lambda s, d: substring_dedup(d), "near": lambda s, d: near_duplicates(d),
    "toxicity": lambda s, d: toxicity(d, labels(s)), "quality": lambda s, d: quality_rules(d),
    "files": lambda s, d: token_files(d, WORD_BPE, 2),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_one_row_out_per_row_in(spark, name):
    out = ROWWISE[name](spark, edge_docs(spark)).collect()
    assert len(out) == len(EDGE)
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(x[0]) for x in EDGE)


@pytest.mark.parametrize("name", ROWWISE)
def test_empty_table(spark, name):
    assert ROWWISE[name](spark, empty_docs(spark)).count() == 0


def test_pieces_and_filters_on_edge_rows(spark):
    docs = edge_docs(spark)
    pieces = pack(docs, BPE).collect()
    assert sum(r["length"] for r in pieces if r["start"] == 0 and r["doc_tokens"] == 1) == 3
    assert {r["doc_id"] for r in contamination(docs, bench(spark)).collect()} == {7, 8, 10}
    clean = decontaminate(docs, bench(spark))
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {x[0] for x in EDGE} - {7, 8, 10}
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["None", "None"] + [str(i) for i in range(1, 14) if i not in (8, 10)])
    assert reject(docs, labels(spark)).columns == docs.columns


def test_filters_on_empty_tables(spark):
    docs, none = empty_docs(spark), bench(spark).filter("false")
    assert pack(docs, BPE).count() == 0
    assert contamination(docs, bench(spark)).count() == 0
    assert contamination(edge_docs(spark), none).count() == 0
    assert decontaminate(edge_docs(spark), none).count() == len(EDGE)
    assert deduplicate(docs).count() == 0
    assert reject(edge_docs(spark), labels(spark).filter("false")).count() == len(EDGE)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, "<p>a"), (2, "u", ""), (2, "u", "x<b"),
                                   (3, "u", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    got = sorted((str(r["page_id"]), r["text"]) for r in extract_text(pages.selectExpr("*", "1 AS text")).collect())
    assert got == [("1", ""), ("2", ""), ("2", "x<b"), ("3", "deep"), ("None", "a")]
    assert extract_text(pages.filter("false")).count() == 0


def test_undetermined_language(spark):
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id(edge_docs(spark, extra=False)).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "und")} <= got
    assert all(p in ("en", "de", "fr", "und") for _, p in got)
    untaught = language_id(edge_docs(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}


def test_fold(spark):
    import zlib
    rows = spark.range(50).select("id", fold_remainder("id").alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)
