"""The corpus pipeline stage by stage against brute-force readings of its rules."""

import corpus_pipeline
from helpers import SF001, words_of
from lendnet.llm.common import stored
from lendnet.llm.secrets import RULES
from test_exact import components_by_brute_force, shingles


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "secret_scan", "packing"]
    bench = [words_of(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = dict(texts)
        docs = stored(stage(spark, docs, SF001), name)
        if name == "packing":
            assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(before)
            break
        assert docs.columns == columns
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(texts)
        if name == "near_dedup":
            comp = components_by_brute_force({i: shingles(t, 5) for i, t in before.items()})
            assert set(texts) == {i for i in before if comp[i] == i}
        elif name == "decontamination":
            whole = {i for i, t in before.items() if any(" ".join(b) in " ".join(words_of(t)) for b in bench)}
            assert whole and not whole & set(texts) and set(texts) <= set(before)
        elif name == "secret_scan":
            assert set(texts) == set(before) and any("[REDACTED]" in t for t in texts.values())
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    assert RULES and corpus_pipeline.ORACLE_SQL is None


def test_run_equals_stages(spark):
    rows = corpus_pipeline.run(spark, SF001)
    assert rows.filter("length <= 0 OR sequence_id IS NULL").count() == 0 and rows.count() > 0
