"""Token alignment against a brute-force reading of the definition."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import SF001, edge_docs, empty_docs
from lendnet.llm import alignment
from lendnet.llm.queries import REGISTRY, tokenizer_file

FILES = (tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def twin():
    """text -> (ids, byte ranges) of both sides, None where the bytes do not come back."""
    import base64
    tok = Tokenizer.from_file(FILES[0])
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        by_rank = {int(n): base64.b64decode(t) for t, n in map(bytes.split, f)}

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def ranges(ids, table):
        out, at = [], 0
        for i in ids:
            n = len(table(i))
            out.append((i, at, at + n))
            at += n
        return out

    def run(text):
        if not text:
            return None
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        want = (" " + text).encode()
        if b"".join(by_rank[i] for i in a) != want or b"".join(map(piece, b)) != want:
            return None
        return ranges(a, by_rank.get), ranges(b, piece)
    return run


def expected(twin, texts):
    sides = {i: twin(t) for i, t in texts.items()}
    links, out = {}, {}
    for i, s in sides.items():
        links[i] = [(x, y) for x, s0, e0 in s[0] for y, s1, e1 in s[1] if s0 < e1 and s1 < e0] if s else []
    count = collections.Counter(p for ps in links.values() for p in ps)
    top = collections.defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    for i, s in sides.items():
        if not s:
            out[i] = (i, 0, 0, 0, 0, 0, 0, "")
            continue
        cuts = sorted({e for _, _, e in s[0]} & {e for _, _, e in s[1]})
        parts = []
        for lo, hi in zip([0] + cuts, cuts):
            parts.append("|".join(",".join(str(x) for x, b, e in side if lo < e <= hi) for side in s))
        out[i] = (i, len(s[0]), len(s[1]), len(cuts), len(links[i]), sum(count[p] == top[p[1]] for p in links[i]),
                  sum(count[p] for p in links[i]), hashlib.sha256(";".join(parts).encode()).hexdigest())
    return out


ODD = {10**6: "<|endoftext|> <s> </s> <unk> <0x41> \x00 a  b\n\n c\t d", 10**6 + 1: "▁mark", 10**6 + 2: " ", 10**6 + 3: "",
       10**6 + 4: None, 10**6 + 5: "漢字かな交じり😀 é ﬁ ́ x y", 10**6 + 6: "a" * 500, 10**6 + 7: "  lead and trail  "}


def test_query_equals_brute_force(spark, twin):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    short = {i: t for i, t in texts.items() if len(t or "") < 3000}
    docs = spark.createDataFrame(list({**short, **ODD}.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(r) for r in alignment.alignment_report(docs, *FILES).collect()}
    assert got == expected(twin, {**short, **ODD})
    full = REGISTRY["op11_token_alignment"][0](spark, SF001).collect()
    assert sorted(r["doc_id"] for r in full) == sorted(texts)
    for r in full:
        side = twin(texts[r["doc_id"]])
        assert (r["n_a"], r["n_b"]) == (len(side[0]), len(side[1]))


def test_small_segments_and_blocks_change_nothing(spark, twin, monkeypatch):
    rng = random.Random(4)
    letters = list("ab é漢.,!'  \n\t\x1c <>0") + [" the", " and ", "ing"]
    texts = {i: "".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for i in range(60)}
    want = expected(twin, texts)
    tok = alignment._Tokens(*FILES)
    for size in (0, 7, 60, 1 << 18):
        cut = [alignment.segments(t, size) if size else alignment.units(t) for t in texts.values()]
        assert [" ".join(c) for c in cut] == list(texts.values())
        for t, c in zip(texts.values(), cut):
            for side in (tok.a, tok.b):
                assert [i for x in side.encode(c) for i in x] == side.encode([t])[0]
    # units that the plain split must not make: blanks beside other white space
    for t in ("a b c", "a \u2003 b", "a \t b", "a  b c", " a b", "a b ", "a\nb c", "a \nb", "\u3000 a b"):
        assert alignment.units(t) == alignment.SAFE.split(t)
    monkeypatch.setattr(alignment, "MAX_UNITS", 5)                 # generations of units
    assert tok.encode(list(texts.values())) == tok.encode(list(texts.values())) == alignment._Tokens(*FILES).encode(
        list(texts.values()))
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 50)
    batch = __import__("pyarrow").record_batch({"doc_id": list(texts), "text": list(texts.values())})
    # the block writer needs a task's partition number
    monkeypatch.setattr(alignment.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda s: 3})()))
    monkeypatch.setattr(alignment, "CHUNK", 300)
    monkeypatch.setattr(alignment, "SEGMENT", 40)
    blocks = [r for x in alignment._blocks(*FILES)([batch]) for r in x.to_pylist()]
    assert len(blocks) > 5 and len({r["block"] for r in blocks}) == len(blocks)
    assert [h for r in blocks for h in r["hashes"]] == [w[-1] for w in want.values()]
    assert [n for r in blocks for n in r["n_links"]] == [w[4] for w in want.values()]


def test_divide_finds_every_shared_cut():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 500):
        for share in (0.0, 0.02, 0.5, 1.0):
            a = np.unique(np.append(rng.choice(5 * n, n), 5 * n))
            b = np.unique(np.append(a[rng.random(len(a)) < share], np.append(rng.choice(5 * n, n), 5 * n)))
            cuts = alignment.divide(a, b, np.array([0]), np.array([len(a) - 1]))
            assert a[cuts].tolist() == sorted(set(a) & set(b))


def test_groups_and_edge_rows(spark):
    docs = edge_docs(spark)
    got = alignment.alignment_report(docs, *FILES).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert tuple(by[1])[1:] == tuple(by[2])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert by[3]["n_a"] > 0                                        # blanks are tokens too
    assert alignment.alignment_report(empty_docs(spark), *FILES).count() == 0
    rows = {r["doc_id"]: r["groups"] for r in alignment.token_groups(docs, *FILES).collect()}
    assert rows[1] == [] and rows[5][0]["start"] == 0 and rows[5][-1]["end"] == 4
    for i, groups in rows.items():
        assert [g["start"] for g in groups[1:]] == [g["end"] for g in groups[:-1]]
        if i is not None:
            assert len(groups) == by[i]["n_groups"] and sum(len(g["a_ids"]) for g in groups) == by[i]["n_a"]
    assert alignment.token_groups(empty_docs(spark), *FILES).count() == 0


def test_texts_and_units_reach_a_worker_in_small_parts(spark, monkeypatch):
    """What waits in an executor's and a worker's memory does not grow with the rows of a batch or with new units."""
    def counted(path_a, path_b):
        def run(batches):
            import pyarrow as pa
            for batch in batches:
                empty = [pa.nulls(1, pa.list_(pa.int64())) for _ in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows]), *empty, pa.nulls(1, pa.list_(pa.string())),
                     *(pa.nulls(1, pa.list_(t)) for t in (pa.int32(), pa.int32(), pa.int64())), pa.nulls(1, pa.binary())],
                    names=["block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "hashes",
                           "pair_a", "pair_b", "pair_n", "links"])
        return run
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    monkeypatch.setattr(alignment, "_blocks", counted)
    docs = spark.range(2500).selectExpr("id AS doc_id", "'a b' AS text").coalesce(1)
    rows = [r.block for r in alignment.aligned_blocks(docs, *FILES).collect()]
    assert sum(rows) == 2500 and max(rows) <= 1000 and spark.conf.get(key) == before

    tok, asked = alignment._Tokens(*FILES), []
    for name in "ab":
        side = getattr(tok, name)
        setattr(tok, name, side._replace(encode=lambda us, f=side.encode: asked.append(len(us)) or f(us)))
    words = [f"w{i}" for i in range(9000)]
    first = tok.encode([" ".join(words)])
    assert sum(asked) == 18000 and max(asked) <= 5000
    monkeypatch.setattr(alignment, "MAX_UNITS", 5)              # known units come over from the old generation
    assert tok.encode([" ".join(words)]) == first and sum(asked) == 18000


def test_one_unit_that_does_not_come_back_leaves_the_others(monkeypatch):
    tok = alignment._Tokens(*FILES)
    broken = alignment._Tokens(*FILES)
    table = list(broken.b.table)
    table[broken.b.encode(["two"])[0][0]] = b"?"
    broken.b = broken.b._replace(table=table)
    assert broken.encode(["one two three", "two", "one three"])[:2] == [None, None]
    assert broken.encode(["one three"]) == tok.encode(["one three"])
    monkeypatch.setattr(alignment, "MAX_UNITS", 0)
    assert broken.encode(["two", "one three"]) == [None, *tok.encode(["one three"])]
