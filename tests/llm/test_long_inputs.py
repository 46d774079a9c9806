"""Inputs that once cost the square of their size, or lost n-grams at a cut."""

import time

import numpy as np
import pyarrow as pa
import pytest

from lendnet.llm import html_text, langid


@pytest.mark.parametrize("page", [
    "<b" * 300_000, "<a " * 200_000, '<a href="x ' * 60_000, "<!x " * 150_000, "<a \"'> " * 90_000, "</script" * 80_000,
    "<script>" + "</script" * 80_000, "<a '>" * 120_000 + '"', '<a "x' * 100_000 + ">", "<a \"><b '" * 60_000])
def test_hostile_pages_take_linear_time(page):
    t = time.process_time()
    html_text.parse(page)
    assert time.process_time() - t < 10          # hours at the square of these sizes


def test_tags_end_outside_quotes_or_at_the_first_mark():
    def tags(page):
        out, at, scan = [], 0, html_text.Tags(page)
        while (found := scan.next(at)) is not None:
            out.append(found[2:])
            at = found[1]
        return out
    assert tags("<a x='>' y>b</A >") == [(False, "a", " x='>' y"), (True, "A", " ")]
    assert tags("<a x='1>b<i>") == [(False, "a", " x='1"), (False, "i", "")]
    assert tags("1 < 2 <!-- > --> <!x> <b") == [(False, None, ""), (False, None, "")]
    assert tags("<!-- open") == [(False, None, "")] and tags("<b><") == [(False, "b", "")]


def test_language_counts_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abc déñ \n"), n)) for n in (0, 1, 2, 3, 5, 17, 64, 200, 1001)]
    col = pa.array(texts + [None])

    def counts():
        total = np.zeros((len(col), langid.SIZE + 1), np.int64)
        for rows, parts, skip in langid._batches(col):
            cp = np.concatenate(parts)
            who = np.repeat(rows, [len(parts[2 * i]) + len(parts[2 * i + 1]) for i in range(len(rows))])
            for cell in langid._cells(cp):
                cell[skip] = langid.SIZE
                np.add.at(total, (who, cell), 1)
        return total[:, :langid.SIZE]
    whole = counts()
    for block in (3, 7, 50):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert (counts() == whole).all()


def test_language_model_by_hand(spark):
    """Naive Bayes recomputed with dictionaries over the same labelled rows."""
    from math import exp, log
    from helpers import DE, EN
    docs = [(i, t, lang) for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (EN[:40], "en"), (DE[10:70], "de"),
                                                         ("the cat", None), ("die katze ist", None)] * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.train(df)

    def grams(text):
        cp = np.frombuffer((text + "\0\0").encode("utf-32-le"), np.uint32)
        return [c[c < langid.SIZE] for c in langid._cells(cp)]
    n = {"de": 0, "en": 0}
    table = {x: np.zeros(langid.SIZE) for x in n}
    for _, t, lang in docs:
        if lang:
            n[lang] += 1
            for c in grams(t):
                np.add.at(table[lang], c, 1)
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    width = 1 << langid.BITS
    for i, t, _ in docs:
        ll = {}
        for lang in n:
            ll[lang] = log(n[lang] / sum(n.values()))
            for k, c in enumerate(grams(t)):
                part = table[lang][k * width:(k + 1) * width] + langid.ALPHA
                ll[lang] += np.log(part[c - k * width] / part.sum()).sum()
        best = max(ll, key=ll.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 / sum(exp(v - ll[best]) for v in ll.values()), rel=1e-4)
