"""Language identification: codes, n-grams and margins against brute force, held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MED
from tidemark.llm import langid, queries

DOCS = "doc_id long, text string, lang string"


def grams(text):
    raw = langid.folded(text)
    out = []
    for n in langid.ORDERS:
        for i in range(len(raw) - n + 1):
            g = int.from_bytes(raw[i:i + n], "big")
            out.append((((g ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - langid.BUCKET_BITS))
    return out


def brute_model(rows):
    count = {}
    for t, lang in rows:
        count.setdefault(lang, Counter()).update(grams(t))
    langs = sorted(x for x in count if count[x])
    code = langid.code_words(len(langs))
    size = 1 << langid.BUCKET_BITS
    share = np.array([[(count[x][b] + langid.ALPHA) / (sum(count[x].values()) + langid.ALPHA * size) for b in range(size)] for x in langs])
    weights = np.stack([np.log(share[code[:, j] == 1].mean(axis=0) / share[code[:, j] == 0].mean(axis=0)) for j in range(code.shape[1])], axis=1)

    def margins(t):
        g = grams(t)
        return weights[g].sum(axis=0) / math.sqrt(max(1, len(g)))

    accuracy = np.ones(code.shape)
    for i, x in enumerate(langs):
        own = [margins(t) for t, lang in rows if lang == x]
        for j in range(code.shape[1]):
            accuracy[i, j] = (sum((m[j] > 0) == (code[i, j] == 1) for m in own) + 1) / (len(own) + 2)

    def predict(t):
        if not any(c.isalpha() for c in t or ""):
            return "und", 0.0
        m = margins(t)
        d = []
        for i in range(len(langs)):
            w = accuracy[i] / accuracy[i].sum() * code.shape[1]
            d.append(sum(w[j] * float(np.logaddexp(0, -m[j] if code[i, j] else m[j])) for j in range(code.shape[1])))
        best = min(range(len(langs)), key=lambda i: d[i])
        return langs[best], 1 / sum(math.exp(d[best] - x) for x in d)

    return predict


def synthetic(k, n, seed, hot=0):
    r = random.Random(seed)
    vocab = [["".join(r.choices("abcdefghijklmnoprstuvéüñß", k=r.randint(2, 7))) for _ in range(60)] for _ in range(k)]
    rows = []
    for i in range(n):
        lang = 0 if r.random() < hot else r.randrange(k)
        rows.append((i, " ".join(r.choices(vocab[lang], k=r.randint(3, 40))), f"l{lang:02d}"))
    return rows


def predicted(spark, rows, model, **kw):
    df = spark.createDataFrame([(i, t, "never read") for i, t, _ in rows], "doc_id long, text string, lang_pred string")
    return [(r.doc_id, r.lang_pred, r.score, r.ambiguous) for r in langid.identify(df, model, **kw).collect()]


def test_equals_brute_force(spark):
    rows = synthetic(4, 60, 1)
    extra = [(100, None, "l00"), (101, "", "l01"), (102, "123 -- !", "l02"), (103, "ÉÑ", None), (104, "x", "l01"), (105, "long text " * 40_000, None), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows + extra, DOCS).withColumns({c: F.lit("clash") for c in ("bucket", "n", "lang_pred", "word")})
    model = langid.fit(df, F.col("doc_id") % 3 != 0)
    predict = brute_model([(t, lang) for i, t, lang in rows + extra if i % 3 and lang is not None])
    for i, lang, score, _ in predicted(spark, rows + extra, model):
        t = next(t for j, t, _ in rows + extra if j == i)
        want = predict(t)
        assert lang == want[0] and score == pytest.approx(want[1], rel=1e-4), (i, t and t[:40])


def test_many_languages_and_a_hot_one(spark):
    rows = synthetic(12, 900, 2, hot=0.4)
    model = langid.fit(spark.createDataFrame(rows, DOCS), F.col("doc_id") % 5 != 0)
    assert model.code.shape == (12, 7 + 8 * 4)
    truth = {i: lang for i, _, lang in rows}
    got = [(i, p) for i, p, _, _ in predicted(spark, [r for r in rows if r[0] % 5 == 0], model)]
    assert sum(truth[i] == p for i, p in got) >= 0.97 * len(got)


@pytest.mark.parametrize("k", [2, 3, 4, 5, 9, 40])
def test_code_words(k):
    code = langid.code_words(k)
    signs = {tuple(c) if c[0] == 0 else tuple(1 - c) for c in code.T}
    assert len(signs) == code.shape[1] and all(0 < c.sum() < k for c in code.T)
    distance = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(distance) >= (1 << (k - 2) if k <= 5 else code.shape[1] // 4)


def test_ambiguous_texts_are_flagged(spark):
    rows = synthetic(3, 200, 3)
    model = langid.fit(spark.createDataFrame(rows, DOCS), F.lit(True))
    a, b = next(t for _, t, x in rows if x == "l00"), next(t for _, t, x in rows if x == "l01")
    got = {i: (p, s, f) for i, p, s, f in predicted(spark, [(1, a * 3, ""), (2, f"{a} {b}" * 2, ""), (3, "q", "")], model, gap=0.5)}
    assert got[1][0] == "l00" and not got[1][2] and got[3][2]
    assert got[3][1] < got[1][1] and got[2][1] <= got[1][1]


def test_nothing_or_one_language_learned(spark):
    empty = spark.createDataFrame([], DOCS)
    some = [(1, "words here", "xx"), (2, None, "xx"), (None, "null id", None)]
    none = langid.fit(empty, F.lit(True))
    assert [r[1:3] for r in predicted(spark, some, none)] == [("und", 0.0)] * 3
    assert langid.identify(empty, none).count() == 0
    one = langid.fit(spark.createDataFrame(some, DOCS), F.lit(True))
    assert sorted(r[1:3] for r in predicted(spark, some, one)) == [("und", 0.0), ("xx", 1.0), ("xx", 1.0)]


def test_held_out_accuracy(spark):
    out = queries.op11_language_id(spark, SF_MED).join(spark.read.parquet(f"{SF_MED}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n")), "doc_id")
    held = out.where("held_out").collect()
    assert len(held) > 150 and all(0 <= r.score <= 1 for r in held)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held), [(r.lang, r.lang_pred, r.n) for r in held if r.lang != r.lang_pred]
