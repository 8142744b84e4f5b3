"""Secret scan: base spans and the battery with its false-discovery control against brute
force in plain Python, texts of very many findings, empty tables."""

import base64
import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from tidemark.llm import secret_scan as S

ASSIGN, OPAQUE = re.compile(S.ASSIGN), re.compile(S.OPAQUE)


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16])


def phi(z):
    x = abs(z)
    u = 1 / (1 + 0.2316419 * x)
    poly = u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))
    tail = max(math.exp(-x * x / 2) / 2.5066282746310002 * poly, 1e-15)
    return tail if z < 0 else 1 - tail


def battery(token):
    body = token.rstrip("=")
    enc = next(i for i, (_, p, _) in enumerate(S.ENCODINGS) if i == len(S.ENCODINGS) - 1 or re.search(p, body))
    alphabet = S.ENCODINGS[enc][2]
    v = [alphabet.find(c) for c in (body.lower() if enc in (1, 3, 4) else body)]
    n, m = len(v), len(alphabet)
    count, mean, high = Counter(v), sum(v) / len(v), sum(x >= m / 2 for x in v)
    sq = sum(c * c for c in count.values())
    runs = 1 + sum((a >= m / 2) != (b >= m / 2) for a, b in zip(v, v[1:]))
    rate, couples = max(S.TEXT_RATE, 2 / m), n * (n - 1) / 2
    p_chi = phi(((sq - n) / 2 - couples * rate) / math.sqrt(couples * rate * (1 - rate) + n * (n - 1) * (n - 2) * S.TEXT_SPREAD))
    expect = 2 * high * (n - high) / n + 1
    var = (expect - 1) * (expect - 2) / (n - 1)
    z_runs = abs(runs - expect) / math.sqrt(var) if var > 0 else 99.0
    dev = sum((x - mean) ** 2 for x in v)
    z_serial = abs(sum((a - mean) * (b - mean) for a, b in zip(v, v[1:])) / dev) * math.sqrt(n) if dev > 1e-9 else 99.0
    uneven = m / n * sq - n > (m - 1) + S.VETO * math.sqrt(2 * (m - 1))
    p = 1.0 if uneven or z_runs > S.VETO or z_serial > S.VETO else p_chi
    return enc * 100 + min(12, int(math.log2(n))), min(S.LAST_BIN, max(0, math.floor(-10 * math.log10(p))))


def brute(texts, fdr=0.05):
    base = [base_spans(t or "") for t in texts]
    runs = [[(m.start(), m.end(), battery(m[0])) for m in OPAQUE.finditer(t or "") if not any(s < m.end() and m.start() < e for s, _, e in b)] for t, b in zip(texts, base)]
    bins = defaultdict(Counter)
    for r in runs:
        for _, _, (stratum, b) in r:
            bins[stratum][b] += 1
    least = {}
    for stratum, c in bins.items():  # the largest p-value below its Benjamini-Hochberg line
        total, found = sum(c.values()), 0
        for b in sorted(c, reverse=True):
            found += c[b]
            if 10 ** (-b / 10) <= fdr * found / total:
                least[stratum] = b
    text = lambda spans: ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return [(text(b), text(sorted(b + [(s, 3, e) for s, e, (st, x) in r if x >= least.get(st, 10 ** 9)]))) for b, r in zip(base, runs)]


def texts_of(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("etaoinshrdlu", k=r.randint(2, 9)))
    secret = lambda: r.choice([lambda: base64.b64encode(r.randbytes(30)).decode(), lambda: r.randbytes(20).hex().upper(), lambda: "".join(r.choices(S.UPPER + "234567", k=32)),
                               lambda: base64.urlsafe_b64encode(r.randbytes(24)).decode(), lambda: "".join(r.choices(S.DIGITS, k=24)), lambda: "".join(r.choices(S.UPPER + S.LOWER + S.DIGITS, k=40))])()
    odd = lambda: r.choice([lambda: "-".join(word() for _ in range(6)), lambda: "a" * 30, lambda: "/".join([word()] * 9), lambda: "abcdefghijklmnopqrstuvwxyz" * 2,
                            lambda: f"token = {secret()}", lambda: f'api_key="{word()}"', lambda: "AKIA" + "".join(r.choices(S.UPPER + S.DIGITS, k=r.randint(10, 20))),
                            lambda: r.randbytes(9).hex(), lambda: f"mysecret:{secret()}.{secret()}", lambda: "é" + secret() + "é", lambda: "password: " + "x" * 11])()
    return ["".join(r.choice([" ", "\n", ", "]) + (word() if r.random() < 0.8 else secret() if r.random() < 0.5 else odd()) for _ in range(r.randint(0, 60))) for _ in range(150)]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_spans_equal_brute_force(spark, seed):
    texts = texts_of(seed) + [None, "", "x", "one " * 5000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: (r.base_sha256, r.spans) for r in S.findings(df).collect()}
    want = brute(texts)
    assert sum("random" in s for _, s in want) > 20
    assert [got[i] for i in range(len(texts))] == [(hashlib.sha256(b.encode()).hexdigest(), s) for b, s in want]


def test_texts_of_very_many_findings_take_linear_time(spark):
    r = random.Random(3)
    many = lambda n: " ".join(r.choice([r.randbytes(10).hex(), base64.b64encode(r.randbytes(24)).decode(), f"token={'ab1' * 5}"]) for _ in range(n))
    texts = [many(5000), many(700)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()
    df.count()
    t = time.time()
    got = {x.doc_id: x for x in S.findings(df).collect()}
    assert time.time() - t < 60
    assert [got[i].spans for i in (0, 1)] == [s for _, s in brute(texts)]
    kept = {x.doc_id: x.text for x in S.redact(df).collect()}
    assert "token=ab1" not in kept[0] and kept[0].count("[SECRET]") > 3000


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.findings(df).count() == 0 and S.redact(df).count() == 0
