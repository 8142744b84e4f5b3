"""Importance resampling against brute force, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(text, max_n, m):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % m for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(rows, items, max_n, m, min_words, percent, seed):
    s, t = Counter(), Counter()
    feats = [buckets(x, max_n, m) for _, x in rows]
    for f in feats:
        s.update(f)
    for x in items:
        t.update(buckets(x, max_n, m))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + m) / ((s[b] + 1) * (T + m)))) for b in range(m)]
    out = []
    for (i, x), f in zip(rows, feats):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((o for o in out if o[5] >= min_words), key=lambda o: (-o[3], o[0] is not None, o[0]))
    for k, o in enumerate(able[:percent * len(able) // 100]):
        o[4] = k + 1
    return sorted((tuple(o[:5]) for o in out), key=repr)


def run(df, target, **kw):
    return sorted((tuple(r) for r in resample.resample(df, target, **kw).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def rows_of(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(80)] + ["Été", "ÄÖ", "x_y", "A-b", "日本", "\x01"]
    rows = [(i, r.choice([" ", ", ", "\n"]).join(r.choices(vocab, k=r.randint(0, 60)))) for i in range(120)]
    return rows + [(120, None), (121, ""), (122, " .\t"), (123, "word " * 40_000), (124, "x" * 70_000), (None, "null id " * 15), (5, rows[5][1])]


@pytest.mark.parametrize("max_n,head", [(1, 50_000), (1, 3), (2, 50_000), (2, 5), (3, 4)])
def test_equals_brute_force_with_any_head(spark, max_n, head):
    rows = rows_of(max_n)
    items = [t for _, t in rows[:9]] + [None, "other words w1"]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("rank", "score", "weight", "__pos", "f", "c")})
    target = spark.createDataFrame([(x, 1) for x in items], "text string, score int")
    got = run(df, target, max_n=max_n, head=head, buckets=97, min_words=20, percent=30)
    assert got == brute(rows, items, max_n, 97, 20, 30, 2024)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10), (2, "d")], "doc_id long, text string")
    assert run(none, some) == []
    assert run(some, none, percent=100) == brute([(1, "a b c " * 10), (2, "d")], [], 1, 10_000, 20, 100, 2024)


def test_equal_rows_share_out_the_ranks(spark):
    rows = [(7, "same text here " * 10)] * 300 + [(i, "some other words " * 10) for i in range(100)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("same text",)], "text string"), percent=50)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 201))
    assert got == brute(rows, ["same text"], 1, 10_000, 20, 50, 2024)


def test_drawn_documents_resemble_the_target(spark):
    r = random.Random(4)
    near, far = [f"t{i}" for i in range(50)], [f"s{i}" for i in range(500)]
    rows = [(i, " ".join(r.choices(near if i % 10 == 0 else far, k=60))) for i in range(1000)]
    items = [(" ".join(r.choices(near, k=40)),) for _ in range(50)]
    got = resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "text string")).where("rank is not null")
    ids = [x.doc_id for x in got.collect()]
    assert len(ids) == 100 and sum(i % 10 == 0 for i in ids) >= 95


def test_contract_query_equals_its_sql(spark):
    import duckdb

    from tests.conftest import SF_SMALL
    from tidemark.llm import queries
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE['op13_target_resampling']})").fetchall())
    got = sorted(tuple(r) for r in queries.op13_target_resampling(spark, SF_SMALL).select(*cols).collect())
    assert got == want and sum(r[4] is not None for r in got) > 0
