"""Token alignment against brute force over byte ranges, and against the tokenizer libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from tests.conftest import SF_SMALL
from tidemark.llm import align, common

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = align.byte_letters()
    of_a = {i: bytes(letters[c] for c in w) for w, i in t.get_vocab(with_added_tokens=False).items()}

    def of_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        raw = (" " + text).encode()
        return (a, b) if b"".join(of_a[i] for i in a) == raw == b"".join(map(of_b, b)) else ([], [])

    return encode, of_a.__getitem__, of_b


def brute(texts, libraries):
    encode, of_a, of_b = libraries
    docs, counts = [], Counter()
    for text in texts:
        a, b = encode(text)
        spans = []
        for ids, of in ((a, of_a), (b, of_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(of(i)), i))
                at += len(of(i))
            spans.append(out)
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            (s, e, x), (u, v, y) = spans[0][i], spans[1][j]
            assert s < v and u < e
            links.append((x, y))
            i, j = i + (e <= v), j + (v <= e)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start < e <= end) for side in spans))
            start = end
        docs.append((len(a), len(b), len(ends), links, ";".join(groups)))
        counts.update(links)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(na, nb, ng, len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls),
             hashlib.sha256(g.encode()).hexdigest() if na else "") for na, nb, ng, ls, g in docs]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HOSTILE = ["", " ", "  ", "a", " a", "a ", "a  b", "x\ty\n z", "\n\n  a\n b  \n", "<s> </s> <unk> <0x41> <|endoftext|>", "a▁b", "▁ ▁▁ a", "ﬁ Å é é", "日本語 текст 😀👍🏽",
           "it's we'll don't 's 12 34.5 --- ... !!", "  a b \u0085c \x1c d ​", "\x00\x01 a", "word " * 3000, "x" * 3000, " " * 300, "a\nb\nc d" * 200,
           "﻿bom", "tail \n", "tail \t ", "é" * 20, "\r\n\r\n x"]


def rows_of():
    r = random.Random(5)
    chars = " \t\n'aeéßñ日😀.,-<>|▁0123sthe"
    return HOSTILE + ["".join(r.choices(chars, k=r.randint(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_equals_brute_force_with_any_head(spark, libraries, head):
    texts = rows_of() + [None, HOSTILE[14]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("links", "groups", "n_a", "code", "__tail")})
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.alignment_digest(df, A, B, head=head).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, libraries)


def test_whole_documents_table(spark, libraries):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = df.orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.alignment_digest(df, A, B).collect()}
    assert [got[r.doc_id] for r in rows] == brute([r.text for r in rows], libraries)


def test_empty_table_null_ids_and_repeated_rows(spark, libraries):
    assert align.alignment_digest(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    rows = [(None, "some text"), (None, "some text"), (3, None), (3, "")]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in align.alignment_digest(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()))
    assert got == sorted(brute([t for _, t in rows], libraries))


def test_merging_by_rank_equals_the_library():
    spec, model = common.read_file(A).decode(), common.read_file(B)
    pair = align.Pair(spec, model)
    assert pair.a.ranked is not None
    texts = [" " + t for t in rows_of()]
    fast = [x.tolist() for x in pair.a.encode(texts)]
    pair.a.ranked = None
    assert [x.tolist() for x in pair.a.encode(texts)] == fast


def test_merging_by_rank_is_refused_for_another_merge_list():
    import json
    j = json.loads(common.read_file(A))
    i = next(k for k, m in enumerate(j["model"]["merges"]) if len("".join(m)) == 4)
    w = "".join(j["model"]["merges"][i])
    j["model"]["merges"][i] = [w[:1], w[1:]] if j["model"]["merges"][i] != [w[:1], w[1:]] else [w[:3], w[3:]]
    assert not align.merges_by_rank(j)


def test_bounded_head_takes_the_largest_counts(spark):
    df = spark.range(1, 1001).select("id", (F.lit(100_000) / F.col("id")).cast("long").alias("n"))
    rows, least = common.bounded_head(df, "n", 100)
    got = [r.n for r in rows.collect()]
    assert 50 <= len(got) <= 100 and min(got) == least and df.where(F.col("n") >= least).count() == len(got)
    assert common.bounded_head(df, "n", 0)[0].count() == 0
