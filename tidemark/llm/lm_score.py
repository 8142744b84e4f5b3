"""Language-model scores with a weighted backoff automaton.

The model is an n-gram model of order ``order`` with Dirichlet smoothing: with c the
training counts, N tokens, V distinct tokens and h' the history h without its first word,

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h w) + mass * p(w | h')) / (c(h) + mass)      where c(h) > 0
    p(w | h) = p(w | h')                                        else

As an automaton: a seen history is a state; a seen n-gram h w is an arc of weight
log p(w | h); the failure arc of h leads to h' and weighs log(mass / (c(h) + mass)).
The arc leads to the longest suffix of h w that is a state. A text starts at the root; one
traversal from left to right carries the state, follows failure arcs while the state has no
arc for the token, and adds up weights. An unknown word has an arc at the root alone. The
end of the text is a token.

The whole model never meets in one place. Documents are dealt into chunks. A chunk
sends its distinct n-grams with their training counts, packed and sorted, to buckets
by hash, which add up and send the totals back in the same order; a chunk then
holds the part of the automaton that its texts can reach. N and V are sums over buckets.
Nothing is pruned: counts cover all training texts, and the model grows with them.
Words are compared as they are; n-grams of two words or more by 64-bit hashes.

Defined results: a null or empty text is the end token alone; repeated rows count
each; if there is no training text, N = V = 0 and every token has p = 1; very long texts
are walked whole, in slices that carry the state on. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, n_chunks, words_of

MIX = np.uint64(0x9E3779B97F4A7C15)
TURN = np.uint64(31)
END = b"\n"  # no word has white space in it


class ChunkGrams:
    """The n-grams of a chunk's texts. Words are numbered in sorted order, so both
    readings of a chunk number alike whatever the order of its rows."""

    def __init__(self, texts: pd.Series, order: int):
        first: dict[bytes, int] = {}
        ids, sizes = [], []
        for t in texts:
            words = [*words_of(t), END]
            ids.append(np.fromiter((first.setdefault(w, len(first)) for w in words), dtype=np.int32, count=len(words)))
            sizes.append(len(words))
        words = sorted(first)
        self.words = words
        rank = np.empty(len(words), dtype=np.int32)
        rank[[first[w] for w in words]] = np.arange(len(words), dtype=np.int32)
        self.token = rank[np.concatenate(ids)] if ids else np.empty(0, np.int32)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.hash = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        starts = np.cumsum(self.sizes) - self.sizes
        # Words of the text before each token: how long a history can be.
        self.depth = np.arange(len(self.token)) - np.repeat(starts, self.sizes)
        self.keys: list[np.ndarray] = []  # per order from 2: distinct n-grams, sorted
        self.at: list[np.ndarray] = []  # and each token's n-gram among them, -1 for none
        gram = self.hash[self.token]
        for k in range(2, order + 1):
            longer = np.zeros_like(gram)
            longer[1:] = (gram[:-1] * MIX) ^ self.hash[self.token[1:]]
            longer ^= longer >> TURN
            longer *= MIX
            gram = longer
            has = self.depth >= k - 1
            keys, inverse = np.unique(gram[has], return_inverse=True)
            at = np.full(len(gram), -1, dtype=np.int64)
            at[has] = inverse
            self.keys.append(keys)
            self.at.append(at)


def _parts(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def _count(at: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    ok = at >= 0
    return np.bincount(at[ok], weights=weight[ok], minlength=n).astype(np.int64)


def _pack(counts: np.ndarray) -> bytes:
    wide = len(counts) and counts.max() > 0xFFFF
    return (b"\x08" if wide else b"\x02") + counts.astype(np.int64 if wide else np.uint16).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int64 if b[:1] == b"\x08" else np.uint16, offset=1).astype(np.int64)


def totals(src: DataFrame, order: int, buckets: int) -> DataFrame:
    """(__chunk, level, bucket, totals): training counts of a chunk's n-grams of a
    bucket, in their order. Rows of chunk -1 have a bucket's tokens and distinct tokens."""
    bits = max(0, (buckets - 1).bit_length())

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        g, chunk = ChunkGrams(pdf["__text"], order), pdf["__chunk"].iloc[0]
        trains = np.repeat((~pdf["__held"].to_numpy(dtype=bool)).astype(np.float64), g.sizes)
        rows = []
        counts, part = _count(g.token.astype(np.int64), trains, len(g.words)), _parts(g.hash, bits)
        for b in np.unique(part):
            own = np.flatnonzero(part == b)
            rows.append((chunk, 1, int(b), b"\0".join(g.words[i].replace(b"\0", b"\r") for i in own), _pack(counts[own])))
        for k, (keys, at) in enumerate(zip(g.keys, g.at), start=2):
            counts, part = _count(at, trains, len(keys)), _parts(keys, bits)
            cuts = np.flatnonzero(np.diff(part)) + 1
            for a, e in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                if e > a:
                    rows.append((chunk, k, int(part[a]), keys[a:e].tobytes(), _pack(counts[a:e])))
        return pd.DataFrame(rows, columns=["__chunk", "level", "bucket", "keys", "counts"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = [_unpack(c) for c in pdf["counts"]]
        if pdf["level"].iloc[0] == 1:
            first: dict[bytes, int] = {}
            at = np.array([first.setdefault(w, len(first)) for k in pdf["keys"] for w in k.split(b"\0")], dtype=np.int64)
            n = len(first)
        else:
            keys, at = np.unique(np.concatenate([np.frombuffer(k, np.uint64) for k in pdf["keys"]]), return_inverse=True)
            n = len(keys)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=n).astype(np.int64)
        spread, ends = total[at], np.cumsum([len(c) for c in counts])
        out = pd.DataFrame({"__chunk": pdf["__chunk"], "level": pdf["level"], "bucket": pdf["bucket"],
                            "totals": [_pack(spread[e - len(c):e]) for c, e in zip(counts, ends)], "tokens": 0, "types": 0})
        if pdf["level"].iloc[0] == 1:
            out.loc[len(out)] = [-1, 1, pdf["bucket"].iloc[0], b"", int(total.sum()), int((total > 0).sum())]
        return out

    asked = src.groupBy("__chunk").applyInPandas(ask, "__chunk int, level int, bucket int, keys binary, counts binary")
    return asked.groupBy("level", "bucket").applyInPandas(answer, "__chunk int, level int, bucket int, totals binary, tokens long, types long")


class Automaton:
    """The part of the model that a chunk's texts can reach.

    States: 0 is the root; then the histories of 1 to order - 1 words with a training
    count, by length. ``depth``, ``fail_to`` and ``fail_weight`` are per state. Arcs: one
    per seen n-gram h w, out of the state h; ``arc[k]`` and ``target[k]`` hold weight (nan:
    no arc) and target of the n-grams of k + 1 words. The target is the longest suffix
    of h w that is a state. The root has an arc for every word."""

    def __init__(self, grams: ChunkGrams, answers: pd.DataFrame, order: int, bits: int, n_tokens: int, n_types: int, mass: float):
        self.grams = g = grams
        counts: list[np.ndarray] = []  # per order: totals of the chunk's n-grams
        by = {(lv, b): t for lv, b, t in zip(answers["level"], answers["bucket"], answers["totals"])}
        for level in range(1, order + 1):
            part = _parts(g.hash if level == 1 else g.keys[level - 2], bits)
            c = np.zeros(len(part), dtype=np.int64)
            for b in np.unique(part):
                c[part == b] = _unpack(by[level, int(b)])
            counts.append(c)
        self.known = counts[0] > 0
        p = (counts[0] + 1) / (n_tokens + n_types + 1)
        self.base = np.log10(p)
        self.at = [g.token.astype(np.int64), *g.at]  # each token's n-gram per length
        root = np.zeros(1)
        fail_to, fail_weight, depth = [root.astype(np.int64)], [root], [root.astype(np.int8)]
        self.arc, self.target = [self.base], []
        states, number = 1, None
        for k in range(order):  # n-grams of k + 1 words
            c = counts[k]
            if k:
                at = self.at[k]
                has = np.flatnonzero(at >= 0)
                suffix, history = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
                suffix[at[has]], history[at[has]] = self.at[k - 1][has], self.at[k - 1][has - 1]
                ch = counts[k - 1][history]
                lower = p[suffix]
                p = np.where(ch > 0, (c + mass * lower) / (ch + mass), lower)
                self.arc.append(np.where((c > 0) & (ch > 0), np.log10(p), np.nan))
                below = self.target[k - 1][suffix]
            else:
                below = np.zeros(len(c), np.int64)
            if k < order - 1:
                seen = c > 0
                number = np.where(seen, states + np.cumsum(seen) - 1, below)
                fail_to.append(below[seen])
                fail_weight.append(np.log10(mass / (c[seen] + mass)))
                depth.append(np.full(int(seen.sum()), k + 1, np.int8))
                states += int(seen.sum())
                self.target.append(number)
            else:
                self.target.append(below)
        self.fail_to, self.fail_weight, self.depth = np.concatenate(fail_to), np.concatenate(fail_weight), np.concatenate(depth)

    def scores(self, slice_tokens: int = 1 << 16) -> np.ndarray:
        """Log10 probability per text: one traversal from left to right carries the state,
        follows failure arcs until the state has an arc for the token, and takes it."""
        depth, fail_to, fail_weight = memoryview(self.depth), memoryview(self.fail_to), memoryview(self.fail_weight)
        out, start = np.empty(len(self.grams.sizes)), 0
        for t, size in enumerate(self.grams.sizes.tolist()):
            state, total = 0, 0.0
            for lo in range(start, start + size, slice_tokens):
                own = slice(lo, min(lo + slice_tokens, start + size))
                # per token: weight and target of its arc out of each state it can meet
                at = [a[own] for a in self.at]
                arcs = zip(*[np.where(a >= 0, arc[a], np.nan).tolist() for a, arc in zip(at, self.arc)])
                targets = zip(*[to[a].tolist() for a, to in zip(at, self.target)])
                for arc, target in zip(arcs, targets):
                    d = depth[state]
                    weight = arc[d]
                    while weight != weight:  # no arc: fail
                        total += fail_weight[state]
                        state = fail_to[state]
                        d -= 1
                        weight = arc[d]
                    total += weight
                    state = target[d]
            out[t] = total
            start += size
        return out


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
                mass: float = 200.0, chunk_bytes: int = 16 << 20) -> DataFrame:
    """One row per row: id, held_out (not learned from), n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (add-one words), score (the model's log10
    probability of the text)."""
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), F.coalesce(held_out, F.lit(False)).alias("__held"))
    chunks = n_chunks(src, "__text", chunk_bytes)
    src = src.withColumn("__chunk", F.pmod(F.xxhash64("__id", F.length("__text")), F.lit(chunks)).cast("int")).repartition(chunks, "__chunk")
    answers = materialize(totals(src, order, chunks), "lm-totals")
    # The last row of each bucket of words: what it holds of all tokens.
    n_tokens, n_types = (int(x or 0) for x in answers.filter("__chunk = -1").agg(F.sum("tokens"), F.sum("types")).first())
    bits = max(0, (chunks - 1).bit_length())
    schema = T.StructType([
        T.StructField(id_col, src.schema["__id"].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType())])

    def score(pdf: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({c: [] for c in schema.names})
        g = ChunkGrams(pdf["__text"], order)
        model = Automaton(g, mine, order, bits, n_tokens, n_types, mass)
        starts = np.cumsum(g.sizes) - g.sizes
        per = lambda x: np.add.reduceat(x, starts)
        return pd.DataFrame({
            id_col: pdf["__id"], "held_out": pdf["__held"].to_numpy(dtype=bool), "n_tokens": g.sizes,
            "n_known": per(model.known.astype(np.int64)[g.token]), "train_tokens": n_tokens,
            "base_score": per(model.base[g.token]), "score": model.scores()})

    return src.groupBy("__chunk").cogroup(answers.filter("__chunk >= 0").groupBy("__chunk")).applyInPandas(score, schema)


def perplexity(score: float, tokens: int) -> float:
    return math.pow(10, -score / tokens)
