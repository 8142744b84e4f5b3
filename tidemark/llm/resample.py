"""Target-distribution importance resampling over hashed n-grams.

Every run of 1 to ``max_n`` consecutive words is a feature; its bucket is the CRC-32
of its UTF-8 bytes modulo ``buckets``. A bucket's gain is the logarithm of its smoothed
share in the target texts over that in the source texts. A document's weight is the
sum of its features' gains; with Gumbel noise from the hash of its id added, the
highest scores are a draw without replacement in proportion to exp(weight).

Head-tail vocabulary: a first pass counts words (and pairs, where ``max_n`` > 1) of
all documents. The most frequent of each kind, ``head`` at most, are broadcast: words with their
exact CRC state, which a run extends byte by byte, pairs with their bucket. Features
unseen there take a direct CRC. Both give the same bucket, so the head decides speed
alone and bucket totals are exact. What travels is bounded: ``head`` entries per kind
and task, and ``buckets`` totals per task.

The draw ranks scores with the distributed positions of ``operators.scan``: range
partitions, one count per partition on the driver.

Defined results: null, empty and blank texts have no features, weight 0; rows with a
null id take part, hashed as ``<seed>:`` alone; repeated rows are documents of their
own, ties go to the smaller id (null first), then to any of the equal rows. With an
empty target table every bucket has t = 0. Very long texts are read whole, one row at
a time. Columns of other names in the tables are never read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scan import global_positions
from .common import bounded_head, materialize

# Everything below U+0080 but digits and letters separates words; A-Z become a-z.
FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
SLICE_BYTES = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class Buckets:
    """Buckets of features with a head of known words and pairs."""

    def __init__(self, buckets: int, max_n: int, states: dict[bytes, int], pairs: dict[bytes, int]):
        self.m, self.n, self.states, self.pairs = buckets, max_n, states, pairs

    def of(self, words: list[bytes]) -> dict[int, int]:
        """Bucket -> number of the words' features in it."""
        m, out = self.m, Counter()
        known, crc32 = self.states.get, zlib.crc32
        state = {}
        for w, c in Counter(words).items():
            s = known(w)
            state[w] = s = crc32(w) if s is None else s
            out[s % m] += c
        if self.n < 2 or len(words) < 2:
            return out
        known = self.pairs.get
        for (a, b), c in Counter(zip(words, words[1:])).items():
            k = known(a + b" " + b)
            out[crc32(b" " + b, state[a]) % m if k is None else k] += c
        for n in range(3, self.n + 1):
            for run, c in Counter(zip(*(words[i:] for i in range(n)))).items():
                s = state[run[0]]
                for w in run[1:]:
                    s = crc32(b" " + w, s)
                out[s % m] += c
        return out


def n_features(n_words: int, max_n: int) -> int:
    return sum(max(0, n_words - n + 1) for n in range(1, max_n + 1))


def _frequent(texts: DataFrame, kind: int, head: int) -> dict[bytes, int]:
    """CRC-32 of the ``head`` most frequent runs of ``kind`` words. A task keeps at most
    4 x ``head`` candidates at a time (the least frequent go) and sends ``head``: which
    features are in the head can depend on that, no result does."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                w = words_of(text.as_py())
                seen.update(w if kind == 1 else [a + b" " + b for a, b in zip(w, w[1:])])
                if len(seen) > 4 * head:
                    seen = Counter(dict(seen.most_common(2 * head)))
        top = seen.most_common(head)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.binary()), pa.array([c for _, c in top], pa.int64())], names=["f", "c"])

    found = materialize(texts.mapInArrow(count, "f binary, c long").groupBy("f").agg(F.sum("c").alias("c")), "resample-frequent")
    rows = bounded_head(found, "c", head)[0].collect()
    return {bytes(r["f"]): zlib.crc32(bytes(r["f"])) for r in rows}


def bucket_totals(texts: DataFrame, book) -> np.ndarray:
    """Features per bucket over all texts: dense per task, summed per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Buckets(*book.value)
        total = np.zeros(b.m, np.int64)
        for batch in batches:
            for text in batch.column(0):
                got = b.of(words_of(text.as_py()))
                if got:
                    total[np.fromiter(got.keys(), np.int64, len(got))] += np.fromiter(got.values(), np.int64, len(got))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "c"])

    out = np.zeros(book.value[0], np.int64)
    for r in texts.mapInArrow(run, "b int, c long").groupBy("b").agg(F.sum("c").alias("c")).collect():
        out[r["b"]] = r["c"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln of the smoothed target share over the source share) per bucket."""
    m, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + m) / ((s + 1.0) * (t_all + m)))) for s, t in zip(source.tolist(), target.tolist())]


def noise(id_col: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 8 hex digits of sha256("seed:id")."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def document_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
                     max_n: int = 1, buckets: int = 10_000, head: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: id, __words, n_features, weight (all long)."""
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    texts = src.select("__text")
    states = _frequent(texts, 1, head)
    pairs = {k: c % buckets for k, c in _frequent(texts, 2, head).items()} if max_n > 1 else {}
    book = sc.broadcast((buckets, max_n, states, pairs))
    gain = gains(bucket_totals(texts, book), bucket_totals(target.select(F.col(target_text).cast("string")), book))
    shared = sc.broadcast(gain)
    schema = T.StructType([T.StructField(id_col, src.schema["__id"].dataType), *[T.StructField(c, T.LongType()) for c in ("__words", "n_features", "weight")]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, g = Buckets(*book.value), shared.value
        for batch in batches:
            n, weight = [], []
            for text in batch.column(1):
                w = words_of(text.as_py())
                n.append(len(w))
                weight.append(sum([g[k] * c for k, c in b.of(w).items()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([n_features(k, b.n) for k in n], pa.int64()),
                                              pa.array(weight, pa.int64())], names=[id_col, "__words", "n_features", "weight"])

    return src.mapInArrow(weigh, schema)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", max_n: int = 1,
             buckets: int = 10_000, head: int = 50_000, min_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score, rank.

    ``rank`` is 1, 2, 3... along falling scores for the drawn rows: ``percent`` of the
    rows with at least ``min_words`` words, rounded down. Undrawn rows have null.
    """
    scored = materialize(
        document_weights(docs, target, id_col, text_col, target_text, max_n, buckets, head)
        .withColumn("score", (F.col("weight") + noise(F.col(id_col), seed)).cast("long"))
        .withColumn("__row", F.monotonically_increasing_id()), "resample-scores")
    cols = [id_col, "n_features", "weight", "score"]
    able = scored.where(F.col("__words") >= min_words)
    drawn = percent * able.count() // 100
    ranked = global_positions(able, [F.col("score").desc(), F.col(id_col), "__row"], "__pos")
    rank = F.when(F.col("__pos") <= drawn, F.col("__pos")).cast("long").alias("rank")
    rest = scored.where(F.col("__words") < min_words)
    return ranked.select(*cols, rank).unionByName(rest.select(*cols, F.lit(None).cast("long").alias("rank")))
