"""Language identification by error-correcting output codes.

Every learned language has a codeword; for each of its bits a binary classifier over
hashed byte n-grams (2 to 4) tells the languages with bit 1 from those with bit 0. A
classifier's weight of an n-gram is the logarithm of its mean smoothed share over the
first languages by that over the second, so a language that holds much of the corpus
counts like any other. A text's bit margin is the mean weight of its n-grams times the
square root of their number.

Decoding is loss-weighted: a language's distance is the sum over bits of the logistic
loss of the margin against its codeword, each bit weighted by how often that
classifier is right on the language's own texts. The nearest codeword wins;
``ambiguous`` marks texts whose second codeword is about as near.

Codes have all splits of the languages into two where these are no more than
7 + 8 log2(languages) bits, else that many drawn splits, of several draws the one with
the greatest least distance between two codewords.

Learning reads whole texts of all learning rows: n-gram counts per (language, bucket)
are summed per task, then over the table; what reaches the driver is one weight per
(bucket, bit), the languages and their bit accuracies. Prediction is a map over rows.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is
every text if nothing was learned. One learned language is predicted for any text.
Rows without a language or id are not learned from; repeated rows count as often as
they occur; equal distances go to the lesser language name. Very long texts are read
in blocks of positions, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS = (2, 3, 4)
BUCKET_BITS = 16
ALPHA = 0.1
BLOCK = 1 << 18
SLICE_BYTES = 1 << 20
# Bytes that are no letter become a space; bytes of letters beyond ASCII stay.
FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def folded(text: str | None) -> bytes:
    """Lower-case letters with single spaces between and around words."""
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(FOLD).split()) + b" " if text else b""


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_buckets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams, in blocks of positions; none crosses texts."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts) + bytes(max(ORDERS)), np.uint8).astype(np.uint32)
    total, stop = int(size.sum()), np.cumsum(size)
    for lo in range(0, total, BLOCK):
        at = np.arange(lo, min(lo + BLOCK, total))
        doc = np.searchsorted(stop, at, side="right")
        left = stop[doc] - at
        gram = data[at]
        for n in range(2, max(ORDERS) + 1):
            gram = (gram << np.uint32(8)) | data[at + n - 1]
            if n in ORDERS:
                fits = left >= n
                hashed = (gram[fits] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                yield doc[fits], hashed >> np.uint32(32 - BUCKET_BITS)


def code_words(k: int, seed: int = 7, draws: int = 32) -> np.ndarray:
    """(k, bits) codewords as 0 and 1."""
    if k < 2:
        return np.zeros((k, 0), np.int8)
    bits = 7 + 8 * (k - 1).bit_length()
    if k - 1 <= 20 and (1 << (k - 1)) - 1 <= bits:
        columns = np.arange(1, 1 << (k - 1))
        return ((columns[None, :] >> np.arange(k)[:, None]) & 1).astype(np.int8)
    r, best, far = np.random.default_rng(seed), None, -1
    for _ in range(draws):
        seen: dict[bytes, np.ndarray] = {}
        while len(seen) < bits:
            c = r.integers(0, 2, k, dtype=np.int8)
            c = c if c[0] == 0 else 1 - c
            if c.any():
                seen.setdefault(c.tobytes(), c)
        code = np.stack(list(seen.values()), axis=1)
        signs = 2 * code.astype(np.int64) - 1
        distance = (bits - signs @ signs.T) // 2
        least = int(distance[~np.eye(k, dtype=bool)].min())
        if least > far:
            best, far = code, least
    return best


class LanguageCodes:
    """Languages, their codewords, n-gram weights per bit, bit accuracies per language."""

    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, accuracy: np.ndarray | None = None):
        self.langs, self.code, self.weights = langs, code, weights
        self.accuracy = np.ones(code.shape) if accuracy is None else accuracy

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """(texts, bits) margins, positive for bit 1."""
        n, bits = len(texts), self.code.shape[1]
        total, count = np.zeros((n, bits)), np.zeros(n)
        for doc, bucket in gram_buckets([folded(t) for t in texts]):
            if len(doc):
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                total[doc[first]] += np.add.reduceat(self.weights[bucket], first, axis=0)
                count += np.bincount(doc, minlength=n)
        return total / np.sqrt(np.maximum(count, 1))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest language's number, its share of exp(-distance), gap to the second)."""
        n, k = len(margins), len(self.langs)
        if k == 1:
            return np.zeros(n, np.int64), np.ones(n), np.full(n, np.inf)
        loss0, loss1 = np.logaddexp(0, margins), np.logaddexp(0, -margins)
        weight = self.accuracy / self.accuracy.sum(axis=1, keepdims=True) * self.code.shape[1]
        distance = loss1 @ (weight * self.code).T + loss0 @ (weight * (1 - self.code)).T
        best = distance.argmin(axis=1)
        near = distance[np.arange(n), best]
        share = 1 / np.exp(near[:, None] - distance).sum(axis=1)
        second = np.partition(distance, 1, axis=1)[:, 1]
        return best, share, (second - near) / self.code.shape[1]


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def gram_counts(rows: DataFrame, flush: int = 64) -> DataFrame:
    """(lang, bucket, n) of the rows (lang, text): dense per task and language, at most
    ``flush`` languages at a time, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}

        def sparse(lang: str, count: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(count[at])], names=["lang", "bucket", "n"])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                by_lang: dict[str, list[bytes]] = {}
                for lang, t in zip(langs[lo:hi], texts[lo:hi]):
                    by_lang.setdefault(lang, []).append(folded(t))
                for lang, part in by_lang.items():
                    if lang not in seen:
                        if len(seen) >= flush:
                            yield from (sparse(*x) for x in seen.items())
                            seen.clear()
                        seen[lang] = np.zeros(1 << BUCKET_BITS, np.int64)
                    for _, bucket in gram_buckets(part):
                        seen[lang] += np.bincount(bucket, minlength=1 << BUCKET_BITS)
        yield from (sparse(*x) for x in seen.items())

    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang") -> LanguageCodes:
    """Learn from the rows where ``learn`` holds (an expression over ``docs``)."""
    from .common import materialize

    spark = docs.sparkSession
    rows = docs.where(learn & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = materialize(gram_counts(rows), "language-grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    code = code_words(len(langs))
    if not code.shape[1]:
        return LanguageCodes(langs, code, np.zeros((1 << BUCKET_BITS, 0), np.float32))
    # shares summed over the languages of either side of each bit; the driver gets buckets x bits
    base = np.array([ALPHA / (totals[x] + ALPHA * (1 << BUCKET_BITS)) for x in langs])
    words = spark.createDataFrame([(x, float(b / ALPHA), [int(v) for v in w]) for x, b, w in zip(langs, base, code)], "lang string, unit double, word array<int>")
    share, bits = F.col("n") * F.col("unit"), code.shape[1]
    side = lambda j, v: F.sum(F.when(F.col("word")[j] == v, share).otherwise(0.0))
    sums = (counts.join(F.broadcast(words), "lang").groupBy("bucket")
            .agg(F.array(*[side(j, 1) for j in range(bits)]).alias("one"), F.array(*[side(j, 0) for j in range(bits)]).alias("zero")).collect())
    one = np.tile(base @ code, (1 << BUCKET_BITS, 1))
    zero = np.tile(base @ (1 - code), (1 << BUCKET_BITS, 1))
    for r in sums:
        one[r["bucket"]] += r["one"]
        zero[r["bucket"]] += r["zero"]
    weights = np.log(one / code.sum(axis=0)) - np.log(zero / (1 - code).sum(axis=0))
    model = LanguageCodes(langs, code, weights.astype(np.float32))
    model.accuracy = _accuracy(rows, model)
    return model


def _accuracy(rows: DataFrame, model: LanguageCodes) -> np.ndarray:
    """How often each bit's classifier is right on each language's texts, (k, bits),
    from sums per task; add-one smoothed, so none is 0."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        number = {x: i for i, x in enumerate(m.langs)}
        right, n = np.zeros(m.code.shape, np.int64), np.zeros(len(m.langs), np.int64)
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                lang = np.array([number[x] for x in langs[lo:hi]])
                np.add.at(right, lang, (m.margins(texts[lo:hi]) > 0) == (m.code[lang] > 0))
                n += np.bincount(lang, minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n).astype(np.int32)), pa.array(n[n > 0]), pa.array(list(right[n > 0]), pa.list_(pa.int64()))],
                                         names=["lang", "n", "right"])

    sums = (rows.mapInArrow(run, "lang int, n long, right array<long>").select("lang", "n", F.posexplode("right").alias("bit", "r"))
            .groupBy("lang", "bit").agg(F.sum("n").alias("n"), F.sum("r").alias("r")).collect())
    out = np.ones(model.code.shape)
    for r in sums:
        out[r["lang"], r["bit"]] = (r["r"] + 1) / (r["n"] + 2)
    return out


def identify(docs: DataFrame, model: LanguageCodes, id_col: str = "doc_id", text_col: str = "text", gap: float = 0.1) -> DataFrame:
    """One row per row: id, lang_pred, score (0 to 1), ambiguous (the second codeword's
    distance per bit is less than ``gap`` above the nearest's)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([T.StructField(id_col, src.schema["__id"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                part = texts[lo:hi]
                known = np.array([bool(m.langs) and has_letter(t) for t in part])
                lang, score, near = np.zeros(len(part), np.int64), np.zeros(len(part)), np.zeros(len(part))
                if m.langs:
                    lang, score, near = m.decode(m.margins(part))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array([m.langs[i] if k else "und" for i, k in zip(lang.tolist(), known.tolist())], pa.string()),
                    pa.array(np.where(known, score, 0.0)), pa.array(~known | (near < gap))], names=schema.names)

    return src.mapInArrow(run, schema)
