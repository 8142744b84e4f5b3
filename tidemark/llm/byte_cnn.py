"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in overlapping chunks that cover it whole. Each byte is
embedded, learned filters run over the chunk, and each filter keeps its maximum per
chunk. A text's features are each filter's maximum over all chunks and its mean over
the chunks' maxima; a logistic unit combines them into one probability.

Training uses a bounded sample of labelled rows: ``sample_per_class`` rows per label
(the least by a hash of the id), each with its whole text. The rows are picked on
the executors; the weights (some thousand numbers) go back as a broadcast. Scoring reads every byte of every
text, row by row, without a shuffle.

Defined results: a null or empty text is one chunk of zero bytes; with no labelled
rows of one of the classes the score is 0.5; rows of null ids are scored like
others; repeated labels of an id count once (the least label). Seeds are fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 256
WIDTH = 8
STRIDE = 4
STEP = CHUNK - WIDTH  # chunks overlap by a filter's width
PLACES = (CHUNK - WIDTH) // STRIDE + 1


def chunks_of(text: str | None) -> np.ndarray:
    """(n, CHUNK) bytes that cover the text; the end is padded with zeros."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    n = max(1, -(-max(0, len(raw) - WIDTH) // STEP))
    data = np.frombuffer(raw + bytes((n - 1) * STEP + CHUNK - len(raw)), dtype=np.uint8)
    return np.lib.stride_tricks.as_strided(data, (n, CHUNK), (STEP, 1))


class ByteCnn:
    """Weights and passes of the network."""

    NAMES = ("embed", "filters", "bias", "out", "shift")

    def __init__(self, width: int = 4, filters: int = 24, seed: int = 5):
        r = np.random.default_rng(seed)
        f = lambda *s: r.standard_normal(s).astype(np.float32)
        self.embed = f(256, width) * 0.5
        self.filters = f(WIDTH * width, filters) * np.float32((2 / (WIDTH * width)) ** 0.5)
        self.bias = np.zeros(filters, np.float32)
        self.out = f(2 * filters) * 0.1
        self.shift = np.zeros(1, np.float32)

    def patches(self, x: np.ndarray) -> np.ndarray:
        """(chunks * PLACES, WIDTH * width) embedded bytes under the filters."""
        e = self.embed[x]
        c, k = x.shape[0], e.shape[2]
        s = e.strides
        return np.lib.stride_tricks.as_strided(e, (c, PLACES, WIDTH * k), (s[0], STRIDE * s[1], s[2])).reshape(c * PLACES, WIDTH * k)

    def chunk_maxima(self, x: np.ndarray, part: int = 512) -> np.ndarray:
        out = np.empty((len(x), len(self.bias)), np.float32)
        for i in range(0, len(x), part):
            b = x[i:i + part]
            out[i:i + part] = (self.patches(b) @ self.filters).reshape(len(b), PLACES, -1).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def features(self, maxima: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return np.hstack([np.maximum.reduceat(maxima, starts), np.add.reduceat(maxima, starts) / sizes[:, None]]).astype(np.float32)

    def probabilities(self, texts: list[str | None], part: int = 4096) -> list[float]:
        """Texts in order; chunks of several texts pass together, long texts in parts."""
        out: list[float] = []
        hold: list[np.ndarray] = []
        rows = 0

        def flush() -> None:
            nonlocal rows
            if hold:
                sizes = np.array([len(h) for h in hold])
                starts = np.cumsum(sizes) - sizes
                f = self.features(self.chunk_maxima(np.concatenate(hold)), starts, sizes)
                out.extend((1 / (1 + np.exp(-(f.astype(np.float64) @ self.out + float(self.shift[0]))))).tolist())
                hold.clear()
                rows = 0

        for t in texts:
            c = chunks_of(t)
            if len(c) > part:
                flush()
                top, total = None, 0
                for i in range(0, len(c), part):
                    m = self.chunk_maxima(c[i:i + part])
                    top = m.max(axis=0) if top is None else np.maximum(top, m.max(axis=0))
                    total = total + m.sum(axis=0, dtype=np.float64)
                f = np.concatenate([top, total / len(c)])
                out.append(float(1 / (1 + np.exp(-(f.astype(np.float64) @ self.out + float(self.shift[0]))))))
                continue
            hold.append(c)
            rows += len(c)
            if rows >= part:
                flush()
        flush()
        return out

    def step(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, part: int = 2048) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss over texts (their chunks stacked in x);
        patches of ``part`` chunks at a time, so long texts need no more memory."""
        k, n = len(self.bias), len(x)
        place, m = np.empty((n, k), np.int16), np.empty((n, k), np.float32)
        for i in range(0, n, part):
            a = (self.patches(x[i:i + part]) @ self.filters).reshape(-1, PLACES, k)
            at = a.argmax(axis=1)
            place[i:i + part], m[i:i + part] = at, np.take_along_axis(a, at[:, None, :], 1)[:, 0]
        m = np.maximum(m + self.bias, 0)
        starts = np.cumsum(sizes) - sizes
        f = self.features(m, starts, sizes)
        d = (1 / (1 + np.exp(-(f @ self.out + self.shift[0]))) - y) / len(y)
        g = {"out": f.T @ d, "shift": np.array([d.sum()], np.float32)}
        doc = np.repeat(np.arange(len(y)), sizes)
        df = d[:, None] * self.out[None, :]
        dm = df[doc, k:] / sizes[doc, None]
        first = m == f[doc, :k]  # chunks that hold the text's maximum share its gradient
        share = np.add.reduceat(first.astype(np.float32), starts)
        dm = (dm + first * (df[:, :k] / np.maximum(share, 1))[doc]) * (m > 0)
        g["bias"] = dm.sum(axis=0)
        g["filters"], g["embed"] = np.zeros_like(self.filters), np.zeros_like(self.embed)
        for i in range(0, n, part):
            xs, at, dms = x[i:i + part], place[i:i + part].astype(np.int64), dm[i:i + part]
            picked = self.patches(xs)[np.arange(len(xs))[:, None] * PLACES + at]  # chunks, filters, patch of the maximum
            g["filters"] += np.einsum("cfk,cf->kf", picked, dms, optimize=True)
            dp = dms[:, :, None] * self.filters.T[None]
            letters = xs[np.arange(len(xs))[:, None, None], at[:, :, None] * STRIDE + np.arange(WIDTH)[None, None, :]]
            np.add.at(g["embed"], letters.reshape(-1), dp.reshape(-1, self.embed.shape[1]))
        return g

    def fit(self, x: list[np.ndarray], y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """Adam over shuffled batches of texts."""
        r, t = np.random.default_rng(seed), 0
        m1 = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        m2 = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                pick = order[i:i + batch]
                g = self.step(np.concatenate([x[j] for j in pick]), np.array([len(x[j]) for j in pick]), y[pick].astype(np.float32))
                t += 1
                for n in self.NAMES:
                    m1[n] = 0.9 * m1[n] + 0.1 * g[n]
                    m2[n] = 0.999 * m2[n] + 0.001 * g[n] ** 2
                    v = getattr(self, n)
                    v -= (rate * (m1[n] / (1 - 0.9 ** t)) / (np.sqrt(m2[n] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fold: Column,
                    sample_per_class: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All chunks and the labels of the bounded sample's texts, in order of the ids' hashes."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).filter("__id IS NOT NULL AND __y IN (0, 1)")
    known = known.groupBy("__id").agg(F.min("__y").alias("__y")).filter(fold).withColumn("__h", F.xxhash64("__id"))
    picked = None
    for y in (0, 1):
        part = known.filter(F.col("__y") == y).orderBy("__h", "__id").limit(sample_per_class)
        picked = part if picked is None else picked.unionByName(part)
    # The sample is bounded by its parameters: two times sample_per_class ids.
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).join(F.broadcast(picked), "__id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(h, y, np.ascontiguousarray(chunks_of(t)).tobytes()) for h, y, t in zip(pdf["__h"], pdf["__y"], pdf["__text"])]
            yield pd.DataFrame(rows, columns=["h", "y", "x"])

    rows = texts.select("__h", "__y", "__text").mapInPandas(cut, "h long, y int, x binary").collect()
    rows = sorted(rows, key=lambda r: (r["h"], bytes(r["x"])))
    return [np.frombuffer(bytes(r["x"]), np.uint8).reshape(-1, CHUNK) for r in rows], np.array([r["y"] for r in rows], dtype=np.int64)


def fit_classifier(docs: DataFrame, labels: DataFrame, fold: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", sample_per_class: int = 1000, epochs: int = 8) -> ByteCnn | None:
    """A network learned from the labelled rows of the fold (a condition on ``__id``);
    None where a class has no row."""
    x, y = training_sample(docs, labels, id_col, text_col, label_col, fold, sample_per_class)
    if len(set(y.tolist())) < 2:
        return None
    net = ByteCnn()
    net.fit(x, y, epochs=epochs)
    return net


def classify(docs: DataFrame, net: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
             group_rows: int = 256) -> DataFrame:
    """One row per row: id, score, predicted (score >= threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([T.StructField(id_col, src.schema["__id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, group_rows):
                b = whole.slice(i, group_rows)
                p = model.probabilities(b.column(1).to_pylist()) if model is not None else [0.5] * b.num_rows
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()), pa.array([int(v >= threshold) for v in p], pa.int32())],
                                                 names=[id_col, "score", "predicted"])

    return src.mapInArrow(run, schema)
