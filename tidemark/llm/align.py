"""Alignment of two tokenizers' tokens over the same bytes.

Side A is a byte-level BPE file of the ``tokenizers`` library, side B a
``sentencepiece`` model. Each text is encoded by both; a token covers a range of the
bytes of space+text. Per batch, ``pandas.merge_asof`` keyed by document finds for
each token's start the other side's covering token; the union of both directions is
the set of overlapping token pairs (links). Offsets where tokens of both sides end cut
a text into groups.

Links of an id pair are counted over the corpus. The most frequent pairs, as many as
``head`` at most, are broadcast and looked up where the links lie; links of the others
go through an equi join on the pair, whose keys are rare by construction. No pair's
documents ever meet in one task.

Side A merges by vocabulary rank (``tiktoken``) if every entry of the file's merge
list shows that this is the same, else through the ``tokenizers`` library.

Defined results: null and empty texts, and those whose A or B bytes differ from
space+text, have no tokens (zeros, empty digest). Repeated rows are documents of their
own; null ids stay null. Very long texts are aligned whole, in a batch of their own.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_head, materialize, read_file

# Pre-tokens of byte-level BPE (fixed value: the public pattern of that pre-tokenizer).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")
SLICE_BYTES = 1 << 19

_WORKER: dict[str, "Pair"] = {}


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others in order for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SideA:
    """Byte-level BPE of a ``tokenizers`` file's content."""

    def __init__(self, spec: str, ranked: bool | None = None):
        j = json.loads(spec)
        letters = byte_letters()
        vocab = {t["content"]: t["id"] for t in j.get("added_tokens") or []} | j["model"]["vocab"]
        self.bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.spec, self._library = spec, None
        self.plain = self._plain(j)
        self.ranked = by_rank(j) if self.plain and (merges_by_rank(j) if ranked is None else ranked) else None

    @property
    def library(self):
        """The library's tokenizer, special strings as plain text."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
            self._library.encode_special_tokens = True
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    @staticmethod
    def _plain(j: dict) -> bool:
        """Nothing but byte-level pre-tokens and merges: no step looks across a space."""
        pre, model = j.get("pre_tokenizer") or {}, j["model"]
        return (j.get("normalizer") is None and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space")
                and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranked is not None:
            enc = self.ranked.encode_to_numpy
            return [enc(t).view(np.int32) for t in texts]
        return [np.array(e.ids, np.int32) for e in self.library.encode_batch(texts, add_special_tokens=False)] if texts else []


def ranks_of(j: dict) -> dict[bytes, int]:
    letters = byte_letters()
    return {bytes(letters[c] for c in t): i for t, i in j["model"]["vocab"].items()}


def by_rank(j: dict):
    import tiktoken

    return tiktoken.Encoding("side-a", pat_str=PRE_TOKEN, mergeable_ranks=ranks_of(j), special_tokens={})


def merges_by_rank(j: dict) -> bool:
    """Whether the i-th merge makes the i-th token after the single bytes and is the
    pair that merging by rank itself arrives at for that token. Then, as no merge
    inside a token depends on what lies outside, merging by rank equals the list."""
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in j["model"]["merges"]]
    vocab, letters, rank = j["model"]["vocab"], byte_letters(), ranks_of(j)
    raw = lambda t: bytes(letters[c] for c in t)
    return (len(rank) == 256 + len(merges) and sorted(rank.values()) == list(range(len(rank)))
            and all(vocab.get(a + b) == 256 + i and vocab[a] < 256 + i and vocab[b] < 256 + i and merges_to(rank, raw(a), raw(b)) for i, (a, b) in enumerate(merges)))


def merges_to(rank: dict[bytes, int], a: bytes, b: bytes) -> bool:
    """Whether merging a+b by rank, ranks below its own, ends in the two parts a and b."""
    top, parts = rank[a + b], [bytes([c]) for c in a + b]
    while len(parts) > 2:
        r, i = min((rank.get(x + y, top), k) for k, (x, y) in enumerate(zip(parts, parts[1:])))
        if r >= top:
            return False
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts == [a, b]


class SideB:
    """A sentencepiece model's content; the model itself adds the space before a text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.match(p)) and self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)] if texts else []


class Pair:
    """Both sides of one worker."""

    def __init__(self, spec: str, model: bytes, ranked: bool | None = None):
        self.a, self.b = SideA(spec, ranked), SideB(model)
        self.len_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.len_b = np.array([len(x) for x in self.b.bytes], np.int64)
        # an id's text behind a comma, and behind the mark that starts a group's part of this side
        text = lambda mark, n: np.array([f"{m}{i}" for m in ("," , mark) for i in range(n)], dtype=object)
        self.names_a, self.names_b = text(";", len(self.len_a)), text("|", len(self.len_b))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, A tokens per text, B ids, B tokens per text) of space+text; none
        for empty texts and where bytes differ."""
        a, b = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        raw = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        # byte-level merges alone keep every byte
        checked = [(self.b.bytes, b)] if self.a.plain else [(self.b.bytes, b), (self.a.bytes, a)]
        for i, (t, r) in enumerate(zip(texts, raw)):
            if not t or any(b"".join([vocab[k] for k in ids[i].tolist()]) != r for vocab, ids in checked):
                a[i], b[i] = a[i][:0], b[i][:0]
        return tuple(x for side in (a, b) for x in (np.concatenate(side).astype(np.int64) if side else np.zeros(0, np.int64), np.array([len(i) for i in side], np.int64)))


def starts(ids: np.ndarray, n: np.ndarray, lengths: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of all tokens; starts grow over the whole batch."""
    doc = np.repeat(np.arange(len(n)), n)
    size = lengths[ids]
    before = np.cumsum(size) - size
    first = np.cumsum(n) - n
    return doc, before - before[first[doc]] + base[doc]


def link(a_doc: np.ndarray, a_at: np.ndarray, b_doc: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all overlapping token pairs, in text order.

    Each token start finds the other side's covering token, keyed by document; pairs
    whose tokens start together come from both directions and stay once."""
    a = pd.DataFrame({"at": a_at, "doc": a_doc, "a": np.arange(len(a_at))})
    b = pd.DataFrame({"at": b_at, "doc": b_doc, "b": np.arange(len(b_at))})
    by_a = pd.merge_asof(a, b, on="at", by="doc")
    by_b = pd.merge_asof(b, a, on="at", by="doc")
    pa_, pb = by_a["a"].to_numpy(), by_a["b"].to_numpy(np.int64)
    qa, qb = by_b["a"].to_numpy(np.int64), by_b["b"].to_numpy()
    fresh = a_at[qa] != b_at[qb]
    la, lb = np.concatenate([pa_, qa[fresh]]), np.concatenate([pb, qb[fresh]])
    order = np.argsort(la + lb, kind="stable")  # along the text, la + lb grows by 1 or 2
    return la[order], lb[order]


def group_texts(pair: Pair, a_doc, a_id, a_last, b_doc, b_id, b_last, n_docs: int) -> tuple[np.ndarray, list[str]]:
    """Groups per document, and their text ``a1,a2|b1;a3|b2,b3``."""
    ga = np.concatenate([[0], np.cumsum(a_last)[:-1]]).astype(np.int64)
    gb = np.concatenate([[0], np.cumsum(b_last)[:-1]]).astype(np.int64)
    n_groups = np.bincount(a_doc[a_last], minlength=n_docs)
    size_a, size_b = np.bincount(ga), np.bincount(gb)
    # place of a token in the text: tokens of its own side before it, and the other side's up to its group
    upto_a, upto_b = np.cumsum(size_a), np.cumsum(size_b)
    place_a = np.arange(len(a_id)) + upto_b[ga] - size_b[ga]
    place_b = np.arange(len(b_id)) + upto_a[gb]
    out = np.empty(len(a_id) + len(b_id), dtype=object)
    new_a = np.concatenate([[True], a_last[:-1]])
    new_b = np.concatenate([[True], b_last[:-1]])
    out[place_a] = pair.names_a[a_id + new_a * len(pair.len_a)]
    out[place_b] = pair.names_b[b_id + new_b * len(pair.len_b)]
    ends = np.cumsum(np.bincount(a_doc, minlength=n_docs) + np.bincount(b_doc, minlength=n_docs))
    parts, start = [], 0
    for e in ends.tolist():
        parts.append("".join(out[start:e].tolist())[1:])
        start = e
    return n_groups, parts


def align_batch(pair: Pair, texts: list[str | None]) -> tuple[list, ...]:
    """Per text: n_a, n_b, n_groups, groups text, codes of its links (a * |B| + b)."""
    a_id, n_a, b_id, n_b = pair.encode([t or "" for t in texts])
    n = len(texts)
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) + 2 if t else 1 for t in texts], np.int64)
    base = np.cumsum(sizes) - sizes
    a_doc, a_at = starts(a_id, n_a, pair.len_a, base)
    b_doc, b_at = starts(b_id, n_b, pair.len_b, base)
    if not len(a_id):
        return n_a, n_b, n_a, [""] * n, np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    la, lb = link(a_doc, a_at, b_doc, b_at)
    a_end, b_end = a_at + pair.len_a[a_id], b_at + pair.len_b[b_id]
    # of the links in text order, those whose tokens end together close a group
    closed = a_end[la] == b_end[lb]
    a_last, b_last = np.zeros(len(a_id), bool), np.zeros(len(b_id), bool)
    a_last[la[closed]], b_last[lb[closed]] = True, True
    n_groups, parts = group_texts(pair, a_doc, a_id, a_last, b_doc, b_id, b_last, n)
    codes = a_id[la] * len(pair.len_b) + b_id[lb]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(a_doc[la], minlength=n))])
    return n_a, n_b, n_groups, parts, codes, cuts


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES of text, one row at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_a, n_b, n_groups, n_links (long), groups (text),
    links (codes a * |B| + b of all links in text order)."""
    spark = docs.sparkSession
    spec, model = read_file(a_path).decode("utf-8"), read_file(b_path)
    shared = spark.sparkContext.broadcast((spec, model, merges_by_rank(json.loads(spec))))
    small = len(SideA(spec, False).bytes) * len(SideB(model).bytes) < 1 << 31  # codes fit 32 bits
    code, np_code = (T.IntegerType(), np.int32) if small else (T.LongType(), np.int64)
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    longs = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([T.StructField(id_col, src.schema["__id"].dataType), *[T.StructField(c, T.LongType()) for c in longs],
                           T.StructField("groups", T.StringType()), T.StructField("links", T.ArrayType(code))])
    key = f"{a_path}|{b_path}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Pair(*shared.value)
        pair = _WORKER[key]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                n_a, n_b, n_groups, parts, codes, cuts = align_batch(pair, texts[lo:hi])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, np.diff(cuts))], pa.array(parts, pa.string()),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(codes.astype(np_code)))], names=schema.names)

    return src.mapInArrow(run, schema)


def link_counts(links: DataFrame, flush: int = 1 << 21) -> DataFrame:
    """(code, n): links per id pair over all rows of the array column ``links``;
    summed per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, size = [], [], 0

        def merged():
            c, inverse = np.unique(np.concatenate(codes), return_inverse=True)
            return c, np.bincount(inverse, np.concatenate(counts), len(c)).astype(np.int64)

        def batch_of(c, n):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                c, n = np.unique(batch.column(0).slice(lo, 1024).flatten().to_numpy(zero_copy_only=False), return_counts=True)
                codes.append(c)
                counts.append(n)
                size += len(c)
                if size > flush:
                    c, n = merged()
                    if len(c) > flush // 2:
                        yield batch_of(c, n)
                        codes, counts, size = [], [], 0
                    else:
                        codes, counts, size = [c], [n], len(c)
        if codes:
            yield batch_of(*merged())

    return links.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def alignment_digest(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", head: int = 1 << 18) -> DataFrame:
    """One row per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best``: links whose id pair is the corpus-wide most frequent of its B id (ties
    included); ``count_sum``: the sum over links of their pair's corpus-wide count.
    """
    spark = docs.sparkSession
    n_b_ids = SideB(read_file(b_path)).model.get_piece_size()
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    base = aligned(docs, a_path, b_path, id_col, text_col).withColumn("groups_sha256", digest).drop("groups").withColumn("__row", F.monotonically_increasing_id())
    base = materialize(base, "alignment", compression="zstd")
    counts = materialize(link_counts(base.select("links")), "alignment-pairs")
    b_id = F.col("code") % n_b_ids
    top = counts.groupBy(b_id.alias("__b")).agg(F.max("n").alias("__top"))
    pairs = counts.join(top, b_id == F.col("__b")).select("code", "n", (F.col("n") == F.col("__top")).alias("best"))
    pairs = materialize(pairs, "alignment-best")
    frequent, least = bounded_head(pairs, "n", head)
    known = frequent.toPandas().sort_values("code")
    shared = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("code", "n", "best")))
    schema = "__row long, __best long, __sum long, __tail array<long>"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = shared.value
        code, n, best = np.append(code, -1), np.append(n, 0), np.append(best, False).astype(np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                links = batch.column(1).slice(lo, 1024)
                sizes = np.diff(links.offsets.to_numpy())
                flat = links.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.searchsorted(code[:-1], flat)
                hit = code[at] == flat
                row = np.repeat(np.arange(len(links)), sizes)
                sums = np.zeros(len(links), np.int64)
                bests = np.zeros(len(links), np.int64)
                np.add.at(sums, row[hit], n[at[hit]])
                np.add.at(bests, row[hit], best[at[hit]])
                cuts = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=len(links)))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 1024), pa.array(bests), pa.array(sums),
                                                  pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat[~hit], pa.int64()))],
                                                 names=["__row", "__best", "__sum", "__tail"])

    met = materialize(base.select("__row", "links").mapInArrow(look_up, schema), "alignment-met", compression="zstd")
    tail = met.select("__row", F.explode("__tail").alias("code")).groupBy("__row", "code").agg(F.count(F.lit(1)).alias("__times"))
    rare = pairs.where(F.col("n") < least)
    added = (tail.join(rare, "code").groupBy("__row")
             .agg(F.sum(F.when(F.col("best"), F.col("__times")).otherwise(0)).alias("__best2"), F.sum(F.col("__times") * F.col("n")).alias("__sum2")))
    out = base.drop("links").join(met.drop("__tail"), "__row").join(added, "__row", "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).cast("long")
    return out.select(id_col, "n_a", "n_b", "n_groups", "n_links", plus("__best", "__best2").alias("n_best"), plus("__sum", "__sum2").alias("count_sum"), "groups_sha256")
