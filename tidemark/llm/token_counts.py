"""Token counts by a map-side lookup in two tiers; no pre-token is ever shuffled.

Text is cut at ASCII white space into pre-tokens, a boundary that the tokenizer
never crosses, and the lengths of a text's pre-tokens add up.

Tier 1 is a broadcast table of lengths of frequent pre-tokens: the whole-word
entries of the tokenizer's own vocabulary, which byte-pair training orders by
frequency. Its size is bounded by the vocabulary and known before any row is
read. Each entry's length comes from the library, not from the assumption that
an entry encodes to itself.

Tier 2 encodes misses, each distinct one once per batch, and keeps lengths in a
cache per Python worker. The cache holds ``cache_size`` entries at most, in two
generations of which the older is dropped, so memory is bounded and results do
not depend on it.

Defined results: null and empty texts have 0 bytes and 0 tokens; strings of
special tokens inside texts are handled as the library handles them; very long
pre-tokens are encoded but not cached; repeated rows get equal counts.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Punctuation that never shares a pre-token with an ASCII letter before it. Left
# out: the apostrophe (contractions) and < > | (strings of special tokens).
TAIL = b"!#$%&*,.:;?)]\""
LETTERS = frozenset(range(65, 91)) | frozenset(range(97, 123))
MAX_KEY = 64

_WORKER: dict[str, tuple] = {}


def load_tokenizer(spec: str):
    """The tokenizer of a ``tokenizers`` file's content."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


def count_batch(tokenizer, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)] if texts else []


def frequent_lengths(tokenizer) -> dict[bytes, int]:
    """Tier 1: lengths of the vocabulary's whole words of ASCII letters and digits
    (lower case), each also with a comma and a full stop behind it."""
    words = sorted({w[:-4] for w in tokenizer.get_vocab(with_added_tokens=False) if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalnum()})
    keys = [v for w in words for v in (w, w + ",", w + ".")]
    return {k.encode(): n for k, n in zip(keys, count_batch(tokenizer, keys))}


class Counts:
    """Length lookup of one worker."""

    def __init__(self, spec: str, table: dict[bytes, int], cache_size: int):
        self.tokenizer, self.table, self.half = load_tokenizer(spec), table, max(1, cache_size // 2)
        self.model = self.tokenizer.model
        # Whether the model alone agrees with the whole tokenizer on such words.
        probe = ["the", "internationalization", "qzxvkj", "t", "doesn"]
        self.direct = count_batch(self.tokenizer, probe) == [len(self.model.tokenize(p)) for p in probe]
        self.new: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def _keep(self, found: dict[bytes, int]) -> None:
        """Two generations: when the new one is full it becomes the old one."""
        if len(self.new) + len(found) > self.half:
            self.old, self.new = self.new, {}
        if len(found) <= self.half:
            self.new.update((w, n) for w, n in found.items() if len(w) <= MAX_KEY)

    def encode(self, wanted: set[bytes]) -> dict[bytes, int]:
        """Lengths of pre-tokens that no tier knows; the library sees each stem once."""
        table, new, old = self.table, self.new, self.old
        parts: list[tuple[bytes, bytes, bytes]] = []
        pieces: dict[bytes, int | None] = {}
        for w in wanted:
            stem = w.rstrip(TAIL)
            if stem and len(stem) < len(w) and stem[-1] in LETTERS:
                tail = w[len(stem):]
                parts.append((w, stem, tail))
                for x in (stem, tail):
                    if x not in pieces:
                        n = table.get(x)
                        n = new.get(x) if n is None else n
                        pieces[x] = old.get(x) if n is None else n
            elif w not in pieces:
                pieces[w] = None
        todo = [x for x, n in pieces.items() if n is None]
        # Lower-case ASCII letters are one pre-token as they are: straight to the model.
        plain = [x for x in todo if x.isalpha() and x.islower()] if self.direct else []
        for x in plain:
            pieces[x] = len(self.model.tokenize(x.decode()))
        rest = [x for x in todo if pieces[x] is None]
        pieces.update(zip(rest, count_batch(self.tokenizer, [x.decode("utf-8", "replace") for x in rest])))
        for w, stem, tail in parts:
            pieces[w] = pieces[stem] + pieces[tail]
        return pieces

    def count(self, texts: list[str | None]) -> list[int]:
        table, new, old = self.table, self.new, self.old
        docs, wanted, again = [], set(), {}
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass") if t else b""
            # The tokenizer lower-cases; in strings of special tokens case counts.
            total, miss = 0, []
            for w, n in Counter((raw if b"<|" in raw else raw.lower()).split()).items():
                k = table.get(w)
                if k is None:
                    k = new.get(w)
                    if k is None:
                        k = old.get(w)
                        if k is None:
                            miss.append((w, n))
                            continue
                        again[w] = k
                total += k * n
            docs.append((total, miss))
            wanted.update(w for w, _ in miss)
        found = self.encode(wanted) if wanted else {}
        if found or again:
            self._keep(found | again)
        return [total + sum([found[w] * n for w, n in miss]) for total, miss in docs]


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, cache_size: int = 1_000_000, group_rows: int = 512) -> DataFrame:
    """One row per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    with open(tokenizer_path, encoding="utf-8") as f:  # read on the driver; workers get its content
        spec = json.dumps(json.load(f), ensure_ascii=False)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((spec, frequent_lengths(load_tokenizer(spec))))
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([T.StructField(id_col, src.schema["__id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    key = f"{tokenizer_path}|{cache_size}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Counts(*shared.value, cache_size)
        worker = _WORKER[key]
        for whole in batches:
            for i in range(0, whole.num_rows, group_rows):
                b = whole.slice(i, group_rows)
                texts = b.column(1).to_pylist()
                tokens = worker.count(texts)
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, schema)
