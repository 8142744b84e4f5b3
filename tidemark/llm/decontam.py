"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every factor of every benchmark item (items are inserted one
by one from the root, so no factor spans two items). A document's words are
streamed through it once: the state and the length of the longest factor that
ends at the current word are carried from word to word. Where that length
reaches ``window`` words, the last ``window`` words are a window of some item;
an item that is shorter is one window as a whole.

The benchmark is the small side and is checked: over ``max_words`` words the
call raises, so what is broadcast is bounded by a parameter. Documents are never
shuffled.

Defined results: null and empty texts have no words, hence no hits; null and
empty items have no windows; equal items all count as occurring; repeated
document rows get equal results; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
# Word characters: 0-9, A-Z, a-z and everything from U+0080 on; the rest divides.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm_words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the windows' items."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self._mark(items)

    def _add(self, length: int, link: int, arcs: dict[bytes, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        """The state of the factors of q that p followed by w reaches."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:  # an earlier item has this factor
            return self._split(last, self.next[last][w], w)
        state = self._add(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, self.next[p][w], w)
        return state

    def _suffix(self, state: int, length: int) -> int:
        """The state that holds the last ``length`` words of a state's factors."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _mark(self, items: list[tuple[int, list[bytes]]]) -> None:
        k, whole, ends = self.window, {}, {}
        for item, words in items:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= k:
                    whole.setdefault(self._suffix(state, k), set()).add(item)
            if 0 < len(words) < k:
                ends.setdefault(self._suffix(state, len(words)), {}).setdefault(len(words), set()).add(item)
        n = len(self.length)
        # Per state: items of its last k words, and short items that end here.
        self.full: list[frozenset | None] = [None] * n
        self.short: list[tuple | None] = [None] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[s]
            self.full[s] = frozenset(whole[s]) if s in whole else self.full[up]
            own = tuple((ln, frozenset(x)) for ln, x in ends.get(s, {}).items())
            self.short[s] = own + (self.short[up] or ()) or None

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words [start, end) inside occurring windows, merged; the items."""
        nxt, link, length, full, short, k = self.next, self.link, self.length, self.full, self.short, self.window
        state = matched = 0
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        arcs = root = nxt[0]
        for i, w in enumerate(words):
            to = arcs.get(w)
            if to is None:
                while state and to is None:
                    state = link[state]
                    matched = length[state]
                    to = nxt[state].get(w)
                if to is None:
                    arcs = root
                    continue
            state = to
            arcs = nxt[to]
            matched += 1
            if matched >= k:
                found.append((i + 1 - k, i + 1))
                items |= full[state]
            if short[state]:
                for ln, who in short[state]:
                    if ln <= matched:
                        found.append((i + 1 - ln, i + 1))
                        items |= who
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged, items


def build_automaton(items: DataFrame, id_col: str, text_col: str, window: int, max_words: int) -> SuffixAutomaton:
    """From the benchmark table, whose size in words is checked before it is read."""
    size = items.agg(F.sum(F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")))).first()[0] or 0
    if size > max_words + 2 * items.count():
        raise ValueError(f"the benchmark has about {size} words, over max_words={max_words}; call once per part of it")
    rows = items.select(id_col, text_col).filter(F.col(text_col).isNotNull()).collect()
    return SuffixAutomaton([(r[0], norm_words(r[1])) for r in sorted(rows, key=lambda r: (str(r[0]), r[1]))], window)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  max_coverage_percent: int = 5, max_words: int = 1_000_000) -> DataFrame:
    """One row per document row: id, n_words, n_hit, items (sorted as strings),
    spans (word positions, end exclusive), contaminated (some hit, and hits cover
    at least ``max_coverage_percent`` of the words)."""
    machine = docs.sparkSession.sparkContext.broadcast(build_automaton(items, item_id, item_text, window, max_words))
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = src.schema["__id"].dataType
    out = T.StructType([
        T.StructField(id_col, kind), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("contaminated", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sam = machine.value
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            n, h, its, sps = [], [], [], []
            for text in b.column(1):
                words = norm_words(text.as_py())
                spans, who = sam.hits(words)
                n.append(len(words))
                h.append(sum(e - s for s, e in spans))
                its.append(sorted(map(str, who)))
                sps.append([{"start": s, "end": e} for s, e in spans])
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(h, pa.int64()), pa.array(its, pa.list_(pa.string())),
                pa.array(sps, span_type), pa.array([x > 0 and 100 * x >= max_coverage_percent * m for x, m in zip(h, n)], pa.bool_())],
                names=[id_col, "n_words", "n_hit", "items", "spans", "contaminated"])

    return src.mapInArrow(run, out)


def cut_spans(text: str, spans: list[tuple[int, int]], max_span: int) -> str:
    """The text without the hit spans of over ``max_span`` words (first to last character)."""
    at = [m.span() for m in WORD.finditer(text)]
    parts, pos = [], 0
    for s, e in spans:
        if e - s > max_span:
            parts.append(text[pos:at[s][0]])
            pos = at[e - 1][1]
    return "".join([*parts, text[pos:]])


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, max_coverage_percent: int = 5,
                  max_span: int | None = None, max_words: int = 1_000_000) -> DataFrame:
    """The table without its contaminated documents, all columns kept. With
    ``max_span``, hit spans of more words than that are cut from the documents
    that stay; without, those stay as they are."""
    machine = docs.sparkSession.sparkContext.broadcast(build_automaton(items, item_id, item_text, window, max_words))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sam = machine.value
        for b in batches:
            keep, texts = [], []
            for text in b.column(at):
                text = text.as_py()
                words = norm_words(text)
                spans, _ = sam.hits(words)
                hit = sum(e - s for s, e in spans)
                keep.append(not (hit > 0 and 100 * hit >= max_coverage_percent * len(words)))
                texts.append(cut_spans(text, spans, max_span) if spans and max_span is not None else text)
            if max_span is not None:
                b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
