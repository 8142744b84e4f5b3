"""Exact Jaccard join of documents on word n-grams, with set-relation skipping.

A document's set holds the hashes (64 bits) of its distinct word n-grams. Equal
sets form classes; a class takes part once. The rest is a prefix-filtered join
over index lists, in a global order of n-grams by rising frequency:

1. Frequencies. Documents are dealt into chunks. Each chunk sends its distinct
   n-grams, packed and sorted, to buckets by hash range, and gets their
   frequencies back in the same order.
2. Index lists. Sets that reach the threshold share an n-gram of their prefixes.
   Prefix n-grams that occur in one place only are not listed. An entry has the
   set's size and the n-gram's position in the set's order.
3. Leaders. In each list and size block the most central set (whose prefix is the
   most frequent) leads; every set is verified against its leaders. Links found
   here join most near-copies without a pair between two followers.
4. Skipping. In what is left a list's blocks are skipped as a whole where sizes or
   positions rule a link out, or where all entries are in the probe's component. A
   follower's answers come from its leader's: with a the overlap of x and b that
   of y with their leader of size m, x and y share at least a + b - m n-grams and
   at most min(a, b) + min(|x| - a, |y| - b). Only pairs that this does not decide
   are verified on the sets.

No partner, list or group is capped. Long lists are cut into blocks and meet as pairs of
blocks, so a task's memory is bounded. Pairs within a component are never emitted.
The result does not depend on the order of n-grams, chunks or leaders.

Defined results: a text of fewer words than n is one n-gram as a whole; without
words, or null, the set is empty and linked with nothing. Rows with the same id and
different texts are documents of their own that share the id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, n_chunks, words_of

MIX = np.uint64(0x9E3779B97F4A7C15)
TURN = np.uint64(29)


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    k = min(n, len(words))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ h[j:len(words) - k + 1 + j]) * MIX
        out ^= out >> TURN
    return np.unique(out)


def fingerprint(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _bucket_bits(buckets: int) -> int:
    return max(0, (buckets - 1).bit_length())


def _below(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow the bucket's bits. Frequencies only order n-grams, so a
    rare collision costs an index entry, never a link; a bucket's load stays the
    same as buckets grow with the input."""
    return ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted keys by their upper bits."""
    if not len(keys):
        return
    top = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(top)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
        yield int(top[a]), slice(int(a), int(b))


def _chunk_sets(texts: pa.ChunkedArray, n: int) -> tuple[list[np.ndarray], list[bytes | None], dict[bytes, np.ndarray]]:
    """Sets, their fingerprints and the distinct sets; one text at a time leaves Arrow's memory."""
    fps: list[bytes | None] = []
    distinct: dict[bytes, np.ndarray] = {}
    for t in texts:
        s = ngram_set(t.as_py(), n)
        fps.append(fingerprint(s) if len(s) else None)
        if fps[-1] is not None:
            distinct.setdefault(fps[-1], s)
    empty = np.empty(0, dtype=np.uint64)
    return [empty if f is None else distinct[f] for f in fps], fps, distinct


def _bytes(column: pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    """Packed numbers of a binary column, as views of Arrow's memory."""
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


def frequencies(src: DataFrame, n: int, buckets: int) -> DataFrame:
    """(__chunk, bucket, df): frequencies of a chunk's n-grams of a bucket, in their order."""
    bits = _bucket_bits(buckets)
    asked_type = pa.schema([("__chunk", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    answer_type = pa.schema([("__chunk", pa.int32()), ("bucket", pa.int32()), ("df", pa.binary())])

    def ask(docs: pa.Table) -> pa.Table:
        _, _, distinct = _chunk_sets(docs["__text"], n)
        keys, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True) if distinct else (np.empty(0, np.uint64), None)
        rows = [(docs["__chunk"][0].as_py(), b, _below(keys[s], bits).tobytes(), counts[s].astype(np.uint16 if len(distinct) < 65536 else np.uint32).tobytes())
                for b, s in _slices(keys, bits)]
        return pa.table([list(x) for x in zip(*rows)], schema=asked_type) if rows else asked_type.empty_table()

    def answer(asked: pa.Table) -> pa.Table:
        keys = _bytes(asked["keys"], np.uint32)
        counts = [np.frombuffer(c.as_buffer(), np.uint16 if c.as_buffer().size == 2 * len(k) else np.uint32) for c, k in zip(asked["counts"], keys)]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.minimum(np.bincount(at, weights=np.concatenate(counts)), 65535).astype(np.uint16)[at]
        ends = np.cumsum([len(k) for k in keys])
        df = [total[e - len(k):e].tobytes() for e, k in zip(ends, keys)]
        return pa.table([asked["__chunk"], asked["bucket"], pa.array(df, pa.binary())], schema=answer_type)

    asked = src.groupBy("__chunk").applyInArrow(ask, "__chunk int, bucket int, keys binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "__chunk int, bucket int, df binary")


def index_entries(src: DataFrame, freq: DataFrame, n: int, percent: int, id_type: T.DataType) -> DataFrame:
    """Three kinds of rows: 0 documents (id, fp, n), 1 index entries (token, fp, n, pos,
    weight), 2 the listed sets (fp, n, items: n-grams that occur in more than one place).

    Rows are built as Arrow columns from packed numbers: a chunk of text costs a
    worker a few times its size, not an object per n-gram."""
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("id", id_type), T.StructField("fp", T.BinaryType()), T.StructField("n", T.IntegerType()),
        T.StructField("token", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("weight", T.DoubleType()),
        T.StructField("items", T.ArrayType(T.LongType()))])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        sets, fps, distinct = _chunk_sets(docs["__text"], n)
        ids = docs["__id"].combine_chunks()
        types = [pa.int32(), ids.type, pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.int64())]

        def rows(kind: int, size: int, **columns: pa.Array) -> pa.Table:
            filled = {"kind": pa.array(np.full(size, kind, np.int32)), **columns}
            return pa.table([filled.get(c, pa.nulls(size, t)) for c, t in zip(schema.names, types)], names=schema.names)

        out = [rows(0, len(fps), id=ids, fp=pa.array(fps, pa.binary()), n=pa.array([len(s) for s in sets], pa.int32()))]
        if distinct:
            keys = np.unique(np.concatenate(list(distinct.values())))
            df = np.concatenate(_bytes(answers.sort_by("bucket")["df"], np.uint16))
            entries, listed = [], []
            for f, s in distinct.items():
                d = df[np.searchsorted(keys, s)]
                order = np.lexsort((s, d))
                prefix = order[:len(s) - (percent * len(s) + 99) // 100 + 1]
                shared = np.flatnonzero(d[prefix] > 1)
                if not len(shared):
                    continue
                signed = s.view(np.int64)
                entries.append((signed[prefix[shared]], shared.astype(np.int32), float(np.log(d[prefix]).sum())))
                listed.append((f, len(s), signed[d > 1]))
            if listed:
                each = np.array([len(t) for t, _, _ in entries])
                size = np.array([k for _, k, _ in listed], np.int32)
                fp = pa.array([f for f, _, _ in listed], pa.binary())
                out.append(rows(1, int(each.sum()), fp=fp.take(pa.array(np.repeat(np.arange(len(listed)), each))), n=pa.array(np.repeat(size, each)),
                                token=pa.array(np.concatenate([t for t, _, _ in entries])), pos=pa.array(np.concatenate([p for _, p, _ in entries])),
                                weight=pa.array(np.repeat([w for _, _, w in entries], each))))
                offsets = np.r_[0, np.cumsum([len(x) for _, _, x in listed])].astype(np.int32)
                out.append(rows(2, len(listed), fp=fp, n=pa.array(size), items=pa.ListArray.from_arrays(offsets, np.concatenate([x for _, _, x in listed]))))
        return pa.concat_tables(out)

    return src.groupBy("__chunk").cogroup(freq.groupBy("__chunk")).applyInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, b, nb) with the overlap, and whether they link."""
    left = sets.select(F.col("fp").alias("a"), F.col("items").alias("ia"))
    right = sets.select(F.col("fp").alias("b"), F.col("items").alias("ib"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("ia", "ib"))).drop("ia", "ib")
    return both.withColumn("linked", F.expr(f"100L * both >= {percent}L * (na + nb - both)"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the least node that links reach, by alternating large-star and
    small-star steps; nodes without an edge are not in it. Edges: u, v."""
    e = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        e = materialize(small.select("x.u", F.col("x.m").alias("v")).filter("u <> v").distinct(), name)
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state


def _cells(entries: DataFrame, block: int) -> DataFrame:
    """Entries of a list in cells: a list of over ``block`` entries is cut into blocks,
    and each pair of blocks is a cell, with every entry's block."""
    sizes = entries.groupBy("token").agg(F.count("*").alias("len"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    live = sizes.filter("len > 1 AND NOT (c0 <=> c1)").select("token", F.ceil(F.col("len") / block).cast("int").alias("nb"))
    at = entries.join(live, "token").withColumn("blk", F.expr("cast(pmod(xxhash64(fp), nb) AS int)"))
    return at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).withColumns({
        "i": F.least("blk", "other"), "j": F.greatest("blk", "other")}).drop("other")


def cross_pairs(entries: DataFrame, percent: int, block: int = 4000, skip: int = 128) -> DataFrame:
    """Pairs of different components that sizes, positions and leaders do not decide
    (known false), or that leaders prove (known true). Entries: token, fp, n, pos,
    comp, leader, own (overlap with the leader), size of the leader."""
    out = "a binary, na int, b binary, nb int, known boolean"

    def cell(g: pd.DataFrame) -> list[pd.DataFrame]:
        g = g.sort_values("n", kind="stable")
        n, pos, comp, lead, own, lsize = (g[c].to_numpy() for c in ("n", "pos", "comp_code", "lead_code", "own", "lsize"))
        fp, blk = g["fp"].to_numpy(), g["blk"].to_numpy()
        mixed = g["i"].iloc[0] != g["j"].iloc[0]
        found = []
        for s in range(0, len(n), skip):
            e = min(s + skip, len(n))
            low_pos = int(pos[s:e].min())
            one = comp[s] if (comp[s:e] == comp[s]).all() else None
            # Probes: this block's own later entries and all that follow it by size.
            last = int(np.searchsorted(n, 100 * int(n[e - 1]) // percent, side="right"))
            for y in range(s + 1, last):
                top = min(e, y)
                a = int(np.searchsorted(n[s:top], -(-percent * int(n[y]) // 100), side="left")) + s
                if a >= top or one is not None and comp[y] == one:
                    continue
                need = -(-percent * (n[a:top].astype(np.int64) + int(n[y])) // (100 + percent))
                if min(int(n[top - 1]) - low_pos, int(n[y]) - int(pos[y])) < int(need[0]):
                    continue  # no position in this block can reach the overlap
                ok = (comp[a:top] != comp[y]) & (np.minimum(n[a:top] - pos[a:top], n[y] - pos[y]) >= need)
                if mixed:
                    ok &= blk[a:top] != blk[y]
                same = ok & (lead[a:top] == lead[y])
                most = np.minimum(own[a:top], own[y]) + np.minimum(n[a:top] - own[a:top], n[y] - own[y])
                ok &= ~(same & (most < need))
                x = np.flatnonzero(ok)
                if len(x):
                    sure = same[x] & (own[a + x] + own[y] - lsize[a + x] >= need[x])
                    found.append(pd.DataFrame({"a": fp[a + x], "na": n[a + x], "b": fp[y], "nb": n[y], "known": sure}))
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            key = pdf[["token", "i", "j"]].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            last = int(cut[-1]) if len(cut) else 0
            yield from work(pdf.iloc[:last])
            rest = pdf.iloc[last:]
        if rest is not None:
            yield from work(rest)

    def work(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(pdf):
            return
        pdf = pdf.assign(comp_code=pd.factorize(pdf["comp"])[0], lead_code=pd.factorize(pdf["leader"])[0])
        for _, g in pdf.groupby(["token", "i", "j"], sort=False):
            if len(g) > 1:
                yield from cell(g)

    cells = _cells(entries, block).select("token", "i", "j", "blk", "fp", "n", "pos", "comp", "leader", "own", "lsize")
    dealt = cells.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInPandas(run, out)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80,
                    chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per row: id, n_shingles (size of its set), component_id (the least id
    that links of Jaccard similarity ``percent`` / 100 or more reach)."""
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    chunks = n_chunks(src, "__text", chunk_bytes)
    src = src.withColumn("__chunk", F.pmod(F.xxhash64("__id", F.length("__text")), F.lit(chunks)).cast("int")).repartition(chunks, "__chunk")
    id_type = src.schema["__id"].dataType
    found = materialize(index_entries(src, frequencies(src, n, chunks), n, percent, id_type), "jaccard-index")

    members = found.filter("kind = 0").select("id", "fp", "n")
    entries = found.filter("kind = 1").groupBy("token", "fp").agg(F.first("n").alias("n"), F.first("pos").alias("pos"), F.first("weight").alias("weight"))
    # Lists of one entry (copies of one set) hold no pair.
    long = entries.groupBy("token").agg(F.count("*").alias("len")).filter("len > 1").select("token")
    entries = materialize(entries.join(long, "token", "left_semi"), "jaccard-lists")
    sets = found.filter("kind = 2").join(entries.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.first("items").alias("items"))
    sets = materialize(sets, "jaccard-sets")

    # Leaders, per list and size block; a set meets those of its own and the next lower block.
    ratio = math.log(100 / percent)
    sized = entries.withColumn("size_block", F.floor(F.log(F.col("n")) / F.lit(ratio)).cast("int"))
    leaders = sized.groupBy("token", "size_block").agg(F.max(F.struct("weight", "fp", "n")).alias("top")).select(
        "token", "size_block", F.col("top.fp").alias("a"), F.col("top.n").alias("na"))
    probes = sized.select("token", F.explode(F.array(F.col("size_block"), F.col("size_block") - 1)).alias("size_block"),
                          F.col("fp").alias("b"), F.col("n").alias("nb"))
    star = leaders.join(probes, ["token", "size_block"]).filter("a <> b").filter(
        F.expr(f"100L * least(na, nb) >= {percent}L * greatest(na, nb)")).select("a", "na", "b", "nb").distinct()
    checked = materialize(_verified(star, sets, percent), "jaccard-stars")

    reps = members.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep"))
    listed = materialize(entries.select("fp", "n").distinct().join(reps, "fp"), "jaccard-reps")
    name = lambda side: listed.select(F.col("fp").alias(side), F.col("rep").alias("u" if side == "a" else "v"))
    as_edges = lambda links: links.select("a", "b").join(name("a"), "a").join(name("b"), "b").select("u", "v")
    first = components(as_edges(checked.filter("linked")), "jaccard-first")

    # What is left: each set with its component, its best leader and the overlap with it.
    best = checked.groupBy("b").agg(F.max(F.struct(F.expr("both / (na + nb - both)").alias("j"), "a", "both", "na")).alias("t")).select(
        F.col("b").alias("fp"), F.col("t.a").alias("leader"), F.col("t.both").alias("own"), F.col("t.na").alias("lsize"))
    label = listed.join(first, listed["rep"] == first["node"], "left").select("fp", F.coalesce("component", "rep").alias("comp"))
    known = label.join(best, "fp", "left").select("fp", "comp", F.coalesce("leader", "fp").alias("leader"), "own", "lsize")
    rest = entries.select("token", "fp", "n", "pos").join(known, "fp").withColumns({"own": F.coalesce("own", "n"), "lsize": F.coalesce("lsize", "n")})
    pairs = cross_pairs(rest, percent).groupBy("a", "na", "b", "nb").agg(F.max("known").alias("known"))
    pairs = materialize(pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti").join(
        checked.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"), "jaccard-pairs")
    more = _verified(pairs.filter("NOT known").drop("known"), sets, percent).filter("linked").select("a", "b").unionByName(
        pairs.filter("known").select("a", "b"))
    more = materialize(as_edges(more), "jaccard-more")
    comp = first
    if not more.isEmpty():
        comp = components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), "jaccard-last")

    label = reps.join(comp, reps["rep"] == comp["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return members.join(label, "fp", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The table with one document of each group, the one with the least id; of equal
    rows of an id and text one stays. Documents without words, and rows without an
    id, stay. Texts that share an id are documents of their own: each stays or goes by
    its own group."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.length(text).cast("string"), text))
    named = docs.filter(F.col(id_col).isNotNull()).withColumn("__key", key)
    groups = near_duplicates(named.select(F.col("__key"), F.col(text_col).alias("__t")), "__key", "__t", **params).distinct()
    rows = named.select("__key", F.col(id_col).alias("__id")).distinct().join(groups, "__key")
    first = rows.filter("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("__id", "__key"))["__key"].alias("__key")).select("__key")
    keep = first.unionByName(rows.filter("n_shingles = 0").select("__key"))
    kept = named.join(keep, "__key", "left_semi").dropDuplicates(["__key"]).select(*cols)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
