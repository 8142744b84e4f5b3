"""Mix sources to target weights, in blocks of tokens.

A source's documents form one stream of tokens (words), cut into blocks of
``block`` tokens; the last block may be shorter. The mix consists of output
shards of ``shard_slots`` slots. Each shard draws how many slots each source
gets: the whole part of the expected number is given, the rest is one
multinomial draw over the fractional parts, seeded by the shard. A source's
slots are numbered through all shards, and slot j holds block P(j mod blocks) of
the source, P a pseudorandom permutation of its block indexes that changes with
every pass j div blocks. Slots and blocks meet in an equi-join on (source, index).

Running sums (a document's place in its source's stream, a shard's place in its
source's slots) are taken in two levels, so a source that holds a third of all
rows is not one task. Slots are (source, index) pairs, spread evenly. Only the
recipe (one row per source, ``max_sources`` at most, else the call raises) reaches
the driver.

Targets share all tokens by weight; a target stops at ``max_repeats`` times its
source's tokens and the excess is shared again by weight. Slots beyond
``max_repeats`` passes of a source are left out, so no document is taken more than
``max_repeats`` times.

Defined results: a null or blank text has size 0 and is taken 0 times; a null
source is a source (the last); rows with the same id or without one are documents of their own;
an empty table has no sources and no slots. Draws depend on the seed, the sources'
sizes and the ids alone, so reruns agree, also after lost executors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, materialize, with_prefix_sum

WEIGHTS = (1, 2, 3)


def default_weight(rank: int) -> float:
    return WEIGHTS[rank % len(WEIGHTS)]


def share_out(sizes: list[int], weights: list[float], total: float, max_repeats: float) -> list[float]:
    """Targets by weight; those above ``max_repeats`` times their size stop there
    and the excess is shared among the others until none is above."""
    target, free, rest = [0.0] * len(sizes), [i for i, w in enumerate(weights) if w > 0], float(total)
    while free:
        unit = rest / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > max_repeats * sizes[i]]
        if not over:
            for i in free:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = float(max_repeats * sizes[i])
            rest -= target[i]
        gone = set(over)
        free = [i for i in free if i not in gone]
    return target


def permute(j: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n): four Feistel rounds over the least
    even number of bits, walked on until the value is below n again."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    mix = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little") | 1) for r in range(4)]

    def walk(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for m in mix:
            f = (right + m) * m
            f ^= f >> np.uint64(32)
            f *= np.uint64(0x9E3779B97F4A7C15)
            left, right = right, left ^ ((f >> np.uint64(40)) & mask)
        return (left << np.uint64(half)) | right

    out = walk(j.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = walk(out[far])
    return out.astype(np.int64)


def _key(seed: int, *parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr((seed, *parts)).encode(), digest_size=8).digest(), "little")


class Mix:
    """A mix of the rows of ``docs``. ``rows`` is the table with columns of its own:
    __source (the source's number), __size and __start (place in the source)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weight: Callable[[int], float] = default_weight, block: int = 128, shard_slots: int = 4096,
                 max_repeats: int = 3, seed: int = 7, max_sources: int = 100_000, buckets: int = 1024):
        spark = docs.sparkSession
        self.block, self.seed = block, seed
        bare = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), f"[^{SPACE}]+", "x")
        size = F.length(F.regexp_replace(bare, f"[{SPACE}]", "")).cast("long")
        sized = docs.select(F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("__name"),
                            F.xxhash64(F.col(id_col), F.col(text_col)).alias("__hash"), size.alias("__size"))
        sized = materialize(sized, "mix-sizes")
        per = sized.groupBy("__name").agg(F.sum("__size").alias("n")).limit(max_sources + 1).collect()
        if len(per) > max_sources:
            raise ValueError(f"over max_sources={max_sources} sources")
        per.sort(key=lambda r: (r[0] is None, r[0] or ""))
        sizes = [r[1] for r in per]
        targets = share_out(sizes, [weight(i) for i in range(len(per))], sum(sizes), max_repeats)
        self.blocks = [math.ceil(n / block) for n in sizes]
        # Slots that bring a target's words, at the source's mean words per block.
        self.expected = [t * b / n if n else 0.0 for t, b, n in zip(targets, self.blocks, sizes)]
        self.max_slots = [max_repeats * b for b in self.blocks]
        self.slots, self.shard_slots = round(sum(self.expected)), shard_slots
        schema = "__name string, __source int, __source_size long, __target double"
        self.recipe = spark.createDataFrame([(r[0], i, r[1], targets[i]) for i, r in enumerate(per)], schema)
        named = self.recipe.withColumnRenamed("__name", "__n2")
        rows = sized.join(named, sized["__name"].eqNullSafe(named["__n2"])).drop("__n2")
        # Rows without an id are dealt by their text.
        deal = F.when(F.col("__id").isNull(), F.col("__hash")).otherwise(F.xxhash64("__id"))
        self.rows = with_prefix_sum(rows, ["__source"], ["__id", "__hash", "__size"], "__size", F.pmod(deal, F.lit(buckets)), "__start")
        self.spark = spark

    def draws(self) -> DataFrame:
        """(shard, source, n): slots that each source gets in each shard."""
        total = sum(self.expected) or 1.0
        p = np.array(self.expected, dtype=float) / total
        slots, width, seed = self.slots, self.shard_slots, self.seed

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for shard in pdf["id"]:
                    n = min(width, slots - int(shard) * width)
                    sure = np.floor(n * p + 1e-9).astype(np.int64)
                    frac = np.maximum(n * p - sure, 0)
                    rest = n - int(sure.sum())
                    if rest > 0 and frac.sum() > 0:
                        sure += np.random.default_rng(_key(seed, "shard", int(shard))).multinomial(rest, frac / frac.sum())
                    at = np.flatnonzero(sure)
                    yield pd.DataFrame({"shard": np.int64(shard), "source": at.astype(np.int32), "n": sure[at]})

        return self.spark.range(math.ceil(slots / width)).mapInPandas(run, "shard long, source int, n long")

    def slot_table(self, slots_per_task: int = 50_000) -> DataFrame:
        """(shard, slot, __source, __index): the block that each slot of the mix holds."""
        numbered = with_prefix_sum(self.draws(), ["source"], ["shard"], "n", F.floor(F.col("shard") / 4096), "first")
        blocks, most, seed = self.blocks, self.max_slots, self.seed

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for shard, s, n, first in zip(pdf["shard"], pdf["source"], pdf["n"], pdf["first"]):
                    j = np.arange(first, min(first + n, most[s]), dtype=np.int64)
                    if not len(j):
                        continue
                    index = np.empty_like(j)
                    for lap in np.unique(j // blocks[s]):
                        of = j // blocks[s] == lap
                        index[of] = permute(j[of] % blocks[s], blocks[s], _key(seed, "source", int(s), int(lap)))
                    # A slot's place within its shard: by a hash, sources mixed.
                    place = np.array([_key(seed, int(shard), int(s), int(x)) >> 1 for x in j], dtype=np.int64)
                    yield pd.DataFrame({"shard": np.int64(shard), "__place": place, "__source": np.int32(s), "__index": index})

        # A row makes up to a shard's slots: dealt by number, so that few bytes are not one task.
        tasks = max(1, math.ceil(self.slots / slots_per_task))
        return numbered.repartition(tasks, "shard", "source").mapInPandas(run, "shard long, __place long, __source int, __index long")

    def segments(self) -> DataFrame:
        """(row's columns, __index, __words): words of each row in each block it touches."""
        end = F.col("__start") + F.col("__size")
        first = F.floor(F.col("__start") / self.block)
        span = F.when(F.col("__size") > 0, F.sequence(first, F.floor((end - 1) / self.block)))
        at = self.rows.withColumn("__index", F.explode_outer(span))
        low = F.greatest(F.col("__start"), F.col("__index") * self.block)
        return at.withColumn("__words", F.coalesce(F.least(end, (F.col("__index") + 1) * self.block) - low, F.lit(0)))

    def taken(self) -> DataFrame:
        """(__id, __size, __source_size, __target, __taken): one row per row of the table."""
        times = self.slot_table().groupBy("__source", "__index").agg(F.count("*").alias("__times"))
        # Sizes of Python output are not known to the planner; both sides grow with the corpus.
        got = self.segments().join(times.hint("merge"), ["__source", "__index"], "left")
        row = ["__id", "__hash", "__source", "__start", "__size", "__source_size", "__target"]
        # Words of rows alike in all of these (repeated blank rows) are told apart by count.
        some = got.filter("__size > 0").groupBy(*row).agg(F.sum(F.coalesce(F.col("__times"), F.lit(0)) * F.col("__words")).alias("__taken"))
        none = self.rows.filter("__size = 0").select(*row, F.lit(0).cast("long").alias("__taken"))
        return some.unionByName(none).select("__id", "__size", "__source_size", "__target", "__taken")


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """Per row: id, size, source_size, target (its source's), taken (words the mix takes)."""
    t = Mix(docs, id_col, text_col, source_col, **params).taken()
    return t.select(F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                    F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def mix_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """The mix itself, one row per slot: shard, slot (place in the shard), source,
    block (index in the source), doc_ids (in order), n_words, text (words as in the
    documents, one space between)."""
    mix = Mix(docs, id_col, text_col, source_col, **params)
    block = mix.block
    # As a struct the key is never null, so rows without an id meet their texts, and one shuffle
    # of the texts serves both the distinct rows and the join.
    texts = docs.select(F.struct(F.col(id_col).alias("__id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("__hash")).alias("__key"),
                        F.col(text_col).alias("__text"))
    # Rows alike in id and text are distinct places in the stream with the same words.
    spots = mix.rows.filter("__size > 0").select(F.struct("__id", "__hash").alias("__key"), "__id", "__source", "__start")
    placed = spots.join(texts.dropDuplicates(["__key"]).hint("merge"), "__key")
    kind = placed.schema["__id"].dataType
    schema = T.StructType([T.StructField("__source", T.IntegerType()), T.StructField("__index", T.LongType()),
                           T.StructField("__at", T.IntegerType()), T.StructField("__id", kind),
                           T.StructField("__n", T.IntegerType()), T.StructField("__piece", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b, out = whole.slice(i, 256), []
                for row, (s, start, text) in enumerate(zip(*(b.column(c).to_pylist() for c in ("__source", "__start", "__text")))):
                    words, pos = text.encode("utf-8", "surrogatepass").split(), 0
                    while pos < len(words):
                        at = (start + pos) % block
                        piece = words[pos:pos + block - at]
                        out.append((s, (start + pos) // block, at, row, len(piece), b" ".join(piece).decode("utf-8", "replace")))
                        pos += len(piece)
                if out:
                    s, index, at, row, n, piece = zip(*out)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(s, pa.int32()), pa.array(index, pa.int64()), pa.array(at, pa.int32()),
                        b.column("__id").take(pa.array(row, pa.int64())), pa.array(n, pa.int32()), pa.array(piece, pa.string())], names=schema.names)

    pieces = placed.select("__id", "__source", "__start", "__text").mapInArrow(run, schema)
    whole = pieces.groupBy("__source", "__index").agg(F.array_sort(F.collect_list(F.struct("__at", "__id", "__n", "__piece"))).alias("__p"))
    slots = mix.slot_table().join(whole.hint("merge"), ["__source", "__index"]).join(mix.recipe.select("__source", F.col("__name").alias("source")), "__source")
    p = F.col("__p")
    return slots.select(
        "shard", F.col("__place").alias("slot"), "source", F.col("__index").alias("block"),
        F.transform(p, lambda x: x["__id"]).alias("doc_ids"),
        F.aggregate(p, F.lit(0), lambda a, x: a + x["__n"]).cast("long").alias("n_words"),
        F.array_join(F.transform(p, lambda x: x["__piece"]), " ").alias("text"))
