"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..session import ensure_checkpoint_dir

# White space between words: space and U+0009..U+000D, nothing else.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes, A-Z lower-cased; null has none.

    ``bytes.split`` cuts at exactly space and U+0009..U+000D.
    """
    return text.encode("utf-8", "surrogatepass").translate(LOWER_AZ).split() if text else []


def word_array(text: Column) -> Column:
    """The words of a text column as an array (empty for null and blank texts)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage,
    and what is lost with an executor is read again, not computed again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_chunks(df: DataFrame, text_col: str, chunk_bytes: int) -> int:
    """How many chunks of about ``chunk_bytes`` of text the table makes (at least 1)."""
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, math.ceil(total / chunk_bytes))


def with_prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` per key in the order (bucket, *order).

    Two levels, so that a key that holds much of the table is not one task: a
    window per (key, bucket), then a window over the buckets' totals alone.
    """
    b, tot, pre, own = "__ps_bucket", "__ps_total", "__ps_before", "__ps_own"
    df = df.withColumn(b, bucket)
    w = W.partitionBy(*keys, b).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inner = df.withColumn(own, F.coalesce(F.sum(value).over(w), F.lit(0)))
    totals = df.groupBy(*keys, b).agg(F.sum(value).alias(tot))
    wk = W.partitionBy(*keys).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    before = totals.withColumn(pre, F.coalesce(F.sum(tot).over(wk), F.lit(0))).drop(tot)
    return inner.join(before.hint("merge"), [*keys, b]).withColumn(out, F.col(own) + F.col(pre)).drop(b, own, pre)


def bounded_head(counts: DataFrame, n: str, limit: int) -> tuple[DataFrame, int]:
    """Rows with the largest counts, ``limit`` at most, and the least count among them.

    The least count is the smallest power of 2^(1/4) above which no more than
    ``limit`` rows lie, from a histogram of a few hundred bins: no sort, no task that
    sees all rows. Rows of equal count are in or out together."""
    step = lambda c: F.floor(F.log2(c.cast("double")) * 4).cast("int")
    bins = counts.where(F.col(n) > 0).groupBy(step(F.col(n)).alias("__bin")).agg(F.count(F.lit(1)).alias("__rows"), F.min(n).alias("__least")).collect()
    total, least = 0, (1 << 63) - 1
    for r in sorted(bins, key=lambda r: -r["__bin"]):
        total += r["__rows"]
        if total > limit:
            break
        least = r["__least"]
    return counts.where(F.col(n) >= least), least


def read_file(path: str) -> bytes:
    """A small file's content, read on the driver."""
    with open(path, "rb") as f:
        return f.read()


def keep_columns(docs: DataFrame, *names: str) -> list[Column]:
    """The named columns, those that the table lacks as null strings."""
    have = set(docs.columns)
    return [F.col(n) if n in have else F.lit(None).cast(T.StringType()).alias(n) for n in names]
