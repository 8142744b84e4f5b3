"""Join strategies a Spark user chooses explicitly:
bucketed (shuffle-free) sort-merge join, range joins rewritten to equi joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def write_bucketed(df: DataFrame, name: str, n: int, cols: Sequence[str], path: str,
                   sort: bool = True, session: SparkSession | None = None) -> DataFrame:
    """Save ``df`` as a table bucketed (and sorted) on ``cols`` into ``n`` buckets at
    ``path``. ``repartition(n, cols)`` first makes each task write one bucket,
    so the table has n files instead of n per task. Returns the table, as seen by
    ``session`` (by default the one of ``df``)."""
    w = df.repartition(n, *cols).write.mode("overwrite").option("path", path).bucketBy(n, *cols)
    if sort:
        w = w.sortBy(*cols)
    w.saveAsTable(name)
    return (session or df.sparkSession).table(name)


def bucketed_tables(spark: SparkSession, tables: dict[str, DataFrame], n: int, cols: Sequence[str],
                    tag: str = "bucketed", session: SparkSession | None = None) -> dict[str, DataFrame]:
    """Bucketed copies of ``tables``. Their names are needed only while they are written
    and looked up: the catalog entries are dropped again (the files stay, and the
    returned tables keep their bucket layout)."""
    base = scratch_path(spark, tag)
    suffix = base.rsplit("-", 1)[-1]
    out = {}
    for k, df in tables.items():
        name = f"{k}_{tag}_{suffix}"
        out[k] = write_bucketed(df, name, n, cols, f"{base}/{k}", session=session)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out


def session_with(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark`` with its settings and some of its own: a plan that needs
    another rule does not change the caller's session."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if s.conf.isModifiable(k):
            s.conf.set(k, v)
    for k, v in settings.items():
        s.conf.set(k.replace("__", "."), v)
    return s


def write_by_period(df: DataFrame, period: str, path: str) -> DataFrame:
    """Facts in one folder per ``period`` value. Joined on that column, a filter of the
    other side reaches the facts at run time: only the folders of the periods that
    its rows have are read."""
    df.repartition(period).write.mode("overwrite").partitionBy(period).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TOP_BIT = 62  # bounds and points lie within +-2^62


def range_cover(ranges: DataFrame, lo: str, hi: str, base: int = 0, bits: int = 4) -> DataFrame:
    """One row per (range, node) with ``__level`` and ``__node``: disjoint aligned blocks
    of width 2^(base + level) that cover [lo, hi], widest first.

    Levels are ``bits`` apart, so a range of any width has fewer than 2^(bits + 1)
    nodes a level: the row count grows with the logarithm of the width. Blocks
    of the lowest level stick out beyond the ends unless ``base`` is 0. Ranges
    with a null end or lo > hi have no node."""
    first, stop = F.shiftright(F.col(lo).cast("long"), base), F.shiftright(F.col(hi).cast("long"), base) + 1
    up = lambda x, k: -F.call_function("shiftright", -x, k)
    down = lambda x, k: F.call_function("shiftright", x, k)
    none = F.array().cast("array<bigint>")
    span = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)

    top = (TOP_BIT - base) // bits - 1

    def nodes(i):
        k = i * bits  # shifts stay below 64: the top level keeps all that is left
        l, r, inner_l, inner_r = up(first, k), down(stop, k), up(first, k + bits), down(stop, k + bits)
        edges = F.concat(span(l, F.shiftleft(inner_l, bits)), span(F.shiftleft(inner_r, bits), r))
        return F.transform(F.when((i < top) & (inner_l < inner_r), edges).otherwise(span(l, r)),
                           lambda x: F.struct((k + base).cast("int").alias("__level"), x.alias("__node")))

    levels = F.transform(F.sequence(F.lit(0), F.lit(top)), nodes)
    valid = ranges.where(F.col(lo) <= F.col(hi))
    return valid.select("*", F.explode(F.flatten(levels)).alias("__n")).select("*", "__n.__level", "__n.__node").drop("__n")


def _levels(cover: DataFrame) -> list[int]:
    """Levels in use: at most 63 numbers."""
    return sorted(r[0] for r in cover.select("__level").distinct().collect())


def range_join(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str,
               block: int, how: str = "left", bits: int = 4) -> DataFrame:
    """``lo <= point <= hi`` as an equi join; every range that holds a point is a match.

    Each range becomes the nodes of its cover over blocks of about ``block``
    (``range_cover``), each point probes the block it lies in at every level in
    use; the equi join is followed by the range predicate. Ranges no wider than
    a few blocks use one level, wide ones a few rows on several levels, never a
    row per block. On one level a left join probes directly; on several the
    matches are found for the distinct points and joined back on the point, for
    a left join (a stream does that per batch, or uses ``narrowest_range``). Whether
    the range side is broadcast is left to Spark's byte threshold and its
    measured sizes."""
    base = max(0, block.bit_length() - 1)
    cover = range_cover(ranges, lo, hi, base, bits)
    levels = _levels(cover) or [base]
    p = F.col(point).cast("long")
    probe = lambda df, level: df.withColumn("__node", F.shiftright(p, level)).withColumn("__level", F.lit(level))

    def matched(left: DataFrame, kind: str) -> DataFrame:
        cond = ((left["__node"] == cover["__node"]) & (left["__level"] == cover["__level"])
                & (left[point] >= cover[lo]) & (left[point] <= cover[hi]))
        return left.join(cover, cond, kind).drop(left["__node"]).drop(left["__level"]).drop(cover["__node"]).drop(cover["__level"])

    if len(levels) == 1:
        return matched(probe(points, levels[0]), how)
    exploded = lambda df: df.select("*", F.explode(F.array(*[F.struct(F.lit(v).alias("__level"), F.shiftright(p, v).alias("__node"))
                                                             for v in levels])).alias("__p")).select("*", "__p.__level", "__p.__node").drop("__p")
    if how == "inner":
        return matched(exploded(points), "inner")
    if how != "left":
        raise ValueError("range_join joins inner or left")
    if points.isStreaming:
        raise ValueError("ranges on several levels: join per batch, or use narrowest_range")
    hits = matched(exploded(points.select(point).where(F.col(point).isNotNull()).distinct()), "inner").withColumnRenamed(point, "__hit")
    return points.join(hits, points[point] == hits["__hit"], "left").drop("__hit")


def narrowest_range(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str,
                    payload: Sequence[str], bits: int = 4) -> DataFrame:
    """Every point row with lo, hi and ``payload`` of the narrowest range that holds it
    (nulls if none); equal widths go to the least (lo, payload).

    Of the ranges that share a node of the exact cover only the narrowest can win,
    so each level is a table with one row per node and the join with it 1:1: no row
    multiplies, no row id or grouping is needed, nested ranges of any depth cost
    one look-up a level, and a stream joins like a table."""
    cover = range_cover(ranges.select(lo, hi, *payload), lo, hi, 0, bits)
    best = F.struct((F.col(hi) - F.col(lo)).alias("w"), F.col(lo).alias("lo"), *[F.col(c).alias(f"p{i}") for i, c in enumerate(payload)], F.col(hi).alias("hi"))
    nodes = cover.groupBy("__level", "__node").agg(F.min(best).alias("__best"))
    levels = _levels(cover)
    out = points
    for v in levels:
        at = nodes.where(F.col("__level") == v).select(F.col("__node").alias("__at"), F.col("__best").alias(f"__b{v}"))
        out = out.join(at, F.shiftright(F.col(point).cast("long"), v) == F.col("__at"), "left").drop("__at")
    if not levels:
        return points.select("*", *[F.lit(None).cast(ranges.schema[c].dataType).alias(c) for c in (lo, hi, *payload)])
    win = F.least(*[F.col(f"__b{v}") for v in levels]) if len(levels) > 1 else F.col(f"__b{levels[0]}")
    out = out.withColumn("__win", win).drop(*[f"__b{v}" for v in levels])
    return out.select(*points.columns, F.col("__win.lo").alias(lo), F.col("__win.hi").alias(hi),
                      *[F.col(f"__win.p{i}").alias(c) for i, c in enumerate(payload)])
