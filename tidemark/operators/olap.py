"""Reporting operators: grouping sets with level labels, referrer window
analysis, rolling stretches and streaks, top answers."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import day_of, map_referrer
from .scan import prefix_scan


def _is_set(s: Collection[str], cols: Sequence[str]) -> Column:
    """Whether a row of grouping sets is of the set ``s``, from the ``__g_`` flags."""
    return reduce(lambda x, y: x & y, [F.col(f"__g_{c}") == (0 if c in s else 1) for c in cols])


def _labelled(df: DataFrame, cols: Sequence[str], labels: dict, overall: str, level_col: str, values: Sequence[str]) -> DataFrame:
    """Level label from the ``__g_`` flags, NULL grouping columns shown as ``overall``."""
    label = None
    for s, name in labels.items():
        cond = _is_set(s, cols)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    return df.select(label.alias(level_col), *[F.coalesce(F.col(c).cast("string"), F.lit(overall)).alias(c) for c in cols], *values)


def labelled_grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], labels: dict,
                           aggs: dict[str, Column], overall: str = "(overall)",
                           level_col: str = "aggregation_level") -> DataFrame:
    """GROUP BY GROUPING SETS with a level label from ``grouping()`` and NULL
    grouping columns shown as ``overall``. One Expand + one aggregation: the
    data is read and shuffled once for all sets.

    ``labels`` maps a frozenset of grouped columns to its label."""
    cols = sorted({c for s in sets for c in s})
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    out = g.agg(*[c.alias(n) for n, c in aggs.items()], *[F.grouping(c).alias(f"__g_{c}") for c in cols])
    return _labelled(out, cols, labels, overall, level_col, list(aggs))


def grouping_sets_over_items(df: DataFrame, sets: Sequence[Sequence[str]], labels: dict, item: str,
                             sums: dict[str, Column], count: str, flags: dict[str, Column],
                             overall: str = "(overall)", level_col: str = "aggregation_level") -> DataFrame:
    """Grouping sets with sums and exact distinct counts of ``item``: ``count`` for all
    items, and per flag the items with a row where it holds.

    Distinct counts in grouping sets would expand every row once more per distinct
    expression, and grouping by (columns, item) first would hold a group per row and set
    in a task's memory. Here a window per set marks the first row of each (item,
    set's columns), one with the flag if there is one; distinct counts are then plain
    sums of marks under one Expand (rows x sets) by the columns alone, partial per task.
    Rows that are dealt by ``item`` are marked where they lie; others are dealt by
    (item, set's columns), so that no group or item is one task. Memory is that of
    sorting a task's rows. Null items are not counted."""
    cols = sorted({c for s in sets for c in s})
    there = F.col(item).isNotNull()
    marked = df.withColumns({f"__f_{f}": F.coalesce(c, F.lit(False)) for f, c in flags.items()})
    holds = {count: F.lit(True), **{f: F.col(f"__f_{f}") for f in flags}}
    by_flag = {n: F.col(f"__f_{n if n in flags else next(iter(flags), count)}").desc() if flags else F.lit(0) for n in holds}
    for k, s in enumerate(sets):
        w = Window.partitionBy(item, *s)
        marked = marked.withColumns({f"__m_{n}_{k}": (there & c & (F.row_number().over(w.orderBy(by_flag[n])) == 1)).cast("long") for n, c in holds.items()})
    marks = [f"__m_{n}_{k}" for n in holds for k in range(len(sets))]
    g = marked.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    out = g.agg(*[c.alias(n) for n, c in sums.items()], *[F.sum(m).alias(m) for m in marks], *[F.grouping(c).alias(f"__g_{c}") for c in cols])
    in_set = [_is_set(s, cols) for s in sets]
    out = out.withColumns({n: F.coalesce(*[F.when(is_set, F.col(f"__m_{n}_{k}")) for k, is_set in enumerate(in_set)]) for n in holds})
    return _labelled(out, cols, labels, overall, level_col, [*sums, count, *flags])


def referrer_daily_counts(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """url x grouped referrer x day counts."""
    return (events.select("url", map_referrer("referrer").alias("referrer"),
                          day_of(time_col).alias("event_date"))
            .groupBy("url", "referrer", "event_date").agg(F.count(F.lit(1)).alias("count")))


def referrer_window_analysis(daily: DataFrame, min_total: int, prev_lo: int = -13,
                             prev_hi: int = -7) -> DataFrame:
    """Month total, running total, overall total, 7-row rolling count and the
    previous-week rolling count per (referrer, url) over days, then shares.

    The input is one row per (referrer, url, day), so the windows run on an
    aggregate whose size is keys x days, not on the events. The reference's
    previous-week frame is rows -13..-6 (overlapping the current week by one
    row); the default here is -13..-7."""
    k = ["referrer", "url"]
    by_month = Window.partitionBy(*k, F.trunc("event_date", "month"))
    whole = Window.partitionBy(*k)
    ordered = Window.partitionBy(*k).orderBy("event_date")
    running = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    w = (daily
         .withColumn("monthly_cumulative_sum", F.sum("count").over(by_month))
         .withColumn("rolling_cumulative_sum", F.sum("count").over(running))
         .withColumn("total_cumulative_sum", F.sum("count").over(whole))
         .withColumn("weekly_rolling_count", F.sum("count").over(ordered.rowsBetween(-6, 0)))
         .withColumn("previous_weekly_rolling_count",
                     F.sum("count").over(ordered.rowsBetween(prev_lo, prev_hi))))
    return (w.where((F.col("total_cumulative_sum") > min_total) & F.col("referrer").isNotNull())
            .select("referrer", "url", "event_date", "count", "rolling_cumulative_sum",
                    "weekly_rolling_count", "previous_weekly_rolling_count",
                    (F.col("count").cast("double") / F.col("monthly_cumulative_sum")).alias("pct_of_month"),
                    (F.col("count").cast("double") / F.col("total_cumulative_sum")).alias("pct_of_total")))


def max_stretch_sum(df: DataFrame, key: Sequence[str], day: str, tiebreak: str, value: str,
                    n: int, out: str = "max_stretch") -> DataFrame:
    """Maximum of SUM(value) over any ``n`` consecutive rows per key (leading
    partial stretches included, as a ROWS n-1 PRECEDING frame does).

    sum(rows p-n+1..p) = cum(p) - cum(p-n). Each position is sent to its own
    (block, offset) slot and, as the 'previous' value, to the same offset of
    the next block (block = (p-1) div n); one aggregation per slot pairs them.
    Positions and running sums come from a distributed prefix scan: no window
    over a whole key or day; the final max is partial per task."""
    key = list(key)
    pos = prefix_scan(df.select(*key, day, tiebreak, value), key, [day, tiebreak], {"cum": value})
    blk = F.floor((F.col("pos") - 1) / n).cast("long")
    off = ((F.col("pos") - 1) % n).cast("long")
    roles = F.explode(F.array(F.struct(blk.alias("b"), F.lit(True).alias("cur")),
                              F.struct((blk + 1).alias("b"), F.lit(False).alias("cur"))))
    slots = pos.select(*key, off.alias("__off"), "cum", roles.alias("__r"))
    paired = slots.groupBy(*key, F.col("__r.b").alias("__b"), "__off").agg(
        F.max(F.when(F.col("__r.cur"), F.col("cum"))).alias("__cur"),
        F.max(F.when(~F.col("__r.cur"), F.col("cum"))).alias("__prev"))
    stretch = F.col("__cur") - F.coalesce(F.col("__prev"), F.lit(0))
    return (paired.where(F.col("__cur").isNotNull())
            .groupBy(*key).agg(F.max(stretch).alias(out)))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str],
                  payload: Sequence[str], prefix: str = "top_") -> DataFrame:
    """Top row per group by descending ``order`` (ties to the larger payload) as
    a struct max: a hash aggregation with map-side partial results, so a hot
    group costs one partial row per task."""
    m = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("__m")
    return df.groupBy(*group).agg(m).select(
        *group, *[F.col(f"__m.{c}").alias(prefix + c) for c in [*order, *payload]])


def top_per_group_by(df: DataFrame, group: Sequence[str], rankings: dict[str, Sequence[str]],
                     payload: Sequence[str]) -> DataFrame:
    """Several top-1 answers per group in ONE aggregation: for each
    ``prefix -> order columns`` a struct max (ties to the larger payload)."""
    aggs = [F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias(f"__{p}")
            for p, order in rankings.items()]
    out = df.groupBy(*group).agg(*aggs)
    return out.select(*group, *[F.col(f"__{p}.{c}").alias(p + c)
                                for p, order in rankings.items() for c in [*order, *payload]])
