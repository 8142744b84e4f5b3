"""Window-function operators: first row per key, change detection, streak ids,
frames over ordered partitions, gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col_


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [col_(c) for c in order]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key: the first by an explicit total ``order``.

    ``row_number() ... = 1`` plans as a shuffle on ``keys`` plus a
    WindowGroupLimit that drops losers before the full sort. A missing order
    would make the survivor arbitrary, so it is required."""
    if not order:
        raise ValueError("first_per_key needs an explicit order for a deterministic survivor")
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def change_flags(df: DataFrame, key: Sequence[str], period: str, attrs: Sequence[str],
                 flag: str = "did_change") -> DataFrame:
    """Null-safe change detection: the first row of a key, or any attribute that
    differs from the previous row (NULL -> value and value -> NULL are changes)."""
    w = Window.partitionBy(*key).orderBy(period)
    first = F.lag(F.lit(1)).over(w).isNull()
    changed = None
    for a in attrs:
        c = ~F.lag(F.col(a)).over(w).eqNullSafe(F.col(a))
        changed = c if changed is None else (changed | c)
    return df.withColumn(flag, first | changed)


def streak_ids(df: DataFrame, key: Sequence[str], period: str, flag: str = "did_change",
               out: str = "streak_id") -> DataFrame:
    """Running count of change flags: rows of one unchanged streak share an id."""
    w = (Window.partitionBy(*key).orderBy(period)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(F.col(flag).cast("int")).over(w))


def rolling_sum(value: str, key: Sequence[str], order: str, lo: int, hi: int) -> Column:
    """SUM over a ROWS frame [lo, hi] relative to the current row."""
    return F.sum(value).over(Window.partitionBy(*key).orderBy(order).rowsBetween(lo, hi))


def longest_run(df: DataFrame, key: Sequence[str], order: Sequence[str], cond: Column,
                out: str = "longest_run") -> DataFrame:
    """Longest run of consecutive rows (ordered by ``order``) where ``cond`` holds, per
    key (gaps and islands). Keys with no qualifying row report 0.

    The running count of failing rows, from a distributed prefix scan, names the
    island of each row; the length of a run is the count of passing rows of its
    island, summed partially per task. No task holds a whole key, day or run."""
    from .scan import prefix_scan
    key = list(key)
    ok = F.coalesce(cond, F.lit(False)).cast("int")
    rows = df.select(*key, *order, ok.alias("__ok"), (1 - ok).alias("__miss"))
    isl = prefix_scan(rows, key, order, {"__island": "__miss"})
    runs = isl.groupBy(*key, "__island").agg(F.sum("__ok").alias("__len"))
    return runs.groupBy(*key).agg(F.max("__len").alias(out))
