"""Unique visitors over periods from a mergeable daily state.

Distinct counts of days do not add up to those of weeks. Two states that do merge are
kept per (key, day), so that a period is answered from stored days without reading an
event again: a HyperLogLog sketch (one small binary; standard error about
1.04 / sqrt(2^lg_k)), and exact bitmaps of integer visitor ids (one per 32,768 ids in
which the key has a visitor, 4 kB at most).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import day_of

PERIODS = ("day", "week", "month", "year")


def _visits(events: DataFrame, key: str, user: str, time_col: str) -> DataFrame:
    e = events.where(F.col(key).isNotNull() & F.col(user).isNotNull())
    return e.select(key, day_of(time_col).alias("date"), F.col(user).alias("__u"))


def daily_sketches(events: DataFrame, key: str = "host", user: str = "user_id", time_col: str = "event_time", lg_k: int = 12) -> DataFrame:
    """(key, date, hits, visitors sketch): one row per key and day. Rows with a null key
    or visitor are left out."""
    return (_visits(events, key, user, time_col).groupBy(key, "date")
            .agg(F.count(F.lit(1)).alias("hits"), F.hll_sketch_agg("__u", lg_k).alias("visitors")))


def daily_bitmaps(events: DataFrame, key: str = "host", user: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """(key, date, bucket, hits, visitors bitmap): one row per key, day and 32,768 ids."""
    u = F.col("__u").cast("long")
    return (_visits(events, key, user, time_col).groupBy(key, "date", F.bitmap_bucket_number(u).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("hits"), F.bitmap_construct_agg(F.bitmap_bit_position(u)).alias("visitors")))


def _in_periods(state: DataFrame, period: str | int) -> DataFrame:
    """``__from``: the first day of the calendar period of a day; for a number n the day
    counts for each of the n days from it on, whose trailing n days hold it."""
    d = F.col("date")
    if isinstance(period, int):
        if period < 1:
            raise ValueError("a trailing period has at least 1 day")
        return state.withColumn("__from", F.explode(F.sequence(d, F.date_add(d, period - 1))))
    if period not in PERIODS:
        raise ValueError(f"no period {period}")
    first: Column = d if period == "day" else F.trunc(d, period)
    return state.withColumn("__from", first)


def visitors_sketched(state: DataFrame, period: str | int, key: str = "host") -> DataFrame:
    """(key, period_start, hits, visitors) per calendar period ('day', 'week', 'month',
    'year'), estimated by the union of the days' sketches. For a number n the rows are
    the trailing n days up to ``period_start``, n - 1 days beyond the last included."""
    return (_in_periods(state, period).groupBy(key, F.col("__from").alias("period_start"))
            .agg(F.sum("hits").alias("hits"), F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors")))


def visitors_exact(state: DataFrame, period: str | int, key: str = "host") -> DataFrame:
    """As ``visitors_sketched``, exactly, by the union of the days' bitmaps."""
    per = (_in_periods(state, period).groupBy(key, F.col("__from").alias("period_start"), "bucket")
           .agg(F.sum("hits").alias("hits"), F.bitmap_count(F.bitmap_or_agg("visitors")).alias("n")))
    return per.groupBy(key, "period_start").agg(F.sum("hits").alias("hits"), F.sum("n").alias("visitors"))
