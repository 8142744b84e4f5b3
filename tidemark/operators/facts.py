"""Fact pipelines: daily activity, cumulative date lists, bit-packed activity,
monthly metric arrays and the reduced monthly fact.

Every backfill form is one or two hash aggregations; every step form is one full
outer join of yesterday's snapshot with today's aggregate. Arrays are bounded by
the number of days in the window/month, never by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import MASK_32_BITS, MASK_LAST_7_DAYS, MASK_PREVIOUS_7_DAYS
from ..functions.exprs import append_if, bit_count_masked, day_of, empty_array


def _lit_date(d: str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def daily_counts(events: DataFrame, keys: Sequence[str] = ("user_id",), time_col: str = "event_time",
                 day: str | None = None, out: str = "num_site_hits") -> DataFrame:
    """Events per key and day; rows with a NULL key are dropped. Map-side partial
    aggregation keeps the shuffle at one row per (key, day, map task)."""
    e = events
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    d = day_of(time_col)
    if day is not None:
        e = e.where(d == _lit_date(day))
    return e.groupBy(*keys, d.alias("date")).agg(F.count(F.lit(1)).alias(out))


# ---- date lists --------------------------------------------------------------------

def dates_backfill(events: DataFrame, as_of: str, keys: Sequence[str] = ("user_id",),
                   time_col: str = "event_time") -> DataFrame:
    """Cumulative active-date list per key as of ``as_of`` in one aggregation:
    ascending distinct active days <= as_of (what iterating the daily step from
    the first day produces)."""
    e = events
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    d = day_of(time_col)
    e = e.where(d <= _lit_date(as_of)).select(*keys, d.alias("__d"))
    # distinct (key, day) first: the collect then sees at most one row per day
    per_day = e.distinct()
    return (per_day.groupBy(*keys).agg(F.array_sort(F.collect_list("__d")).alias("dates_active"))
            .withColumn("date", _lit_date(as_of)))


def cumulate_dates(prev: DataFrame, events: DataFrame, day: str, keys: Sequence[str] = ("user_id",),
                   time_col: str = "event_time") -> DataFrame:
    """Daily step: yesterday's date lists full-outer-joined with today's active
    keys; today's date is appended for active keys, others are carried."""
    today = daily_counts(events, keys, time_col, day, out="__n").select(*keys, F.col("date").alias("__t"))
    y, t = prev.alias("y"), today.alias("t")
    cond = None
    for k in keys:
        c = F.col(f"y.{k}") == F.col(f"t.{k}")
        cond = c if cond is None else cond & c
    j = y.join(t, cond, "full")
    return j.select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"y.{k}")).alias(k) for k in keys],
        append_if(F.col("y.dates_active"), F.col("t.__t").isNotNull(), F.col("t.__t"), T.DateType())
        .alias("dates_active"),
        F.coalesce(F.col("t.__t"), F.date_add(F.col("y.date"), 1)).alias("date"))


def datelist_int(dates: str | Column, as_of: str | Column, n: int = 32,
                 mode: str = "built") -> Column:
    """Pack the last ``n`` days of a date list into the low 32 bits of a long.

    built: bit (n-1-d) for an active day d days before as_of (today = highest bit).
    reference: exponent n-d truncated to 32 bits (today is lost, bit 0 unused)."""
    a = _lit_date(as_of)
    arr = F.col(dates) if isinstance(dates, str) else dates
    recent = F.filter(arr, lambda x: (F.datediff(a, x) >= 0) & (F.datediff(a, x) < n))
    shift = (lambda x: F.lit(n - 1) - F.datediff(a, x)) if mode == "built" else (lambda x: F.lit(n) - F.datediff(a, x))
    bits = F.aggregate(recent, F.lit(0).cast("long"),
                       lambda acc, x: acc.bitwiseOR(F.pow(F.lit(2), shift(x)).cast("long")))
    return bits.bitwiseAND(F.lit(MASK_32_BITS).cast("long")) if mode != "built" else bits


def activity_readout(df: DataFrame, bits: str = "datelist_int") -> DataFrame:
    """Monthly / weekly / previous-week activity from the packed bits by mask and
    popcount (pure projection)."""
    l32 = F.bit_count(F.col(bits))
    l7 = bit_count_masked(bits, MASK_LAST_7_DAYS)
    prev7 = bit_count_masked(bits, MASK_PREVIOUS_7_DAYS)
    return df.select("*", (l32 > 0).alias("monthly_active"), l32.alias("l32"),
                     (l7 > 0).alias("weekly_active"), l7.alias("l7"),
                     (prev7 > 0).alias("weekly_active_previous_week"))


# ---- monthly metric arrays -----------------------------------------------------------

def month_array_backfill(daily: DataFrame, as_of: str, keys: Sequence[str] = ("user_id",),
                         value: str = "num_site_hits", fill=0,
                         with_first_found: bool = False) -> DataFrame:
    """Positional month array per key as of ``as_of``: index i = month_start + i,
    ``fill`` where the key had no row that day. Keys without any row in the
    month up to as_of are absent. One aggregation; the array is built with
    ``transform(sequence(...))`` over a day->value map (no pivot, no grid join)."""
    a = _lit_date(as_of)
    ms = F.trunc(a, "month")
    d = daily.where((F.col("date") >= ms) & (F.col("date") <= a))
    per_key = d.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(
        F.datediff(F.col("date"), ms).alias("i"), F.col(value).alias("v")))).alias("__m"),
        F.min("date").alias("first_found_date"))
    n = F.datediff(a, ms)
    fill_col = F.lit(fill).cast("long")
    arr = F.transform(F.sequence(F.lit(0), n), lambda i: F.coalesce(F.col("__m")[i], fill_col))
    extra = ["first_found_date"] if with_first_found else []
    return per_key.select(*keys, ms.alias("month_start"), arr.alias("metric_array"), *extra)


def cumulate_month(prev: DataFrame, daily_today: DataFrame, day: str, keys: Sequence[str] = ("user_id",),
                   value: str = "num_site_hits", fill=0, metric_name: str | None = None) -> DataFrame:
    """Daily step of the month array: the month's arrays so far full-outer-joined
    with today's values; arrays are padded with ``fill`` up to day-1 (late joiners
    and skipped days) before today's value (or ``fill``) is appended. Rows of other
    months in ``prev`` are left alone, and an array that already reaches today is
    cut to day-1 first, so a new month starts afresh and a day can run again."""
    a = _lit_date(day)
    ms = F.trunc(a, "month")
    if "month_start" in prev.columns:
        prev = prev.where(F.col("month_start").cast("date") == ms)
    y, t = prev.alias("y"), daily_today.alias("t")
    cond = None
    for k in keys:
        c = F.col(f"y.{k}") == F.col(f"t.{k}")
        cond = c if cond is None else cond & c
    j = y.join(t, cond, "full")
    fill_col = F.lit(fill).cast("long")
    base = F.slice(F.coalesce(F.col("y.metric_array"), empty_array(T.LongType())), F.lit(1), F.datediff(a, ms))
    pad = F.array_repeat(fill_col, F.greatest(F.datediff(a, ms) - F.size(base), F.lit(0)))
    today_val = F.coalesce(F.col(f"t.{value}").cast("long"), fill_col)
    cols = [*[F.coalesce(F.col(f"y.{k}"), F.col(f"t.{k}")).alias(k) for k in keys],
            ms.alias("month_start")]
    if metric_name is not None:
        cols.append(F.lit(metric_name).alias("metric_name"))
    cols.append(F.concat(base, pad, F.array(today_val)).alias("metric_array"))
    if "first_found_date" in prev.columns:
        # earliest day seen, NULL-skipping (a known key absent today keeps its date)
        cols.append(F.least(F.col("y.first_found_date"),
                            F.when(F.col(f"t.{value}").isNotNull(), a)).alias("first_found_date"))
    return j.select(*cols)


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert as a plan: rows of ``existing`` whose key is not in
    ``updates`` (left anti join), plus all of ``updates``. Written back with a
    dynamic partition overwrite this is the ON CONFLICT DO UPDATE of the
    reference, and re-running it is idempotent. Two updates of one key fail the
    query: which of them wins is not defined."""
    per_key = Window.partitionBy(*keys)
    twice = F.raise_error(F.lit("upsert: more than one update row for a key"))
    updates = (updates.withColumn("__same_key", F.count(F.lit(1)).over(per_key))
               .where(F.when(F.col("__same_key") > 1, twice).otherwise(F.lit(True))).drop("__same_key"))
    keep = existing.join(updates.select(*keys), list(keys), "left_anti")
    return keep.unionByName(updates.select(*existing.columns))


def position_sums(df: DataFrame, n: int, group: Sequence[str] = ("month_start",),
                  arr: str = "hit_array", names: Sequence[str] | None = None) -> DataFrame:
    """SUM of the first ``n`` positions per group, NULL-safe (missing or NULL -> 0)."""
    names = names or [f"pos_{i}" for i in range(n)]
    return df.groupBy(*group).agg(*[
        F.sum(F.coalesce(F.get(F.col(arr), i), F.lit(0))).cast("long").alias(names[i]) for i in range(n)])


def array_to_rows(df: DataFrame, group: Sequence[str] = ("metric_name", "month_start"),
                  arr: str = "metric_array") -> DataFrame:
    """Element-wise sum of the arrays per group, one row per position with its
    date (month_start + position). posexplode + aggregation: partial sums are
    combined map-side, so a hot group costs one row per position per task."""
    e = df.select(*group, F.posexplode(arr).alias("__pos", "__v"))
    return (e.groupBy(*group, "__pos").agg(F.sum("__v").cast("long").alias("value"))
            .select(*[g for g in group if g != "month_start"],
                    F.date_add("month_start", F.col("__pos")).alias("adjusted_date"), "value"))


def reduced_month_fact(events: DataFrame, as_of: str, key: str = "host",
                       user: str = "user_id", time_col: str = "event_time",
                       approx_visitors: bool = False) -> DataFrame:
    """Monthly reduced fact per key: hit_array (events per day) and
    unique_visitors (distinct users per day) as of ``as_of``.

    The distinct count is planned by Spark as a (key, day, user) partial
    de-duplication followed by a count, so a hot key is split across tasks
    before the per-key arrays (bounded by the month length) are assembled.
    ``approx_visitors`` uses a HyperLogLog++ sketch instead (one small buffer per
    group and task, no de-duplication shuffle)."""
    a = _lit_date(as_of)
    ms = F.trunc(a, "month")
    d = day_of(time_col)
    e = events.where(F.col(key).isNotNull() & (d >= ms) & (d <= a))
    daily = e.groupBy(key, d.alias("date")).agg(
        F.count(F.lit(1)).alias("hits"),
        (F.approx_count_distinct(user) if approx_visitors else F.count_distinct(user)).alias("visitors"))
    per_key = daily.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(
        F.datediff(F.col("date"), ms).alias("i"),
        F.struct(F.col("hits"), F.col("visitors")).alias("v")))).alias("__m"))
    idx = F.sequence(F.lit(0), F.datediff(a, ms))
    zero = F.lit(0).cast("long")
    return per_key.select(
        key, ms.alias("month_start"),
        F.transform(idx, lambda i: F.coalesce(F.col("__m")[i]["hits"], zero)).alias("hit_array"),
        F.transform(idx, lambda i: F.coalesce(F.col("__m")[i]["visitors"], zero)).alias("unique_visitors"))


def reduced_month_step(prev: DataFrame, events: DataFrame, day: str, key: str = "host",
                       user: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """Daily step of :func:`reduced_month_fact`: only ``day``'s events are read, both
    arrays are cut or padded with 0 to day-1 and today's values appended, so the
    step equals the whole-month form, also when a day is skipped (as a day without
    events), run again, or the first of a month. Rows of other months in ``prev``
    are left alone."""
    a = _lit_date(day)
    today = (events.where(F.col(key).isNotNull() & (day_of(time_col) == a)).groupBy(key)
             .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct(user).alias("visitors")))
    month = F.trunc(a, "month")
    y = prev.where(F.col("month_start") == month).alias("y")
    zero = F.lit(0).cast("long")

    def reached(arr: str, value: str) -> Column:
        base = F.slice(F.coalesce(F.col(f"y.{arr}"), empty_array(T.LongType())), F.lit(1), F.datediff(a, month))
        pad = F.array_repeat(zero, F.datediff(a, month) - F.size(base))
        return F.concat(base, pad, F.array(F.coalesce(F.col(f"t.{value}"), zero))).alias(arr)

    j = y.join(today.alias("t"), F.col(f"y.{key}") == F.col(f"t.{key}"), "full")
    return j.select(F.coalesce(f"y.{key}", f"t.{key}").alias(key), month.alias("month_start"),
                    reached("hit_array", "hits"), reached("unique_visitors", "visitors"))
