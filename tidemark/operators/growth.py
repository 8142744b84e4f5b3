"""Growth accounting, retention curve and same-day funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (CONVERSION_URL, STATE_CHURNED, STATE_NEW, STATE_RESURRECTED,
                                   STATE_RETAINED, STATE_STALE)
from ..functions.exprs import append_if, day_of


def _states(y_present: Column, t_day: Column, y_last: Column, y_date: Column) -> tuple[Column, Column]:
    """Daily and weekly states; first match wins and comparisons with a missing
    ``t_day`` are NULL and fall through (SQL CASE semantics kept on purpose)."""
    daily = (F.when(~y_present, STATE_NEW)
             .when(y_last == F.date_sub(t_day, 1), STATE_RETAINED)
             .when(y_last < F.date_sub(t_day, 1), STATE_RESURRECTED)
             .when(t_day.isNull() & (y_last == y_date), STATE_CHURNED)
             .otherwise(STATE_STALE))
    weekly = (F.when(~y_present, STATE_NEW)
              .when(y_last < F.date_sub(t_day, 7), STATE_RESURRECTED)
              .when(t_day.isNull() & (y_last == F.date_sub(y_date, 7)), STATE_CHURNED)
              .when(F.date_add(F.coalesce(t_day, y_last), 7) >= y_date, STATE_RETAINED)
              .otherwise(STATE_STALE))
    return daily, weekly


def growth_step(prev: DataFrame, events: DataFrame, day: str, key: str = "user_id",
                time_col: str = "event_time") -> DataFrame:
    """One daily snapshot from yesterday's: full outer join with today's active keys."""
    d = day_of(time_col)
    today = (events.where(F.col(key).isNotNull() & (d == F.lit(day).cast("date")))
             .select(key, d.alias("today_date")).distinct())
    y, t = prev.alias("y"), today.alias("t")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full")
    t_day = F.col("t.today_date")
    daily, weekly = _states(F.col(f"y.{key}").isNotNull(), t_day, F.col("y.last_active_date"),
                            F.col("y.date"))
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.coalesce(F.col("y.first_active_date"), t_day).alias("first_active_date"),
        F.coalesce(t_day, F.col("y.last_active_date")).alias("last_active_date"),
        daily.alias("daily_active_state"), weekly.alias("weekly_active_state"),
        append_if(F.col("y.dates_active"), t_day.isNotNull(), t_day, T.DateType()).alias("dates_active"),
        F.coalesce(t_day, F.date_add(F.col("y.date"), 1)).alias("date"))


def growth_backfill(events: DataFrame, last_day: str, key: str = "user_id",
                    time_col: str = "event_time", with_dates: bool = True) -> DataFrame:
    """Every daily snapshot from each key's first active day to ``last_day`` in one
    pass (equals iterating :func:`growth_step` from an empty table).

    Plan: one aggregation per key gathers its sorted active days (bounded by the
    number of days). Each active day d_i then generates the snapshot rows of
    the interval [d_i, d_{i+1}) — in that interval the last active day is d_i
    and i+1 days are active — so the work is linear in the number of snapshot
    rows: no per-day join, no window over a key, no scan of the day list per
    row. ``with_dates`` adds the cumulative ``dates_active`` array of the
    snapshot table (its size grows with the history)."""
    d = day_of(time_col)
    last = F.lit(last_day).cast("date")
    per_key = (events.where(F.col(key).isNotNull() & (d <= last))
               .select(key, d.alias("__d")).distinct()
               .groupBy(key).agg(F.array_sort(F.collect_list("__d")).alias("__days")))
    act = per_key.select(key, "__days", F.posexplode("__days").alias("__i", "__di"))
    nxt = F.try_element_at("__days", (F.col("__i") + 2).cast("int"))
    prev = F.when(F.col("__i") > 0, F.try_element_at("__days", F.col("__i").cast("int")))
    act = act.select(key, "__days", "__i", "__di", prev.alias("__prev"),
                     F.explode(F.sequence(F.col("__di"), F.coalesce(F.date_sub(nxt, 1), last)))
                     .alias("date"))
    active = F.col("date") == F.col("__di")
    prev_last = F.when(active, F.col("__prev")).otherwise(F.col("__di"))
    y_present = ~(active & (F.col("__i") == 0))
    t_day = F.when(active, F.col("date"))
    daily, weekly = _states(y_present, t_day, prev_last, F.date_sub(F.col("date"), 1))
    extra = [F.slice("__days", 1, F.col("__i") + 1).alias("dates_active")] if with_dates else []
    return act.select(key, F.col("__days")[0].alias("first_active_date"),
                      F.col("__di").alias("last_active_date"), daily.alias("daily_active_state"),
                      weekly.alias("weekly_active_state"), *extra,
                      (F.col("__i") + 1).cast("int").alias("num_dates"), "date")


def retention_curve(snapshots: DataFrame) -> DataFrame:
    """J-curve over all snapshots: by days since first activity, the share of
    rows that are active (New, Retained, Resurrected) and the number of rows."""
    active = F.col("daily_active_state").isin(STATE_RETAINED, STATE_RESURRECTED, STATE_NEW)
    return (snapshots.groupBy(F.datediff("date", "first_active_date").alias("days_since_first_active"))
            .agg(F.try_divide(F.count(F.when(active, 1)).cast("double"), F.count(F.lit(1)))
                 .alias("pct_active"),
                 F.count(F.lit(1)).alias("num_rows")))


def funnel(events: DataFrame, target_url: str = CONVERSION_URL, min_count: int = 0,
           denominator: str = "followed", key: str = "user_id", time_col: str = "event_time",
           url: str = "url") -> DataFrame:
    """Same-day funnel: for every (user, time, url) event, did ``target_url``
    happen later the same day; per url the number of events and the rate.

    ``denominator="followed"`` counts only events followed by another event that
    day (the self-join semantics); ``"all"`` counts every event.

    The quadratic self join is replaced by one aggregate per (user, day) — the
    latest event time and the latest target time — joined back on (user, day).
    Partial aggregation and AQE skew-join splitting keep a hot user-day from
    landing in one task."""
    d = day_of(time_col)
    clean = (events.where(F.col(key).isNotNull())
             .select(key, time_col, url).distinct()
             .withColumn("__day", d))
    per_day = clean.groupBy(key, "__day").agg(
        F.max(time_col).alias("__last"),
        F.max(F.when(F.col(url) == target_url, F.col(time_col))).alias("__last_target"))
    j = clean.join(per_day, [key, "__day"])
    if denominator == "followed":
        j = j.where(F.col("__last") > F.col(time_col))
    conv = F.coalesce(F.col("__last_target") > F.col(time_col), F.lit(False)).cast("long")
    out = (j.groupBy(url).agg(F.count(F.lit(1)).alias("num_events"),
                              (F.sum(conv).cast("double") / F.count(F.lit(1))).alias("conversion_rate")))
    return out.where((F.col("conversion_rate") > 0) & (F.col("num_events") > min_count))
