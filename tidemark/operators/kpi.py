"""KPI roll-ups: a unit-grain fact and aggregates derived from it, so the
investor-level numbers reconcile with the experiment-level ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import day_of


def unit_day_fact(rows: DataFrame, unit: str = "unit", day: str = "day", measure: str = "profit") -> DataFrame:
    """Unit x day grain (sum of the per-row integral measure)."""
    return rows.groupBy(unit, day).agg(F.sum(measure).alias(measure))


def monthly_rollup(fact: DataFrame, unit: str = "unit", day: str = "day", measure: str = "profit") -> DataFrame:
    return (fact.groupBy(F.trunc(day, "month").alias("month"))
            .agg(F.sum(measure).alias(f"total_{measure}"), F.count_distinct(unit).alias("units"))
            .withColumn(f"{measure}_per_unit", F.col(f"total_{measure}") / F.col("units")))


def daily_growth(events: DataFrame, key: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """Daily actives, first-time actives and the cumulative number of units.

    The running total is a window over the per-day aggregate (one row per
    day), never over events."""
    d = day_of(time_col)
    act = events.where(F.col(key).isNotNull()).select(key, d.alias("day")).distinct()
    first = act.groupBy(key).agg(F.min("day").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("new_users"))
    dau = act.groupBy("day").agg(F.count(F.lit(1)).alias("active_users"))
    j = dau.join(first, "day", "left").fillna(0, ["new_users"])
    run = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select("day", "active_users", "new_users",
                    (F.col("active_users") - F.col("new_users")).alias("returning_users"),
                    F.sum("new_users").over(run).alias("cumulative_users"))


def daily_engagement(events: DataFrame, key: str = "user_id", time_col: str = "event_time") -> DataFrame:
    d = day_of(time_col)
    e = events.where(F.col(key).isNotNull())
    return (e.groupBy(d.alias("day"))
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct(key).alias("active_users"),
                 F.count_distinct("url").alias("distinct_urls"))
            .withColumn("events_per_user", F.col("events") / F.col("active_users")))
