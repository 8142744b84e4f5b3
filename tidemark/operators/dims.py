"""Dimension pipelines: cumulative dimension (step and backfill), type-2 slowly
changing dimension (backfill and incremental), state changes.

Snapshot schema produced by :func:`backfill_dim` / :func:`cumulate_dim`::

    <key>, <static...>, seasons array<struct<period, stats...>>, scoring_class,
    years_since_last_active int, is_active boolean, current_season int
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (PLAYER_CONTINUED, PLAYER_NEW, PLAYER_RETIRED,
                                   PLAYER_RETURNED, PLAYER_STAYED_RETIRED)
from ..functions.exprs import append_if, last_elem, scoring_class
from .windows import change_flags, streak_ids

ClassFn = Callable[[Column], Column]


def _stats_struct(period: str, stats: Sequence[str], prefix: str = "") -> Column:
    return F.struct(F.col(prefix + period).cast("int").alias("season"),
                    *[F.col(prefix + s).alias(s) for s in stats])


def backfill_dim(src: DataFrame, last_period: int | Column, key: str = "player_name",
                 period: str = "season", stats: Sequence[str] = ("gp", "pts", "ast", "reb"),
                 static: Sequence[str] = ("weight", "country", "college"),
                 class_of: str = "pts", class_fn: ClassFn = scoring_class,
                 current_col: str = "current_season") -> DataFrame:
    """Whole cumulative history in one pass: one snapshot row per entity and
    period from its first period to ``last_period``.

    Plan: ONE shuffle (group by entity) gathers the entity's period rows and
    static maxima; each snapshot row is then generated locally with
    ``explode(sequence(first, last))`` and a ``filter`` of the sorted history —
    no grid join and no window sort. Group size is bounded by the number of
    periods, not by the data volume."""
    per_entity = (src.groupBy(key)
                  .agg(F.array_sort(F.collect_list(_stats_struct(period, stats))).alias("__hist"),
                       *[F.max(c).alias(c) for c in static]))
    last = F.lit(last_period) if not isinstance(last_period, Column) else last_period
    grid = per_entity.select(
        key, *static, "__hist",
        F.explode(F.sequence(F.col("__hist")[0]["season"], last.cast("int"))).alias(current_col))
    seasons = F.filter("__hist", lambda s: s["season"] <= F.col(current_col))
    snap = grid.select(key, *static, seasons.alias("seasons"), current_col)
    lst = last_elem("seasons")
    return snap.select(
        key, *static, "seasons",
        class_fn(lst[class_of]).alias("scoring_class"),
        (F.col(current_col) - lst["season"]).alias("years_since_last_active"),
        (lst["season"] == F.col(current_col)).alias("is_active"),
        current_col)


def cumulate_dim(prev: DataFrame, cur: DataFrame, period_value: int, key: str = "player_name",
                 period: str = "season", stats: Sequence[str] = ("gp", "pts", "ast", "reb"),
                 static: Sequence[str] = ("weight", "country", "college"),
                 class_of: str = "pts", class_fn: ClassFn = scoring_class,
                 current_col: str = "current_season") -> DataFrame:
    """One period of the cumulative dimension: full outer join of the previous
    snapshot with this period's rows. Static columns keep the earliest known
    value, the period's stats are appended, the class is recomputed when active
    and carried otherwise. ``years_since_last_active`` is maintained (0 when
    active, +1 otherwise)."""
    y = prev.alias("y")
    t = cur.alias("t")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full")
    active = F.col(f"t.{period}").isNotNull()
    elem_t = T.StructType([T.StructField("season", T.IntegerType())] +
                          [T.StructField(s, cur.schema[s].dataType) for s in stats])
    new_elem = F.struct(F.col(f"t.{period}").cast("int").alias("season"),
                        *[F.col(f"t.{s}").alias(s) for s in stats])
    return j.select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        *[F.coalesce(F.col(f"y.{c}"), F.col(f"t.{c}")).alias(c) for c in static],
        append_if(F.col("y.seasons").cast(T.ArrayType(elem_t)), active, new_elem, elem_t).alias("seasons"),
        F.when(active, class_fn(F.col(f"t.{class_of}"))).otherwise(F.col("y.scoring_class"))
         .alias("scoring_class"),
        F.when(active, F.lit(0))
         .otherwise(F.coalesce(F.col("y.years_since_last_active"), F.lit(0)) + 1)
         .alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period_value).cast("int").alias(current_col))


def season_slots(src: DataFrame, last_period: int, key: str = "player_name", period: str = "season",
                 stats: Sequence[str] = ("gp", "pts", "ast", "reb"), out: str = "slots") -> DataFrame:
    """Per key an array with one slot per period from the key's first to ``last_period``:
    the period's struct, or null where the key has no row (of several the least
    counts). ``array_compact`` turns it into the history without gaps."""
    per_entity = src.groupBy(key).agg(F.array_sort(F.collect_list(_stats_struct(period, stats))).alias("__hist"))
    at = F.sequence(F.col("__hist")[0]["season"], F.lit(last_period).cast("int"))
    return per_entity.select(key, F.transform(at, lambda p: F.get(F.filter("__hist", lambda s: s["season"] == p), F.lit(0))).alias(out))


def scd2_backfill(snapshots: DataFrame, key: Sequence[str] = ("player_name",),
                  period: str = "current_season", attrs: Sequence[str] = ("scoring_class",),
                  start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Type-2 history from dense snapshots: null-safe change flag -> streak id ->
    min/max period per streak. Window and aggregate share the hash
    partitioning on ``key`` (one shuffle)."""
    key = list(key)
    flagged = change_flags(snapshots.select(*key, period, *attrs), key, period, attrs)
    streaks = streak_ids(flagged, key, period)
    return (streaks.groupBy(*key, *attrs, "streak_id")
            .agg(F.min(period).alias(start_col), F.max(period).alias(end_col))
            .drop("streak_id"))


def scd2_correct(scd: DataFrame, corrections: DataFrame, key: Sequence[str] = ("player_name",),
                 attrs: Sequence[str] = ("scoring_class",), period: str = "current_season",
                 start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Facts for closed periods that arrive late: ``corrections`` has the true ``attrs`` of a
    (key, period), one row each; the result is the history that a backfill on the
    corrected periods gives.

    A row whose interval holds corrected periods is cut around them, the corrected
    periods become intervals of length 1 (also where the key had none, or is new), and
    neighbours that touch and are equal (null-safe) join again. Keys without a
    correction pass through; only the others are shuffled by key for the joining."""
    key = list(key)
    on = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key]
    periods = corrections.groupBy(*key).agg(F.array_sort(F.collect_set(F.col(period).cast("int"))).alias("__cuts"))
    both = scd.alias("s").join(periods.alias("c"), on("s", "c"), "left")
    fields = [*key, *attrs, start_col, end_col]
    own = [F.col(f"s.{c}").alias(c) for c in fields]
    same = both.where(F.col("__cuts").isNull()).select(*own)
    cut = both.where(F.col("__cuts").isNotNull()).select(*own, "__cuts")
    # what is left of an interval: the gaps between the corrected periods inside it
    inside = F.filter("__cuts", lambda p: (p >= F.col(start_col)) & (p <= F.col(end_col)))
    lows = F.concat(F.array(F.col(start_col).cast("int")), F.transform(inside, lambda p: p + 1))
    highs = F.concat(F.transform(inside, lambda p: p - 1), F.array(F.col(end_col).cast("int")))
    gaps = F.filter(F.arrays_zip(lows.alias("lo"), highs.alias("hi")), lambda g: g["lo"] <= g["hi"])
    left = cut.withColumn("__g", F.explode(gaps)).select(*key, *attrs, F.col("__g.lo").alias("__lo"), F.col("__g.hi").alias("__hi"))
    new = corrections.select(*key, *attrs, F.col(period).cast("int").alias("__lo"), F.col(period).cast("int").alias("__hi"))
    parts = left.unionByName(new)
    w = Window.partitionBy(*key).orderBy("__lo")
    joined = F.lag("__hi").over(w) == F.col("__lo") - 1
    for a in attrs:
        joined = joined & F.lag(a).over(w).eqNullSafe(F.col(a))
    begins = parts.withColumn("__begins", (~F.coalesce(joined, F.lit(False))).cast("int"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = (begins.withColumn("__run", F.sum("__begins").over(run)).groupBy(*key, *attrs, "__run")
              .agg(F.min("__lo").alias(start_col), F.max("__hi").alias(end_col)).drop("__run"))
    types = {f.name: f.dataType for f in scd.schema}
    return same.unionByName(merged.select(*[F.col(c).cast(types[c]).alias(c) for c in fields]))


def scd2_incremental(prev_scd: DataFrame, cur: DataFrame, period_value: int,
                     key: Sequence[str] = ("player_name",), attrs: Sequence[str] = ("scoring_class",),
                     period: str = "current_season", start_col: str = "start_date",
                     end_col: str = "end_date") -> DataFrame:
    """Extend a type-2 table by one period.

    closed rows (end < previous period) pass through without a shuffle; open
    rows (end = previous period) are full-outer joined with this period's
    snapshot once and expanded with ``inline`` into 1-2 records:
    unchanged -> extended; changed -> old closed + new opened; new -> opened;
    open but absent this period -> kept as is. Comparison is null-safe."""
    key = list(key)
    prev_period = period_value - 1
    closed = prev_scd.where(F.col(end_col) < prev_period)
    open_ = prev_scd.where(F.col(end_col) == prev_period)
    o = open_.alias("o")
    t = cur.select(*key, *attrs).alias("t")
    cond = None
    for k in key:
        c = F.col(f"o.{k}") == F.col(f"t.{k}")
        cond = c if cond is None else cond & c
    j = o.join(t, cond, "full")
    in_t = F.col(f"t.{key[0]}").isNotNull()
    in_o = F.col(f"o.{key[0]}").isNotNull()
    same = None
    for a in attrs:
        c = F.col(f"o.{a}").eqNullSafe(F.col(f"t.{a}"))
        same = c if same is None else same & c

    def rec(src: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{src}.{a}").alias(a) for a in attrs],
                        start.cast("int").alias(start_col), end.cast("int").alias(end_col))

    pv = F.lit(period_value)
    old_kept = rec("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}"))
    extended = rec("t", F.col(f"o.{start_col}"), pv)
    opened = rec("t", pv, pv)
    records = (F.when(in_o & in_t & same, F.array(extended))
               .when(in_o & in_t, F.array(old_kept, opened))
               .when(in_t, F.array(opened))
               .otherwise(F.array(old_kept)))
    keys_out = [F.coalesce(F.col(f"o.{k}"), F.col(f"t.{k}")).alias(k) for k in key]
    expanded = j.select(*keys_out, F.inline(records))
    cols = [*key, *attrs, start_col, end_col]
    return closed.select(*cols).unionByName(expanded.select(*cols))


def player_state_change(snapshots: DataFrame, key: str = "player_name",
                        current_col: str = "current_season") -> DataFrame:
    """New / Retired / Continued Playing / Returned from Retirement / Stayed Retired.

    Derived per snapshot row from its own history array: the previous period's
    activity is 'last season = current - 1' (active row) or
    'years_since_last_active = 1' (inactive row). No window, no shuffle."""
    prev_elem = F.element_at("seasons", -2)
    active = F.col("is_active")
    state = (F.when(active & (F.size("seasons") == 1), PLAYER_NEW)
             .when(active & (prev_elem["season"] == F.col(current_col) - 1), PLAYER_CONTINUED)
             .when(active, PLAYER_RETURNED)
             .when(F.col("years_since_last_active") == 1, PLAYER_RETIRED)
             .otherwise(PLAYER_STAYED_RETIRED))
    return snapshots.select(key, current_col, "is_active", state.alias("state"))


def latest_films_class(films: DataFrame, key: str, year: str, rating: str,
                       class_fn: ClassFn) -> DataFrame:
    """Quality class from the average rating of each entity's most recent year:
    one aggregate per (entity, year) and a struct max per entity."""
    # averages of non-integral ratings are rounded to 9 decimals so that the class
    # cut-offs do not depend on the summation order
    per_year = films.groupBy(key, year).agg(F.round(F.avg(rating), 9).alias("avg_rating"))
    last = (per_year.groupBy(key)
            .agg(F.max(F.struct(F.col(year), F.col("avg_rating"))).alias("__m")))
    return last.select(key, F.col("__m")[year].alias("last_year"),
                       F.col("__m.avg_rating").alias("last_year_avg_rating"),
                       class_fn(F.col("__m.avg_rating")).alias("quality_class"))


def _actor_year_summary(films: DataFrame, keys: Sequence[str], name: str, film_fields: Sequence[str],
                        with_films: bool) -> DataFrame:
    aggs = [F.max(name).alias(name), F.count(F.lit(1)).alias("n"),
            F.sum("votes").cast("long").alias("v"),
            # rounded so the class cut-offs do not depend on the summation order
            F.round(F.avg("rating"), 9).alias("avg_rating")]
    if with_films:
        aggs.append(F.array_sort(F.collect_list(F.struct(*[F.col(f) for f in film_fields]))).alias("films"))
    return films.groupBy(*keys).agg(*aggs)


def cumulate_actors(prev: DataFrame, films_this_year: DataFrame, year_value: int,
                    key: str = "actorid", name: str = "actor",
                    film_fields: Sequence[str] = ("film", "votes", "rating", "filmid"),
                    class_fn: ClassFn | None = None, with_films: bool = True) -> DataFrame:
    """Actor variant of the cumulative step: several films per entity and year, so
    this year's films are grouped first; quality class from this year's average
    rating when active, carried otherwise.

    ``with_films`` keeps the films array of the actors table (it grows with an
    actor's filmography); without it the snapshot carries ``num_films`` and
    ``total_votes`` and no row holds an unbounded collection."""
    from ..functions.exprs import quality_class
    class_fn = class_fn or quality_class
    cur = _actor_year_summary(films_this_year, [key], name, film_fields, with_films)
    y, t = prev.alias("y"), cur.alias("t")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full")
    active = F.col(f"t.{key}").isNotNull()
    if with_films:
        elem_t = cur.schema["films"].dataType
        body = [F.concat(F.coalesce(F.col("y.films"), F.array().cast(elem_t)),
                         F.coalesce(F.col("t.films"), F.array().cast(elem_t))).alias("films")]
    else:
        zero = F.lit(0).cast("long")
        body = [(F.coalesce(F.col("y.num_films").cast("long"), zero) + F.coalesce(F.col("t.n"), zero))
                .alias("num_films"),
                (F.coalesce(F.col("y.total_votes"), zero) + F.coalesce(F.col("t.v"), zero)).alias("total_votes")]
    return j.select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        F.coalesce(F.col(f"y.{name}"), F.col(f"t.{name}")).alias(name),
        *body,
        F.when(active, class_fn(F.col("t.avg_rating"))).otherwise(F.col("y.quality_class"))
         .alias("quality_class"),
        active.alias("is_active"),
        F.lit(year_value).cast("int").alias("current_year"))


def backfill_actors(films: DataFrame, last_year: int, key: str = "actorid", name: str = "actor",
                    film_fields: Sequence[str] = ("film", "votes", "rating", "filmid"),
                    class_fn: ClassFn | None = None, with_films: bool = True) -> DataFrame:
    """Actors table for every year from an actor's first year to ``last_year`` in
    one pass: per-year summaries are grouped once per actor (bounded by the
    number of years), the years are exploded and the history filtered. Equals
    iterating :func:`cumulate_actors` (with the same ``with_films``)."""
    from ..functions.exprs import quality_class
    class_fn = class_fn or quality_class
    films = films.where(F.col("year") <= last_year)  # later debuts have no year yet
    per_year = _actor_year_summary(films, [key, "year"], name, film_fields, with_films)
    fields = ["year", "avg_rating", "n", "v"] + (["films"] if with_films else [])
    per_actor = (per_year.groupBy(key)
                 .agg(F.max(name).alias(name),
                      F.array_sort(F.collect_list(F.struct(*fields))).alias("__h")))
    grid = per_actor.select(key, name, "__h",
                            F.explode(F.sequence(F.col("__h")[0]["year"], F.lit(last_year)))
                            .alias("current_year"))
    upto = F.filter("__h", lambda h: h["year"] <= F.col("current_year"))
    g = grid.select(key, name, upto.alias("__u"), "current_year")
    lst = F.element_at("__u", -1)
    zero = F.lit(0).cast("long")
    if with_films:
        body = [F.flatten(F.transform("__u", lambda h: h["films"])).alias("films")]
    else:
        body = [F.aggregate("__u", zero, lambda acc, h: acc + h["n"]).alias("num_films"),
                F.aggregate("__u", zero, lambda acc, h: acc + h["v"]).alias("total_votes")]
    return g.select(
        key, name, *body,
        class_fn(lst["avg_rating"]).alias("quality_class"),
        (lst["year"] == F.col("current_year")).alias("is_active"),
        F.col("current_year").cast("int").alias("current_year"))


def actor_films(films: DataFrame, key: str = "actorid", year: str = "year",
                film_fields: Sequence[str] = ("film", "votes", "rating", "filmid")) -> DataFrame:
    """Films history in long form: a row per film, with the actor's class of that year.
    The class is one aggregate per (actor, year); no row holds an actor's films."""
    from ..functions.exprs import quality_class
    per_year = films.groupBy(key, year).agg(
        F.count(F.lit(1)).alias("films_of_year"), quality_class(F.round(F.avg("rating"), 9)).alias("quality_class"))
    return films.select(key, "actor", year, *film_fields).join(per_year, [key, year])
