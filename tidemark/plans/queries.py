"""Registered queries: one per operator of SURVEY §2, each ``fn(spark, sf_dir) -> DataFrame``.

Each builds the ``v_*`` views over the given tables and applies library
operators. Outputs with arrays are flattened to text/size columns so that the
DuckDB oracle (``oracle.py``) can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dims, rollups
from ..sources import layout as L
from ..sources import writers as W
from ..sources.fixtures import Views

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries (the reference hard-codes such literals).
STEP_SEASON = 2000          # period of the one-step dimension queries
AS_OF = "2024-01-30"        # snapshot day of the fact queries (events cover Jan 1-30)
MATCH_DAY = "1996-03-09"    # day of the dimension-side date predicate
THRESHOLD_TOTAL = 100       # referrer window analysis: minimum total events
FUNNEL_MIN_COUNT = 100      # funnel: minimum number of events per url


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _max_season(v: Views):
    # every order has a customer, so the last season needs the orders alone
    return v.t.orders.agg(F.max(F.year("o_orderdate"))).scalar()


def _season_list(col: str = "seasons"):
    return F.array_join(F.transform(col, lambda s: s["season"].cast("string")), ",")


def _flat_players(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "player_name", "current_season", "scoring_class", "years_since_last_active", "is_active",
        F.size("seasons").alias("seasons_played"), _season_list().alias("season_list"),
        F.element_at("seasons", -1)["pts"].alias("last_pts"), *extra)


def players_backfill(v: Views, last=None) -> DataFrame:
    src = v.v_player_seasons
    if last is not None:
        src = src.where(F.col("season") <= last)
    return dims.backfill_dim(src, last if last is not None else _max_season(v))


# ---- 2.9 cumulative dimension and SCD ------------------------------------------------

@query("dim_backfill")
def q_dim_backfill(spark, sf):
    return _flat_players(players_backfill(Views(spark, sf)))


@query("cumulative_dim_step")
def q_cumulative_dim_step(spark, sf):
    v = Views(spark, sf)
    prev = players_backfill(v, STEP_SEASON - 1).where(F.col("current_season") == STEP_SEASON - 1)
    cur = v.v_player_seasons.where(F.col("season") == STEP_SEASON)
    out = dims.cumulate_dim(prev, cur, STEP_SEASON)
    return _flat_players(out, "weight", "country", "college")


@query("scd2_backfill")
def q_scd2_backfill(spark, sf):
    return dims.scd2_backfill(players_backfill(Views(spark, sf)))


@query("scd2_backfill_multi")
def q_scd2_backfill_multi(spark, sf):
    return dims.scd2_backfill(players_backfill(Views(spark, sf)),
                              attrs=("scoring_class", "is_active"))


@query("scd2_incremental")
def q_scd2_incremental(spark, sf):
    v = Views(spark, sf)
    attrs = ("scoring_class", "is_active")
    prev_snap = players_backfill(v, STEP_SEASON - 1)
    prev_scd = dims.scd2_backfill(prev_snap, attrs=attrs)
    cur = players_backfill(v, STEP_SEASON).where(F.col("current_season") == STEP_SEASON)
    return dims.scd2_incremental(prev_scd, cur, STEP_SEASON, attrs=attrs)


@query("scd2_late_corrections")
def q_scd2_late_corrections(spark, sf):
    """History of the spending class, to which corrections of closed seasons come late."""
    snapshots = players_backfill(Views(spark, sf))
    late = snapshots.where((F.length("player_name") + F.substring("player_name", -2, 2).cast("int") + F.col("current_season")) % 5 == 0)
    late = late.select("player_name", "current_season", F.when(F.col("current_season") % 2 == 0, F.lit("star")).otherwise(F.lit("corrected")).alias("scoring_class"))
    return dims.scd2_correct(dims.scd2_backfill(snapshots), late)


@query("player_state_change")
def q_player_state_change(spark, sf):
    return dims.player_state_change(players_backfill(Views(spark, sf)))


# ---- 2.9 fact pipelines ----------------------------------------------------------------

from ..operators import facts  # noqa: E402


def _prev_day(d: str) -> str:
    import datetime as _dt
    return (_dt.date.fromisoformat(d) - _dt.timedelta(days=1)).isoformat()


def _dates_text(col: str = "dates_active"):
    return F.array_join(F.transform(col, lambda d: d.cast("string")), ",")


def _long_text(col: str):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",", "null")


def _events_devices(v: Views) -> DataFrame:
    return v.v_events.join(v.v_devices, "device_id")


@query("daily_user_hits")
def q_daily_user_hits(spark, sf):
    return facts.daily_counts(Views(spark, sf).v_events)


@query("users_cumulated")
def q_users_cumulated(spark, sf):
    v = Views(spark, sf)
    prev = facts.dates_backfill(v.v_events, _prev_day(AS_OF))
    out = facts.cumulate_dates(prev, v.v_events, AS_OF)
    return out.select("user_id", "date", F.size("dates_active").alias("num_dates"),
                      _dates_text().alias("dates_text"))


def users_datelist_int(v: Views, mode: str = "built") -> DataFrame:
    uc = facts.dates_backfill(v.v_events, AS_OF)
    return uc.select("user_id", "date", facts.datelist_int("dates_active", AS_OF, mode=mode)
                     .alias("datelist_int"))


@query("datelist_int")
def q_datelist_int(spark, sf):
    return users_datelist_int(Views(spark, sf))


@query("datelist_activity")
def q_datelist_activity(spark, sf):
    return facts.activity_readout(users_datelist_int(Views(spark, sf)).drop("date"))


def site_hits_arrays(v: Views, fill, metric_name=None, first_found=False) -> DataFrame:
    daily = facts.daily_counts(v.v_events)
    prev = facts.month_array_backfill(daily, _prev_day(AS_OF), fill=fill, with_first_found=first_found)
    if metric_name is not None:
        prev = prev.withColumn("metric_name", F.lit(metric_name))
    today = daily.where(F.col("date") == F.lit(AS_OF).cast("date"))
    # the full outer join already carries every key of yesterday's table, so the
    # step output is the whole month table (the keyed upsert is `merge_upsert`)
    return facts.cumulate_month(prev, today, AS_OF, fill=fill, metric_name=metric_name)


@query("monthly_array_metrics")
def q_monthly_array_metrics(spark, sf):
    out = site_hits_arrays(Views(spark, sf), 0, "site_hits")
    return out.select("user_id", "month_start", "metric_name",
                      F.size("metric_array").alias("array_len"),
                      _long_text("metric_array").alias("metric_text"))


def monthly_user_site_hits(v: Views) -> DataFrame:
    out = site_hits_arrays(v, None, first_found=True)
    return out.select("user_id", F.col("metric_array").alias("hit_array"), "month_start",
                      "first_found_date", F.lit(AS_OF).cast("date").alias("date_partition"))


@query("monthly_user_site_hits")
def q_monthly_user_site_hits(spark, sf):
    out = monthly_user_site_hits(Views(spark, sf))
    return out.select("user_id", "month_start", "first_found_date", "date_partition",
                      F.size("hit_array").alias("array_len"), _long_text("hit_array").alias("hit_text"))


@query("array_position_sum")
def q_array_position_sum(spark, sf):
    hits = monthly_user_site_hits(Views(spark, sf)).where(F.col("date_partition") == F.lit(AS_OF).cast("date"))
    return facts.position_sums(hits, 3, names=["num_hits_first_day", "num_hits_second_day",
                                               "num_hits_third_day"])


@query("array_metric_to_rows")
def q_array_metric_to_rows(spark, sf):
    return facts.array_to_rows(site_hits_arrays(Views(spark, sf), 0, "site_hits"))


@query("array_length_profile")
def q_array_length_profile(spark, sf):
    hits = monthly_user_site_hits(Views(spark, sf))
    return (hits.groupBy(F.size("hit_array").alias("array_length"))
            .agg(F.count(F.lit(1)).alias("num_rows"),
                 F.count(F.when(F.col("first_found_date") == F.col("month_start"), 1)).alias("from_month_start")))


def user_devices_cumulated(v: Views) -> DataFrame:
    return facts.dates_backfill(_events_devices(v), AS_OF, keys=("user_id", "browser_type"))


@query("user_devices_cumulated")
def q_user_devices_cumulated(spark, sf):
    out = user_devices_cumulated(Views(spark, sf))
    return out.select("user_id", "browser_type", "date", F.size("dates_active").alias("num_dates"),
                      _dates_text().alias("dates_text"))


@query("user_devices_map")
def q_user_devices_map(spark, sf):
    """The MAP<browser, dates> form of the per-device date lists, as a view over
    the long (user, browser) rows; entries sorted by browser."""
    out = user_devices_cumulated(Views(spark, sf))
    m = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("browser_type"),
                                                                _dates_text().alias("d")))))
    return out.groupBy("user_id").agg(F.to_json(m).alias("device_activity_datelist"))


@query("device_datelist_int")
def q_device_datelist_int(spark, sf):
    out = user_devices_cumulated(Views(spark, sf))
    return out.select("user_id", "browser_type", "date",
                      facts.datelist_int("dates_active", AS_OF).alias("datelist_int"))


@query("hosts_cumulated")
def q_hosts_cumulated(spark, sf):
    v = Views(spark, sf)
    prev = facts.dates_backfill(v.v_events, _prev_day(AS_OF), keys=("host",))
    out = facts.cumulate_dates(prev, v.v_events, AS_OF, keys=("host",))
    return out.select("host", "date", F.size("dates_active").alias("num_dates"),
                      _dates_text().alias("dates_text"))


@query("host_activity_reduced")
def q_host_activity_reduced(spark, sf):
    out = facts.reduced_month_fact(Views(spark, sf).v_events, AS_OF)
    return out.select("host", "month_start", _long_text("hit_array").alias("hit_text"),
                      _long_text("unique_visitors").alias("visitors_text"))


@query("host_activity_step")
def q_host_activity_step(spark, sf):
    v = Views(spark, sf)
    prev = facts.reduced_month_fact(v.v_events, _prev_day(AS_OF))
    out = facts.reduced_month_step(prev, v.v_events, AS_OF)
    return out.select("host", "month_start", _long_text("hit_array").alias("hit_text"),
                      _long_text("unique_visitors").alias("visitors_text"))


@query("visitors_by_period")
def q_visitors_by_period(spark, sf):
    """Weekly, monthly and trailing 7-day visitors per host from stored daily bitmaps;
    the last day is written on its own, and again, as a daily run would."""
    from ..operators import uniques as U
    e = Views(spark, sf).v_events
    path = scratch_path(spark, "daily_visitors")
    state = U.daily_bitmaps(e)
    W.write_snapshot(state, path, ["date"])
    W.write_snapshot(state.where(F.col("date") == F.lit(AS_OF).cast("date")), path, ["date"])
    days = spark.read.schema(state.schema).parquet(path)
    parts = [U.visitors_exact(days, p).withColumn("period", F.lit(str(p))) for p in ("week", "month", 7)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- 2.9 growth, retention, funnel --------------------------------------------------------

from ..operators import growth  # noqa: E402


def growth_snapshots(v: Views) -> DataFrame:
    return growth.growth_backfill(v.v_events, AS_OF, with_dates=False)


@query("growth_accounting")
def q_growth_accounting(spark, sf):
    return growth_snapshots(Views(spark, sf)).select(
        "user_id", "date", "first_active_date", "last_active_date", "daily_active_state",
        "weekly_active_state", "num_dates")


@query("growth_accounting_step")
def q_growth_accounting_step(spark, sf):
    v = Views(spark, sf)
    prev = growth.growth_backfill(v.v_events, _prev_day(AS_OF))
    prev = prev.where(F.col("date") == F.lit(_prev_day(AS_OF)).cast("date"))
    out = growth.growth_step(prev, v.v_events, AS_OF)
    return out.select("user_id", "date", "first_active_date", "last_active_date", "daily_active_state",
                      "weekly_active_state", F.size("dates_active").alias("num_dates"))


@query("retention_curve")
def q_retention_curve(spark, sf):
    return growth.retention_curve(growth_snapshots(Views(spark, sf)))


@query("funnel_conversion")
def q_funnel_conversion(spark, sf):
    return growth.funnel(Views(spark, sf).v_events, min_count=FUNNEL_MIN_COUNT)


# ---- 2.4/2.5 reports: grouping sets, windows ---------------------------------------------

from ..functions.exprs import map_referrer  # noqa: E402
from ..operators import olap  # noqa: E402


def _events_augmented(v: Views) -> DataFrame:
    e = _events_devices(v)
    return e.select(F.coalesce("os_type", F.lit("unknown")).alias("os_type"),
                    F.coalesce("device_type", F.lit("unknown")).alias("device_type"),
                    F.coalesce("browser_type", F.lit("unknown")).alias("browser_type"),
                    "url", "user_id", "referrer", "event_time")


@query("device_hits_dashboard")
def q_device_hits_dashboard(spark, sf):
    e = _events_augmented(Views(spark, sf))
    sets = [["browser_type", "device_type", "os_type"], ["browser_type"], ["os_type"], ["device_type"]]
    labels = {frozenset(sets[0]): "os_type__device_type__browser", frozenset(["browser_type"]): "browser_type",
              frozenset(["device_type"]): "device_type", frozenset(["os_type"]): "os_type"}
    out = olap.labelled_grouping_sets(e, sets, labels, {"number_of_hits": F.count(F.lit(1))})
    return out.orderBy(F.col("number_of_hits").desc())


@query("referrer_groups")
def q_referrer_groups(spark, sf):
    e = Views(spark, sf).v_events
    return (e.groupBy("referrer", map_referrer("referrer").alias("referrer_group"))
            .agg(F.count(F.lit(1)).alias("num_events")))


@query("referrer_daily_counts")
def q_referrer_daily_counts(spark, sf):
    return olap.referrer_daily_counts(_events_augmented(Views(spark, sf)))


@query("referrer_window_analysis")
def q_referrer_window_analysis(spark, sf):
    daily = olap.referrer_daily_counts(_events_augmented(Views(spark, sf)))
    return olap.referrer_window_analysis(daily, THRESHOLD_TOTAL, prev_lo=-13, prev_hi=-6)


def _games_facts(v: Views) -> DataFrame:
    """De-duplicated game details with their game's season and winner. Dealt by game once:
    winners, facts and what follows by game run where the rows lie. Games too big for one
    task are staged, since the winners and the facts both come from them."""
    cols = ["player_name", "team_id", "team_abbreviation", "pts"]
    small, big = v.details_by_game(cols)
    with_game = lambda gd: gd.hint("merge").join(v.games_of(gd).select("game_id", "season", "winner_team_id"), "game_id")
    f = with_game(small)
    return f if big is None else f.unionByName(with_game(W.materialize(v.spark, big, "game-details")))


GAME_SETS = {"player_team": ["player_name", "team_abbreviation"],
             "player_season": ["player_name", "season"],
             "team": ["team_abbreviation"]}


def game_grouping_sets(v: Views) -> DataFrame:
    f = _games_facts(v)
    labels = {frozenset(s): n for n, s in GAME_SETS.items()}
    return olap.grouping_sets_over_items(
        f, list(GAME_SETS.values()), labels, "game_id", {"total_pts": F.sum("pts")}, "num_games",
        {"games_won": F.col("team_id") == F.col("winner_team_id")})


@query("game_grouping_sets")
def q_game_grouping_sets(spark, sf):
    return game_grouping_sets(Views(spark, sf))


@query("game_grouping_top")
def q_game_grouping_top(spark, sf):
    g = game_grouping_sets(Views(spark, sf))
    keys = ["player_name", "team_abbreviation", "season"]
    return olap.top_per_group_by(g, ["aggregation_level"],
                                 {"pts_": ["total_pts"], "won_": ["games_won"]}, keys)


@query("team_90_game_wins")
def q_team_90_game_wins(spark, sf):
    v = Views(spark, sf)
    # a team's games: distinct (team, game) pairs (duplicates of a player's row do
    # not change them, so the raw details suffice), with the game's date and winner
    teams_in_game = v.v_game_details.select("team_id", "game_id").distinct()
    g = v.v_games.select("game_id", "game_date", "winner_team_id")
    team_games = teams_in_game.join(g, "game_id").select(
        "team_id", "game_id", "game_date",
        (F.col("team_id") == F.col("winner_team_id")).cast("long").alias("won"))
    return olap.max_stretch_sum(team_games, ["team_id"], "game_date", "game_id", "won", 90,
                                out="max_wins_90_games")


@query("longest_streak")
def q_longest_streak(spark, sf):
    from ..operators.windows import longest_run
    v = Views(spark, sf)
    dates = v.t.orders.select(F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date"))
    f = v.v_game_details_dedup.select("player_id", "game_id", "pts").join(dates, "game_id")
    return longest_run(f, ["player_id"], ["game_date", "game_id"], F.col("pts") > 10,
                       out="longest_streak_over_10")


# ---- 2.10 graph ---------------------------------------------------------------------------

from ..operators import graph  # noqa: E402


def _json_props(df: DataFrame, col: str = "properties") -> DataFrame:
    return df.withColumn(col, F.to_json(F.col(col)))


@query("team_vertices")
def q_team_vertices(spark, sf):
    t = Views(spark, sf).v_teams
    props = [("abbreviation", F.col("abbreviation")), ("nickname", F.col("nickname")),
             ("city", F.col("city")), ("arena", F.col("arena")), ("year_founded", F.col("yearfounded"))]
    return _json_props(graph.vertices(t, "team_id", "team", props, order=[F.col("nickname").desc()]))


@query("player_game_edges")
def q_player_game_edges(spark, sf):
    gd = Views(spark, sf).v_game_details_dedup
    return graph.edges(gd, "player_id", "player", "game_id", "game", "plays_in",
                       [("start_position", F.col("start_position")), ("pts", F.col("pts")),
                        ("team_id", F.col("team_id")), ("team_abbreviation", F.col("team_abbreviation"))])


@query("player_player_edges")
def q_player_player_edges(spark, sf):
    small, big = Views(spark, sf).details_by_game(["player_name", "team_abbreviation", "pts"])
    names = ("game_id", "player_id", "player_name", "team_abbreviation", "pts", "shares_team", "plays_against")
    return graph.small_group_edges(small, *names) if big is None else graph.co_occurrence_edges(big, *names, small=small)


@query("player_vertices")
def q_player_vertices(spark, sf):
    gd = Views(spark, sf).v_game_details_dedup
    per = gd.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.array_join(F.array_sort(F.collect_set("team_abbreviation")), ",").alias("teams"))
    props = [(c, F.col(c)) for c in ("player_name", "number_of_games", "total_points", "teams")]
    return _json_props(graph.vertices(per, "player_id", "player", props))


@query("game_vertices")
def q_game_vertices(spark, sf):
    g = Views(spark, sf).v_games
    props = [("game_date", F.col("game_date")), ("season", F.col("season")),
             ("winning_team", F.col("winner_team_id"))]
    return _json_props(graph.vertices(g, "game_id", "game", props))


@query("plays_on_edges")
def q_plays_on_edges(spark, sf):
    gd = Views(spark, sf).v_game_details_dedup
    per = gd.groupBy("player_id", "team_id").agg(F.count(F.lit(1)).alias("num_games"),
                                                 F.sum("pts").alias("total_points"))
    return graph.edges(per, "player_id", "player", "team_id", "team", "plays_on",
                       [("num_games", F.col("num_games")), ("total_points", F.col("total_points"))])


# ---- 2.3 joins ----------------------------------------------------------------------------

from ..operators import joins  # noqa: E402

EVENT_COLS = ["event_id", "user_id", "url", "host", "device_id", "event_time"]
DEVICE_COLS = ["browser_type", "os_type", "device_type"]


@query("event_device_join")
def q_event_device_join(spark, sf):
    v = Views(spark, sf)
    return v.v_events.select(*EVENT_COLS).join(v.v_devices, "device_id").select(*EVENT_COLS, *DEVICE_COLS)


@query("event_device_left")
def q_event_device_left(spark, sf):
    v = Views(spark, sf)
    return (v.v_events.select(*EVENT_COLS).join(v.v_devices, "device_id", "left")
            .select(*EVENT_COLS, *DEVICE_COLS))


@query("new_entities")
def q_new_entities(spark, sf):
    ps = Views(spark, sf).v_player_seasons.select("player_name", "season")
    prev = ps.select("player_name", (F.col("season") + 1).alias("season"))
    return ps.join(prev, ["player_name", "season"], "left_anti")


@query("entity_period_grid")
def q_entity_period_grid(spark, sf):
    v = Views(spark, sf)
    first = v.v_player_seasons.groupBy("player_name").agg(F.min("season").alias("first_season"))
    return first.select("player_name", F.explode(F.sequence("first_season", _max_season(v))).alias("season"))


@query("geo_enrich")
def q_geo_enrich(spark, sf):
    v = Views(spark, sf)
    return geo_enrich(v.v_web_events, v.v_geo_ranges)


def geo_enrich(web_events: DataFrame, ranges: DataFrame, block: int = 1000) -> DataFrame:
    j = joins.range_join(web_events, ranges, "ip", "lo", "hi", block)
    geo = F.when(F.col("lo").isNotNull(),
                 F.to_json(F.struct("country", "state", "city"))).otherwise(F.lit("{}"))
    return j.select("event_id", "ip", "event_time", "referrer", "host", "url", geo.alias("geodata"))


@query("geo_enrich_nested")
def q_geo_enrich_nested(spark, sf):
    """Address blocks inside one another, 1 to 2^40 wide: the narrowest one wins."""
    v = Views(spark, sf)
    j = joins.narrowest_range(v.v_web_events, v.v_geo_nested, "ip", "lo", "hi", ["name"])
    return j.select("event_id", "ip", "event_time", "name", (F.col("hi") - F.col("lo") + 1).alias("width"))


def _medals(v: Views) -> DataFrame:
    return v.v_medals.select("medal_id", F.col("name").alias("medal_name"))


def _maps(v: Views) -> DataFrame:
    """One row per nation: small by definition, so its users state the broadcast."""
    return v.v_maps.select("mapid", F.col("name").alias("map_name"))


@query("broadcast_map_medal")
def q_broadcast_map_medal(spark, sf):
    v = Views(spark, sf)
    mmp = v.v_medals_matches_players
    m = v.v_matches.select("match_id", "mapid")
    return (mmp.join(_medals(v), "medal_id")
            .join(m, "match_id")
            .join(F.broadcast(_maps(v)), "mapid")
            .select("match_id", "player_gamertag", "medal_id", "medal_name", "count", "mapid", "map_name"))


# rows that share match_id and player share the match_id bucket
BY_PART_OF_KEY = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}


def bucketed_match_tables(spark, v: Views, n: int | None = None,
                          only: tuple[str, ...] = ("match_details", "matches", "medals_matches_players")) -> dict[str, DataFrame]:
    """The match tables in ``n`` buckets, by default as many as the session's shuffle partitions."""
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return joins.bucketed_tables(spark, {k: getattr(v, f"v_{k}") for k in only}, n, ["match_id"], tag="bucketed",
                                 session=joins.session_with(spark, **BY_PART_OF_KEY))


def bucket_join(t: dict[str, DataFrame]) -> DataFrame:
    """Three tables bucketed on match_id: medals are summed per match and player (the
    bucket column is among the keys, no exchange), then the sort-merge joins use
    the bucket layout."""
    md, m, mmp = t["match_details"], t["matches"], t["medals_matches_players"]
    medals = mmp.groupBy("match_id", "player_gamertag").agg(F.sum("count").alias("__n"))
    j = (md.join(m.hint("merge"), "match_id")
         .join(medals.hint("merge"), ["match_id", "player_gamertag"], "left"))
    return j.select("match_id", "player_gamertag", "player_total_kills", "playlist_id", "mapid",
                    F.coalesce("__n", F.lit(0)).cast("long").alias("medal_count"))


@query("bucket_join")
def q_bucket_join(spark, sf):
    return bucket_join(bucketed_match_tables(spark, Views(spark, sf)))


def matches_on_day(t: dict[str, DataFrame], day: str) -> DataFrame:
    """Match details of the matches that were completed on ``day`` (J11): the date is a
    range on the dimension side's own column, so it reaches the scan; the join uses
    the buckets."""
    start = F.lit(day).cast(t["matches"].schema["completion_date"].dataType)
    at = F.col("completion_date")
    m = t["matches"].where((at >= start) & (at < start + F.expr("INTERVAL 1 DAY")))
    return t["match_details"].join(m.hint("merge"), "match_id").select(
        "match_id", "player_gamertag", "player_total_kills", "player_total_deaths", "playlist_id", "mapid",
        F.to_date("completion_date").alias("completion_date"))


@query("bucket_join_by_date")
def q_bucket_join_by_date(spark, sf):
    return matches_on_day(bucketed_match_tables(spark, Views(spark, sf), only=("match_details", "matches")), MATCH_DAY)


def tables_by_month(spark, v: Views) -> dict[str, DataFrame]:
    """Match details in one folder per month of their match, and the matches."""
    base = scratch_path(spark, "by-month")
    m = v.v_matches.withColumn("match_month", F.date_format("completion_date", "yyyy-MM"))
    m.write.parquet(f"{base}/matches")
    m = spark.read.schema(m.schema).parquet(f"{base}/matches")
    details = v.v_match_details.join(m.select("match_id", "match_month"), "match_id")
    return {"matches": m, "match_details": joins.write_by_period(details, "match_month", f"{base}/details")}


def pruned_by_matches(t: dict[str, DataFrame], day: str) -> DataFrame:
    """Match details of the team games of a day (J11): the filter is on the matches
    alone; the months that they have prune the details' folders at run time."""
    m = t["matches"].where((F.to_date("completion_date") == day) & F.col("is_team_game"))
    return t["match_details"].join(m.select("match_id", "match_month", "playlist_id", "mapid"), ["match_id", "match_month"])


@query("partition_pruned_join")
def q_partition_pruned_join(spark, sf):
    return pruned_by_matches(tables_by_month(spark, Views(spark, sf)), MATCH_DAY)


# ---- 2.4 match questions (A16) ------------------------------------------------------------

def _match_facts(v: Views) -> DataFrame:
    return v.v_match_details.join(v.v_matches, "match_id")


@query("match_top_player")
def q_match_top_player(spark, sf):
    f = _match_facts(Views(spark, sf))
    per = f.groupBy("player_gamertag").agg(
        (F.sum("player_total_kills") / F.count_distinct("match_id")).alias("avg_kills_per_game"))
    return per.orderBy(F.col("avg_kills_per_game").desc(), F.col("player_gamertag").desc()).limit(1)


@query("match_top_playlist")
def q_match_top_playlist(spark, sf):
    m = Views(spark, sf).v_matches
    per = m.groupBy("playlist_id").agg(F.count_distinct("match_id").alias("num_matches"))
    return per.orderBy(F.col("num_matches").desc(), F.col("playlist_id").desc()).limit(1)


@query("match_top_map")
def q_match_top_map(spark, sf):
    v = Views(spark, sf)
    per = v.v_matches.groupBy("mapid").agg(F.count_distinct("match_id").alias("num_matches"))
    per = per.join(F.broadcast(_maps(v)), "mapid")
    return per.orderBy(F.col("num_matches").desc(), F.col("mapid").desc()).limit(1)


@query("match_top_medal_map")
def q_match_top_medal_map(spark, sf):
    v = Views(spark, sf)
    mm = v.v_medals_matches_players.join(v.v_matches.select("match_id", "mapid"), "match_id")
    per = mm.groupBy("medal_id", "mapid").agg(F.sum("count").alias("num_medals"))
    top = olap.top_per_group(per, ["medal_id"], ["num_medals"], ["mapid"], prefix="")
    return (top.join(_medals(v), "medal_id")
            .join(F.broadcast(_maps(v)), "mapid")
            .select("medal_id", "medal_name", "mapid", "map_name", "num_medals"))


# ---- misc aggregations, windows, arrays, quality ------------------------------------------

@query("entity_static")
def q_entity_static(spark, sf):
    ps = Views(spark, sf).v_player_seasons
    return ps.groupBy("player_name").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"),
        F.count(F.lit(1)).alias("num_seasons"), F.max("weight").alias("weight"),
        F.max("country").alias("country"), F.max("college").alias("college"))


def events_aggregated(v: Views) -> DataFrame:
    return rollups.events_by_user_device(v.v_events)


@query("user_device_rollup")
def q_user_device_rollup(spark, sf):
    """Devices per user in long form, with the user's totals."""
    out = rollups.with_user_totals(events_aggregated(Views(spark, sf)))
    return out.select("user_id", "device_id", "event_counts", F.array_join("host_array", ",").alias("hosts"), "total_hits", "num_devices")


@query("device_user_rollup")
def q_device_user_rollup(spark, sf):
    """Users per device in long form (device, user, the device's user count): a
    popular device may have any number of users, so its list is never gathered
    into one row."""
    v = Views(spark, sf)
    agg = events_aggregated(v)
    j = v.v_devices.join(agg, "device_id")
    per_dev = j.groupBy("device_id").agg(F.count(F.lit(1)).alias("num_users"))
    return (j.select("device_id", "device_type", "user_id", "event_counts")
            .join(per_dev, "device_id"))


@query("dedup_events")
def q_dedup_events(spark, sf):
    return Views(spark, sf).v_events.select("url", "host", "user_id", "event_time").distinct()


@query("dedup_game_details")
def q_dedup_game_details(spark, sf):
    return Views(spark, sf).v_game_details_dedup.select(
        "game_id", "player_id", "player_name", "team_id", "team_abbreviation", "start_position", "pts",
        "l_linenumber")


@query("duplicate_keys")
def q_duplicate_keys(spark, sf):
    from ..operators.quality import duplicate_keys
    return duplicate_keys(Views(spark, sf).v_game_details, ["player_id", "game_id"])


@query("scoring_class")
def q_scoring_class(spark, sf):
    from ..functions.exprs import scoring_class
    ps = Views(spark, sf).v_player_seasons
    return ps.select("player_name", "season", "pts", scoring_class("pts").alias("scoring_class"))


@query("quality_class")
def q_quality_class(spark, sf):
    from ..functions.exprs import quality_class
    f = Views(spark, sf).v_actor_films
    return dims.latest_films_class(f, "actorid", "year", "rating", quality_class)


@query("history_compacted")
def q_history_compacted(spark, sf):
    """Per player one array over all seasons, null where the player did not play, and
    the same with the nulls removed."""
    v = Views(spark, sf)
    last = v.t.orders.agg(F.max(F.year("o_orderdate"))).first()[0]  # a lambda takes no sub-query
    h = dims.season_slots(v.v_player_seasons, last)
    return h.select("player_name", F.size("slots").cast("int").alias("num_slots"),
                    F.size(F.array_compact("slots")).cast("int").alias("num_seasons"),
                    F.array_join(F.transform(F.array_compact("slots"), lambda s: s["season"].cast("string")), ",").alias("season_list"),
                    F.element_at(F.array_compact("slots"), 1)["pts"].alias("first_pts"))


@query("first_last_ratio")
def q_first_last_ratio(spark, sf):
    from ..functions.exprs import first_elem, guarded_ratio, last_elem
    p = players_backfill(Views(spark, sf)).where(F.col("current_season") == STEP_SEASON)
    return p.select("player_name", guarded_ratio(last_elem("seasons")["pts"], first_elem("seasons")["pts"])
                    .alias("ratio_most_recent_to_first"))


@query("unnest_history")
def q_unnest_history(spark, sf):
    v = Views(spark, sf)
    p = players_backfill(v).where(F.col("current_season") == _max_season(v))
    return p.select("player_name", F.inline("seasons"))


ACTOR_YEAR = STEP_SEASON    # period of the one-step actor query


def actors_backfill(v: Views, last: int | None = None) -> DataFrame:
    f = v.v_actor_films
    if last is not None:
        f = f.where(F.col("year") <= last)
    if last is None:  # the last year of the data
        last = f.agg(F.max("year")).scalar()
    return dims.backfill_actors(f, last, with_films=False)


def _flat_actors(df: DataFrame) -> DataFrame:
    return df.select("actorid", "actor", "current_year", "quality_class", "is_active",
                     F.col("num_films").cast("int").alias("num_films"), "total_votes")


@query("actor_cumulative")
def q_actor_cumulative(spark, sf):
    v = Views(spark, sf)
    prev = actors_backfill(v, ACTOR_YEAR - 1).where(F.col("current_year") == ACTOR_YEAR - 1)
    films = v.v_actor_films.where(F.col("year") == ACTOR_YEAR)
    return _flat_actors(dims.cumulate_actors(prev, films, ACTOR_YEAR, with_films=False))


@query("actor_scd")
def q_actor_scd(spark, sf):
    a = actors_backfill(Views(spark, sf))
    return dims.scd2_backfill(a, key=("actorid",), period="current_year",
                              attrs=("quality_class", "is_active"))


@query("actor_scd_incremental")
def q_actor_scd_incremental(spark, sf):
    v = Views(spark, sf)
    by = {"key": ("actorid",), "period": "current_year", "attrs": ("quality_class", "is_active")}
    snaps = actors_backfill(v, ACTOR_YEAR)
    prev = dims.scd2_backfill(snaps.where(F.col("current_year") < ACTOR_YEAR), **by)
    cur = snaps.where(F.col("current_year") == ACTOR_YEAR)
    return dims.scd2_incremental(prev, cur, ACTOR_YEAR, **by)


@query("actor_films")
def q_actor_films(spark, sf):
    return dims.actor_films(Views(spark, sf).v_actor_films)


# ---- 2.11 streams -------------------------------------------------------------------------

from ..session import scratch_path  # noqa: E402
from ..streaming import streams as S  # noqa: E402
from ..streaming.keyed_table import KeyedTable, fan_out  # noqa: E402

# Arrival order of the staged web-event files (event-time text boundaries).
STREAM_SLICES = ["2024-01-11T00:00:00.000Z", "2024-01-21T00:00:00.000Z"]
SENTINEL_HOST = "__end_of_stream__"


def run_event_stream(spark: SparkSession, v: Views, build, output_mode: str,
                     late_copy: bool = False, sentinel: bool = False, make_sink=None) -> DataFrame | None:
    """Stage ``v_web_events`` as files arriving in event-time order (one append
    per slice), and after each arrival run ``build(stream)`` to completion with
    the same checkpoint. ``late_copy`` re-sends the first slice inside the last
    one (late data); ``sentinel`` appends one far-future event so the watermark
    closes every open window/session. ``make_sink(base, stream's result)`` gives
    another sink than the change log, which is returned otherwise."""
    base = scratch_path(spark, "stream")
    src, ck, out = f"{base}/in", f"{base}/checkpoint", f"{base}/out"
    sink = None
    we = v.v_web_events
    t = F.col("event_time")
    bounds = [None, *STREAM_SLICES, None]
    parts = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (t >= lo)
        if hi is not None:
            cond = cond & (t < hi)
        parts.append(we.where(cond))
    if late_copy:
        parts[-1] = parts[-1].unionByName(parts[0])
    if sentinel:
        end = spark.range(1).select(F.lit(None).cast("long").alias("event_id"),
                                    F.lit(None).cast("long").alias("ip"),
                                    F.lit("2999-01-01T00:00:00.000Z").alias("event_time"),
                                    F.lit(None).cast("string").alias("referrer"),
                                    F.lit(SENTINEL_HOST).alias("host"),
                                    F.lit(None).cast("string").alias("url"))
        parts.append(end)
    for p in parts:
        p.write.mode("append").parquet(src)
        stream = S.parse_event_time(S.read_stream(spark, "parquet", S.WEB_EVENT_SCHEMA, src))
        built = build(stream)
        if sink is None:
            sink = make_sink(base, built) if make_sink else S.foreach_batch_changelog(out)
        S.run_available_now(built, ck, output_mode, sink)
    return None if make_sink else spark.read.parquet(out)


def _tumbling(spark, sf, keys, late=False):
    """Window counts in a keyed table: every update-mode batch replaces its keys' rows."""
    v = Views(spark, sf)
    tables = []

    def make_sink(base, result):
        tables.append(KeyedTable(spark, f"{base}/table", result.schema, ["window_start", *keys]))
        return tables[0].sink()

    run_event_stream(spark, v, lambda s: S.tumbling_counts(s, keys), "update", late_copy=late, make_sink=make_sink)
    return tables[0].read()


@query("stream_tumbling_host")
def q_stream_tumbling_host(spark, sf):
    return _tumbling(spark, sf, ["host"])


@query("stream_tumbling_host_referrer")
def q_stream_tumbling_host_referrer(spark, sf):
    return _tumbling(spark, sf, ["host", "referrer"])


@query("stream_late_drop")
def q_stream_late_drop(spark, sf):
    return _tumbling(spark, sf, ["host"], late=True)


def stream_sessions(spark, v: Views) -> DataFrame:
    log = run_event_stream(spark, v, lambda s: S.sessionize(s, ["ip", "host"]), "append", sentinel=True)
    return log.where(F.col("host").isNull() | (F.col("host") != SENTINEL_HOST)).drop("batch_id")


@query("sessionize")
def q_sessionize(spark, sf):
    return stream_sessions(spark, Views(spark, sf))


@query("session_avg_by_host")
def q_session_avg_by_host(spark, sf):
    s = stream_sessions(spark, Views(spark, sf))
    return s.groupBy("host").agg(F.avg("num_events").alias("avg_events_per_session"),
                                 F.count(F.lit(1)).alias("num_sessions"))


@query("stream_two_sinks")
def q_stream_two_sinks(spark, sf):
    """Two keyed tables from one query that reads its source once: counts per host
    and referrer, and, of the windows a batch touches, counts per host from them.
    The first is rolled up and set beside the second, so the two must agree."""
    v = Views(spark, sf)
    tables = []

    def make_sink(base, result):
        by_referrer = KeyedTable(spark, f"{base}/by_referrer", result.schema, ["window_start", "host", "referrer"])
        host_cols = T.StructType([f for f in result.schema if f.name != "referrer"])
        by_host = KeyedTable(spark, f"{base}/by_host", host_cols, ["window_start", "host"])
        tables.extend([by_referrer, by_host])
        return fan_out([(lambda batch: batch, by_referrer), (lambda batch: S.rolled_up(batch, by_referrer.read(), "window_start", ["host"], "num_hits"), by_host)])

    run_event_stream(spark, v, lambda s: S.tumbling_counts(s, ["host", "referrer"]), "update", make_sink=make_sink)
    fine, host = tables[0].read(), tables[1].read()
    b = fine.groupBy("window_start", "host").agg(F.sum("num_hits").alias("num_hits_by_referrer_sink"))
    return host.join(b, ["window_start", "host"], "full")


@query("stream_geo_enrich")
def q_stream_geo_enrich(spark, sf):
    v = Views(spark, sf)
    ranges = v.v_geo_ranges

    def build(s):
        j = joins.narrowest_range(s, ranges, "ip", "lo", "hi", ["country", "state", "city"])
        geo = F.when(F.col("lo").isNotNull(),
                     F.to_json(F.struct("country", "state", "city"))).otherwise(F.lit("{}"))
        return j.select("event_id", "ip", S.utc_ts_to_ntz("event_timestamp").alias("event_timestamp"),
                        "referrer", "host", "url", geo.alias("geodata"))

    return run_event_stream(spark, v, build, "append").drop("batch_id")


# ---- 2.12 experiments, KPIs ---------------------------------------------------------------

from ..functions.constants import EXPERIMENT  # noqa: E402
from ..operators import experiments as X  # noqa: E402
from ..operators import kpi  # noqa: E402

WEIGHTS = (("control", 50), ("treatment", 50))


@query("experiment_assignment")
def q_experiment_assignment(spark, sf):
    users = Views(spark, sf).v_events.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return X.assign(users, EXPERIMENT, WEIGHTS)


@query("experiment_exposure")
def q_experiment_exposure(spark, sf):
    return X.exposures_and_outcomes(Views(spark, sf).v_events, EXPERIMENT, WEIGHTS)


@query("experiment_readout")
def q_experiment_readout(spark, sf):
    return X.readout(X.exposures_and_outcomes(Views(spark, sf).v_events, EXPERIMENT, WEIGHTS))


@query("experiment_srm")
def q_experiment_srm(spark, sf):
    return X.sample_ratio_check(X.exposures_and_outcomes(Views(spark, sf).v_events, EXPERIMENT, WEIGHTS),
                                WEIGHTS)


@query("experiment_welch")
def q_experiment_welch(spark, sf):
    v = Views(spark, sf)
    return X.welch_readout(v.v_events, X.exposures_and_outcomes(v.v_events, EXPERIMENT, WEIGHTS))


@query("experiment_adjusted")
def q_experiment_adjusted(spark, sf):
    v = Views(spark, sf)
    return X.adjusted_readout(X.unit_metrics(v.v_events, X.exposures_and_outcomes(v.v_events, EXPERIMENT, WEIGHTS)))


@query("experiment_bootstrap")
def q_experiment_bootstrap(spark, sf):
    v = Views(spark, sf)
    units = X.unit_metrics(v.v_events, X.exposures_and_outcomes(v.v_events, EXPERIMENT, WEIGHTS))
    return X.bootstrap_intervals(units, replicates=50)


@query("kpi_profit")
def q_kpi_profit(spark, sf):
    return kpi.monthly_rollup(kpi.unit_day_fact(Views(spark, sf).v_profit))


@query("kpi_growth")
def q_kpi_growth(spark, sf):
    return kpi.daily_growth(Views(spark, sf).v_events)


@query("kpi_engagement")
def q_kpi_engagement(spark, sf):
    return kpi.daily_engagement(Views(spark, sf).v_events)


# ---- 2.1 sources and sinks ----------------------------------------------------------------

from ..sources.tables import enforce_schema, read_csv  # noqa: E402

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("device_id", T.IntegerType(), False),
    T.StructField("event_time", T.TimestampNTZType()),
])


@query("enforce_schema")
def q_enforce_schema(spark, sf):
    raw = Views(spark, sf).v_events
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in EVENT_SCHEMA.fieldNames()])
    return enforce_schema(as_text, EVENT_SCHEMA)


@query("csv_scan")
def q_csv_scan(spark, sf):
    """The device catalogue written as CSV and read back with its schema (null fields
    stay null, text with commas and quotes is text)."""
    d = Views(spark, sf).v_devices.withColumn("note", F.concat(F.col("device_type"), F.lit(', "as is"')))
    path = scratch_path(spark, "devices-csv")
    d.write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, d.schema, escape='"')


@query("insert_by_name")
def q_insert_by_name(spark, sf):
    """Two inserts whose columns come in another order than the table's."""
    daily = facts.daily_counts(Views(spark, sf).v_events)
    path = scratch_path(spark, "daily-table")
    name = f"daily_{path.rsplit('-', 1)[-1]}"
    first = F.col("date") < F.lit(LAYOUT_DAYS[0]).cast("date")
    daily.where(first).write.option("path", path).saveAsTable(name)
    W.insert_by_name(spark, daily.where(~first).select("num_site_hits", "date", "user_id"), name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.schema(daily.schema).parquet(path)


@query("stream_to_topic_values")
def q_stream_to_topic_values(spark, sf):
    """The JSON values that the topic sink sends, here to files, parsed back."""
    v = Views(spark, sf)
    base = scratch_path(spark, "topic")
    v.v_web_events.write.parquet(f"{base}/in")
    values = S.topic_values(S.read_stream(spark, "parquet", S.WEB_EVENT_SCHEMA, f"{base}/in"))
    S.run_available_now(values, f"{base}/ck", "append", S.foreach_batch_changelog(f"{base}/out"))
    sent = spark.read.parquet(f"{base}/out").select(F.from_json("value", S.WEB_EVENT_SCHEMA).alias("e"))
    return sent.select("e.*")


@query("merge_upsert")
def q_merge_upsert(spark, sf):
    v = Views(spark, sf)
    daily = facts.daily_counts(v.v_events)
    prev = (facts.month_array_backfill(daily, _prev_day(AS_OF))
            .withColumn("metric_name", F.lit("site_hits")))
    path = scratch_path(spark, "array_metrics")
    W.write_snapshot(prev, path, ["month_start"])
    table = spark.read.parquet(path)
    today = daily.where(F.col("date") == F.lit(AS_OF).cast("date"))
    updates = facts.cumulate_month(table, today, AS_OF, metric_name="site_hits").checkpoint(eager=True)
    keys = ["user_id", "month_start", "metric_name"]
    month = {"month_start": [dt.date.fromisoformat(AS_OF).replace(day=1)]}
    W.merge_upsert(spark, path, updates, keys, ["month_start"], month)
    # the day runs again, on the table that holds it already: same result
    again = facts.cumulate_month(spark.read.parquet(path), today, AS_OF, metric_name="site_hits").checkpoint(eager=True)
    W.merge_upsert(spark, path, again, keys, ["month_start"], month)
    out = spark.read.parquet(path)
    return out.select("user_id", "month_start", "metric_name", F.size("metric_array").alias("array_len"),
                      _long_text("metric_array").alias("metric_text"))


@query("snapshot_partition_read")
def q_snapshot_partition_read(spark, sf):
    """Daily snapshots written with dynamic partition overwrite (twice: the
    re-run replaces, not appends), then one partition read back (pruned)."""
    v = Views(spark, sf)
    daily = facts.daily_counts(v.v_events)
    path = scratch_path(spark, "daily_hits")
    W.write_snapshot(daily, path, ["date"])
    W.write_snapshot(daily.where(F.col("date") == F.lit(AS_OF).cast("date")), path, ["date"])
    t = spark.read.parquet(path)
    return t.where(F.col("date") == F.lit(AS_OF).cast("date")).select("user_id", "date", "num_site_hits")


LAYOUT_DAYS = ("2024-01-10", "2024-01-12")
LAYOUT_USERS = (100, 140)


@query("layout_report")
def q_layout_report(spark, sf):
    """Bytes, files, rows and files touched by a predicate on day and user, of the events
    as they arrive, sorted within partitions, and clustered along a curve. The
    numbers are those of the files written here, so no SQL over the given tables
    can state them; the tests hold them against the files' own metadata."""
    e = Views(spark, sf).v_events.withColumn("event_date", F.to_date("event_time"))
    start = e.repartition(8, "event_date")
    base = scratch_path(spark, "layout")
    start.write.mode("overwrite").parquet(f"{base}/unsorted")
    start.sortWithinPartitions("event_date", "host").write.mode("overwrite").parquet(f"{base}/sorted")
    L.write_clustered(e, f"{base}/clustered", ["event_date", "user_id"], 8)
    return L.layout_report(spark, {k: f"{base}/{k}" for k in ("unsorted", "sorted", "clustered")},
                           {"event_date": LAYOUT_DAYS, "user_id": LAYOUT_USERS})


@query("hidden_partition_read")
def q_hidden_partition_read(spark, sf):
    """Events partitioned by a day and a user bucket that readers do not name."""
    path = scratch_path(spark, "hidden")
    L.write_hidden(Views(spark, sf).v_events, path, [L.Field("event_time", "day"), L.Field("user_id", "bucket", 4)])
    t = L.read_hidden(spark, path, [("event_time", ">=", LAYOUT_DAYS[0]), ("event_time", "<", LAYOUT_DAYS[1]), ("user_id", "in", list(HIDDEN_USERS))])
    return t.select("event_id", "user_id", "url", "host", "event_time")


HIDDEN_USERS = tuple(range(1, 40))


# ---- 2.12 UDF surface ---------------------------------------------------------------------

@query("udf_surface")
def q_udf_surface(spark, sf):
    """A vectorized (pandas) UDF registered by name and called from SQL: it
    renders the geodata JSON the enrichment attaches (no per-row service call)."""
    from ..functions.udfs import register_udfs
    v = Views(spark, sf)
    register_udfs(spark)
    j = joins.range_join(v.v_web_events, v.v_geo_ranges, "ip", "lo", "hi", 1000)
    j.createOrReplaceTempView("web_events_ranged")
    return spark.sql("SELECT event_id, ip, geo_json(country, state, city) AS geodata FROM web_events_ranged")
