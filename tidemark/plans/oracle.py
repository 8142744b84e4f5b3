"""DuckDB oracle SQL for every registered query that SQL can express.

Each statement is written from the operator's rule, by another way than the Spark
query takes: histories by a join to all earlier periods, runs by the difference
of period and rank, steps as a day of the whole history, frames by list slices.
"""

from __future__ import annotations

from .oracle_views import with_views
from .queries import AS_OF, FUNNEL_MIN_COUNT, HIDDEN_USERS, LAYOUT_DAYS, MATCH_DAY, STEP_SEASON, THRESHOLD_TOTAL  # noqa: F401

ORACLE: dict[str, str] = {}


def _class_sql(x: str) -> str:
    return (f"CASE WHEN {x} > 20 THEN 'star' WHEN {x} > 15 THEN 'good' "
            f"WHEN {x} > 10 THEN 'average' ELSE 'bad' END")


def players_ctes(last: str = "(SELECT MAX(season) FROM v_player_seasons)", src_filter: str = "TRUE",
                 name: str = "players") -> list[tuple[str, str]]:
    """Players of every season from their first on: each (player, season) row meets
    all seasons that the player had up to then."""
    return [
        (f"{name}_had", f"SELECT * FROM v_player_seasons WHERE {src_filter}"),
        (f"{name}_rows", f"""SELECT player_name, UNNEST(range(MIN(season), {last} + 1)) AS yr FROM {name}_had GROUP BY player_name"""),
        (f"{name}_past", f"""SELECT r.player_name, CAST(r.yr AS INTEGER) AS yr, MAX(h.season) AS newest,
              arg_max(h.pts, h.season) AS newest_pts, MAX(h.weight) AS weight, MAX(h.country) AS country, MAX(h.college) AS college,
              list({{'season': h.season, 'gp': h.gp, 'pts': h.pts, 'ast': h.ast, 'reb': h.reb}} ORDER BY h.season) AS seasons
            FROM {name}_rows r JOIN {name}_had h ON h.player_name = r.player_name AND h.season <= r.yr GROUP BY 1, 2"""),
        (name, f"""SELECT player_name, weight, country, college, seasons, {_class_sql('newest_pts')} AS scoring_class,
            yr - newest AS years_since_last_active, yr = newest AS is_active, yr AS current_season FROM {name}_past"""),
    ]


FLAT_PLAYERS = """player_name, current_season, scoring_class, years_since_last_active, is_active,
    CAST(len(seasons) AS INTEGER) AS seasons_played,
    array_to_string(list_transform(seasons, lambda x: CAST(x.season AS VARCHAR)), ',') AS season_list,
    seasons[-1].pts AS last_pts"""

ORACLE["dim_backfill"] = with_views(["v_player_seasons"], f"SELECT {FLAT_PLAYERS} FROM players",
                                    players_ctes())

# A step's result is the last season of the history that ends with it.
ORACLE["cumulative_dim_step"] = with_views(["v_player_seasons"], f"""
SELECT {FLAT_PLAYERS}, weight, country, college FROM players WHERE current_season = {STEP_SEASON}""",
    players_ctes(last=str(STEP_SEASON), src_filter=f"season <= {STEP_SEASON}"))


def _scd_sql(attrs: list[str], src: str = "players", key: str = "player_name", period: str = "current_season") -> str:
    """Runs of equal attributes. A key has a row in every period, so within a run the
    period rises in step with its rank among the rows of the same attributes."""
    same = ", ".join([key, *attrs])
    return f"""
SELECT {same}, MIN({period}) AS start_date, MAX({period}) AS end_date
FROM (SELECT {same}, {period}, {period} - ROW_NUMBER() OVER (PARTITION BY {same} ORDER BY {period}) AS run FROM {src})
GROUP BY {same}, run"""


ORACLE["scd2_backfill"] = with_views(["v_player_seasons"], _scd_sql(["scoring_class"]), players_ctes())
ORACLE["scd2_backfill_multi"] = with_views(["v_player_seasons"], _scd_sql(["scoring_class", "is_active"]),
                                           players_ctes())

# One season more gives the history that a backfill up to that season gives.
ORACLE["scd2_incremental"] = with_views(
    ["v_player_seasons"], _scd_sql(["scoring_class", "is_active"]),
    players_ctes(last=str(STEP_SEASON), src_filter=f"season <= {STEP_SEASON}"))

ORACLE["player_state_change"] = with_views(["v_player_seasons"], f"""
SELECT player_name, current_season, is_active,
  CASE WHEN prev_active IS NULL THEN 'New'
       WHEN prev_active AND is_active THEN 'Continued Playing'
       WHEN prev_active AND NOT is_active THEN 'Retired'
       WHEN NOT prev_active AND is_active THEN 'Returned from Retirement'
       ELSE 'Stayed Retired' END AS state
FROM (SELECT *, LAG(is_active) OVER (PARTITION BY player_name ORDER BY current_season) AS prev_active
      FROM players)
""", players_ctes())


# ---- fact pipelines -------------------------------------------------------------------

def _d(x: str) -> str:
    return f"DATE '{x}'"


def _prev(d: str) -> str:
    import datetime as _dt
    return (_dt.date.fromisoformat(d) - _dt.timedelta(days=1)).isoformat()


DATES_TEXT = "array_to_string(list_transform(dates_active, lambda d: CAST(d AS VARCHAR)), ',')"


def _long_text(col: str) -> str:
    return f"array_to_string(list_transform({col}, lambda x: COALESCE(CAST(x AS VARCHAR), 'null')), ',')"


def dates_backfill_sql(as_of: str, keys: str = "user_id", src: str = "v_events") -> str:
    nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT {keys}, list_sort(list(DISTINCT CAST(event_time AS DATE))) AS dates_active,
        {_d(as_of)} AS date FROM {src}
        WHERE {nn} AND CAST(event_time AS DATE) <= {_d(as_of)} GROUP BY {keys}"""


def dates_step_sql(key: str) -> str:
    return f"""SELECT COALESCE(t.{key}, y.{key}) AS {key},
       COALESCE(y.dates_active, CAST([] AS DATE[])) ||
         CASE WHEN t.{key} IS NOT NULL THEN [t.today_date] ELSE CAST([] AS DATE[]) END AS dates_active,
       CAST(COALESCE(t.today_date, y.date + INTERVAL 1 DAY) AS DATE) AS date
FROM yesterday y FULL OUTER JOIN today t ON t.{key} = y.{key}"""


def today_sql(key: str) -> str:
    return f"""SELECT {key}, CAST(event_time AS DATE) AS today_date, COUNT(1) AS n FROM v_events
        WHERE CAST(event_time AS DATE) = {_d(AS_OF)} AND {key} IS NOT NULL
        GROUP BY {key}, CAST(event_time AS DATE)"""


ORACLE["daily_user_hits"] = with_views(["v_events"], """
SELECT user_id, CAST(event_time AS DATE) AS date, COUNT(1) AS num_site_hits
FROM v_events WHERE user_id IS NOT NULL GROUP BY user_id, CAST(event_time AS DATE)""")

ORACLE["users_cumulated"] = with_views(["v_events"], f"""
SELECT user_id, date, CAST(len(dates_active) AS INTEGER) AS num_dates, {DATES_TEXT} AS dates_text
FROM ({dates_step_sql('user_id')})""",
    [("yesterday", dates_backfill_sql(_prev(AS_OF))), ("today", today_sql("user_id"))])


def datelist_int_ctes(src: str = "uc", keys: str = "user_id") -> list[tuple[str, str]]:
    """One bit per active day of the last 32, the as-of day the highest."""
    age = f"date_diff('day', d, {_d(AS_OF)})"
    return [("bits", f"""SELECT {keys}, {_d(AS_OF)} AS date, CAST(COALESCE(list_sum(list_transform(
              list_filter(dates_active, lambda d: {age} BETWEEN 0 AND 31),
              lambda d: CAST(1 AS BIGINT) << CAST(31 - {age} AS INTEGER))), 0) AS BIGINT) AS datelist_int FROM {src}""")]


ORACLE["datelist_int"] = with_views(["v_events"], "SELECT user_id, date, datelist_int FROM bits",
                                    [("uc", dates_backfill_sql(AS_OF))] + datelist_int_ctes())

ORACLE["datelist_activity"] = with_views(["v_events"], """
SELECT user_id, datelist_int,
  bit_count(datelist_int) > 0 AS monthly_active,
  CAST(bit_count(datelist_int) AS INTEGER) AS l32,
  bit_count(datelist_int & CAST(4261412864 AS BIGINT)) > 0 AS weekly_active,
  CAST(bit_count(datelist_int & CAST(4261412864 AS BIGINT)) AS INTEGER) AS l7,
  bit_count(datelist_int & CAST(33292288 AS BIGINT)) > 0 AS weekly_active_previous_week
FROM bits""", [("uc", dates_backfill_sql(AS_OF))] + datelist_int_ctes())


def month_backfill_sql(as_of: str, fill: str) -> str:
    """Per user with activity in the month up to as_of: the day grid of the month
    left-joined with the daily counts, listed in day order."""
    return f"""
SELECT u.user_id, DATE_TRUNC('month', {_d(as_of)})::DATE AS month_start,
       list(COALESCE(c.n, {fill}) ORDER BY g.d) AS metric_array,
       MIN(c.d) AS first_found_date
FROM (SELECT DISTINCT user_id FROM v_events WHERE user_id IS NOT NULL
        AND CAST(event_time AS DATE) BETWEEN DATE_TRUNC('month', {_d(as_of)})::DATE AND {_d(as_of)}) u
CROSS JOIN (SELECT CAST(generate_series AS DATE) AS d FROM generate_series(
        DATE_TRUNC('month', {_d(as_of)})::TIMESTAMP, {_d(as_of)}::TIMESTAMP, INTERVAL 1 DAY)) g
LEFT JOIN (SELECT user_id, CAST(event_time AS DATE) AS d, COUNT(1) AS n FROM v_events
           WHERE user_id IS NOT NULL GROUP BY 1, 2) c ON c.user_id = u.user_id AND c.d = g.d
GROUP BY u.user_id"""


# The step's table is the month's array up to the day, built at once.
MONTHLY_ARRAY_CTES = [("array_metrics", f"SELECT *, 'site_hits' AS metric_name FROM ({month_backfill_sql(AS_OF, '0')})")]

ORACLE["monthly_array_metrics"] = with_views(["v_events"], f"""
SELECT user_id, month_start, metric_name, CAST(len(metric_array) AS INTEGER) AS array_len,
       {_long_text('metric_array')} AS metric_text FROM array_metrics""", MONTHLY_ARRAY_CTES)

SITE_HITS_CTES = [("monthly_user_site_hits", f"""SELECT user_id, metric_array AS hit_array, month_start, first_found_date,
    {_d(AS_OF)} AS date_partition FROM ({month_backfill_sql(AS_OF, 'NULL')})""")]

ORACLE["monthly_user_site_hits"] = with_views(["v_events"], f"""
SELECT user_id, month_start, first_found_date, date_partition,
       CAST(len(hit_array) AS INTEGER) AS array_len, {_long_text('hit_array')} AS hit_text
FROM monthly_user_site_hits""", SITE_HITS_CTES)

ORACLE["array_position_sum"] = with_views(["v_events"], f"""
SELECT month_start,
       CAST(SUM(COALESCE(hit_array[1], 0)) AS BIGINT) AS num_hits_first_day,
       CAST(SUM(COALESCE(hit_array[2], 0)) AS BIGINT) AS num_hits_second_day,
       CAST(SUM(COALESCE(hit_array[3], 0)) AS BIGINT) AS num_hits_third_day
FROM monthly_user_site_hits WHERE date_partition = {_d(AS_OF)} GROUP BY month_start""", SITE_HITS_CTES)

ORACLE["array_metric_to_rows"] = with_views(["v_events"], """
SELECT metric_name, CAST(month_start + CAST(i AS INTEGER) AS DATE) AS adjusted_date,
       CAST(SUM(v) AS BIGINT) AS value
FROM (SELECT metric_name, month_start, unnest(metric_array) AS v,
             unnest(range(len(metric_array))) AS i FROM array_metrics)
GROUP BY metric_name, month_start, i""", MONTHLY_ARRAY_CTES)

ORACLE["array_length_profile"] = with_views(["v_events"], """
SELECT CAST(len(hit_array) AS INTEGER) AS array_length, COUNT(*) AS num_rows,
       COUNT(CASE WHEN first_found_date = month_start THEN 1 END) AS from_month_start
FROM monthly_user_site_hits GROUP BY 1""", SITE_HITS_CTES)

_ev_dev = ("ev_dev", "SELECT e.*, d.browser_type, d.os_type, d.device_type FROM v_events e "
                     "JOIN v_devices d ON e.device_id = d.device_id")

ORACLE["user_devices_cumulated"] = with_views(["v_events", "v_devices"], f"""
SELECT user_id, browser_type, date, CAST(len(dates_active) AS INTEGER) AS num_dates,
       {DATES_TEXT} AS dates_text FROM udc""",
    [_ev_dev, ("udc", dates_backfill_sql(AS_OF, "user_id, browser_type", "ev_dev"))])

ORACLE["device_datelist_int"] = with_views(
    ["v_events", "v_devices"], "SELECT user_id, browser_type, date, datelist_int FROM bits",
    [_ev_dev, ("udc", dates_backfill_sql(AS_OF, "user_id, browser_type", "ev_dev"))]
    + datelist_int_ctes("udc", "user_id, browser_type"))

ORACLE["hosts_cumulated"] = with_views(["v_events"], f"""
SELECT host, date, CAST(len(dates_active) AS INTEGER) AS num_dates, {DATES_TEXT} AS dates_text
FROM ({dates_step_sql('host')})""",
    [("yesterday", dates_backfill_sql(_prev(AS_OF), "host")), ("today", today_sql("host"))])

ORACLE["host_activity_reduced"] = with_views(["v_events"], f"""
SELECT h.host, DATE_TRUNC('month', {_d(AS_OF)})::DATE AS month_start,
       array_to_string(list(COALESCE(c.hits, 0) ORDER BY g.d), ',') AS hit_text,
       array_to_string(list(COALESCE(c.visitors, 0) ORDER BY g.d), ',') AS visitors_text
FROM (SELECT DISTINCT host FROM v_events WHERE host IS NOT NULL
        AND CAST(event_time AS DATE) BETWEEN DATE_TRUNC('month', {_d(AS_OF)})::DATE AND {_d(AS_OF)}) h
CROSS JOIN (SELECT CAST(generate_series AS DATE) AS d FROM generate_series(
        DATE_TRUNC('month', {_d(AS_OF)})::TIMESTAMP, {_d(AS_OF)}::TIMESTAMP, INTERVAL 1 DAY)) g
LEFT JOIN (SELECT host, CAST(event_time AS DATE) AS d, COUNT(1) AS hits, COUNT(DISTINCT user_id) AS visitors
           FROM v_events WHERE host IS NOT NULL GROUP BY 1, 2) c ON c.host = h.host AND c.d = g.d
GROUP BY h.host""")

# a day's step from the day before equals the whole month
ORACLE["host_activity_step"] = ORACLE["host_activity_reduced"]


# ---- growth accounting, retention, funnel -----------------------------------------------

def growth_ctes(last_day: str = AS_OF) -> list[tuple[str, str]]:
    """A row per user and day from the first active day on. ``since`` is the number
    of days back to the last active day before."""
    return [
        ("active", f"""SELECT user_id, list_sort(list(DISTINCT CAST(event_time AS DATE))) AS ds FROM v_events
                   WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {_d(last_day)} GROUP BY user_id"""),
        ("days", f"""SELECT user_id, ds, CAST(UNNEST(generate_series(CAST(ds[1] AS TIMESTAMP), CAST({_d(last_day)} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
                 FROM active"""),
        ("seen", """SELECT user_id, ds, day, list_contains(ds, day) AS here, list_filter(ds, lambda x: x < day) AS past FROM days"""),
        ("gaps", "SELECT *, date_diff('day', past[-1], day) AS since FROM seen"),
        ("users_growth_accounting", """
SELECT user_id, day AS date, ds[1] AS first_active_date, CASE WHEN here THEN day ELSE past[-1] END AS last_active_date,
       CASE WHEN len(past) = 0 THEN 'New' WHEN here THEN CASE WHEN since = 1 THEN 'Retained' ELSE 'Resurrected' END
            WHEN since = 1 THEN 'Churned' ELSE 'Stale' END AS daily_active_state,
       CASE WHEN len(past) = 0 THEN 'New' WHEN here THEN CASE WHEN since > 7 THEN 'Resurrected' ELSE 'Retained' END
            WHEN since < 8 THEN 'Retained' WHEN since = 8 THEN 'Churned' ELSE 'Stale' END AS weekly_active_state,
       CAST(len(past) + CASE WHEN here THEN 1 ELSE 0 END AS INTEGER) AS num_dates, here
FROM gaps"""),
    ]


GROWTH_COLUMNS = "* EXCLUDE (here)"

ORACLE["growth_accounting"] = with_views(["v_events"], f"SELECT {GROWTH_COLUMNS} FROM users_growth_accounting", growth_ctes())

ORACLE["growth_accounting_step"] = with_views(
    ["v_events"], f"SELECT {GROWTH_COLUMNS} FROM users_growth_accounting WHERE date = {_d(AS_OF)}", growth_ctes())

ORACLE["retention_curve"] = with_views(["v_events"], """
SELECT CAST(day - ds[1] AS INTEGER) AS days_since_first_active,
       CAST(COUNT(*) FILTER (WHERE here) AS DOUBLE) / COUNT(*) AS pct_active, COUNT(*) AS num_rows
FROM seen GROUP BY 1""", growth_ctes())

# An event counts if a later one of its user follows on the same day; it converts if
# a sign-up call is among those. The day's last event and last sign-up call decide both.
ORACLE["funnel_conversion"] = with_views(["v_events"], f"""
SELECT url, COUNT(*) AS num_events, AVG(CASE WHEN last_call > event_time THEN 1.0 ELSE 0.0 END) AS conversion_rate
FROM (SELECT DISTINCT e.user_id, e.event_time, e.url, l.last_call
      FROM v_events e JOIN lasts l ON l.user_id = e.user_id AND l.day = CAST(e.event_time AS DATE) AND l.last_event > e.event_time)
GROUP BY url
HAVING COUNT(*) > {FUNNEL_MIN_COUNT} AND MAX(last_call > event_time)""", [
    ("lasts", """SELECT user_id, CAST(event_time AS DATE) AS day, MAX(event_time) AS last_event,
        MAX(event_time) FILTER (WHERE url = '/api/v1/user') AS last_call FROM v_events WHERE user_id IS NOT NULL GROUP BY 1, 2"""),
])


# ---- reports -------------------------------------------------------------------------------

EVENTS_AUGMENTED = ("events_augmented", """
SELECT COALESCE(d.os_type, 'unknown') AS os_type, COALESCE(d.device_type, 'unknown') AS device_type,
       COALESCE(d.browser_type, 'unknown') AS browser_type, url, user_id, referrer, event_time
FROM v_events e JOIN v_devices d ON e.device_id = d.device_id""")

def _hits(level: str, *by: str) -> str:
    cols = ", ".join(c if c in by else f"'(overall)' AS {c}" for c in ("os_type", "device_type", "browser_type"))
    return f"SELECT '{level}' AS aggregation_level, {cols}, COUNT(*) AS number_of_hits FROM events_augmented GROUP BY {', '.join(by)}"


ORACLE["device_hits_dashboard"] = with_views(["v_events", "v_devices"], "\nUNION ALL\n".join([
    _hits("os_type__device_type__browser", "os_type", "device_type", "browser_type"),
    *[_hits(c, c) for c in ("browser_type", "os_type", "device_type")]]), [EVENTS_AUGMENTED])

REFERRER_CASE = """CASE WHEN referrer LIKE '%linkedin%' THEN 'Linkedin'
            WHEN referrer LIKE '%t.co%' THEN 'Twitter'
            WHEN referrer LIKE '%google%' THEN 'Google'
            WHEN referrer LIKE '%lnkd%' THEN 'Linkedin'
            WHEN referrer LIKE '%site-one%' THEN 'On Site'
            WHEN referrer LIKE '%site-two%' THEN 'On Site'
            ELSE referrer END"""

ORACLE["referrer_groups"] = with_views(["v_events"], f"""
SELECT referrer, {REFERRER_CASE} AS referrer_group, COUNT(1) AS num_events FROM v_events GROUP BY 1, 2""")

AGGREGATED = ("aggregated", f"""
SELECT url, {REFERRER_CASE} AS referrer, CAST(event_time AS DATE) AS event_date, COUNT(1) AS count
FROM events_augmented GROUP BY 1, 2, 3""")

ORACLE["referrer_daily_counts"] = with_views(["v_events", "v_devices"], "SELECT * FROM aggregated",
                                             [EVENTS_AUGMENTED, AGGREGATED])

# Per referrer and url the days in order as lists; frames are slices by place.
ORACLE["referrer_window_analysis"] = with_views(["v_events", "v_devices"], f"""
SELECT referrer, url, event_date, count,
       CAST(list_sum(counts[1:i]) AS BIGINT) AS rolling_cumulative_sum,
       CAST(list_sum(counts[greatest(1, i - 6):i]) AS BIGINT) AS weekly_rolling_count,
       CASE WHEN i > 6 THEN CAST(list_sum(counts[greatest(1, i - 13):i - 6]) AS BIGINT) END AS previous_weekly_rolling_count,
       count / CAST(month_total AS DOUBLE) AS pct_of_month, count / CAST(list_sum(counts) AS DOUBLE) AS pct_of_total
FROM (SELECT referrer, url, counts, UNNEST(dates) AS event_date, UNNEST(counts) AS count, UNNEST(range(1, len(counts) + 1)) AS i FROM series)
JOIN (SELECT referrer, url, DATE_TRUNC('month', event_date) AS m, SUM(count) AS month_total FROM aggregated GROUP BY 1, 2, 3) t
  USING (referrer, url)
WHERE m = DATE_TRUNC('month', event_date) AND list_sum(counts) > {THRESHOLD_TOTAL}""", [EVENTS_AUGMENTED, AGGREGATED, ("series", """
SELECT referrer, url, list(event_date ORDER BY event_date) AS dates, list(count ORDER BY event_date) AS counts
FROM aggregated WHERE referrer IS NOT NULL GROUP BY referrer, url""")])

GAME_FACTS = ("game_facts", """SELECT gd.*, g.game_date, g.season, g.winner_team_id
    FROM v_game_details_dedup gd JOIN v_games g ON gd.game_id = g.game_id""")

GAME_SETS_SQL = """
SELECT CASE WHEN GROUPING(player_name) = 0 AND GROUPING(team_abbreviation) = 0 THEN 'player_team'
            WHEN GROUPING(player_name) = 0 AND GROUPING(season) = 0 THEN 'player_season'
            ELSE 'team' END AS aggregation_level,
       COALESCE(player_name, '(overall)') AS player_name,
       COALESCE(team_abbreviation, '(overall)') AS team_abbreviation,
       COALESCE(CAST(season AS VARCHAR), '(overall)') AS season,
       SUM(pts) AS total_pts, COUNT(DISTINCT game_id) AS num_games,
       COUNT(DISTINCT CASE WHEN team_id = winner_team_id THEN game_id END) AS games_won
FROM game_facts
GROUP BY GROUPING SETS ((player_name, team_abbreviation), (player_name, season), (team_abbreviation))"""

ORACLE["game_grouping_sets"] = with_views(["v_games"], GAME_SETS_SQL, [GAME_FACTS])

ORACLE["game_grouping_top"] = with_views(["v_games"], """
SELECT p.aggregation_level, p.total_pts AS pts_total_pts, p.player_name AS pts_player_name,
       p.team_abbreviation AS pts_team_abbreviation, p.season AS pts_season,
       w.games_won AS won_games_won, w.player_name AS won_player_name,
       w.team_abbreviation AS won_team_abbreviation, w.season AS won_season
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY aggregation_level ORDER BY total_pts DESC,
        player_name DESC, team_abbreviation DESC, season DESC) AS rn FROM gs) p
JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY aggregation_level ORDER BY games_won DESC,
        player_name DESC, team_abbreviation DESC, season DESC) AS rn FROM gs) w
  ON p.aggregation_level = w.aggregation_level AND w.rn = 1
WHERE p.rn = 1""", [GAME_FACTS, ("gs", GAME_SETS_SQL)])

ORACLE["team_90_game_wins"] = with_views(["v_games"], """
SELECT team_id, MAX(wins_90) AS max_wins_90_games FROM (
  SELECT team_id, CAST(SUM(won) OVER (PARTITION BY team_id ORDER BY game_date, game_id
         ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS BIGINT) AS wins_90
  FROM (SELECT DISTINCT team_id, game_id, game_date,
               CAST(team_id = winner_team_id AS BIGINT) AS won FROM game_facts))
GROUP BY team_id""", [GAME_FACTS])

ORACLE["longest_streak"] = with_views(["v_games"], """
SELECT player_id, CAST(COALESCE(MAX(len), 0) AS BIGINT) AS longest_streak_over_10 FROM (
  SELECT player_id, island, SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS len FROM (
    SELECT player_id, ok, SUM(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY player_id
           ORDER BY game_date, game_id ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT player_id, game_date, game_id, COALESCE(pts > 10, FALSE) AS ok FROM game_facts))
  GROUP BY player_id, island)
GROUP BY player_id""", [GAME_FACTS])


# ---- graph --------------------------------------------------------------------------------

ORACLE["team_vertices"] = with_views(["v_teams"], """
SELECT team_id AS identifier, 'team' AS type,
       CAST(json_object('abbreviation', abbreviation, 'nickname', nickname, 'city', city, 'arena', arena,
                        'year_founded', CAST(yearfounded AS VARCHAR)) AS VARCHAR) AS properties
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY nickname DESC) AS row_num FROM v_teams)
WHERE row_num = 1""")

ORACLE["player_game_edges"] = with_views(["v_game_details_dedup"], """
SELECT CAST(player_id AS VARCHAR) AS subject_identifier, 'player' AS subject_type,
       CAST(game_id AS VARCHAR) AS object_identifier, 'game' AS object_type, 'plays_in' AS edge_type,
       CAST(json_object('start_position', start_position, 'pts', pts, 'team_id', team_id,
                        'team_abbreviation', team_abbreviation) AS VARCHAR) AS properties
FROM v_game_details_dedup""")

# A game's pairs from the list of its players, the higher id first.
ORACLE["player_player_edges"] = with_views(["v_game_details_dedup"], """
SELECT s.player_id AS subject_identifier, s.player_name AS subject_name, o.player_id AS object_identifier, o.player_name AS object_name,
       IF(s.team_abbreviation = o.team_abbreviation, 'shares_team', 'plays_against') AS edge_type,
       COUNT(*) AS num_games, SUM(s.pts) AS subject_points, SUM(o.pts) AS object_points
FROM (SELECT p AS s, UNNEST(list_filter(players, lambda q: q.player_id < p.player_id AND q.player_name <> p.player_name)) AS o
      FROM (SELECT players, UNNEST(players) AS p FROM (
        SELECT list({'player_id': player_id, 'player_name': player_name, 'team_abbreviation': team_abbreviation, 'pts': pts}) AS players
        FROM v_game_details_dedup GROUP BY game_id)))
GROUP BY 1, 2, 3, 4, 5""")

ORACLE["player_vertices"] = with_views(["v_game_details_dedup"], """
SELECT player_id AS identifier, 'player' AS type,
       CAST(json_object('player_name', player_name, 'number_of_games', CAST(n AS VARCHAR),
            'total_points', CAST(p AS VARCHAR), 'teams', teams) AS VARCHAR) AS properties
FROM (SELECT player_id, MAX(player_name) AS player_name, COUNT(1) AS n, SUM(pts) AS p,
             array_to_string(list_sort(list(DISTINCT team_abbreviation)), ',') AS teams
      FROM v_game_details_dedup GROUP BY player_id)""")

ORACLE["game_vertices"] = with_views(["v_games"], """
SELECT game_id AS identifier, 'game' AS type,
       CAST(json_object('game_date', CAST(game_date AS VARCHAR), 'season', CAST(season AS VARCHAR),
            'winning_team', CAST(winner_team_id AS VARCHAR)) AS VARCHAR) AS properties
FROM v_games""")

ORACLE["plays_on_edges"] = with_views(["v_game_details_dedup"], """
SELECT CAST(player_id AS VARCHAR) AS subject_identifier, 'player' AS subject_type,
       CAST(team_id AS VARCHAR) AS object_identifier, 'team' AS object_type, 'plays_on' AS edge_type,
       CAST(json_object('num_games', COUNT(1), 'total_points', SUM(pts)) AS VARCHAR) AS properties
FROM v_game_details_dedup GROUP BY player_id, team_id""")

# ---- joins --------------------------------------------------------------------------------

_EV = "e.event_id, e.user_id, e.url, e.host, e.device_id, e.event_time, d.browser_type, d.os_type, d.device_type"
ORACLE["event_device_join"] = with_views(["v_events", "v_devices"], f"""
SELECT {_EV} FROM v_events e JOIN v_devices d ON e.device_id = d.device_id""")
ORACLE["event_device_left"] = with_views(["v_events", "v_devices"], f"""
SELECT {_EV} FROM v_events e LEFT JOIN v_devices d ON e.device_id = d.device_id""")

ORACLE["new_entities"] = with_views(["v_player_seasons"], """
SELECT ts.player_name, ts.season FROM v_player_seasons ts
LEFT JOIN v_player_seasons ls ON ls.player_name = ts.player_name AND ls.season = ts.season - 1
WHERE ls.player_name IS NULL""")

ORACLE["entity_period_grid"] = with_views(["v_player_seasons"], """
SELECT p.player_name, y.season FROM
  (SELECT player_name, MIN(season) AS first_season FROM v_player_seasons GROUP BY player_name) p
JOIN (SELECT CAST(s AS INTEGER) AS season FROM generate_series(
        (SELECT MIN(season) FROM v_player_seasons), (SELECT MAX(season) FROM v_player_seasons)) t(s)) y
  ON p.first_season <= y.season""")

ORACLE["geo_enrich"] = with_views(["v_web_events", "v_geo_ranges"], """
SELECT w.event_id, w.ip, w.event_time, w.referrer, w.host, w.url,
       CASE WHEN g.lo IS NOT NULL THEN CAST(json_object('country', g.country, 'state', g.state,
            'city', g.city) AS VARCHAR) ELSE '{}' END AS geodata
FROM v_web_events w LEFT JOIN v_geo_ranges g ON w.ip BETWEEN g.lo AND g.hi""")

ORACLE["geo_enrich_nested"] = with_views(["v_web_events", "v_geo_nested"], """
SELECT w.event_id, w.ip, w.event_time, h.name, h.hi - h.lo + 1 AS width
FROM v_web_events w LEFT JOIN (
  SELECT i.ip, g.* FROM (SELECT DISTINCT ip FROM v_web_events) i JOIN v_geo_nested g ON i.ip BETWEEN g.lo AND g.hi
  QUALIFY row_number() OVER (PARTITION BY i.ip ORDER BY g.hi - g.lo, g.lo, g.name) = 1) h ON w.ip = h.ip""")

ORACLE["broadcast_map_medal"] = with_views(["v_medals_matches_players", "v_medals", "v_matches", "v_maps"], """
SELECT mmp.match_id, mmp.player_gamertag, mmp.medal_id, md.name AS medal_name, mmp.count,
       m.mapid, mp.name AS map_name
FROM v_medals_matches_players mmp JOIN v_medals md ON mmp.medal_id = md.medal_id
JOIN v_matches m ON mmp.match_id = m.match_id JOIN v_maps mp ON m.mapid = mp.mapid""")

ORACLE["bucket_join"] = with_views(["v_match_details", "v_matches", "v_medals_matches_players"], """
SELECT md.match_id, md.player_gamertag, md.player_total_kills, m.playlist_id, m.mapid,
       CAST(COALESCE(x.c, 0) AS BIGINT) AS medal_count
FROM v_match_details md JOIN v_matches m ON md.match_id = m.match_id
LEFT JOIN (SELECT match_id, player_gamertag, SUM(count) AS c FROM v_medals_matches_players GROUP BY 1, 2) x
  ON x.match_id = md.match_id AND x.player_gamertag = md.player_gamertag""")

ORACLE["bucket_join_by_date"] = with_views(["v_match_details", "v_matches"], f"""
SELECT match_id, player_gamertag, player_total_kills, player_total_deaths, playlist_id, mapid,
       CAST(completion_date AS DATE) AS completion_date
FROM v_match_details JOIN v_matches USING (match_id) WHERE CAST(completion_date AS DATE) = DATE '{MATCH_DAY}'""")

ORACLE["match_top_player"] = with_views(["v_match_details", "v_matches"], """
SELECT md.player_gamertag, SUM(md.player_total_kills) / COUNT(DISTINCT md.match_id) AS avg_kills_per_game
FROM v_match_details md JOIN v_matches m ON md.match_id = m.match_id
GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1""")

ORACLE["match_top_playlist"] = with_views(["v_matches"], """
SELECT playlist_id, COUNT(DISTINCT match_id) AS num_matches FROM v_matches GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1""")

ORACLE["match_top_map"] = with_views(["v_matches", "v_maps"], """
SELECT m.mapid, COUNT(DISTINCT m.match_id) AS num_matches, MAX(mp.name) AS map_name
FROM v_matches m JOIN v_maps mp ON m.mapid = mp.mapid GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1""")

ORACLE["match_top_medal_map"] = with_views(["v_medals_matches_players", "v_matches", "v_medals", "v_maps"], """
SELECT t.medal_id, md.name AS medal_name, t.mapid, mp.name AS map_name, t.num_medals FROM (
  SELECT medal_id, mapid, num_medals, ROW_NUMBER() OVER (PARTITION BY medal_id
         ORDER BY num_medals DESC, mapid DESC) AS rn
  FROM (SELECT mmp.medal_id, m.mapid, CAST(SUM(mmp.count) AS BIGINT) AS num_medals
        FROM v_medals_matches_players mmp JOIN v_matches m ON mmp.match_id = m.match_id GROUP BY 1, 2)) t
JOIN v_medals md ON t.medal_id = md.medal_id JOIN v_maps mp ON t.mapid = mp.mapid
WHERE t.rn = 1""")

# ---- misc ---------------------------------------------------------------------------------

ORACLE["entity_static"] = with_views(["v_player_seasons"], """
SELECT player_name, MIN(season) AS first_season, MAX(season) AS last_season, COUNT(1) AS num_seasons,
       MAX(weight) AS weight, MAX(country) AS country, MAX(college) AS college
FROM v_player_seasons GROUP BY player_name""")

_EVENTS_AGG = ("events_aggregated", """SELECT user_id, device_id, COUNT(1) AS event_counts,
    array_to_string(list_sort(list(DISTINCT host)), ',') AS hosts
    FROM v_events WHERE user_id IS NOT NULL GROUP BY 1, 2""")

ORACLE["user_device_rollup"] = with_views(["v_events"], """
SELECT user_id, device_id, event_counts, hosts, MAX(event_counts) OVER (PARTITION BY user_id) AS total_hits,
       COUNT(1) OVER (PARTITION BY user_id) AS num_devices
FROM events_aggregated""", [_EVENTS_AGG])

ORACLE["device_user_rollup"] = with_views(["v_events", "v_devices"], """
SELECT d.device_id, d.device_type, a.user_id, a.event_counts,
       COUNT(1) OVER (PARTITION BY d.device_id) AS num_users
FROM v_devices d JOIN events_aggregated a ON d.device_id = a.device_id""", [_EVENTS_AGG])

ORACLE["dedup_events"] = with_views(["v_events"], """
SELECT url, host, user_id, event_time FROM v_events GROUP BY 1, 2, 3, 4""")

ORACLE["dedup_game_details"] = with_views(["v_game_details_dedup"], """
SELECT game_id, player_id, player_name, team_id, team_abbreviation, start_position, pts, l_linenumber
FROM v_game_details_dedup""")

ORACLE["duplicate_keys"] = with_views(["v_game_details"], """
SELECT player_id, game_id, COUNT(1) AS num_rows FROM v_game_details GROUP BY 1, 2 HAVING COUNT(1) > 1""")

ORACLE["scoring_class"] = with_views(["v_player_seasons"], f"""
SELECT player_name, season, pts, {_class_sql('pts')} AS scoring_class FROM v_player_seasons""")


def _quality_sql(x: str) -> str:
    return (f"CASE WHEN {x} > 8 THEN 'star' WHEN {x} > 7 THEN 'good' "
            f"WHEN {x} > 6 THEN 'average' ELSE 'bad' END")


ORACLE["quality_class"] = with_views(["v_actor_films"], f"""
SELECT actorid, year AS last_year, avg_rating AS last_year_avg_rating, {_quality_sql('avg_rating')} AS quality_class
FROM (SELECT actorid, year, round(AVG(rating), 9) AS avg_rating,
             ROW_NUMBER() OVER (PARTITION BY actorid ORDER BY year DESC) AS rn
      FROM v_actor_films GROUP BY actorid, year) WHERE rn = 1""")

ORACLE["first_last_ratio"] = with_views(["v_player_seasons"], f"""
SELECT player_name, seasons[-1].pts / CASE WHEN seasons[1].pts = 0 THEN 1 ELSE seasons[1].pts END
         AS ratio_most_recent_to_first
FROM players WHERE current_season = {STEP_SEASON}""", players_ctes())

ORACLE["unnest_history"] = with_views(["v_player_seasons"], """
SELECT player_name, s.season, s.gp, s.pts, s.ast, s.reb
FROM (SELECT player_name, UNNEST(seasons) AS s FROM players
      WHERE current_season = (SELECT MAX(season) FROM v_player_seasons))""", players_ctes())

ACTOR_YEAR = STEP_SEASON
ORACLE["actor_cumulative"] = with_views(["v_actor_films"], f"""
SELECT COALESCE(p.actorid, c.actorid) AS actorid, COALESCE(p.actor, c.actor) AS actor,
       {ACTOR_YEAR} AS current_year,
       CASE WHEN c.actorid IS NOT NULL THEN {_quality_sql('c.r')} ELSE pc.quality_class END AS quality_class,
       c.actorid IS NOT NULL AS is_active,
       CAST(COALESCE(p.n, 0) + COALESCE(c.n, 0) AS INTEGER) AS num_films,
       CAST(COALESCE(p.v, 0) + COALESCE(c.v, 0) AS BIGINT) AS total_votes
FROM (SELECT actorid, MAX(actor) AS actor, COUNT(*) AS n, SUM(votes) AS v FROM v_actor_films
      WHERE year <= {ACTOR_YEAR - 1} GROUP BY actorid) p
LEFT JOIN (SELECT actorid, {_quality_sql('r')} AS quality_class FROM (
      SELECT actorid, year, round(AVG(rating), 9) AS r, ROW_NUMBER() OVER (PARTITION BY actorid ORDER BY year DESC) AS rn
      FROM v_actor_films WHERE year <= {ACTOR_YEAR - 1} GROUP BY actorid, year) WHERE rn = 1) pc
  ON pc.actorid = p.actorid
FULL OUTER JOIN (SELECT actorid, MAX(actor) AS actor, COUNT(*) AS n, SUM(votes) AS v, round(AVG(rating), 9) AS r
      FROM v_actor_films WHERE year = {ACTOR_YEAR} GROUP BY actorid) c ON p.actorid = c.actorid""")

ORACLE["actor_scd"] = with_views(["v_actor_films"], _scd_sql(["quality_class", "is_active"], "actors", "actorid", "current_year"), [
    ("per_year", "SELECT actorid, year, round(AVG(rating), 9) AS r FROM v_actor_films GROUP BY 1, 2"),
    ("actor_rows", """SELECT actorid, UNNEST(range(MIN(year), (SELECT MAX(year) FROM per_year) + 1)) AS at FROM per_year GROUP BY actorid"""),
    ("actors", f"""SELECT a.actorid, CAST(a.at AS INTEGER) AS current_year, MAX(p.year) = a.at AS is_active,
                  {_quality_sql('arg_max(p.r, p.year)')} AS quality_class
                  FROM actor_rows a JOIN per_year p ON p.actorid = a.actorid AND p.year <= a.at GROUP BY a.actorid, a.at"""),
])


# the step onto a year's history equals the history up to that year
ORACLE["actor_scd_incremental"] = with_views(["v_actor_films"], _scd_sql(["quality_class", "is_active"], "actors", "actorid", "current_year"), [
    ("per_year", f"SELECT actorid, year, round(AVG(rating), 9) AS r FROM v_actor_films WHERE year <= {ACTOR_YEAR} GROUP BY 1, 2"),
    ("actor_rows", f"""SELECT actorid, UNNEST(range(MIN(year), {ACTOR_YEAR} + 1)) AS at FROM per_year GROUP BY actorid"""),
    ("actors", f"""SELECT a.actorid, CAST(a.at AS INTEGER) AS current_year, MAX(p.year) = a.at AS is_active,
                  {_quality_sql('arg_max(p.r, p.year)')} AS quality_class
                  FROM actor_rows a JOIN per_year p ON p.actorid = a.actorid AND p.year <= a.at GROUP BY a.actorid, a.at"""),
])

ORACLE["actor_films"] = with_views(["v_actor_films"], f"""
SELECT actorid, actor, year, film, votes, rating, filmid,
       COUNT(*) OVER (PARTITION BY actorid, year) AS films_of_year,
       {_quality_sql('round(AVG(rating) OVER (PARTITION BY actorid, year), 9)')} AS quality_class
FROM v_actor_films""")


# ---- streams (checked against the batch answer) -------------------------------------------

_WE_TS = ("we", """SELECT *, strptime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts FROM v_web_events""")

ORACLE["stream_tumbling_host"] = with_views(["v_web_events"], """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, host, COUNT(host) AS num_hits
FROM we GROUP BY 1, 2""", [_WE_TS])

ORACLE["stream_tumbling_host_referrer"] = with_views(["v_web_events"], """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, host, referrer, COUNT(host) AS num_hits
FROM we GROUP BY 1, 2, 3""", [_WE_TS])

# late copies of the first slice are behind the watermark and dropped: the
# answer is the tumbling count of the events sent once
ORACLE["stream_late_drop"] = ORACLE["stream_tumbling_host"]

_SESSIONS = ("sessions", """
SELECT ip, host, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end,
       COUNT(1) AS num_events
FROM (SELECT *, SUM(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 5 MINUTE THEN 1 ELSE 0 END)
               OVER (PARTITION BY ip, host ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
      FROM (SELECT ip, host, ts, LAG(ts) OVER (PARTITION BY ip, host ORDER BY ts) AS prev FROM we))
GROUP BY ip, host, sid""")

ORACLE["sessionize"] = with_views(["v_web_events"], "SELECT * FROM sessions", [_WE_TS, _SESSIONS])

ORACLE["session_avg_by_host"] = with_views(["v_web_events"], """
SELECT host, AVG(num_events) AS avg_events_per_session, COUNT(1) AS num_sessions
FROM sessions GROUP BY host""", [_WE_TS, _SESSIONS])

ORACLE["stream_geo_enrich"] = with_views(["v_web_events", "v_geo_ranges"], """
SELECT w.event_id, w.ip, w.ts AS event_timestamp, w.referrer, w.host, w.url,
       CASE WHEN g.lo IS NOT NULL THEN CAST(json_object('country', g.country, 'state', g.state,
            'city', g.city) AS VARCHAR) ELSE '{}' END AS geodata
FROM we w LEFT JOIN v_geo_ranges g ON w.ip BETWEEN g.lo AND g.hi""", [_WE_TS])


# ---- experiments, KPIs --------------------------------------------------------------------

EXPERIMENT = "signup_button"
_BUCKET = f"CAST(('0x' || substr(md5('{EXPERIMENT}:' || CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER)"

ORACLE["experiment_assignment"] = with_views(["v_events"], f"""
SELECT user_id, '{EXPERIMENT}' AS experiment, {_BUCKET} AS bucket,
       CASE WHEN {_BUCKET} < 50 THEN 'control' WHEN {_BUCKET} < 100 THEN 'treatment' END AS variant
FROM (SELECT DISTINCT user_id FROM v_events WHERE user_id IS NOT NULL)""")

_OUTCOMES = ("outcomes", f"""
SELECT x.user_id, '{EXPERIMENT}' AS experiment,
       CASE WHEN {_BUCKET.replace('user_id', 'x.user_id')} < 50 THEN 'control' ELSE 'treatment' END AS variant,
       x.exposure_time,
       EXISTS (SELECT 1 FROM v_events c WHERE c.user_id = x.user_id AND c.url = '/api/v1/user'
               AND c.event_time > x.exposure_time) AS converted
FROM (SELECT user_id, MIN(event_time) AS exposure_time FROM v_events
      WHERE user_id IS NOT NULL AND url = '/signup' GROUP BY user_id) x""")

ORACLE["experiment_exposure"] = with_views(["v_events"], "SELECT * FROM outcomes", [_OUTCOMES])

ORACLE["experiment_readout"] = with_views(["v_events"], """
SELECT p.experiment, p.variant, p.users, p.conversions, p.conversion_rate,
       CASE WHEN p.variant <> 'control' THEN p.conversion_rate / c.conversion_rate - 1 END AS lift,
       CASE WHEN p.variant <> 'control' THEN (p.conversion_rate - c.conversion_rate) /
            sqrt(((p.conversions + c.conversions) / (p.users + c.users)) *
                 (1 - (p.conversions + c.conversions) / (p.users + c.users)) *
                 (1.0 / p.users + 1.0 / c.users)) END AS z_score
FROM per p LEFT JOIN (SELECT * FROM per WHERE variant = 'control') c ON p.experiment = c.experiment""",
    [_OUTCOMES, ("per", """SELECT experiment, variant, COUNT(1) AS users,
        CAST(SUM(CAST(converted AS BIGINT)) AS BIGINT) AS conversions,
        CAST(SUM(CAST(converted AS BIGINT)) AS BIGINT) / COUNT(1) AS conversion_rate
        FROM outcomes GROUP BY 1, 2""")])

ORACLE["experiment_srm"] = with_views(["v_events"], """
SELECT experiment, users_control, users_treatment,
       (users_control + users_treatment) * CAST(0.5 AS DOUBLE) AS expected_control,
       (users_control + users_treatment) * CAST(0.5 AS DOUBLE) AS expected_treatment,
       pow(users_control - (users_control + users_treatment) * CAST(0.5 AS DOUBLE), 2) / ((users_control + users_treatment) * CAST(0.5 AS DOUBLE))
       + pow(users_treatment - (users_control + users_treatment) * CAST(0.5 AS DOUBLE), 2) / ((users_control + users_treatment) * CAST(0.5 AS DOUBLE))
         AS chi_square
FROM (SELECT experiment, COUNT(CASE WHEN variant = 'control' THEN 1 END) AS users_control,
             COUNT(CASE WHEN variant = 'treatment' THEN 1 END) AS users_treatment
      FROM outcomes GROUP BY experiment)""", [_OUTCOMES])

ORACLE["kpi_profit"] = with_views(["v_profit"], """
SELECT CAST(DATE_TRUNC('month', day) AS DATE) AS month, CAST(SUM(profit) AS BIGINT) AS total_profit,
       COUNT(DISTINCT unit) AS units, CAST(SUM(profit) AS BIGINT) / COUNT(DISTINCT unit) AS profit_per_unit
FROM (SELECT unit, day, SUM(profit) AS profit FROM v_profit GROUP BY 1, 2) GROUP BY 1""")

ORACLE["kpi_growth"] = with_views(["v_events"], """
SELECT d.day, d.active_users, COALESCE(f.new_users, 0) AS new_users,
       d.active_users - COALESCE(f.new_users, 0) AS returning_users,
       CAST(SUM(COALESCE(f.new_users, 0)) OVER (ORDER BY d.day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_users
FROM (SELECT day, COUNT(1) AS active_users FROM act GROUP BY day) d
LEFT JOIN (SELECT day, COUNT(1) AS new_users FROM (SELECT user_id, MIN(day) AS day FROM act GROUP BY user_id)
           GROUP BY day) f ON d.day = f.day""",
    [("act", "SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM v_events WHERE user_id IS NOT NULL")])

ORACLE["kpi_engagement"] = with_views(["v_events"], """
SELECT CAST(event_time AS DATE) AS day, COUNT(1) AS events, COUNT(DISTINCT user_id) AS active_users,
       COUNT(DISTINCT url) AS distinct_urls, COUNT(1) / COUNT(DISTINCT user_id) AS events_per_user
FROM v_events WHERE user_id IS NOT NULL GROUP BY 1""")

# ---- sources and sinks ----------------------------------------------------------------------

ORACLE["enforce_schema"] = with_views(["v_events"], """
SELECT event_id, user_id, url, referrer, host, device_id, event_time,
       NULLIF(concat_ws('; ',
         CASE WHEN event_id IS NULL THEN 'missing event_id' END,
         CASE WHEN user_id IS NULL THEN 'missing user_id' END,
         CASE WHEN device_id IS NULL THEN 'missing device_id' END), '') AS reject_reason
FROM v_events""")

ORACLE["merge_upsert"] = ORACLE["monthly_array_metrics"]

ORACLE["snapshot_partition_read"] = with_views(["v_events"], f"""
SELECT user_id, CAST(event_time AS DATE) AS date, COUNT(1) AS num_site_hits FROM v_events
WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) = {_d(AS_OF)} GROUP BY 1, 2""")

ORACLE["udf_surface"] = with_views(["v_web_events", "v_geo_ranges"], """
SELECT w.event_id, w.ip,
       CASE WHEN g.lo IS NOT NULL THEN CAST(json_object('country', g.country, 'state', g.state,
            'city', g.city) AS VARCHAR) ELSE '{}' END AS geodata
FROM v_web_events w LEFT JOIN v_geo_ranges g ON w.ip BETWEEN g.lo AND g.hi""")

ORACLE["stream_two_sinks"] = with_views(["v_web_events"], """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, host, COUNT(host) AS num_hits,
       COUNT(host) AS num_hits_by_referrer_sink
FROM we GROUP BY 1, 2""", [_WE_TS])

ORACLE["user_devices_map"] = with_views(["v_events", "v_devices"], f"""
SELECT user_id, '{{' || string_agg('"' || browser_type || '":"' || {DATES_TEXT} || '"', ','
         ORDER BY browser_type) || '}}' AS device_activity_datelist
FROM udc GROUP BY user_id""",
    [_ev_dev, ("udc", dates_backfill_sql(AS_OF, "user_id, browser_type", "ev_dev"))])

ORACLE["experiment_welch"] = with_views(["v_events"], """
SELECT p.experiment, p.variant, p.users, p.mean_events, p.var_events,
       round(CASE WHEN p.variant <> 'control' THEN (p.mean_events - c.mean_events) /
            sqrt(p.var_events / p.users + c.var_events / c.users) END, 9) AS welch_t
FROM per p LEFT JOIN (SELECT * FROM per WHERE variant = 'control') c ON p.experiment = c.experiment""",
    [_OUTCOMES,
     ("per_unit", """SELECT o.user_id, o.experiment, o.variant,
         COUNT(CASE WHEN e.event_time > o.exposure_time THEN 1 END) AS metric
         FROM outcomes o LEFT JOIN v_events e ON e.user_id = o.user_id GROUP BY 1, 2, 3"""),
     ("per", """SELECT experiment, variant, COUNT(1) AS users, round(AVG(metric), 9) AS mean_events,
         round(VAR_SAMP(metric), 9) AS var_events FROM per_unit GROUP BY 1, 2""")])

ORACLE["hidden_partition_read"] = with_views(["v_events"], f"""
SELECT event_id, user_id, url, host, event_time FROM v_events
WHERE event_time >= TIMESTAMP '{LAYOUT_DAYS[0]}' AND event_time < TIMESTAMP '{LAYOUT_DAYS[1]}'
  AND user_id IN ({', '.join(map(str, HIDDEN_USERS))})""")

ORACLE["visitors_by_period"] = with_views(["v_events"], """
SELECT host, period_start, COUNT(*) AS hits, COUNT(DISTINCT user_id) AS visitors, period FROM (
  SELECT host, user_id, CAST(date_trunc('week', event_time) AS DATE) AS period_start, 'week' AS period FROM v_events
  UNION ALL SELECT host, user_id, CAST(date_trunc('month', event_time) AS DATE), 'month' FROM v_events
  UNION ALL SELECT host, user_id, CAST(event_time AS DATE) + CAST(k AS INTEGER), '7' FROM v_events, range(7) r(k))
WHERE host IS NOT NULL AND user_id IS NOT NULL GROUP BY host, period, period_start""")

# The backfill of the corrected seasons.
ORACLE["scd2_late_corrections"] = with_views(["v_player_seasons"], _scd_sql(["scoring_class"], "corrected"),
    [*players_ctes(), ("corrected", """SELECT player_name, current_season,
        CASE WHEN (length(player_name) + CAST(right(player_name, 2) AS INTEGER) + current_season) % 5 <> 0 THEN scoring_class
             WHEN current_season % 2 = 0 THEN 'star' ELSE 'corrected' END AS scoring_class FROM players""")])

ORACLE["partition_pruned_join"] = with_views(["v_match_details", "v_matches"], f"""
SELECT match_id, strftime(completion_date, '%Y-%m') AS match_month, player_gamertag, player_total_kills, player_total_deaths, playlist_id, mapid
FROM v_match_details JOIN v_matches USING (match_id)
WHERE is_team_game AND CAST(completion_date AS DATE) = DATE '{MATCH_DAY}'""")

_UNITS = ("units", """SELECT o.user_id, o.experiment, o.variant,
    COUNT(CASE WHEN e.event_time > o.exposure_time THEN 1 END) AS metric,
    COUNT(CASE WHEN e.event_time < o.exposure_time THEN 1 END) AS before
    FROM outcomes o LEFT JOIN v_events e ON e.user_id = o.user_id GROUP BY 1, 2, 3""")

ORACLE["experiment_adjusted"] = with_views(["v_events"], """
SELECT experiment, variant, users, round(m, 9) AS mean, round(theta, 9) AS theta, adjusted_mean, round(kept, 9) AS variance_kept,
       CASE WHEN variant <> 'control' THEN round(adjusted_mean / max(CASE WHEN variant = 'control' THEN adjusted_mean END) OVER (PARTITION BY experiment) - 1, 9) END AS adjusted_lift
FROM (SELECT experiment, variant, COUNT(*) AS users, AVG(metric) AS m, any_value(theta) AS theta, any_value(kept) AS kept,
             round(AVG(metric) - any_value(theta) * (AVG(before) - any_value(mb)), 9) AS adjusted_mean
      FROM units JOIN (SELECT experiment, covar_samp(metric, before) / var_samp(before) AS theta, 1 - pow(corr(metric, before), 2) AS kept, AVG(before) AS mb
                       FROM units GROUP BY 1) USING (experiment)
      GROUP BY 1, 2)""", [_OUTCOMES, _UNITS])

# Poisson(1) by inversion of the first 32 bits of the same md5.
ORACLE["experiment_bootstrap"] = with_views(["v_events"], """
SELECT experiment, variant, COUNT(*) AS replicates, round(quantile_cont(m, 0.025), 9) AS mean_low, round(quantile_cont(m, 0.975), 9) AS mean_high,
       round(quantile_cont(d, 0.025), 9) AS diff_low, round(quantile_cont(d, 0.975), 9) AS diff_high
FROM (SELECT t.experiment, t.variant, t.m, CASE WHEN t.variant <> 'control' THEN t.m - c.m END AS d
      FROM means t LEFT JOIN (SELECT * FROM means WHERE variant = 'control') c USING (experiment, r))
GROUP BY 1, 2""", [_OUTCOMES, _UNITS,
    ("cuts", "SELECT k, CAST(ceil(sum(exp(-1) / CAST(factorial(CAST(k AS INTEGER)) AS DOUBLE)) OVER (ORDER BY k) * 4294967296) AS BIGINT) AS cut FROM range(12) t(k)"),
    ("drawn", """SELECT experiment, variant, metric, r, CAST('0x' || substr(md5('bootstrap:' || experiment || ':' || user_id || ':' || r), 1, 8) AS BIGINT) AS h
        FROM units, range(1, 51) t(r)"""),
    ("weighted", "SELECT d.*, (SELECT count(*) FROM cuts WHERE d.h >= cut) AS w FROM drawn d"),
    ("means", "SELECT experiment, variant, r, sum(w * metric) / sum(w) AS m FROM weighted WHERE w > 0 GROUP BY 1, 2, 3")])

ORACLE["csv_scan"] = with_views(["v_devices"], """
SELECT device_id, browser_type, os_type, device_type, device_type || ', "as is"' AS note FROM v_devices""")

ORACLE["insert_by_name"] = with_views(["v_events"], """
SELECT user_id, CAST(event_time AS DATE) AS date, COUNT(1) AS num_site_hits FROM v_events WHERE user_id IS NOT NULL GROUP BY 1, 2""")

ORACLE["stream_to_topic_values"] = with_views(["v_web_events"], "SELECT event_id, ip, event_time, referrer, host, url FROM v_web_events")

ORACLE["history_compacted"] = with_views(["v_player_seasons"], """
SELECT player_name, CAST((SELECT MAX(season) FROM v_player_seasons) - MIN(season) + 1 AS INTEGER) AS num_slots, CAST(COUNT(*) AS INTEGER) AS num_seasons,
       string_agg(CAST(season AS VARCHAR), ',' ORDER BY season) AS season_list, arg_min(pts, season) AS first_pts
FROM v_player_seasons GROUP BY player_name""")
