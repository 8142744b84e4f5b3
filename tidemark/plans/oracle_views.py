"""The ``v_*`` views of FIXTURES.md §2 written in plain SQL for the DuckDB oracle.

Each entry is (dependencies, SQL body). ``with_views`` assembles a WITH clause
with the views a query needs, dependencies first.
"""

from __future__ import annotations

from ..functions.constants import HOSTS, REFERRERS


def _case(values, idx: str) -> str:
    arms = " ".join(
        f"WHEN {idx} = {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'")
        for i, v in enumerate(values))
    return f"CASE {arms} END"


VIEWS: dict[str, tuple[list[str], str]] = {}

VIEWS["v_player_seasons"] = ([], """
SELECT c.c_name AS player_name, CAST(year(o.o_orderdate) AS INTEGER) AS season,
       COUNT(*) AS gp,
       MAX(o.o_totalprice) / CAST(20000.0 AS DOUBLE) AS pts,
       CAST(COUNT(*) AS DOUBLE) AS ast,
       MIN(o.o_totalprice) / CAST(20000.0 AS DOUBLE) AS reb,
       MAX(c.c_nationkey) AS weight,
       CAST(MAX(c.c_nationkey) AS VARCHAR) AS country,
       MAX(c.c_mktsegment) AS college
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_name, year(o.o_orderdate)
""")

VIEWS["v_actor_films"] = ([], """
SELECT s.s_name AS actor, g.l_suppkey AS actorid, p.p_name AS film,
       CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(g.l_linenumber AS BIGINT) AS votes,
       g.q / CAST(5.0 AS DOUBLE) AS rating,
       CAST(g.l_orderkey AS VARCHAR) || '-' || CAST(g.l_linenumber AS VARCHAR) AS filmid
FROM (SELECT l_suppkey, l_orderkey, l_linenumber, AVG(l_quantity) AS q, MIN(l_partkey) AS partkey
      FROM lineitem GROUP BY l_suppkey, l_orderkey, l_linenumber) g
JOIN orders o ON g.l_orderkey = o.o_orderkey
JOIN part p ON g.partkey = p.p_partkey
JOIN supplier s ON g.l_suppkey = s.s_suppkey
""")

VIEWS["v_game_details"] = ([], """
SELECT l.l_orderkey AS game_id, l.l_suppkey AS player_id, s.s_name AS player_name,
       s.s_nationkey AS team_id, n.n_name AS team_abbreviation,
       l.l_returnflag AS start_position, l.l_quantity AS pts,
       l.l_linenumber, l.l_partkey, l.l_extendedprice, l.l_discount, l.l_tax, l.l_shipdate
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
""")

VIEWS["v_game_details_dedup"] = (["v_game_details"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY player_id, game_id
      ORDER BY l_linenumber, l_partkey, pts, l_extendedprice, l_discount, l_tax,
               l_shipdate, start_position) AS rn
  FROM v_game_details) WHERE rn = 1
""")

VIEWS["v_games"] = (["v_game_details_dedup"], """
SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS game_date,
       CAST(year(o.o_orderdate) AS INTEGER) AS season, w.winner_team_id
FROM orders o JOIN (
  SELECT game_id, team_id AS winner_team_id FROM (
    SELECT game_id, team_id, ROW_NUMBER() OVER (PARTITION BY game_id
           ORDER BY SUM(pts) DESC, team_id ASC) AS rn
    FROM v_game_details_dedup GROUP BY game_id, team_id) WHERE rn = 1
) w ON o.o_orderkey = w.game_id
""")

VIEWS["v_teams"] = ([], """
SELECT CAST(s.s_nationkey AS BIGINT) AS team_id, n.n_name AS abbreviation, s.s_name AS nickname,
       r.r_name AS city, n.n_name AS arena, CAST(1900 + n.n_nationkey AS BIGINT) AS yearfounded
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
VIEWS["v_events_base"] = ([], f"""
SELECT event_id,
       CASE WHEN event_type = 'purchase' THEN '/api/v1/user' ELSE '/' || event_type END AS url,
       {_case(REFERRERS, f"({_K}) % 8")} AS referrer,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN ({_K}) % 11 = 10 THEN -({_K}) ELSE {_K} END AS device_id,
       {_case(HOSTS, "user_id % 3")} AS host,
       ts AS event_time
FROM events
""")

VIEWS["v_events"] = (["v_events_base"], """
SELECT * FROM v_events_base
UNION ALL
SELECT * FROM v_events_base WHERE event_id % 50 = 0
""")

VIEWS["v_devices"] = ([], """
SELECT p_partkey AS device_id, p_brand AS browser_type,
       CASE WHEN p_size < 5 THEN NULL ELSE p_type END AS os_type,
       split_part(p_name, ' ', 1) AS device_type
FROM part
""")

VIEWS["v_web_events"] = (["v_events"], """
SELECT event_id, user_id * 1000 + abs(device_id) AS ip, referrer, host, url,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time
FROM v_events
""")

VIEWS["v_geo_ranges"] = ([], """
SELECT CAST(n.n_nationkey AS BIGINT) * 6000 AS lo, CAST(n.n_nationkey AS BIGINT) * 6000 + 4999 AS hi,
       n.n_name AS country, r.r_name AS state, n.n_name AS city
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")

VIEWS["v_geo_nested"] = (["v_geo_ranges"], """
SELECT s_suppkey * 331 AS lo, s_suppkey * 331 + (s_suppkey % 7) * 40 AS hi, 'street ' || s_name AS name FROM supplier
UNION ALL SELECT lo, hi, 'country ' || country FROM v_geo_ranges
UNION ALL SELECT r_regionkey * 300000, r_regionkey * 300000 + 599999, 'region ' || r_name FROM region
UNION ALL SELECT 0, 1099511627775, 'world'
""")

VIEWS["v_matches"] = ([], """
SELECT o.o_orderkey AS match_id, o.o_orderpriority AS playlist_id, c.c_nationkey AS mapid,
       o.o_orderdate AS completion_date, (o.o_orderstatus = 'F') AS is_team_game
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")

VIEWS["v_match_details"] = ([], """
SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS player_total_kills,
       COUNT(*) AS player_total_deaths
FROM lineitem GROUP BY l_orderkey, l_suppkey
""")

VIEWS["v_medals_matches_players"] = ([], """
SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag, l_partkey AS medal_id,
       CAST(SUM(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS count
FROM lineitem GROUP BY l_orderkey, l_suppkey, l_partkey
""")

VIEWS["v_medals"] = ([], """
SELECT p_partkey AS medal_id, p_name AS name, p_type AS classification FROM part
""")

VIEWS["v_maps"] = ([], "SELECT n_nationkey AS mapid, n_name AS name FROM nation")

VIEWS["v_profit"] = ([], """
SELECT l_orderkey AS unit, CAST(l_shipdate AS DATE) AS day,
       CAST(floor(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS profit
FROM lineitem
""")


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH v1 AS (...), ..., extra1 AS (...) <body>``."""
    ctes = [f"{n} AS ({VIEWS[n][1].strip()})" for n in _ordered(names)]
    ctes += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(ctes) + "\n" + body.strip()) if ctes else body.strip()
