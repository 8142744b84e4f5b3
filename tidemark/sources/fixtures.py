"""Views derived from the given tables that stand in for the reference's inputs
(players, game details, events, devices, matches, ...). Each is a lazy plan
over the parquet scans, so its size grows with the tables.

The same definitions are written in SQL for the DuckDB oracle
(``tidemark.plans.oracle_views``); keep the two in step.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import HOSTS, REFERRERS
from .tables import load


class Tables:
    """Lazy accessor for the given tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = load(self.spark, self.sf_dir, name)
        return self._cache[name]


def _pick(values, idx_col):
    """values[idx] from a literal array: the index expression appears once (a CASE
    would repeat it in every branch)."""
    arr = F.array(*[F.lit(v) if v is not None else F.lit(None).cast("string") for v in values])
    return F.element_at(arr, (idx_col + 1).cast("int"))


class Views:
    """The ``v_*`` views of FIXTURES.md §2.

    ``Views(spark, sf_dir)`` returns one shared instance per session and folder:
    the views are immutable logical plans over read-only tables, so queries of
    one application reuse them instead of rebuilding (and re-analysing) them."""

    _instances: dict = {}

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), spark.sparkContext.applicationId, sf_dir)
        inst = cls._instances.get(key)
        if inst is None:
            inst = super().__new__(cls)
            inst._init(spark, sf_dir)
            cls._instances = {k: v for k, v in cls._instances.items() if k[:2] == key[:2]}
            cls._instances[key] = inst
        return inst

    def _init(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.spark = spark

    # -- players ---------------------------------------------------------------
    @cached_property
    def v_player_seasons(self) -> DataFrame:
        # Pre-aggregate orders per (customer, year) before the join: the join then
        # moves one row per customer-year instead of one per order.
        per_cust = (self.t.orders
                    .groupBy(F.col("o_custkey"), F.year("o_orderdate").alias("season"))
                    .agg(F.count(F.lit(1)).alias("n"),
                         F.max("o_totalprice").alias("mx"),
                         F.min("o_totalprice").alias("mn")))
        c = self.t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        j = per_cust.join(c, per_cust.o_custkey == c.c_custkey)
        return (j.groupBy(F.col("c_name").alias("player_name"), "season")
                .agg(F.sum("n").alias("gp"),
                     (F.max("mx") / 20000.0).alias("pts"),
                     F.sum("n").cast("double").alias("ast"),
                     (F.min("mn") / 20000.0).alias("reb"),
                     F.max("c_nationkey").alias("weight"),
                     F.max("c_nationkey").cast("string").alias("country"),
                     F.max("c_mktsegment").alias("college")))

    # -- actors ----------------------------------------------------------------
    @cached_property
    def v_actor_films(self) -> DataFrame:
        li = (self.t.lineitem
              .groupBy("l_suppkey", "l_orderkey", "l_linenumber")
              .agg(F.avg("l_quantity").alias("q"), F.min("l_partkey").alias("partkey")))
        o = self.t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
        p = self.t.part.select("p_partkey", F.col("p_name").alias("film"))
        s = self.t.supplier.select("s_suppkey", F.col("s_name").alias("actor"))
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(p, F.col("partkey") == p.p_partkey)
             .join(s, F.col("l_suppkey") == s.s_suppkey))
        return j.select(
            "actor",
            F.col("l_suppkey").alias("actorid"),
            "film",
            "year",
            F.col("l_linenumber").cast("long").alias("votes"),
            (F.col("q") / 5.0).alias("rating"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("filmid"))

    # -- games -----------------------------------------------------------------
    @cached_property
    def v_game_details(self) -> DataFrame:
        li = self.t.lineitem
        s = self.t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        n = self.t.nation.select("n_nationkey", "n_name")
        j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey)
        return j.select(
            F.col("l_orderkey").alias("game_id"),
            F.col("l_suppkey").alias("player_id"),
            F.col("s_name").alias("player_name"),
            F.col("s_nationkey").alias("team_id"),
            F.col("n_name").alias("team_abbreviation"),
            F.col("l_returnflag").alias("start_position"),
            F.col("l_quantity").alias("pts"),
            # columns of the de-duplication order
            "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_tax",
            "l_shipdate")

    DEDUP_ORDER = ["l_linenumber", "l_partkey", "pts", "l_extendedprice", "l_discount",
                   "l_tax", "l_shipdate", "start_position"]

    @cached_property
    def v_game_details_dedup(self) -> DataFrame:
        """De-duplicated game details. A job producing several outputs from it
        should stage it once (``sources.writers.materialize``)."""
        from ..operators.windows import first_per_key
        return first_per_key(self.v_game_details, ["player_id", "game_id"], self.DEDUP_ORDER)

    # Decides pts; rows alike in these columns differ in nothing that ``details_by_game`` returns.
    PTS_ORDER = ["l_linenumber", "l_partkey", "pts"]

    def details_by_game(self, columns: Sequence[str], task_rows: int = 100_000, big_rows: int = 2000) -> tuple[DataFrame, DataFrame | None]:
        """De-duplicated details with a game, the key and ``columns`` of player, team and pts:
        those of games of at most ``big_rows`` line items, dealt by game to tasks of about
        ``task_rows`` rows however large the table, and those of bigger games (None if there
        is none), which are not dealt by game. Only columns that decide pts are shuffled."""
        from ..operators.windows import first_per_key
        from .writers import materialize
        sizes = self.t.lineitem.where("l_orderkey IS NOT NULL").groupBy(F.col("l_orderkey").alias("game_id")).agg(F.count(F.lit(1)).alias("n"))
        rows, n_big = sizes.agg(F.sum("n"), F.count_if(F.col("n") > big_rows)).first()
        raw = self.v_game_details.where(F.col("game_id").isNotNull()).select(
            "game_id", "player_id", *dict.fromkeys([*columns, *self.PTS_ORDER]))
        one = lambda df: first_per_key(df, ["game_id", "player_id"], self.PTS_ORDER).select("game_id", "player_id", *columns)
        big = None
        if n_big:
            keys = materialize(self.spark, sizes.where(F.col("n") > big_rows).select("game_id"), "big-games")
            big = one(raw.join(keys, "game_id", "left_semi"))
            raw = raw.join(keys, "game_id", "left_anti")
        return one(raw.repartition(max(1, -(-(rows or 0) // task_rows)), "game_id")), big

    @cached_property
    def v_games(self) -> DataFrame:
        return self.games_of(self.v_game_details_dedup)

    def games_of(self, gd: DataFrame) -> DataFrame:
        """Games with their winner from de-duplicated (perhaps staged) details."""
        team_pts = gd.groupBy("game_id", "team_id").agg(F.sum("pts").alias("team_pts"))
        # winner = highest point sum, ties to the lowest team_id: one hash aggregate
        # with a struct max, no per-game sort
        win = (team_pts.groupBy("game_id")
               .agg(F.max(F.struct(F.col("team_pts"), (-F.col("team_id")).alias("neg")))
                    .alias("w"))
               .select("game_id", (-F.col("w.neg")).alias("winner_team_id")))
        o = self.t.orders.select(F.col("o_orderkey").alias("game_id"),
                                 F.to_date("o_orderdate").alias("game_date"),
                                 F.year("o_orderdate").alias("season"))
        return o.join(win, "game_id")

    @cached_property
    def v_teams(self) -> DataFrame:
        s, n, r = self.t.supplier, self.t.nation, self.t.region
        j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        return j.select(
            F.col("s_nationkey").cast("long").alias("team_id"),
            F.col("n_name").alias("abbreviation"),
            F.col("s_name").alias("nickname"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("arena"),
            (F.lit(1900) + F.col("n_nationkey")).cast("long").alias("yearfounded"))

    # -- web events --------------------------------------------------------------
    @cached_property
    def v_events(self) -> DataFrame:
        # parse the JSON once; the derived columns read the parsed value
        e = self.t.events.select("event_id", "event_type", "user_id", "ts",
                                 F.get_json_object("props", "$.k").cast("int").alias("__k"))
        k = F.col("__k")
        # rows with event_id % 50 = 0 appear twice: generated from ONE scan
        copies = F.explode(F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1)))
                           .otherwise(F.array(F.lit(0))))
        return e.select(
            "event_id",
            F.when(F.col("event_type") == "purchase", F.lit("/api/v1/user"))
             .otherwise(F.concat(F.lit("/"), F.col("event_type"))).alias("url"),
            _pick(REFERRERS, k % 8).alias("referrer"),
            F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("long"))
             .otherwise(F.col("user_id")).alias("user_id"),
            # some devices are not in the catalogue: their ids are negative
            F.when(k % 11 == 10, -k).otherwise(k).alias("device_id"),
            _pick(HOSTS, F.col("user_id") % 3).alias("host"),
            F.col("ts").alias("event_time"),
            copies.alias("__copy")).drop("__copy")

    @cached_property
    def v_devices(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("device_id"),
            F.col("p_brand").alias("browser_type"),
            F.when(F.col("p_size") < 5, F.lit(None).cast("string"))
             .otherwise(F.col("p_type")).alias("os_type"),
            F.split("p_name", " ").getItem(0).alias("device_type"))

    @cached_property
    def v_web_events(self) -> DataFrame:
        e = self.v_events
        return e.select(
            "event_id",
            (F.col("user_id") * 1000 + F.abs("device_id")).alias("ip"),
            "referrer", "host", "url",
            F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"))

    @cached_property
    def v_geo_ranges(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        j = n.join(r, n.n_regionkey == r.r_regionkey)
        return j.select(
            (F.col("n_nationkey").cast("long") * 6000).alias("lo"),
            (F.col("n_nationkey").cast("long") * 6000 + 4999).alias("hi"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("city"))

    @cached_property
    def v_geo_nested(self) -> DataFrame:
        """Nested and overlapping address blocks: streets, countries, regions, the world."""
        s = self.t.supplier.select(F.col("s_suppkey") * 331, F.col("s_suppkey") * 331 + (F.col("s_suppkey") % 7) * 40, F.concat(F.lit("street "), F.col("s_name")))
        n = self.v_geo_ranges.select("lo", "hi", F.concat(F.lit("country "), F.col("country")))
        r = self.t.region.select(F.col("r_regionkey").cast("long") * 300_000, F.col("r_regionkey").cast("long") * 300_000 + 599_999, F.concat(F.lit("region "), F.col("r_name")))
        world = self.t.region.where("r_regionkey = 0").select(F.lit(0).cast("long"), F.lit((1 << 40) - 1), F.lit("world"))
        return s.union(n).union(r).union(world).toDF("lo", "hi", "name")

    # -- matches -----------------------------------------------------------------
    @cached_property
    def v_matches(self) -> DataFrame:
        o, c = self.t.orders, self.t.customer
        j = o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey)
        return j.select(
            F.col("o_orderkey").alias("match_id"),
            F.col("o_orderpriority").alias("playlist_id"),
            F.col("c_nationkey").alias("mapid"),
            F.col("o_orderdate").alias("completion_date"),
            (F.col("o_orderstatus") == "F").alias("is_team_game"))

    @cached_property
    def v_match_details(self) -> DataFrame:
        return (self.t.lineitem.groupBy(F.col("l_orderkey").alias("match_id"),
                                        F.col("l_suppkey").alias("player_gamertag"))
                .agg(F.sum(F.col("l_quantity").cast("long")).alias("player_total_kills"),
                     F.count(F.lit(1)).alias("player_total_deaths")))

    @cached_property
    def v_medals_matches_players(self) -> DataFrame:
        return (self.t.lineitem.groupBy(F.col("l_orderkey").alias("match_id"),
                                        F.col("l_suppkey").alias("player_gamertag"),
                                        F.col("l_partkey").alias("medal_id"))
                .agg(F.sum(F.col("l_linenumber").cast("long")).alias("count")))

    @cached_property
    def v_medals(self) -> DataFrame:
        return (self.t.part
                .select(F.col("p_partkey").alias("medal_id"), F.col("p_name").alias("name"),
                        F.col("p_type").alias("classification")))

    @cached_property
    def v_maps(self) -> DataFrame:
        return self.t.nation.select(F.col("n_nationkey").alias("mapid"),
                                    F.col("n_name").alias("name"))

    # -- KPI source ---------------------------------------------------------------
    @cached_property
    def v_profit(self) -> DataFrame:
        li = self.t.lineitem
        return li.select(
            F.col("l_orderkey").alias("unit"),
            F.to_date("l_shipdate").alias("day"),
            F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100)
             .cast("long").alias("profit"))
