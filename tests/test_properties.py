"""Properties between step and batch forms, idempotent sinks, exact semantics."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing import assertDataFrameEqual

from tidemark.operators import dims, facts, growth, olap, windows
from tidemark.operators.joins import range_join
from tidemark.plans import queries as Q
from tidemark.session import scratch_path
from tidemark.sources import writers as W
from tidemark.sources.fixtures import Views
from tidemark.sources.tables import enforce_schema, split_valid

from .conftest import SF_SMALL


def _flat(df):
    return Q._flat_players(df)


def test_cumulative_step_iterated_equals_backfill(spark):
    v = Views(spark, SF_SMALL)
    ps = v.v_player_seasons
    first, last = ps.agg(F.min("season"), F.max("season")).first()
    full = dims.backfill_dim(ps, last)
    prev = full.limit(0)
    for season in range(first, last + 1):
        cur = ps.where(F.col("season") == season)
        prev = dims.cumulate_dim(prev, cur, season).checkpoint()  # cut lineage per period
        expected = full.where(F.col("current_season") == season)
        assertDataFrameEqual(_flat(prev), _flat(expected))


def test_scd_incremental_equals_backfill(spark):
    v = Views(spark, SF_SMALL)
    attrs = ("scoring_class", "is_active")
    s = Q.STEP_SEASON
    prev_scd = dims.scd2_backfill(Q.players_backfill(v, s - 1), attrs=attrs)
    cur = Q.players_backfill(v, s).where(F.col("current_season") == s)
    inc = dims.scd2_incremental(prev_scd, cur, s, attrs=attrs)
    full = dims.scd2_backfill(Q.players_backfill(v, s), attrs=attrs)
    assertDataFrameEqual(inc, full)


def test_month_array_step_equals_backfill(spark):
    v = Views(spark, SF_SMALL)
    daily = facts.daily_counts(v.v_events)
    for fill in (0, None):
        prev = facts.month_array_backfill(daily, "2024-01-14", fill=fill)
        today = daily.where(F.col("date") == F.lit("2024-01-15").cast("date"))
        step = facts.cumulate_month(prev, today, "2024-01-15", fill=fill)
        assertDataFrameEqual(step, facts.month_array_backfill(daily, "2024-01-15", fill=fill))


def test_month_array_pads_skipped_days(spark):
    prev = spark.createDataFrame([(1, dt.date(2024, 1, 1), [3, 4])],
                                 "user_id long, month_start date, metric_array array<bigint>")
    today = spark.createDataFrame([(2, 5)], "user_id long, num_site_hits long")
    out = {r.user_id: r.metric_array for r in facts.cumulate_month(prev, today, "2024-01-05").collect()}
    assert out == {1: [3, 4, 0, 0, 0], 2: [0, 0, 0, 0, 5]}


def test_growth_step_equals_backfill(spark):
    v = Views(spark, SF_SMALL)
    e = v.v_events
    prev = growth.growth_backfill(e, "2024-01-19").where(F.col("date") == F.lit("2024-01-19").cast("date"))
    step = growth.growth_step(prev, e, "2024-01-20")
    full = growth.growth_backfill(e, "2024-01-20").where(F.col("date") == F.lit("2024-01-20").cast("date"))
    assertDataFrameEqual(step, full.select(*step.columns))


def test_dates_step_equals_backfill(spark):
    v = Views(spark, SF_SMALL)
    prev = facts.dates_backfill(v.v_events, "2024-01-09")
    step = facts.cumulate_dates(prev, v.v_events, "2024-01-10")
    assertDataFrameEqual(step, facts.dates_backfill(v.v_events, "2024-01-10").select(*step.columns))


def test_datelist_bits_modes(spark):
    df = spark.createDataFrame([([dt.date(2024, 1, 30), dt.date(2024, 1, 29), dt.date(2023, 12, 1)],)],
                               "dates array<date>")
    r = df.select(facts.datelist_int("dates", "2024-01-30").alias("b"),
                  facts.datelist_int("dates", "2024-01-30", mode="reference").alias("r")).first()
    assert r.b == (1 << 31) | (1 << 30)
    assert r.r == (1 << 31)  # today's 2^32 is truncated away


def test_upsert_is_idempotent(spark):
    path = scratch_path(spark, "upsert-test")
    base = spark.createDataFrame([(1, "2024-01", 10), (2, "2024-01", 20), (3, "2024-02", 30)],
                                 "k long, m string, v long")
    W.write_snapshot(base, path, ["m"])
    upd = spark.createDataFrame([(2, "2024-01", 21), (4, "2024-01", 40)], "k long, m string, v long")
    W.merge_upsert(spark, path, upd, ["k", "m"], ["m"])
    once = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "m", "v").collect())
    W.merge_upsert(spark, path, upd, ["k", "m"], ["m"])
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "m", "v").collect())
    assert once == twice == [(1, "2024-01", 10), (2, "2024-01", 21), (3, "2024-02", 30), (4, "2024-01", 40)]


def test_enforce_schema_rejects(spark):
    raw = spark.createDataFrame([("1", "x"), ("abc", "y"), (None, "z")], "id string, name string")
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())])
    valid, rejected = split_valid(enforce_schema(raw, schema))
    assert [tuple(r) for r in valid.collect()] == [(1, "x")]
    assert sorted(r.reject_reason for r in rejected.collect()) == ["bad id", "missing id"]


def test_range_join_matches_brute_force(spark):
    pts = spark.createDataFrame(list(enumerate([5, 999, 1000, 2500, 7000, None, 12000])),
                                "id long, ip long")
    rng = spark.createDataFrame([(0, 1500, "a"), (1400, 2600, "b"), (6000, 6999, "c"), (11000, 13050, "d")],
                                "lo long, hi long, name string")
    got = sorted((r.id, r.name) for r in range_join(pts, rng, "ip", "lo", "hi", 1000).collect())
    p, r = pts.toPandas(), rng.toPandas()
    exp = []
    for row in p.itertuples():
        m = r[(r.lo <= row.ip) & (r.hi >= row.ip)] if pd.notna(row.ip) else r.iloc[0:0]
        exp += [(row.id, n) for n in m["name"]] or [(row.id, None)]
    assert got == sorted(exp, key=lambda t: (t[0], t[1] or ""))


def test_max_stretch_and_longest_run_brute_force(spark):
    import random
    rnd = random.Random(7)
    data = []
    for key in range(3):
        for g in range(200):
            data.append((key, dt.date(2024, 1, 1) + dt.timedelta(days=g // 3), g, rnd.randint(0, 1)))
    df = spark.createDataFrame(data, "k long, d date, gid long, won long")
    got = {r.k: r.best for r in olap.max_stretch_sum(df, ["k"], "d", "gid", "won", 10, out="best").collect()}
    runs = {r.k: r.lr for r in windows.longest_run(df, ["k"], ["d", "gid"], F.col("won") == 1, out="lr").collect()}
    pdf = pd.DataFrame(data, columns=["k", "d", "gid", "won"]).sort_values(["k", "d", "gid"])
    for k, grp in pdf.groupby("k"):
        w = grp["won"].tolist()
        assert got[k] == max(sum(w[max(0, i - 9):i + 1]) for i in range(len(w)))
        best = cur = 0
        for x in w:
            cur = cur + 1 if x == 1 else 0
            best = max(best, cur)
        assert runs[k] == best


def test_funnel_window_equals_self_join_semantics(spark):
    rows = [(1, "2024-01-01 10:00:00", "/signup"), (1, "2024-01-01 10:05:00", "/api/v1/user"),
            (1, "2024-01-01 11:00:00", "/view"), (2, "2024-01-01 09:00:00", "/signup"),
            (2, "2024-01-02 09:00:00", "/api/v1/user")]
    e = spark.createDataFrame(rows, "user_id long, t string, url string").select(
        "user_id", F.col("t").cast("timestamp_ntz").alias("event_time"), "url")
    out = {r.url: (r.num_events, r.conversion_rate) for r in growth.funnel(e).collect()}
    # user 1: /signup followed by conversion; /api/v1/user followed by /view only
    assert out == {"/signup": (1, 1.0)}
    allrows = {r.url: r.num_events for r in growth.funnel(e, denominator="all").collect()}
    assert allrows["/signup"] == 2


def test_cached_rollups_and_csv(spark, tmp_path):
    from tidemark.operators.rollups import user_device_rollups
    from tidemark.sources.tables import read_csv
    v = Views(spark, SF_SMALL)
    users, devs, release = user_device_rollups(v.v_events, v.v_devices)
    pairs = v.v_events.where("user_id is not null").select("user_id", "device_id").distinct()
    assert users.count() == pairs.count()
    assert devs.count() == pairs.join(v.v_devices, "device_id").count() > 0
    per = {r.user_id: (r.num_devices, r.total_hits) for r in users.collect()}
    for r in users.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_counts").alias("m")).collect():
        assert per[r.user_id] == (r.n, r.m)
    release()
    p = tmp_path / "maps.csv"
    p.write_text("mapid,name,description\nm1,Alpha,first\nm2,Beta,\n")
    schema = T.StructType([T.StructField("mapid", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("description", T.StringType())])
    rows = read_csv(spark, str(p), schema).orderBy("mapid").collect()
    assert [tuple(r) for r in rows] == [("m1", "Alpha", "first"), ("m2", "Beta", None)]
    assert read_csv(spark, str(p)).schema["mapid"].dataType == T.StringType()


def test_actor_step_iterated_equals_backfill(spark):
    v = Views(spark, SF_SMALL)
    films = v.v_actor_films
    first, last = films.agg(F.min("year"), F.max("year")).first()
    for with_films in (True, False):
        full = dims.backfill_actors(films, last, with_films=with_films)
        prev = full.limit(0)
        for year in range(first, last + 1):
            prev = dims.cumulate_actors(prev, films.where(F.col("year") == year), year,
                                        with_films=with_films).checkpoint()
            exp = full.where(F.col("current_year") == year)
            cols = ["actorid", "actor", "quality_class", "is_active", "current_year"]
            extra = ([F.size("films").alias("nf")] if with_films
                     else [F.col("num_films").alias("nf"), "total_votes"])
            assertDataFrameEqual(prev.select(*cols, *extra), exp.select(*cols, *extra))


def test_insert_by_name(spark):
    path = scratch_path(spark, "by-name")
    spark.createDataFrame([(1, "a")], "k long, v string").write.mode("overwrite").option("path", path) \
        .saveAsTable("by_name_t")
    W.insert_by_name(spark, spark.createDataFrame([("b", 2)], "v string, k long"), "by_name_t")
    assert sorted(tuple(r) for r in spark.table("by_name_t").collect()) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE by_name_t")


def test_run_periods_equals_backfill(spark):
    from tidemark.plans.periodic import run_periods
    v = Views(spark, SF_SMALL)
    days = [f"2024-01-{d:02d}" for d in range(1, 6)]
    empty = facts.dates_backfill(v.v_events, "2024-01-01").limit(0)
    path = scratch_path(spark, "periods")
    table = run_periods(spark, path, days, empty,
                        lambda prev, d: facts.cumulate_dates(prev.drop("snapshot"), v.v_events, d),
                        "snapshot")
    last = table.where(F.col("snapshot") == "2024-01-05").drop("snapshot")
    assertDataFrameEqual(last, facts.dates_backfill(v.v_events, "2024-01-05").select(*last.columns))
    n = last.count()
    # re-running one period replaces it
    run_periods(spark, path, ["2024-01-05"], table.where(F.col("snapshot") == "2024-01-04"),
                lambda prev, d: facts.cumulate_dates(prev.drop("snapshot"), v.v_events, d), "snapshot")
    assert spark.read.parquet(path).where(F.col("snapshot") == "2024-01-05").count() == n


def test_reduced_fact_approx_visitors_close(spark):
    v = Views(spark, SF_SMALL)
    exact = {r.host: r.unique_visitors for r in facts.reduced_month_fact(v.v_events, "2024-01-30").collect()}
    approx = {r.host: r.unique_visitors
              for r in facts.reduced_month_fact(v.v_events, "2024-01-30", approx_visitors=True).collect()}
    assert exact.keys() == approx.keys()
    for h in exact:
        assert all(abs(a - b) <= max(1, 0.1 * b) for a, b in zip(approx[h], exact[h]))


def test_growth_backfill_equals_iterated_steps_random(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for u in range(12):
        for day in range(1, 21):
            if rnd.random() < (0.15 if u % 3 == 0 else 0.5):
                rows.append((u, f"2024-02-{day:02d} 10:00:00"))
    ev = spark.createDataFrame(rows, "user_id long, t string").select(
        "user_id", F.col("t").cast("timestamp_ntz").alias("event_time"))
    full = growth.growth_backfill(ev, "2024-02-20")
    prev = full.limit(0).drop("num_dates")
    cols = ["user_id", "first_active_date", "last_active_date", "daily_active_state",
            "weekly_active_state", "date"]
    for day in range(1, 21):
        d = f"2024-02-{day:02d}"
        prev = growth.growth_step(prev, ev, d).checkpoint()
        exp = full.where(F.col("date") == F.lit(d).cast("date"))
        assertDataFrameEqual(prev.select(*cols, F.size("dates_active").alias("n")),
                             exp.select(*cols, F.col("num_dates").alias("n")))


def test_range_join_random_against_brute_force(spark):
    import random
    rnd = random.Random(5)
    ranges = []
    for i in range(40):
        lo = rnd.randint(0, 50_000)
        ranges.append((lo, lo + rnd.randint(0, 4_000), f"r{i}"))
    points = [(i, rnd.randint(-100, 56_000)) for i in range(300)]
    pts = spark.createDataFrame(points, "id long, ip long")
    rng = spark.createDataFrame(ranges, "lo long, hi long, name string")
    for block in (250, 1000, 7000):
        got = sorted((r.id, r.name or "") for r in range_join(pts, rng, "ip", "lo", "hi", block).collect())
        exp = []
        for pid, ip in points:
            hits = [n for lo, hi, n in ranges if lo <= ip <= hi]
            exp += [(pid, n) for n in hits] or [(pid, "")]
        assert got == sorted(exp)


def test_reduced_month_step_equals_the_whole_month(spark):
    """Random days, a month's change, skipped days and days that run again."""
    rng = np.random.default_rng(5)
    start = dt.datetime(2024, 1, 20)
    rows = [(f"h{rng.integers(3)}" if rng.random() > .05 else None, int(rng.integers(4)) if rng.random() > .1 else None,
             start + dt.timedelta(hours=int(rng.integers(24 * 20)))) for _ in range(120)]
    ev = spark.createDataFrame(rows, "host string, user_id long, event_time timestamp_ntz")
    state = facts.reduced_month_fact(ev, "2024-01-29")
    for day in ("2024-01-30", "2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02", "2024-02-02"):
        state = facts.reduced_month_step(state, ev, day).checkpoint()
        assertDataFrameEqual(state, facts.reduced_month_fact(ev, day))
    # a day that is skipped counts as a day without events
    gap = facts.reduced_month_step(state, ev, "2024-02-05")
    without = ev.where(~F.to_date("event_time").isin(dt.date(2024, 2, 3), dt.date(2024, 2, 4)))
    assertDataFrameEqual(gap, facts.reduced_month_fact(without, "2024-02-05"))


def test_actor_step_onto_history_equals_history(spark):
    films = Views(spark, SF_SMALL).v_actor_films
    by = {"key": ("actorid",), "period": "current_year", "attrs": ("quality_class", "is_active")}
    snaps = dims.backfill_actors(films, 2001, with_films=False).checkpoint()
    scd = dims.scd2_backfill(snaps.where("current_year <= 1998"), **by)
    for year in (1999, 2000, 2001):
        scd = dims.scd2_incremental(scd, snaps.where(F.col("current_year") == year), year, **by).checkpoint()
        assertDataFrameEqual(scd, dims.scd2_backfill(snaps.where(F.col("current_year") <= year), **by))


def test_geo_json_udf_quotes_and_nulls(spark):
    import json
    from tidemark.functions.udfs import register_udfs
    register_udfs(spark)
    rows = [(1, "a", "s", "c"), (2, None, "s", "c"), (3, 'q"\\x', None, "\u00e9"), (4, "a", "s", None)]
    spark.createDataFrame(rows, "id int, country string, state string, city string").createOrReplaceTempView("geo_rows")
    got = {r.id: r.g for r in spark.sql("SELECT id, geo_json(country, state, city) AS g FROM geo_rows").collect()}
    assert got == {i: json.dumps({"country": c, "state": s, "city": t}, separators=(",", ":")) if c is not None else "{}" for i, c, s, t in rows}
    assert spark.sql("SELECT geo_json(country, state, city) AS g FROM geo_rows WHERE id > 9").count() == 0


def test_season_slots_and_compaction(spark):
    df = spark.createDataFrame([("a", 2001, 1, 1.0, 1.0, 1.0), ("a", 2004, 2, 2.0, 2.0, 2.0), ("b", 2004, 3, 3.0, 3.0, 3.0)],
                               "player_name string, season int, gp long, pts double, ast double, reb double")
    out = {r.player_name: r for r in dims.season_slots(df, 2005).select("*", F.array_compact("slots").alias("c")).collect()}
    assert [s and s.gp for s in out["a"].slots] == [1, None, None, 2, None] and [s.season for s in out["a"].c] == [2001, 2004]
    assert [s and s.gp for s in out["b"].slots] == [3, None] and len(out["b"].c) == 1
