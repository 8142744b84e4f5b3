"""The rules of the cumulative operators on small literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dims, facts, graph
from tidemark.session import LOCAL_DEFAULTS, get_spark


def history(spark, rows):
    src = spark.createDataFrame(rows, "player_name string, current_season int, scoring_class string")
    got = dims.scd2_backfill(src).collect()
    return sorted((r.player_name, r.start_date, r.end_date, r.scoring_class) for r in got)


def test_history_single_row(spark):
    assert history(spark, [("ann", 7, "bad")]) == [("ann", 7, 7, "bad")]


def test_history_runs_and_returns_to_an_old_value(spark):
    rows = [("ann", 1, "good"), ("ann", 2, "good"), ("ann", 3, "star"), ("ann", 4, "good"), ("bo", 2, "bad"), ("bo", 3, "bad")]
    assert history(spark, rows) == [("ann", 1, 2, "good"), ("ann", 3, 3, "star"), ("ann", 4, 4, "good"), ("bo", 2, 3, "bad")]


def test_history_null_is_a_value_of_its_own(spark):
    src = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 3, None), ("a", 4, "x")],
                                "player_name string, current_season int, scoring_class string")
    out = dims.scd2_backfill(src).orderBy("start_date").collect()
    assert [(r.scoring_class, r.start_date, r.end_date) for r in out] == [("x", 1, 1), (None, 2, 3), ("x", 4, 4)]


def test_vertex_keeps_one_row_per_id(spark):
    src = spark.createDataFrame([(5, "north", 10), (5, "south", 11), (6, None, 12)], "id long, name string, size long")
    out = graph.vertices(src, "id", "place", [("name", F.col("name")), ("size", F.col("size"))], order=[F.col("size")])
    got = {r.identifier: (r.type, r.properties) for r in out.collect()}
    assert set(got) == {5, 6}
    assert got[5] == ("place", {"name": "north", "size": "10"})


def test_position_sums_with_short_empty_and_null_arrays(spark):
    src = spark.createDataFrame([("m1", [4, None, 6, 9]), ("m1", [1]), ("m2", []), ("m2", None)], "month_start string, hit_array array<bigint>")
    got = {r.month_start: (r.a, r.b, r.c) for r in facts.position_sums(src, 3, names=["a", "b", "c"]).collect()}
    assert got == {"m1": (5, 0, 6), "m2": (0, 0, 0)}


MONTH = "user_id long, month_start date, metric_array array<bigint>"


def step(spark, prev, today, day):
    out = facts.cumulate_month(spark.createDataFrame(prev, MONTH), spark.createDataFrame(today, "user_id long, num_site_hits long"), day)
    return {r.user_id: (r.month_start, r.metric_array) for r in out.collect()}


def test_month_step_starts_a_new_month_afresh(spark):
    got = step(spark, [(1, dt.date(2024, 1, 1), [7] * 31)], [(1, 2), (2, 3)], "2024-02-01")
    assert got == {1: (dt.date(2024, 2, 1), [2]), 2: (dt.date(2024, 2, 1), [3])}


def test_month_step_can_run_again(spark):
    got = step(spark, [(1, dt.date(2024, 1, 1), [5, 6]), (2, dt.date(2024, 1, 1), [0, 9])], [(1, 6)], "2024-01-02")
    assert got == {1: (dt.date(2024, 1, 1), [5, 6]), 2: (dt.date(2024, 1, 1), [0, 0])}


def test_upsert_refuses_two_updates_of_a_key(spark):
    old = spark.createDataFrame([(1, "a")], "k long, v string")
    new = spark.createDataFrame([(2, "b"), (2, "c")], "k long, v string")
    with pytest.raises(Exception, match="more than one update row"):
        facts.upsert(old, new, ["k"]).collect()


def test_actor_whose_first_film_is_later_than_the_last_year(spark):
    films = spark.createDataFrame([(1, "a", "f", 1999, 3, 9.0, "x"), (2, "b", "g", 2005, 1, 5.0, "y")],
                                  "actorid long, actor string, film string, year int, votes long, rating double, filmid string")
    assert {r.actorid for r in dims.backfill_actors(films, 2000).collect()} == {1}


def test_a_configured_partition_count_is_kept(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark(app="tidemark-tests").conf.get("spark.sql.shuffle.partitions") == before
    assert "spark.sql.shuffle.partitions" in LOCAL_DEFAULTS
