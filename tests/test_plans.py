"""Plan-shape checks: shuffles that must not be there, joins that must be
broadcast, pushdown and pruning that must reach the scan."""

from pyspark.sql import functions as F

from tidemark.operators import dims
from tidemark.plans import queries as Q
from tidemark.plans.explain import count_ops, plan_text
from tidemark.sources.fixtures import Views

from .conftest import SF_SMALL


def test_bucket_join_has_no_exchange(spark):
    v = Views(spark, SF_SMALL)
    tables = Q.bucketed_match_tables(spark, v)
    out = Q.bucket_join(tables)
    assert count_ops(out, "Exchange") == 0, plan_text(out)
    assert count_ops(out, "SortMergeJoin") == 2


def test_explicit_broadcast_without_auto_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.q_broadcast_map_medal(spark, SF_SMALL)
        # the maps; medals grow with the data and carry no hint
        assert count_ops(out, "BroadcastHashJoin") == 1, plan_text(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scd_window_and_aggregate_share_one_shuffle(spark):
    src = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")],
                                "player_name string, current_season int, scoring_class string")
    out = dims.scd2_backfill(src)
    assert count_ops(out, "Exchange") == 1, plan_text(out)


def test_backfill_is_one_shuffle_over_its_input(spark):
    src = spark.createDataFrame([("a", 2000, 1, 25.0, 1.0, 1.0, 1, "1", "c")],
                                "player_name string, season int, gp long, pts double, ast double, reb double, "
                                "weight int, country string, college string")
    out = dims.backfill_dim(src, 2003)
    assert count_ops(out, "Exchange") == 1, plan_text(out)
    assert out.count() == 4


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = Q.q_daily_user_hits(spark, SF_SMALL)
    txt = plan_text(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in txt, txt
    df2 = Views(spark, SF_SMALL).v_events.where(F.col("event_time") < F.lit("2024-01-05").cast("timestamp_ntz"))
    assert "LessThan(ts," in plan_text(df2)


def test_funnel_has_no_nested_loop_or_cartesian(spark):
    df = Q.q_funnel_conversion(spark, SF_SMALL)
    txt = plan_text(df)
    assert "NestedLoop" not in txt and "Cartesian" not in txt


def test_range_join_is_equi_join(spark):
    df = Q.q_geo_enrich(spark, SF_SMALL)
    txt = plan_text(df)
    assert "NestedLoop" not in txt and "Cartesian" not in txt


def test_first_per_key_limits_before_the_shuffle(spark):
    df = Q.q_team_vertices(spark, SF_SMALL)
    txt = plan_text(df, "simple")
    assert "WindowGroupLimit" in txt and "Partial" in txt, txt


def test_date_predicate_of_the_dimension_side_reaches_its_scan(spark):
    tables = Q.bucketed_match_tables(spark, Views(spark, SF_SMALL), only=("match_details", "matches"))
    out = Q.matches_on_day(tables, Q.MATCH_DAY)
    assert count_ops(out, "Exchange") == 0, plan_text(out)
    assert "GreaterThanOrEqual(completion_date" in plan_text(out), plan_text(out)
