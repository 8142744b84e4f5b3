"""Pairs of big groups in triangle cells, and distinct counts over grouping sets, against plain forms."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import graph, olap
from tidemark.plans.explain import count_ops, plan_text
from tidemark.sources.fixtures import Views

FACTS = "game long, player long, name string, team string, pts long"


def edges_of(df, cell_rows):
    return sorted(tuple(r) for r in graph.co_occurrence_edges(df, "game", "player", "name", "team", "pts", "same", "against", cell_rows).collect())


def brute(rows):
    by_game, out = defaultdict(list), {}
    for g, *r in rows:
        if g is not None and r[0] is not None:
            by_game[g].append(r)
    for members in by_game.values():
        for a in members:
            for b in members:
                if a[0] > b[0] and None not in (a[1], b[1]) and a[1] != b[1]:
                    rel = "same" if a[2] == b[2] else "against"
                    n, x, y = out.get((a[0], a[1], b[0], b[1], rel), (0, 0, 0))
                    out[a[0], a[1], b[0], b[1], rel] = (n + 1, x + a[3], y + b[3])
    return sorted((*k, *v) for k, v in out.items())


@pytest.mark.parametrize("cell_rows", [1, 7, 2000])
def test_edges_with_a_hot_game(spark, cell_rows):
    r = random.Random(3)
    rows = [(0 if i % 3 == 0 else r.randrange(1, 30), p, f"n{p % 40}", r.choice("xy"), r.randrange(30)) for i, p in enumerate(r.choices(range(60), k=150))]
    rows += [(None, 1, "n1", "x", 1), (0, None, "n", "x", 1), (0, 3, None, "x", 1), (5, 9, "n9", "x", 4), (5, 9, "n9", "x", 4)]
    assert edges_of(spark.createDataFrame(rows, FACTS), cell_rows) == brute(rows)


def test_a_hot_game_is_spread_over_tasks(spark):
    df = spark.range(3000).select(F.lit(1).cast("long").alias("game"), F.col("id").alias("player"), F.lit("n").alias("name"), F.lit("t").alias("team"), F.lit(1).alias("pts"))
    left, right = graph.pair_cells(df, "game", "player", 100)
    cells = left.groupBy("game", "__i", "__j").count().join(right.groupBy("game", "__i", "__j").count().withColumnRenamed("count", "n"), ["game", "__i", "__j"]).collect()
    assert len(cells) == 30 * 31 // 2 and max(c["count"] * c["n"] for c in cells) < 4 * 100 * 100
    assert left.count() == right.count() or left.count() + right.count() == 3000 * 31
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = [x["count"] for x in left.repartition(8, "game", "__i", "__j").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(per) == 8 and max(per) < 2 * min(per), per


def test_cells_plan_sums_before_the_pair_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a", "x", 1)], FACTS)
    txt = plan_text(graph.co_occurrence_edges(df, "game", "player", "name", "team", "pts", "s", "d"))
    assert "NestedLoop" not in txt and "Cartesian" not in txt and "partial_count(1)" in txt


SETS = [["a", "b"], ["a", "c"], ["b"], []]
LABELS = {frozenset(s): "-".join(s) or "all" for s in SETS}


def test_distinct_counts_over_grouping_sets(spark):
    r = random.Random(6)
    rows = [(r.choice("xyz"), r.choice([None, "u", "v"]), r.randrange(3), r.choice([None, *range(12)]) if r.random() < 0.6 else 1, r.randrange(9), r.choice([True, False, None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, c int, item long, v long, f boolean")
    got = olap.grouping_sets_over_items(df, SETS, LABELS, "item", {"total": F.sum("v")}, "items", {"flagged": F.col("f")})
    want = olap.labelled_grouping_sets(df, SETS, LABELS, {"total": F.sum("v"), "items": F.count_distinct("item"),
                                                          "flagged": F.count_distinct(F.when(F.col("f"), F.col("item")))})
    key = lambda d: sorted((tuple(x) for x in d.select("aggregation_level", "a", "b", "c", "total", "items", "flagged").collect()), key=repr)
    assert key(got) == key(want)
    assert count_ops(got, "Expand") == 1
    assert key(olap.grouping_sets_over_items(df.limit(0), SETS[:3], LABELS, "item", {"total": F.sum("v")}, "items", {"flagged": F.col("f")})) == []


def test_edges_of_small_and_big_games_together(spark):
    """Pairs that meet in both kinds of game are one edge; small games are joined from one shuffle by game."""
    r = random.Random(5)
    rows = [(0 if i % 3 == 0 else r.randrange(1, 30), p, f"n{p % 40}", r.choice("xy"), r.randrange(30)) for i, p in enumerate(r.choices(range(60), k=150))]
    rows += [(None, 1, "n1", "x", 1), (0, None, "n", "x", 1), (4, None, "n", "x", 1), (5, 3, None, "x", 1), (5, 9, "n9", "x", 4), (5, 9, "n9", "x", 4)]
    df = spark.createDataFrame(rows, FACTS)
    names = ("game", "player", "name", "team", "pts", "same", "against")
    small = df.where("game IS NULL OR game > 0")
    got = graph.co_occurrence_edges(df.where("game = 0"), *names, cell_rows=7, small=small)
    assert sorted(tuple(x) for x in got.collect()) == brute(rows)
    alone = graph.small_group_edges(small.repartition(3, "game"), *names)
    assert sorted(tuple(x) for x in alone.collect()) == brute([x for x in rows if x[0] != 0])
    txt = plan_text(graph.small_group_edges(small.repartition(3, "game"), *names))
    assert txt.count("hashpartitioning(game") <= 2 and "ENSURE_REQUIREMENTS" not in "".join(x for x in txt.splitlines() if "hashpartitioning(game" in x), txt


def _game_tables(tmp_path, spark, lines):
    """A folder with line items of two suppliers a nation, given as (order, supplier, line, part, quantity)."""
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put("lineitem", [(o, p, s, n, float(q), 1.0 * i, 0.0, 0.0, "N", "O", None) for i, (o, s, n, p, q) in enumerate(lines)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    put("supplier", [(s, f"S{s}", s // 2, 0.0) for s in range(40)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    put("nation", [(k, f"N{k}", 0) for k in range(20)], "n_nationkey int, n_name string, n_regionkey int")
    return str(tmp_path)


@pytest.mark.parametrize("big_rows", [2000, 12])
def test_details_by_game_are_the_deduplicated_ones(spark, tmp_path, big_rows):
    r = random.Random(8)
    lines = [(r.choice([0, 0, *range(1, 25), None]), r.choice([*range(40), None]), r.choice([1, 1, 2, None]), r.choice([5, 5, 6, None]), r.randrange(1, 4)) for _ in range(400)]
    v = Views(spark, _game_tables(tmp_path, spark, lines))
    cols = ["player_name", "team_id", "team_abbreviation", "pts"]
    small, big = v.details_by_game(cols, task_rows=50, big_rows=big_rows)
    assert (big is None) == (big_rows == 2000) and small.rdd.getNumPartitions() == -(-sum(x[0] is not None for x in lines) // 50)
    got = small if big is None else small.unionByName(big)
    want = v.v_game_details_dedup.where("game_id IS NOT NULL").select("game_id", "player_id", *cols)
    key = lambda d: sorted((tuple(x) for x in d.collect()), key=repr)
    assert key(got) == key(want)


def test_marks_of_dealt_items_need_no_shuffle_by_item(spark):
    """Rows dealt by item stay where they lie: what is aggregated has a row per group and task, not one per row and set."""
    df = spark.range(1200).select((F.col("id") % 4).cast("string").alias("a"), F.lit("u").alias("b"), F.lit(1).alias("c"), (F.col("id") % 300).alias("item"),
                                  F.lit(1).alias("v"), (F.col("id") % 2 == 0).alias("f"))
    got = olap.grouping_sets_over_items(df.repartition(3, "item"), SETS, LABELS, "item", {"total": F.sum("v")}, "items", {"flagged": F.col("f")})
    by_item = [x for x in plan_text(got).splitlines() if "hashpartitioning(" in x and "item#" in x]
    assert len(by_item) == 1 and "REPARTITION_BY_NUM" in by_item[0], plan_text(got)
    assert {(x.a, x.total, x.items, x.flagged) for x in got.where("aggregation_level = 'a-b'").collect()} == {(str(i), 300, 75, 75 * (i % 2 == 0)) for i in range(4)}
