"""Distributed prefix scan, and the operators on it, against plain Python."""

import random

from pyspark.sql import functions as F

from tidemark.operators import olap, scan, windows
from tidemark.plans.explain import plan_text


def _brute(rows, n):
    per = {}
    for k, d, g, v in sorted(rows, key=lambda r: (r[0] is not None, r)):
        per.setdefault(k, []).append(v)
    best = {k: max(sum(v[max(0, i - n + 1):i + 1]) for i in range(len(v))) for k, v in per.items()}
    runs = {}
    for k, v in per.items():
        cur = top = 0
        for x in v:
            cur = cur + 1 if x else 0
            top = max(top, cur)
        runs[k] = top
    return best, runs


def _check(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, d int, g long, v long")
    best, runs = _brute(rows, n)
    assert {r.k: r.b for r in olap.max_stretch_sum(df, ["k"], "d", "g", "v", n, out="b").collect()} == best
    assert {r.k: r.b for r in windows.longest_run(df, ["k"], ["d", "g"], F.col("v") == 1, out="b").collect()} == runs


def test_scan_with_one_hot_key_and_all_rows_on_one_day(spark):
    r = random.Random(1)
    rows = [("hot" if r.random() < 0.7 else f"k{r.randrange(20)}", 1, i, r.randrange(2)) for i in range(3000)]
    _check(spark, rows, 90)


def test_scan_with_null_keys_and_many_days(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.randrange(50), i, int(r.random() < 0.8)) for i in range(1000)]
    _check(spark, rows, 10)


def test_scan_of_an_empty_table_and_of_single_rows(spark):
    df = spark.createDataFrame([], "k string, d int, g long, v long")
    assert olap.max_stretch_sum(df, ["k"], "d", "g", "v", 3).count() == 0
    assert windows.longest_run(df, ["k"], ["d"], F.col("v") == 1).count() == 0
    _check(spark, [("a", 1, 1, 0), ("b", 1, 2, 1)], 90)


def test_a_hot_key_is_spread_over_partitions(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit(1).alias("d"), F.col("id").alias("g"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = [r["count"] for r in scan.ordered_rows(df, ["k", "d", "g"]).groupBy(scan.PART).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(per) == 8 and max(per) < 2 * min(per), per


def test_window_never_runs_over_a_whole_key(spark):
    df = spark.range(100).select(F.lit("a").alias("k"), F.col("id").alias("g"), F.lit(1).alias("v"))
    txt = plan_text(scan.prefix_scan(df, ["k"], ["g"], {"s": "v"}))
    assert "hashpartitioning(__part" in txt, txt


def test_global_positions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("c").alias("pos_"))
    got = {r.x: r.pos for r in scan.global_positions(df, [F.col("x").desc()]).collect()}
    assert got == {x: 5000 - x for x in range(5000)}
    assert scan.global_positions(df.limit(0), ["x"]).count() == 0
