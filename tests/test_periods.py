"""Visitors over periods, late corrections, run-time pruning and experiment intervals."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dims, joins
from tidemark.operators import experiments as X
from tidemark.operators import uniques as U
from tidemark.plans import queries as Q
from tidemark.plans.explain import count_ops, plan_text
from tidemark.session import scratch_path
from tidemark.sources.fixtures import Views

from .conftest import SF_SMALL


def visits(spark, r, n, users):
    day = dt.datetime(2024, 1, 29)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([None, *users]), day + dt.timedelta(days=r.randrange(40), hours=r.randrange(24))) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "host string, user_id long, event_time timestamp_ntz")


def brute(rows, starts):
    got = defaultdict(lambda: [0, set()])
    for host, user, at in rows:
        if host is not None and user is not None:
            for s in starts(at.date()):
                got[host, s][0] += 1
                got[host, s][1].add(user)
    return {k: (n, len(u)) for k, (n, u) in got.items()}


@pytest.mark.parametrize("period,starts", [
    ("day", lambda d: [d]), ("week", lambda d: [d - dt.timedelta(days=d.weekday())]), ("month", lambda d: [d.replace(day=1)]),
    ("year", lambda d: [d.replace(month=1, day=1)]), (5, lambda d: [d + dt.timedelta(days=k) for k in range(5)])])
def test_exact_visitors_of_every_period(spark, period, starts):
    rows, df = visits(spark, random.Random(1), 1500, [*range(50), 32_767, 32_768, 40_000, 10_000_000, 0])
    got = {(r.host, r.period_start): (r.hits, r.visitors) for r in U.visitors_exact(U.daily_bitmaps(df), period).collect()}
    assert got == brute(rows, starts)


def test_sketches_merge_within_their_error(spark):
    n = 30_000
    df = spark.range(n * 3).select(F.lit("h").alias("host"), (F.col("id") * 7919 % n).alias("user_id"),
                                   (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 28).cast("int"))).alias("event_time"))
    exact = {r.period_start: r.visitors for r in U.visitors_exact(U.daily_bitmaps(df), "week").collect()}
    for lg_k in (10, 14):
        for r in U.visitors_sketched(U.daily_sketches(df, lg_k=lg_k), "week").collect():
            assert abs(r.visitors / exact[r.period_start] - 1) < 4 * 1.04 / 2 ** (lg_k / 2)


def test_stored_days_answer_without_events(spark):
    _, df = visits(spark, random.Random(2), 300, range(30))
    path = scratch_path(spark, "state")
    U.daily_bitmaps(df).write.partitionBy("date").parquet(path)
    plan = plan_text(U.visitors_exact(spark.read.parquet(path).where("date >= '2024-02-05'"), "week"))
    assert "PartitionFilters: [isnotnull(date" in plan and "event_time" not in plan
    assert U.visitors_exact(U.daily_bitmaps(df.limit(0)), 7).count() == 0
    with pytest.raises(ValueError):
        U.visitors_exact(U.daily_bitmaps(df), "decade")


@pytest.mark.parametrize("seed", range(3))
def test_late_corrections_equal_the_backfill(spark, seed):
    r = random.Random(seed)
    values = [None, "x", "y"]
    truth = {(k, p): (r.choice(values), r.random() < 0.7) for k in ["a", "b", "c", "d", "e"] for p in range(1, 25)}
    schema = "k string, p int, v string, f boolean"
    scd = lambda t: dims.scd2_backfill(spark.createDataFrame([(k, p, *v) for (k, p), v in t.items()], schema), ["k"], "p", ["v", "f"])
    history = scd(truth)
    late = {(k, p): (r.choice(values), r.random() < 0.5) for k, p in truth if k in "abe" and r.random() < 0.3}
    late |= {("new", p): ("x", True) for p in (3, 4, 9)} | {("b", 25): truth["b", 24], ("e", 1): ("z", None), ("a", 30): ("x", True)}
    got = dims.scd2_correct(history, spark.createDataFrame([(k, p, *v) for (k, p), v in late.items()], schema), ["k"], ["v", "f"], "p")
    assert got.schema["start_date"].dataType == history.schema["start_date"].dataType
    fixed = truth | late
    want = []
    for key in sorted({k for k, _ in fixed}):
        run = None
        for p in sorted(p for k, p in fixed if k == key):
            v = fixed[key, p]
            if run and run[1] == p - 1 and run[2] == v:
                run[1] = p
            else:
                run = [p, p, v]
                want.append((key, run))
    want = sorted(((k, *v, a, b) for k, (a, b, v) in want), key=repr)
    assert sorted(map(tuple, got.select("k", "v", "f", "start_date", "end_date").collect()), key=repr) == want
    again = dims.scd2_correct(got, spark.createDataFrame([(k, p, *v) for (k, p), v in late.items()], schema), ["k"], ["v", "f"], "p")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)
    assert dims.scd2_correct(history, spark.createDataFrame([], schema), ["k"], ["v", "f"], "p").exceptAll(history).count() == 0


def test_dimension_filter_prunes_fact_partitions_at_run_time(spark):
    v = Views(spark, SF_SMALL)
    tables = Q.tables_by_month(spark, v)
    out = Q.pruned_by_matches(tables, Q.MATCH_DAY)
    assert "dynamicpruning" in plan_text(out).lower()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()
    read = [m for m in _scan_metrics(plan) if "numPartitions" in m]
    assert read and min(m["numPartitions"] for m in read) == 1, read
    assert len({r[0] for r in tables["match_details"].select("match_month").distinct().collect()}) > 20


def _scan_metrics(plan):
    """Metrics of all file scans of an executed plan."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            m, found = p.metrics(), {}
            for name in ("numPartitions", "numFiles"):
                if m.contains(name):
                    found[name] = m.apply(name).value()
            out.append(found)
    return out


def test_bucket_join_leaves_session_and_catalog_alone(spark):
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", None), {t.name for t in spark.catalog.listTables()}
    out = Q.q_bucket_join(spark, SF_SMALL)
    assert count_ops(out, "Exchange") == 0 and out.count() > 0
    assert (spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", None), {t.name for t in spark.catalog.listTables()}) == before
    assert out.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_session_with_keeps_other_settings(spark):
    s = joins.session_with(spark, spark__sql__ansi__enabled="false")
    assert s.conf.get("spark.sql.ansi.enabled") == "false" and s.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def units(spark, r, n, effect=0.0, link=3.0):
    rows = []
    for i in range(n):
        x = r.gauss(10, 3)
        variant = "treatment" if i % 2 else "control"
        rows.append((i, "e", variant, max(0, round(link * x + r.gauss(0, 2) + (effect if i % 2 else 0))), max(0, round(x))))
    return rows, spark.createDataFrame(rows, "user_id long, experiment string, variant string, metric long, before long")


def test_adjustment_removes_the_covariates_noise(spark):
    import numpy as np
    rows, df = units(spark, random.Random(4), 600, effect=1.0)
    got = {x.variant: x for x in X.adjusted_readout(df).collect()}
    y, b, t = (np.array([z[k] for z in rows], dtype=object) for k in (3, 4, 2))
    y, b = y.astype(float), b.astype(float)
    theta = np.cov(y, b)[0, 1] / b.var(ddof=1)
    for v in ("control", "treatment"):
        want = y[t == v].mean() - theta * (b[t == v].mean() - b.mean())
        assert got[v].adjusted_mean == pytest.approx(want, abs=1e-6) and got[v].mean == pytest.approx(y[t == v].mean(), abs=1e-6)
    assert got["treatment"].variance_kept < 0.2
    assert abs(got["treatment"].adjusted_mean - got["control"].adjusted_mean - 1.0) < 0.6


def test_adjustment_without_a_covariate_or_units(spark):
    df = spark.createDataFrame([(1, "e", "control", 2, 0), (2, "e", "treatment", 4, 0)], "user_id long, experiment string, variant string, metric long, before long")
    got = {x.variant: x for x in X.adjusted_readout(df).collect()}
    assert got["treatment"].adjusted_mean == 4.0 and got["treatment"].theta == 0.0 and got["treatment"].adjusted_lift == 1.0
    assert X.adjusted_readout(df.limit(0)).count() == 0 and X.bootstrap_intervals(df.limit(0)).count() == 0


def test_poisson_weights_are_poisson(spark):
    w = spark.range(20_000).select(X.poisson_weight(F.col("id"), F.lit(1), "s").alias("w"))
    m, v, z = w.agg(F.avg("w"), F.var_samp("w"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert abs(m - 1) < 0.03 and abs(v - 1) < 0.05 and abs(z - 0.3679) < 0.012


def test_bootstrap_intervals_cover_the_true_difference(spark):
    """60 experiments in one table: about 57 of the 95 % intervals hold the truth."""
    r = random.Random(9)
    rows = [(i, f"e{k}", "treatment" if i % 2 else "control", max(0, round(r.gauss(20 + (2 if i % 2 else 0), 6)))) for k in range(60) for i in range(120)]
    df = spark.createDataFrame(rows, "user_id long, experiment string, variant string, metric long")
    got = X.bootstrap_intervals(df, replicates=100).where("variant = 'treatment'").collect()
    assert len(got) == 60 and 51 <= sum(x.diff_low <= 2 <= x.diff_high for x in got) <= 60
    assert all(x.mean_low < x.mean_high and x.replicates == 100 for x in got)
