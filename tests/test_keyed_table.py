"""Keyed table sink: retries, kills between data and manifest, merges, one pass into two tables."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.streaming import keyed_table as K
from tidemark.streaming import streams as S

SCHEMA = "k string, g int, v long"


def table(spark, name="keyed", **kw):
    df = spark.createDataFrame([], SCHEMA)
    return K.KeyedTable(spark, scratch_path(spark, name), df.schema, ["k", "g"], buckets=3, **kw)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_many_batches_equal_a_dict_and_stay_few_runs(spark):
    t, want, r = table(spark, fan_in=3), {}, random.Random(1)
    for b in range(14):
        new = {(r.choice(["a", "b", None, "c"]), r.randrange(4)): r.randrange(1000) for _ in range(6)}
        want.update(new)
        assert t.upsert(batch(spark, [(k, g, v) for (k, g), v in new.items()]), b)
        assert len(t.manifest()["runs"]) <= 2 * 3
    assert rows(t.read()) == sorted(((k, g, v) for (k, g), v in want.items()), key=repr)
    named = {x["folder"] for x in t.manifest()["runs"]}
    assert len(t.store.names("runs")) <= len(named) + 6 and len(t.store.names("manifest")) <= 6
    (k, g), v = next(iter(want.items()))
    assert rows(t.lookup({"k": k, "g": g})) == [(k, g, v)]
    assert rows(t.lookup({"k": "none", "g": 1})) == []


def test_a_batch_that_comes_again_changes_nothing(spark):
    t = table(spark)
    assert t.upsert(batch(spark, [("a", 1, 1)]), 0) and t.upsert(batch(spark, [("a", 1, 2)]), 1)
    before = t.manifest()
    assert not t.upsert(batch(spark, [("a", 1, 1)]), 0) and not t.upsert(batch(spark, [("a", 1, 2)]), 1)
    assert t.manifest() == before and rows(t.read()) == [("a", 1, 2)]
    assert t.upsert(batch(spark, [("b", 1, 5)]), 0, writer="another")
    assert rows(t.read()) == [("a", 1, 2), ("b", 1, 5)]


def test_a_kill_between_data_and_manifest_is_invisible(spark, monkeypatch):
    t = table(spark, fan_in=2)
    t.upsert(batch(spark, [("a", 1, 1)]), 0)

    def killed(*a, **kw):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(t.store, "write_new", killed)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(batch(spark, [("a", 1, 9), ("z", 1, 9)]), 1)
    assert len(t.store.names("runs")) == 2 and rows(t.read()) == [("a", 1, 1)]
    assert t.upsert(batch(spark, [("a", 1, 2), ("z", 1, 3)]), 1)
    assert rows(t.read()) == [("a", 1, 2), ("z", 1, 3)]
    t.upsert(batch(spark, [("y", 1, 1)]), 2)
    t.upsert(batch(spark, [("y", 2, 1)]), 3)  # merges; the orphan is gone
    assert len(t.store.names("runs")) <= 5 and len(rows(t.read())) == 4


def test_a_kill_between_merge_and_its_manifest(spark, monkeypatch):
    t, commit = table(spark, fan_in=2), K.KeyedTable._commit
    t.upsert(batch(spark, [("a", 1, 1)]), 0)
    done = []

    def second_fails(self, *a):
        if done:
            raise KeyboardInterrupt
        done.append(1)
        return commit(self, *a)

    with monkeypatch.context() as m:
        m.setattr(K.KeyedTable, "_commit", second_fails)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(batch(spark, [("a", 1, 2)]), 1)
    assert rows(t.read()) == [("a", 1, 2)] and not t.upsert(batch(spark, [("a", 1, 2)]), 1)
    t.upsert(batch(spark, [("b", 1, 3)]), 2)
    assert rows(t.read()) == [("a", 1, 2), ("b", 1, 3)] and len(t.manifest()["runs"]) <= 2


def test_a_second_writer_fails_instead_of_mixing(spark):
    t = table(spark)
    old = t.manifest()
    t.upsert(batch(spark, [("a", 1, 1)]), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        t._commit(old, [], {})
    with pytest.raises(ValueError, match="buckets"):
        K.KeyedTable(spark, t.path, t.schema, t.keys, buckets=5).read()


def test_order_inside_a_batch_and_empty_tables(spark):
    t = table(spark)
    assert rows(t.read()) == []
    t.upsert(batch(spark, []), 0)
    assert rows(t.read()) == []
    t.upsert(batch(spark, [("a", 1, 3), ("a", 1, 7), ("a", 1, 5)]), 1, order="v")
    assert rows(t.read()) == [("a", 1, 7)]


def test_failure_between_two_sinks_heals_on_restart(spark):
    """One query, its source read once per file; the second sink fails at first."""
    base = scratch_path(spark, "fan")
    src = f"{base}/in"
    cols = "event_id long, ip long, event_time string, referrer string, host string, url string"
    event = lambda i, m: (i, 1, f"2024-01-01T00:{m:02d}:00.000Z", f"r{i % 3}", f"h{i % 2}", "/")
    spark.createDataFrame([event(i, i % 20) for i in range(60)], cols).coalesce(1).write.mode("append").parquet(src)
    stream = lambda: S.tumbling_counts(S.parse_event_time(S.read_stream(spark, "parquet", S.WEB_EVENT_SCHEMA, src)), ["host", "referrer"])
    schema = stream().schema
    fine = K.KeyedTable(spark, f"{base}/fine", schema, ["window_start", "host", "referrer"])
    coarse = K.KeyedTable(spark, f"{base}/coarse", schema.__class__([f for f in schema if f.name != "referrer"]), ["window_start", "host"])
    state = {"fail": True, "batches": 0}

    def up(batch):
        state["batches"] += 1
        if state.pop("fail", False):
            raise RuntimeError("killed between the sinks")
        return S.rolled_up(batch, fine.read(), "window_start", ["host"], "num_hits")

    sink = K.fan_out([(lambda b: b, fine), (up, coarse)])
    with pytest.raises(Exception, match="killed between the sinks"):
        S.run_available_now(stream(), f"{base}/ck", "update", sink)
    assert fine.read().count() > 0 and coarse.read().count() == 0
    S.run_available_now(stream(), f"{base}/ck", "update", sink)
    spark.createDataFrame([event(i, 18) for i in range(100, 105)], cols).coalesce(1).write.mode("append").parquet(src)
    S.run_available_now(stream(), f"{base}/ck", "update", sink)
    want = fine.read().groupBy("window_start", "host").agg(F.sum("num_hits").alias("num_hits"))
    assert rows(coarse.read().select("window_start", "host", "num_hits")) == rows(want)
    assert want.agg(F.sum("num_hits")).first()[0] == 65
