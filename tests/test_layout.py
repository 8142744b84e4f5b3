"""Hidden partitioning, clustering and file reports against the files' own metadata."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.plans import queries as Q
from tidemark.plans.explain import plan_text
from tidemark.session import scratch_path
from tidemark.sources import layout as L
from tidemark.sources.fixtures import Views

from .conftest import SF_SMALL


def local(path):
    return path.removeprefix("file:")


def test_a_predicate_on_the_source_alone_prunes_partitions(spark):
    path = scratch_path(spark, "by-year")
    e = Views(spark, SF_SMALL).v_events.withColumn("event_date", F.to_date("event_time"))
    L.write_hidden(e, path, [L.Field("event_date", "day"), L.Field("user_id", "bucket", 4)])
    t = L.read_hidden(spark, path, [("event_date", ">=", "2024-01-20"), ("user_id", "=", 7)])
    txt = plan_text(t)
    assert "event_date_day" in txt.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "user_id_bucket_4" in txt.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(event_date" in txt and t.columns == e.columns
    folders = {r[0].rsplit("/", 3)[1] for r in t.select("_metadata.file_path").distinct().collect()}
    assert folders and all(f >= "event_date_day=20240120" for f in folders)
    assert sorted(map(tuple, t.collect())) == sorted(map(tuple, e.where("event_date >= '2024-01-20' AND user_id = 7").collect()))


@pytest.mark.parametrize("field", [L.Field("x", "truncate", 10), L.Field("x", "bucket", 3), L.Field("x", "identity"), L.Field("d", "year"), L.Field("d", "month"), L.Field("d", "day")])
def test_every_transform_and_operator_equals_a_plain_filter(spark, field):
    r = random.Random(3)
    day = lambda: dt.date(2022, 11, 20) + dt.timedelta(days=r.randrange(500))
    rows = [(i, r.choice([None, r.randrange(-40, 40)]), r.choice([None, day()])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x long, d date")
    path = scratch_path(spark, "transform")
    L.write_hidden(df, path, [field])
    for op in ("=", "<", "<=", ">", ">=", "in"):
        value = next(v[1] if field.source == "x" else v[2] for v in rows if None not in v)
        value = [value, value] if op == "in" else value
        t = L.read_hidden(spark, path, [(field.source, op, value)])
        plain = [i for i, x, d in rows if (v := x if field.source == "x" else d) is not None and
                 {"=": lambda: v == value, "<": lambda: v < value, "<=": lambda: v <= value, ">": lambda: v > value, ">=": lambda: v >= value, "in": lambda: v in value}[op]()]
        assert sorted(x.id for x in t.collect()) == plain, (field, op)
    assert L.read_hidden(spark, path).count() == 200
    with pytest.raises(ValueError, match="otherwise"):
        L.write_hidden(df, path, [L.Field("id", "bucket", 2)])


def test_report_equals_the_files_own_metadata(spark):
    e = Views(spark, SF_SMALL).v_events.withColumn("event_date", F.to_date("event_time")).withColumn("part", F.col("user_id") % 2)
    base = scratch_path(spark, "report")
    e.repartition(5).write.parquet(f"{base}/plain")
    e.repartition(2).write.partitionBy("part").parquet(f"{base}/parts")
    L.write_clustered(e, f"{base}/curve", ["event_date", "user_id"], 6)
    bounds = {"event_date": ("2024-01-03", "2024-01-04"), "user_id": (2, 4)}
    got = {r.layout: r for r in L.layout_report(spark, {k: f"{base}/{k}" for k in ("plain", "parts", "curve")}, bounds).collect()}
    import glob
    import os
    for k, r in got.items():
        files = glob.glob(f"{local(base)}/{k}/**/*.parquet", recursive=True)
        assert (r.num_files, r.size_bytes) == (len(files), sum(map(os.path.getsize, files)))
        meta = {f: pq.ParquetFile(f).metadata for f in files}
        assert r.num_rows == sum(m.num_rows for m in meta.values()) == e.count()
        meets = {}
        for f, m in meta.items():
            for i in range(m.num_columns):
                c = m.schema.column(i).name
                if c in bounds:
                    stats = [m.row_group(g).column(i).statistics for g in range(m.num_row_groups)]
                    values = [(str if c == "event_date" else int)(x) for s in stats for x in (s.min, s.max) if x is not None]
                    meets.setdefault(f, []).append(bool(values) and max(values) >= bounds[c][0] and min(values) <= bounds[c][1])
        assert r.files_touched == sum(all(m) for m in meets.values()), k


def test_clustering_touches_fewer_files(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"), F.col("id").alias("c"))
    base = scratch_path(spark, "curve")
    df.repartition(64).write.parquet(f"{base}/plain")
    df.repartitionByRange(64, "a").write.parquet(f"{base}/one")
    L.write_clustered(df, f"{base}/curve", ["a", "b"], 64)
    layouts = {k: f"{base}/{k}" for k in ("plain", "one", "curve")}
    a = {r.layout: r.files_touched for r in L.layout_report(spark, layouts, {"a": (100, 150)}).collect()}
    b = {r.layout: r.files_touched for r in L.layout_report(spark, layouts, {"b": (100, 150)}).collect()}
    assert a["plain"] == b["plain"] == b["one"] == 64
    assert a["curve"] <= 20 and b["curve"] <= 20
    assert spark.read.parquet(layouts["curve"]).exceptAll(df).count() == 0


def test_curve_with_nulls_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None), (1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 1))], "a long, d date")
    base = scratch_path(spark, "edge")
    L.write_clustered(df, f"{base}/x", ["a", "d"], 2)
    assert spark.read.parquet(f"{base}/x").count() == 3
    L.write_clustered(df.limit(0), f"{base}/none", ["a", "d"], 2)
    r = L.layout_report(spark, {"x": f"{base}/x"}, {"a": (1, 1)}).first()
    assert r.files_touched >= 1 and r.num_rows == 3


def test_registered_report_has_bytes_and_files(spark):
    rows = {r.layout: r for r in Q.q_layout_report(spark, SF_SMALL).collect()}
    assert set(rows) == {"unsorted", "sorted", "clustered"} and len({r.num_rows for r in rows.values()}) == 1
    assert all(r.size_bytes > 0 and r.num_files > 0 for r in rows.values())
