"""Keyed table sink of a stream: the latest row per key, upserted batch by batch.

Each batch becomes a run: one Parquet folder, divided by a hash of the key into the
table's buckets. A manifest lists the runs that make up the table and, per writer, the
last batch it holds; a run counts from the moment its manifest is there, so a batch
that fails half-way changes nothing and a batch that comes again is skipped.

When ``fan_in`` runs of one level are together they are merged into one run of the
next level, bucket by bucket, with the newest row of a key: a table of n batches is
read from fewer than ``fan_in`` runs a level and log n levels, and a row is rewritten
once a level. After a merge, folders and manifests older than the table before the
batch are removed, so a reader of that table can finish. One query writes a table at a
time; a second one's commit fails, it does not mix.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.fs import Store

BUCKET, RUN = "__bucket", "__run"


class KeyedTable:
    """``schema`` are the table's columns, ``keys`` some of them (null keys are keys too)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 8, fan_in: int = 4):
        if fan_in < 2 or buckets < 1:
            raise ValueError("fan_in is at least 2 and buckets at least 1")
        self.spark, self.path, self.keys, self.buckets, self.fan_in = spark, path.rstrip("/"), list(keys), buckets, fan_in
        # columns of files can be null whatever the stream says
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.store = Store(spark, path)

    # -- manifest ------------------------------------------------------------------------
    def _versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self.store.names("manifest") if n.endswith(".json")]

    def manifest(self) -> dict:
        """{version, runs: [{folder, level}] from old to new, writers: {name: last batch}}."""
        found = self._versions()
        if not found:
            return {"version": 0, "buckets": self.buckets, "runs": [], "writers": {}}
        m = json.loads(self.store.read(f"manifest/{max(found):012d}.json"))
        if m["buckets"] != self.buckets:
            raise ValueError(f"the table has {m['buckets']} buckets, not {self.buckets}")
        return m

    def _commit(self, old: dict, runs: list[dict], writers: dict) -> dict:
        new = {"version": old["version"] + 1, "buckets": self.buckets, "runs": runs, "writers": writers}
        if not self.store.write_new(f"manifest/{new['version']:012d}.json", json.dumps(new), f"tmp/{uuid.uuid4().hex}"):
            raise RuntimeError(f"version {new['version']} of {self.path} was committed by another writer")
        return new

    # -- writing -------------------------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write_run(self, rows: DataFrame, level: int) -> dict:
        """One file per bucket, rows in key order."""
        folder = f"runs/{uuid.uuid4().hex}"
        (rows.withColumn(BUCKET, self._bucket()).repartition(self.buckets, BUCKET).sortWithinPartitions(BUCKET, *self.keys)
         .write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}"))
        return {"folder": folder, "level": level}

    def _newest(self, rows: DataFrame, order: Column) -> DataFrame:
        w = Window.partitionBy(*self.keys).orderBy(order.desc())
        return rows.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").select(*self.schema.names)

    def upsert(self, batch: DataFrame, batch_id: int, writer: str = "stream", order: str | None = None) -> bool:
        """Make the batch's rows the latest of their keys. ``order`` names the column
        whose greatest value wins inside the batch; without it keys must not repeat
        there. False if this writer's batch is in the table already."""
        m = self.manifest()
        if batch_id <= m["writers"].get(writer, -1):
            return False
        if order is not None:
            batch = self._newest(batch, F.col(order))
        run = self._write_run(batch.select(*self.schema.names), 0)
        self._merge(self._commit(m, [*m["runs"], run], {**m["writers"], writer: batch_id}), m["version"])
        return True

    def _merge(self, m: dict, before: int) -> None:
        merged = False
        while True:
            runs = m["runs"]
            last = runs[-1]["level"]
            same = [r for r in runs if r["level"] == last]
            if len(same) < self.fan_in:
                break
            run = self._write_run(self._merged(same), last + 1)
            m = self._commit(m, [r for r in runs if r["level"] > last] + [run], m["writers"])
            merged = True
        if merged:
            self._clean(before)

    def _clean(self, first: int) -> None:
        """Remove manifests before version ``first`` and folders that none from there on
        names."""
        versions = self._versions()
        kept = set()
        for v in [v for v in versions if v >= first]:
            kept |= {r["folder"] for r in json.loads(self.store.read(f"manifest/{v:012d}.json"))["runs"]}
        for name in self.store.names("runs"):
            if f"runs/{name}" not in kept:
                self.store.delete(f"runs/{name}")
        for v in [v for v in versions if v < first]:
            self.store.delete(f"manifest/{v:012d}.json")

    # -- reading -------------------------------------------------------------------------
    def _runs(self, runs: Sequence[dict]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        out = None
        for i, r in enumerate(runs):
            d = self.spark.read.schema(stored).parquet(f"{self.path}/{r['folder']}").withColumn(RUN, F.lit(i))
            out = d if out is None else out.unionByName(d)
        return out

    def _merged(self, runs: Sequence[dict]) -> DataFrame:
        rows = self._runs(runs)
        return rows.select(*self.schema.names) if len(runs) == 1 else self._newest(rows, F.col(RUN))

    def read(self) -> DataFrame:
        """The table as of its last manifest."""
        runs = self.manifest()["runs"]
        return self._merged(runs) if runs else self.spark.createDataFrame([], self.schema)

    def lookup(self, values: dict) -> DataFrame:
        """The row of one key, read from its bucket alone."""
        runs = self.manifest()["runs"]
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        if set(values) != set(self.keys):
            raise ValueError(f"a value for each of {self.keys} is needed")
        types = {f.name: f.dataType for f in self.schema}
        one = self.spark.range(1).select(*[F.lit(values[k]).cast(types[k]).alias(k) for k in self.keys])
        bucket = one.select(self._bucket()).first()[0]
        rows = self._runs(runs).where(F.col(BUCKET) == bucket)
        for k in self.keys:
            rows = rows.where(F.col(k).eqNullSafe(F.lit(values[k]).cast(types[k])))
        return self._newest(rows, F.col(RUN))

    def sink(self, writer: str = "stream", order: str | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.upsert(batch, batch_id, writer, order)
        return write


def fan_out(sinks: Sequence[tuple[Callable[[DataFrame], DataFrame], KeyedTable]], writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """Several keyed tables from one streaming query, for ``foreachBatch``.

    The micro-batch is computed and persisted once; each (transform, table) then takes
    its rows and commits for itself. If a run fails between two tables, the batch
    comes again: tables that hold it skip it, the others take it. A transform may read a
    table before it in the list, which holds the batch by then."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for transform, table in sinks:
                table.upsert(transform(batch), batch_id, writer)
        finally:
            batch.unpersist()
    return write
