"""Sinks: idempotent snapshot writes, keyed upsert, staging, insert by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, part_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition
    overwrite): re-running a period replaces it instead of appending twice."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*part_cols).format(fmt).save(path))


def merge_upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                 part_cols: Sequence[str], partitions: dict[str, Sequence] | None = None) -> None:
    """ON CONFLICT (keys) DO UPDATE for a parquet table partitioned by
    ``part_cols``. ``partitions`` names the partition values of the batch (known
    from its period), so the scan of the old table is pruned to them; updates outside
    of them fail. The old rows of the touched partitions are merged
    (old rows without a new version + all new rows), checkpointed to the shared
    checkpoint folder (the merged rows must not be read from the files being
    replaced) and written back with a dynamic partition overwrite. Re-running
    with the same updates yields the same table."""
    from ..operators.facts import upsert
    existing = spark.read.parquet(path)
    for col, values in (partitions or {}).items():
        existing = existing.where(F.col(col).isin(list(values)))
        stray = F.raise_error(F.lit(f"merge_upsert: an update outside the named partitions of {col}"))
        updates = updates.where(F.when(F.col(col).isin(list(values)), F.lit(True)).otherwise(stray))
    touched = updates.select(*part_cols).distinct()
    old = existing.join(touched, list(part_cols), "left_semi")
    merged = upsert(old, updates, keys).checkpoint(eager=True)
    write_snapshot(merged, path, part_cols)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several branches of a job read (a staging
    table) as parquet under the shared checkpoint folder and read it back.
    This cuts the lineage, is computed once instead of once per branch, and the
    read-back keeps column pruning (unlike an RDD checkpoint)."""
    from ..session import scratch_path
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def insert_by_name(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append ``df`` to ``table`` matching columns by NAME, not position (a
    positional insert silently shifts values when column orders differ)."""
    view = f"__insert_{table.replace('.', '_')}"
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
