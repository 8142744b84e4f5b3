"""Run a daily/seasonal step over several periods with the state carried by a
table, as a scheduler would run one period per day.

Each period is one distributed job: the previous snapshot is read back from
the table, the step is applied, and the new snapshot is written to its own
partition (dynamic overwrite, so a re-run of a period replaces it). Reading
the written snapshot back cuts the lineage, so plans do not grow with the
number of periods."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import write_snapshot


def run_periods(spark: SparkSession, path: str, periods: Iterable, first_prev: DataFrame,
                step: Callable[[DataFrame, object], DataFrame], period_col: str) -> DataFrame:
    """Apply ``step(prev_snapshot, period)`` for each period in order; snapshot
    rows carry ``period_col`` = period. Returns the table of all snapshots."""
    prev = first_prev
    for p in periods:
        out = step(prev, p).withColumn(period_col, F.lit(p))
        write_snapshot(out, path, [period_col])
        prev = spark.read.parquet(path).where(F.col(period_col) == F.lit(p))
    return spark.read.parquet(path)
