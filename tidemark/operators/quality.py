"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "num_rows") -> DataFrame:
    """Keys that occur more than once (a primary-key check). Partial
    aggregation: one row per key per task crosses the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
            .where(F.col(out) > 1))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` is not unique (one bounded action: limit 1)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise AssertionError(f"duplicate key {dup[0].asDict()} for {list(keys)}")
