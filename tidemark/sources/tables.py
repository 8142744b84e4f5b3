"""Batch sources: the given parquet tables, header CSV with an explicit schema,
and typed reads that split valid rows from rejected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table. Column pruning and filters reach the parquet scan; a
    declared schema (where known) avoids a schema-inference job per read."""
    from ..schemas import SCHEMAS
    r = spark.read
    if name in SCHEMAS:
        r = r.schema(SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, **options: str) -> DataFrame:
    """Header CSV. With a schema nothing is inferred (no extra pass over the data);
    without one every column is read as text, as a header-only read does.
    ``options`` go to the reader (quote, escape, sep...)."""
    r = spark.read.options(**options).option("header", header)
    if schema is not None:
        return r.schema(schema).option("mode", "PERMISSIVE").csv(path)
    return r.csv(path)


def enforce_schema(df: DataFrame, schema: T.StructType, required: list[str] | None = None,
                   reason_col: str = "reject_reason") -> DataFrame:
    """Cast every declared field with ``try_cast``; a value that does not cast, or a
    NULL in a required field, rejects the row. Returns all rows with the typed
    columns plus ``reason_col`` (NULL for valid rows); split with
    :func:`split_valid`. One narrow projection: no shuffle."""
    required = set(required or [])
    typed: list[Column] = []
    reasons: list[Column] = []
    for f in schema.fields:
        src = F.col(f.name)
        cast = src.try_cast(f.dataType)
        typed.append(cast.alias(f.name))
        reasons.append(F.when(src.isNotNull() & cast.isNull(), F.lit(f"bad {f.name}")))
        if f.name in required or not f.nullable:
            reasons.append(F.when(src.isNull(), F.lit(f"missing {f.name}")))
    reason = F.concat_ws("; ", *reasons)
    return df.select(*typed, F.when(reason != "", reason).alias(reason_col))


def split_valid(checked: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    return (checked.where(F.col(reason_col).isNull()).drop(reason_col),
            checked.where(F.col(reason_col).isNotNull()))
