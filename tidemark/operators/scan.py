"""Distributed prefix scan: positions and running sums along an order, with no
task that holds a whole key.

Rows are range-partitioned on (key, order) and written once in that order, so a
row's place is its partition and its index inside it. Partial sums per
(partition, key) are added up along the partitions and joined back: a key that
holds a third of all rows is spread over a third of the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col_
from ..sources.writers import materialize

PART, INDEX = "__part", "__index"
_LOW = 33  # monotonically_increasing_id: partition above, row below this bit


def ordered_rows(df: DataFrame, by: Sequence[str | Column], name: str = "ordered") -> DataFrame:
    """``df`` in the global order ``by`` with each row's range partition
    (``__part``) and its index inside it (``__index``), staged in the shared folder so
    that both are fixed values. Rows equal in ``by`` fall into one partition:
    give a unique last column where many rows may tie."""
    cols = [col_(c) for c in by]
    placed = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("__place", F.monotonically_increasing_id()))
    t = materialize(df.sparkSession, placed, name)
    return (t.withColumn(PART, F.shiftright("__place", _LOW))
            .withColumn(INDEX, F.col("__place").bitwiseAND((1 << _LOW) - 1)).drop("__place"))


def global_positions(df: DataFrame, by: Sequence[str | Column], out: str = "pos") -> DataFrame:
    """Position (1-based) of every row in the global order ``by``. Only one count per
    partition reaches the driver; the offsets go back as a broadcast of that size."""
    spark = df.sparkSession
    rows = ordered_rows(df, by)
    offsets, total = [], 0
    for part, n in sorted((r[PART], r["n"]) for r in rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part, total))
        total += n
    offs = spark.createDataFrame(offsets, f"{PART} long, __before long")
    return (rows.join(F.broadcast(offs), PART)
            .withColumn(out, F.col("__before") + F.col(INDEX) + 1).drop(PART, INDEX, "__before"))


def prefix_scan(df: DataFrame, key: Sequence[str], order: Sequence[str], sums: dict[str, str],
                pos: str = "pos") -> DataFrame:
    """Position (1-based) of each row within its key along ``order``, and running sums
    ``{out: column}`` up to and including the row. Null keys form a key of their own.

    The window runs per (partition, key), the offsets over one row per (key,
    partition it reaches); the join back moves only those."""
    key = list(key)
    rows = ordered_rows(df, [*key, *order])
    w = Window.partitionBy(PART, *key).orderBy(INDEX)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select(*[c for c in rows.columns if c != INDEX], F.row_number().over(w).cast("long").alias("__k"),
                        *[F.coalesce(F.sum(c).over(run), F.lit(0)).alias(f"__s_{o}") for o, c in sums.items()])
    totals = rows.groupBy(PART, *key).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__t_{o}") for o, c in sums.items()])
    before = Window.partitionBy(*key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    prior = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    offs = totals.select(F.col(PART).alias("__p2"), *[F.col(c).alias(f"__k2_{c}") for c in key], prior("__n").alias("__n0"),
                         *[prior(f"__t_{o}").alias(f"__t0_{o}") for o in sums])
    cond = F.col(PART) == F.col("__p2")
    for c in key:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__k2_{c}"))
    out = local.join(offs, cond)
    return out.select(*df.columns, (F.col("__n0") + F.col("__k")).alias(pos),
                      *[(F.col(f"__t0_{o}") + F.col(f"__s_{o}")).alias(o) for o in sums])
