"""Table layout: hidden partitioning (readers filter the source column, partitions are
pruned), clustering along a space-filling curve, and reports of bytes, files and the
files that a predicate touches."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fs import Store
from .writers import write_snapshot

SPEC = "_partitioning.json"  # names with an underscore are no data to Spark


@dataclass(frozen=True)
class Transform:
    """A partition value from a source column. ``ordered``: it never falls as the
    source rises, so ranges carry over; else only equality does."""

    fn: Callable[[Column, int], Column]
    ordered: bool


TRANSFORMS: dict[str, Transform] = {
    "identity": Transform(lambda c, n: c, True),
    "year": Transform(lambda c, n: F.year(c), True),
    "month": Transform(lambda c, n: F.year(c) * 100 + F.month(c), True),
    "day": Transform(lambda c, n: F.year(c) * 10000 + F.month(c) * 100 + F.day(c), True),
    "truncate": Transform(lambda c, n: F.floor(c / n).cast("long") * n, True),
    "bucket": Transform(lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int"), False),
}


@dataclass(frozen=True)
class Field:
    """One partition column: ``source``, a transform and its number (width or buckets)."""

    source: str
    transform: str
    n: int = 0

    @property
    def name(self) -> str:
        return f"{self.source}_{self.transform}" + (f"_{self.n}" if self.n else "")

    def of(self, c: Column) -> Column:
        return TRANSFORMS[self.transform].fn(c, self.n)


def write_hidden(df: DataFrame, path: str, fields: Sequence[Field]) -> None:
    """Write (or overwrite the partitions present in ``df``) with derived partition
    columns, and leave their definition beside the data for readers."""
    for f in fields:
        if f.transform not in TRANSFORMS:
            raise ValueError(f"no transform {f.transform}")
    store = Store(df.sparkSession, path)
    spec = json.dumps([[f.source, f.transform, f.n] for f in fields])
    if SPEC in store.names(""):
        if store.read(SPEC) != spec:
            raise ValueError(f"{path} is partitioned otherwise: {store.read(SPEC)}")
    write_snapshot(df.withColumns({f.name: f.of(F.col(f.source)) for f in fields}).repartition(*[f.name for f in fields]), path, [f.name for f in fields])
    if SPEC not in store.names(""):
        store.write_new(SPEC, spec, f"_{SPEC}.tmp")


# (operator, value): the predicate on the source; what holds for ordered partition values then
_CARRIED = {"=": "=", "<": "<=", "<=": "<=", ">": ">=", ">=": ">="}
_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def read_hidden(spark: SparkSession, path: str, where: Sequence[tuple[str, str, object]] = ()) -> DataFrame:
    """Rows of a table of ``write_hidden`` for which all (column, operator, value)
    predicates hold; operators =, <, <=, >, >=, in. Each predicate on a partition's
    source column also becomes one on the partition value, so readers need not
    know the partitioning. The partition columns are not returned."""
    fields = [Field(*f) for f in json.loads(Store(spark, path).read(SPEC))]
    t = spark.read.parquet(path)
    for column, op, value in where:
        values = [F.lit(v).cast(t.schema[column].dataType) for v in (value if op == "in" else [value])]
        compare = _COMPARE.get("=" if op == "in" else op)
        if compare is None:
            raise ValueError(f"no operator {op}")
        any_of = lambda parts: parts[0] if len(parts) == 1 else F.lit(False) if not parts else parts[0] | any_of(parts[1:])
        t = t.where(any_of([compare(F.col(column), v) for v in values]))
        for f in fields:
            if f.source != column:
                continue
            if op in ("=", "in"):
                t = t.where(any_of([F.col(f.name) == f.of(v) for v in values]))
            elif TRANSFORMS[f.transform].ordered:
                t = t.where(_COMPARE[_CARRIED[op]](F.col(f.name), f.of(values[0])))
    return t.drop(*[f.name for f in fields])


def curve_position(df: DataFrame, cols: Sequence[str], bits: int = 5) -> Column:
    """Place on a Z-order curve: each column is cut at 2^bits - 1 quantiles (from one
    pass with ``percentile_approx``), and the bits of the cut numbers are
    interleaved. Nulls come first. Numbers, dates and timestamps."""
    n = 1 << bits
    share = F.array(*[F.lit(i / n) for i in range(1, n)])
    at = {c: F.unix_micros(F.col(c).cast("timestamp")) if df.schema[c].dataType.typeName().startswith("timestamp")
          else F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) if df.schema[c].dataType.typeName() == "date" else F.col(c) for c in cols}
    cuts = df.agg(*[F.percentile_approx(at[c].cast("double"), share, 10 * n).alias(c) for c in cols]).first()
    z = F.lit(0).cast("long")
    for k, c in enumerate(cols):
        edges = F.array(*[F.lit(float(x)) for x in (cuts[c] or [])]).cast("array<double>")
        x = at[c].cast("double")
        cell = F.coalesce(F.size(F.filter(edges, lambda e: e <= x)), F.lit(0)).cast("long")
        for b in range(bits):
            z = z + F.shiftleft(F.shiftright(cell, b).bitwiseAND(1), b * len(cols) + k)
    return z


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int, bits: int = 5) -> None:
    """Overwrite ``path`` with about ``files`` files, range-partitioned along the curve
    over ``cols`` and sorted by it: rows close in all columns share files."""
    z = curve_position(df, cols, bits)
    # the hash of the row parts cells that hold more than a file's share
    (df.withColumn("__z", z).repartitionByRange(files, "__z", F.xxhash64(*df.columns)).sortWithinPartitions("__z").drop("__z")
     .write.mode("overwrite").parquet(path))


def layout_report(spark: SparkSession, layouts: dict[str, str], bounds: dict[str, tuple] | None = None) -> DataFrame:
    """Per written layout: size_bytes, num_files, num_rows, and files_touched: files whose
    least and greatest values meet all ``bounds`` {column: (low, high)}. Files and
    bytes come from the store's listing (so files without rows count), rows and
    values per file from the files themselves, one task per part of the table."""
    out = None
    for label, path in layouts.items():
        listed = Store(spark, path).files("")
        same = lambda c: F.regexp_replace(c, "^file:/+", "file:/").alias("name")
        names = spark.createDataFrame(listed, "name string, bytes long").select(same("name"), "bytes")
        t = spark.read.parquet(path)
        meets = F.lit(True)
        for c, (lo, hi) in (bounds or {}).items():
            typ = t.schema[c].dataType
            meets = meets & (F.max(c) >= F.lit(lo).cast(typ)) & (F.min(c) <= F.lit(hi).cast(typ))
        per = t.groupBy(same("_metadata.file_path")).agg(F.count(F.lit(1)).alias("rows"), meets.alias("meets"))
        r = names.join(per, "name", "left").agg(
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"), F.count("name").alias("num_files"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("num_rows"), F.count_if(F.coalesce("meets", F.lit(False))).alias("files_touched"))
        r = r.withColumn("layout", F.lit(label))
        out = r if out is None else out.unionByName(r)
    return out
