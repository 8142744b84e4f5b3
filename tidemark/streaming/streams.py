"""Structured Streaming operators: event sources, watermarked tumbling counts,
session windows, stream-static enrichment, idempotent table sinks.

Operators take and return streaming DataFrames; ``run_*`` helpers start a
query with its own checkpoint folder under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.exprs import col_

__all__ = ["WEB_EVENT_SCHEMA", "read_stream", "parse_event_time", "utc_ts_to_ntz", "tumbling_counts",
           "sessionize", "foreach_batch_changelog", "latest_per_key", "run_available_now"]

# JSON payload of the web-event topic (the event time arrives as ISO text).
WEB_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ip", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("url", T.StringType()),
])

ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSX"


def read_stream(spark: SparkSession, fmt: str, schema: T.StructType, path: str | None = None,
                options: dict | None = None) -> DataFrame:
    """Stream source. ``kafka``: the JSON ``value`` is parsed with ``schema``
    (options such as ``kafka.bootstrap.servers``, ``subscribe``,
    ``startingOffsets=latest`` pass through); file formats read ``path``."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        raw = r.load()
        return (raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v"))
                .select("v.*"))
    return r.schema(schema).load(path)


def parse_event_time(df: DataFrame, text_col: str = "event_time", out: str = "event_timestamp",
                     pattern: str = ISO_MILLIS_Z) -> DataFrame:
    """Text -> TIMESTAMP with ``try_to_timestamp`` (bad text -> NULL). The
    pattern reads the trailing 'Z' as the UTC offset, so the instant does not
    depend on the session time zone."""
    return df.withColumn(out, F.try_to_timestamp(F.col(text_col), F.lit(pattern)))


def utc_ts_to_ntz(c: str | Column) -> Column:
    """TIMESTAMP instant -> its UTC wall-clock TIMESTAMP_NTZ (session-zone free)."""
    m = F.unix_micros(col_(c))
    day_us = 86400 * 1000000
    days = F.floor(m / F.lit(day_us)).cast("int")
    secs = ((m - days.cast("long") * F.lit(day_us)).cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(days, F.lit(0), F.lit(0), secs))


def tumbling_counts(events: DataFrame, keys: Sequence[str], size: str = "5 minutes",
                    watermark: str = "15 seconds", time_col: str = "event_timestamp",
                    count_col: str = "host", start_alias: str = "window_start") -> DataFrame:
    """COUNT(count_col) per tumbling window and keys (NULLs of ``count_col`` not
    counted), with a watermark: rows behind it are dropped as late, and window
    state is evicted once the watermark passes the window end. Keyed state is
    hash-partitioned on (window, keys)."""
    w = events.withWatermark(time_col, watermark)
    return (w.groupBy(F.window(time_col, size).alias("w"), *keys)
            .agg(F.count(count_col).alias("num_hits"))
            .select(utc_ts_to_ntz(F.col("w.start")).alias(start_alias), *keys, "num_hits"))


def sessionize(events: DataFrame, keys: Sequence[str], gap: str = "5 minutes",
               watermark: str = "15 seconds", time_col: str = "event_timestamp") -> DataFrame:
    """Session windows per keys: events closer than ``gap`` share a session.
    Emitted in append mode once the watermark passes the session end."""
    w = events.withWatermark(time_col, watermark)
    return (w.groupBy(F.session_window(time_col, gap).alias("s"), *keys)
            .agg(F.count(F.lit(1)).alias("num_events"))
            .select(*keys, utc_ts_to_ntz(F.col("s.start")).alias("session_start"),
                    utc_ts_to_ntz(F.col("s.end")).alias("session_end"), "num_events"))


def foreach_batch_changelog(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch``: each micro-batch is written to its own
    ``batch_id=N`` folder with overwrite, so a retried batch replaces its own
    output (idempotent) and the folder is an append-only change log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def latest_per_key(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current table from an update-mode change log: the row of the latest
    batch per key (one shuffle on the key)."""
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return (changelog.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
            .drop("__rn", "batch_id"))


def rolled_up(changed: DataFrame, table: DataFrame, window_col: str, keys: Sequence[str], value: str) -> DataFrame:
    """Sums of ``value`` per (window, keys) over a finer ``table``, for the (window,
    keys) that occur in ``changed`` alone. Only the span of windows that the batch
    touches is read from the table."""
    span = changed.agg(F.min(window_col), F.max(window_col)).first()
    if span[0] is None:
        return changed.select(window_col, *keys, value)
    touched = changed.select(F.col(window_col).alias("__w"), *[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    cond = F.col(window_col) == F.col("__w")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    rows = table.where(F.col(window_col).between(F.lit(span[0]).cast("timestamp_ntz"), F.lit(span[1]).cast("timestamp_ntz")))
    return rows.join(touched, cond, "left_semi").groupBy(window_col, *keys).agg(F.sum(value).alias(value))


def run_available_now(df: DataFrame, checkpoint: str, output_mode: str,
                      sink: Callable[[DataFrame, int], None], name: str | None = None) -> None:
    """Process everything available, then stop (restartable: offsets, state and
    the watermark live in ``checkpoint``)."""
    q = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink).trigger(availableNow=True))
    if name:
        q = q.queryName(name)
    h = q.start()
    h.awaitTermination()
    if h.exception() is not None:  # pragma: no cover
        raise RuntimeError(str(h.exception()))


def topic_values(df: DataFrame) -> DataFrame:
    """Every row as one JSON ``value``, nulls included."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))


def kafka_sink(df: DataFrame, topic: str, checkpoint: str, options: dict | None = None):
    """Stream-to-topic sink: every row as a JSON ``value`` (broker options such
    as ``kafka.bootstrap.servers`` pass through). Returns the unstarted writer;
    needs the Kafka connector on the classpath."""
    return (topic_values(df).writeStream.format("kafka").option("topic", topic)
            .option("checkpointLocation", checkpoint).options(**(options or {})))


def start_stream(df: DataFrame, checkpoint: str, output_mode: str,
                 sink: Callable[[DataFrame, int], None], processing_time: str = "10 seconds",
                 name: str | None = None):
    """Long-running form: a micro-batch every ``processing_time`` (the trigger
    interval plays the role of a checkpoint interval: offsets and state are
    committed to ``checkpoint`` once per batch). Returns the query handle."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink).trigger(processingTime=processing_time))
    if name:
        w = w.queryName(name)
    return w.start()


def foreach_batch_jdbc(url: str, table: str, properties: dict | None = None,
                       mode: str = "append") -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch`` into a relational table over JDBC (the driver
    jar must be on the classpath). For exactly-once results into a keyed table,
    write each batch to a staging table and upsert from it on the database
    side, or use the change-log sink and ``latest_per_key``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode(mode).jdbc(url, table, properties=properties or {})
    return write
