"""Change streams: normalise envelopes and keep a snapshot up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakewarden.operators.cdc_apply import activity_windows, apply_changes
from lakewarden.sources.debezium import parse_envelopes, typed_row
from lakewarden.streaming.tables import read_table, upsert_batch, write_batch

DELETED = "deleted"
BY = ["domain", "schema_name", "table_name", "operation"]
ACTIVITY = (
    "window_start timestamp, domain string, schema_name string, table_name string, operation string, "
    "events bigint, greatest bigint, batch_id bigint"
)


def cdc_events(raw: DataFrame, json: str = "value", received_at: str = "received_at") -> DataFrame:
    """Well-formed events of a raw stream (or batch) of envelopes."""
    return parse_envelopes(raw, json, received_at).where(~F.col("malformed"))


def typed_changes(events: DataFrame, row_schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Events as flat rows of the caller's schema, plus the columns to `keep`.

    Deletes take their key from `before`.
    """
    row = typed_row(F.coalesce("after", "before"), row_schema)
    return events.withColumn("__row", row).select(
        "operation", "tenant_id", "ts_ms", "event_id", *keep, "__row.*"
    )


def keep_snapshot(
    changes: DataFrame,
    root: str,
    schema: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint_location: str,
    version: str | None = None,
    buckets: int = 64,
    **trigger,
) -> StreamingQuery:
    """Applies every micro-batch to the table `root`; `read_snapshot` reads it.

    Only the partitions that a batch's keys fall into are read and overwritten. A micro-batch that
    is run again ends in the same table. Deletes stay as rows marked `deleted`, so with `version` a
    change that comes late is known to be older than a delete.
    """
    kept = StructType.fromDDL(schema).add(DELETED, "boolean")

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        return apply_changes(old, batch, keys, order, version=version, deleted=DELETED)

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            upsert_batch(batch, batch_id, root, kept, keys, merge, buckets)
        finally:
            batch.unpersist()

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_snapshot(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of a kept snapshot without those deleted."""
    kept = StructType.fromDDL(schema).add(DELETED, "boolean")
    return read_table(spark, root, kept).where(~F.col(DELETED)).drop(DELETED)


def activity_stream(events: DataFrame, width: str = "1 minute", late: str = "5 minutes") -> DataFrame:
    """Events per table, operation and window, with late data up to `late`; later rows are left out.

    `keep_activity` sets those aside.
    """
    marked = events.withWatermark("event_time", late)
    return activity_windows(marked, "event_time", BY, width)


def keep_activity(
    events: DataFrame,
    root: str,
    checkpoint_location: str,
    width: str = "1 minute",
    late_seconds: int = 300,
    **trigger,
) -> StreamingQuery:
    """Counts per window in `<root>/windows`; rows whose window has closed go to `<root>/late`.

    A window is closed once the greatest event time of earlier micro-batches is `late_seconds`
    beyond its end. That time is kept with the counts, so every row is either counted or set aside,
    and a micro-batch that is run again decides alike and replaces its own partitions. Rows without
    a time are set aside.
    """
    windows, aside = f"{root}/windows", f"{root}/late"
    # not by F.window, which leaves out rows without a time
    at, size = F.unix_micros("event_time"), F.expr(f"unix_micros(timestamp_seconds(0) + interval {width})")
    end = at - F.pmod(at, size) + size

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_table(spark, windows, ACTIVITY).where(F.col("batch_id") < batch_id)
        greatest = before.agg(F.max("greatest")).first()[0]
        closed = F.lit(False) if greatest is None else end <= F.lit(greatest - late_seconds * 1_000_000)
        batch = batch.withColumn("__late", F.coalesce(closed, F.lit(True)) | F.col("event_time").isNull()).persist()
        try:
            write_batch(batch.where("__late").drop("__late"), aside, batch_id)
            on_time = batch.where("not __late")
            counted = on_time.groupBy(F.window("event_time", width).alias("w"), *BY).agg(
                F.count(F.lit(1)).alias("events"), F.max(F.unix_micros("event_time")).alias("greatest")
            )
            write_batch(counted.select(F.col("w.start").alias("window_start"), *BY, "events", "greatest"), windows, batch_id)
        finally:
            batch.unpersist()

    return (
        events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_activity(spark: SparkSession, root: str) -> DataFrame:
    """Events per window and group over all micro-batches."""
    counts = read_table(spark, f"{root}/windows", ACTIVITY)
    return counts.groupBy("window_start", *BY).agg(F.sum("events").alias("events"))
