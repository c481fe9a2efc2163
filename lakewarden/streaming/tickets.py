"""Status changes of tickets as a stream: check, bind, refuse replays, decide, change the request."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from lakewarden.fixed_values import EVENT_DEDUPE_SECONDS
from lakewarden.operators.tickets import bound_status_changes, decide_requests
from lakewarden.streaming.ordered import first_in_time, in_time_order
from lakewarden.streaming.tables import read_table, write_batch


def marked_ticket_stream(
    deliveries: DataFrame,
    keys: DataFrame,
    instances: DataFrame,
    requests: DataFrame,
    delivery_id: str,
    ttl_seconds: int = EVENT_DEDUPE_SECONDS,
    late: str = "15 minutes",
) -> DataFrame:
    """Bound deliveries with replays refused, in receive order whatever the order of micro-batches.

    A delivery waits in its key's state until the watermark has passed it. A verified signature
    covers the payload and with it the event id, so equal signatures mean equal events: the event
    key decides alone where there is one, the signature else. Deliveries refused before that pass
    at once.
    """
    # every delivery moves the watermark, refused ones too
    timed = deliveries.withWatermark("received_at", late)
    bound = bound_status_changes(timed, keys, instances, requests, delivery_id)
    usable = bound.where(F.col("reject_reason").isNull()).withColumn(
        "__replay", F.coalesce("replay_event", "replay_signature")
    )
    accept = first_in_time(ttl_seconds * 1_000_000, "received_at", strict=False)

    def mark(held: tuple | None, pdf: pd.DataFrame):
        carry, kept, free = accept(held, pdf)
        return carry, pdf.assign(reject_reason=[None if i in kept.index else "REPLAY" for i in pdf.index]), free

    schema = StructType([f if f.name != "reject_reason" else StructField(f.name, f.dataType, True) for f in usable.schema])
    marked = in_time_order(
        usable, "__replay", "received_at", mark, "allowed bigint", schema, ties=(delivery_id,), late=None, hold=True
    )
    refused = bound.where(F.col("reject_reason").isNotNull())
    return marked.drop("__replay").unionByName(refused)


def keep_transitions(
    marked: DataFrame, root: str, delivery_id: str, checkpoint_location: str, **trigger
) -> StreamingQuery:
    """Writes the outcome of every delivery to the table `root`, one partition per micro-batch.

    Deliveries come in receive order, so the first effective one of a request in the earliest
    micro-batch decides it; later ones find it decided. A micro-batch that is run again after a
    failure looks only at earlier ones and replaces its own partition, so it writes the same.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        outcomes = decide_requests(batch.limit(0), delivery_id)
        schema = StructType([*outcomes.schema.fields]).add("batch_id", "long")
        before = read_table(batch.sparkSession, root, schema).where(
            (F.col("batch_id") < batch_id) & F.col("new_status").isNotNull()
        )
        decided = before.select("request_id", F.col("new_status").alias("__now"))
        batch = batch.persist()  # it is used twice, the keys' state must be walked once
        try:
            known = batch.join(decided, "request_id", "left").withColumn(
                "request_status", F.coalesce("__now", "request_status")
            )
            write_batch(decide_requests(known.select(*batch.columns), delivery_id), root, batch_id)
        finally:
            batch.unpersist()

    return (
        marked.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_requests(requests: DataFrame, transitions: DataFrame) -> DataFrame:
    """The requests with the status that the transitions gave them."""
    decided = transitions.where(F.col("new_status").isNotNull()).select("request_id", "new_status")
    changed = requests.join(decided, "request_id", "left")
    return changed.withColumn("status", F.coalesce("new_status", "status")).select(*requests.columns)
