"""Signed event streams: verify, de-duplicate, route, count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import EVENT_DEDUPE_SECONDS
from lakewarden.operators.dedupe import dedupe_key
from lakewarden.operators.routing import affected_tables, with_parsed_payload
from lakewarden.operators.tickets import check_status_changes, parse_status_changes, replay_keys
from lakewarden.operators.verify import rejection, verify_timestamped
from lakewarden.streaming.ordered import first_in_time, in_time_order


def first_deliveries(accepted: DataFrame, key: str, ttl_seconds: int, strict: bool = True) -> DataFrame:
    """One delivery per key and time to live, by receive time, as `mark_duplicates` has it.

    State is the time of the last accepted delivery of a key, forgotten by a timer. A delivery
    that comes again after its time to live counts again. De-duplication comes after the checks,
    so a rejected delivery can be sent again.
    """
    step = first_in_time(ttl_seconds * 1_000_000, "received_at", strict)
    return in_time_order(accepted, key, "received_at", step, "allowed bigint", accepted.schema)


def catalog_event_stream(
    deliveries: DataFrame,
    keys: DataFrame,
    key_id: str,
    ttl_seconds: int = EVENT_DEDUPE_SECONDS,
) -> DataFrame:
    """Tables invalidated by a stream of signed catalog events."""
    checked = verify_timestamped(deliveries, keys, key_id)
    accepted = with_parsed_payload(checked.where(rejection().isNull())).select(
        "received_at",
        dedupe_key(F.col("fields"), F.col("items"), F.col("signature"), F.col("sent_at")).alias(
            "dedupe_key"
        ),
        affected_tables(F.col("fields"), F.col("items")).alias("tables"),
    )
    useful = accepted.where(F.size("tables") > 0)
    once = first_deliveries(useful, "dedupe_key", ttl_seconds)
    return once.select("received_at", F.explode("tables").alias("t")).select("received_at", "t.*")


def epoch_stream(invalidated: DataFrame, width: str = "1 minute") -> DataFrame:
    """Epoch increments per table and window of `catalog_event_stream`, by its watermark."""
    counted = invalidated.groupBy(
        F.window("received_at", width).alias("w"), "domain", "schema_name", "table_name"
    ).agg(F.count(F.lit(1)).alias("increments"))
    return counted.select(
        F.col("w.start").alias("window_start"), "domain", "schema_name", "table_name", "increments"
    )


def ticket_event_stream(
    deliveries: DataFrame, keys: DataFrame, ttl_seconds: int = EVENT_DEDUPE_SECONDS
) -> DataFrame:
    """Checked status changes of a stream, each signature once, without requests.

    `streaming.tickets` also binds and decides them.
    """
    checked = replay_keys(check_status_changes(parse_status_changes(deliveries), keys))
    accepted = checked.where(F.col("reject_reason").isNull())
    return first_deliveries(accepted, "replay_signature", ttl_seconds, strict=False)
