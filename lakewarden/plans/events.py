"""Batch processing of signed deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import EVENT_DEDUPE_SECONDS
from lakewarden.operators.dedupe import dedupe_key, mark_duplicates
from lakewarden.operators.rate_limit import limit_calls
from lakewarden.operators.replay import mark_joint_replays
from lakewarden.operators.routing import (
    affected_tables,
    delivery_status,
    epoch_increments,
    invalidations,
    with_parsed_payload,
)
from lakewarden.operators.tickets import decide_requests, stored_status_changes
from lakewarden.operators.triage import triage
from lakewarden.operators.verify import rejection, verify_timestamped
from lakewarden.session import checkpoint


def process_catalog_events(
    deliveries: DataFrame,
    keys: DataFrame,
    key_id: str,
    delivery_id: str,
    legacy_payload_only: bool = False,
    ttl_seconds: int = EVENT_DEDUPE_SECONDS,
) -> DataFrame:
    """`status`, `dedupe_key` and `tables` of every delivery, without its payload.

    Only deliveries that passed the checks and speak of a table take part in de-duplication,
    so a rejected or useless one never blocks a later good one. The checked deliveries are
    stored once in their short form, so no payload is parsed or signed twice.
    """
    verified = verify_timestamped(deliveries, keys, key_id, legacy_payload_only)
    checked = checkpoint(
        with_parsed_payload(verified).select(
            delivery_id,
            "received_at",
            rejection().alias("rejected"),
            dedupe_key(F.col("fields"), F.col("items"), F.col("signature"), F.col("sent_at")).alias(
                "dedupe_key"
            ),
            affected_tables(F.col("fields"), F.col("items")).alias("tables"),
        )
    )
    useful = F.col("rejected").isNull() & (F.size("tables") > 0)
    counted = checked.withColumn("__key", F.when(useful, F.col("dedupe_key")))
    marked = mark_duplicates(counted, "__key", "received_at", delivery_id, ttl_seconds)
    status = delivery_status(F.col("rejected"), F.col("is_duplicate"), F.col("tables"))
    return marked.select(
        delivery_id, "received_at", "dedupe_key", "tables", status.alias("status")
    )


def skip_repeated(
    events: DataFrame, delivery_id: str, ttl_seconds: int = EVENT_DEDUPE_SECONDS
) -> DataFrame:
    """Policy-store or job-run events (`policy_events`, `run_events`) with repeated ids refused.

    Only events that passed their checks count, so a refused one may come again. A `route`, if
    there is one, goes with the refusal.
    """
    stored = checkpoint(events)
    key = F.when(F.col("reject_reason").isNull(), F.col("event_id"))
    marked = mark_duplicates(stored.withColumn("__key", key), "__key", "received_at", delivery_id, ttl_seconds)
    repeated = F.when(F.col("is_duplicate"), F.lit("IGNORED_DUPLICATE_EVENT"))
    out = marked.withColumn("reject_reason", F.coalesce("reject_reason", repeated))
    if "route" in events.columns:
        out = out.withColumn("route", F.when(F.col("reject_reason").isNull(), F.col("route")))
    return out.drop("__key", "is_duplicate")


def catalog_epochs(processed: DataFrame) -> DataFrame:
    """Epoch increments per table of processed deliveries."""
    return epoch_increments(invalidations(processed))


def process_ticket_events(
    deliveries: DataFrame,
    keys: DataFrame,
    instances: DataFrame,
    requests: DataFrame,
    delivery_id: str,
    ttl_seconds: int = EVENT_DEDUPE_SECONDS,
) -> DataFrame:
    """Outcome of every ticket delivery; replays by event id or signature have no effect.

    A delivery counts only if both of its keys are free, and takes both or none.

    Deliveries that cannot take effect are sorted out before replays are looked for, so a
    failed one may be sent again. The bound deliveries are stored once without payload.
    """
    bound = stored_status_changes(deliveries, keys, instances, requests, delivery_id)
    usable = F.col("reject_reason").isNull()
    keyed = bound.withColumns({f"__{k}": F.when(usable, F.col(k)) for k in ("replay_event", "replay_signature")})
    # a ticket event counts again at exactly the end of its time to live
    marked = mark_joint_replays(
        keyed, "__replay_event", "__replay_signature", "received_at", delivery_id, ttl_seconds, strict=False
    )
    replay = F.when(F.col("is_duplicate"), F.lit("REPLAY"))
    bound = marked.withColumn("reject_reason", F.coalesce("reject_reason", replay)).drop(
        "__replay_event", "__replay_signature", "replay_event", "replay_signature", "is_duplicate"
    )
    return decide_requests(bound, delivery_id)


def triage_requests(
    requests: DataFrame, caller: str, at: str, request_id: str, text: str, **options
) -> DataFrame:
    """Rate-limits callers, then triages; limited requests go to manual review."""
    limited = limit_calls(requests, caller, at, request_id)
    return triage(limited, text, limited="is_limited", **options)
