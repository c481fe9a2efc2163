"""Event de-duplication: first delivery per key, within a time to live or for good."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import EVENT_DEDUPE_SECONDS, EVENT_ID_FIELDS
from lakewarden.functions.crypto import clean_signature
from lakewarden.functions.text import blank_to_null, json_scalar
from lakewarden.operators.chains import chain_anchors


def dedupe_key(fields: Column, items: Column, signature: Column, sent_at: Column) -> Column:
    """`id:<event id>` (ids of an array joined), else `sig:<seconds>:<signature>`, else null.

    `fields` and `items` are the payload parsed by `json_object` and `json_objects`.
    """
    ids = F.transform(items, lambda item: json_scalar(item, *EVENT_ID_FIELDS))
    of_items = blank_to_null(F.array_join(F.array_compact(ids), ","))
    event_id = F.coalesce(json_scalar(fields, *EVENT_ID_FIELDS), of_items)
    by_signature = F.concat(
        F.lit("sig:"),
        F.unix_seconds(sent_at.cast("timestamp")).cast("string"),
        F.lit(":"),
        F.lower(clean_signature(signature)),
    )
    return F.coalesce(
        F.concat(F.lit("id:"), event_id),
        F.when(blank_to_null(signature).isNotNull() & sent_at.isNotNull(), by_signature),
    )


def mark_duplicates(
    deliveries: DataFrame,
    key: str,
    at: str,
    tie: str,
    ttl_seconds: int | None = EVENT_DEDUPE_SECONDS,
    strict: bool = True,
) -> DataFrame:
    """Adds `is_duplicate`. `tie` is unique and orders deliveries of the same instant.

    With a time to live a key may be accepted again once more than that (`strict`), or at least
    that much, has passed since it was last accepted; without one only the first delivery counts. Deliveries without a key are
    always accepted. Copies of one key are reduced per task and instant before any shuffle, and
    the flags come back over the unique `tie`, so a hot key stays spread out. Keys seen only
    within one time to live, nearly all of them, are settled by a minimum; the rest follow
    their chain.
    """
    at_us = F.unix_micros(F.col(at).cast("timestamp"))
    keyed = deliveries.where(F.col(key).isNotNull()).select(key, at_us.alias("__at"), tie)
    if ttl_seconds is None:
        first = keyed.groupBy(key).agg(F.min(F.struct("__at", tie)).alias("f"))
        accepted = first.select(F.col(f"f.{tie}").alias("__ok"))
    else:
        accepted = accepted_in_time(keyed, key, tie, ttl_seconds * 1_000_000, strict)
    flagged = deliveries.join(accepted, F.col(tie) == F.col("__ok"), "left")
    duplicate = F.col(key).isNotNull() & F.col("__ok").isNull()
    return flagged.select(*deliveries.columns, duplicate.alias("is_duplicate"))


def accepted_in_time(keyed: DataFrame, key: str, tie: str, ttl_us: int, strict: bool) -> DataFrame:
    """`__ok`, the ties of accepted rows of `(key, __at, tie)`, times in microseconds."""
    instants = keyed.groupBy(key, "__at").agg(F.min(tie).alias(tie))
    spans = instants.groupBy(key).agg(
        F.min(F.struct("__at", tie)).alias("f"),
        F.max("__at").alias("last"),
        F.count(F.lit(1)).alias("__n"),
    )
    whole = F.col("last") - F.col("f.__at")
    short = (whole <= ttl_us) if strict else (whole < ttl_us)
    settled = spans.where(short).select(F.col(f"f.{tie}").alias("__ok"))
    lasting = instants.join(spans.where(~short).select(key, "__n"), key)
    chain = chain_anchors(lasting, [key], "__at", "__n", ttl_us, strict=strict)
    followed = chain.where(F.col("__at") == F.col("anchor")).select(F.col(tie).alias("__ok"))
    return settled.unionByName(followed)
