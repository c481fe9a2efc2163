"""Signature and time checks of deliveries. There is no bypass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import EVENT_TOLERANCE_SECONDS
from lakewarden.functions.crypto import hmac_hex, key_pads, signature_hex
from lakewarden.functions.text import blank_to_null
from lakewarden.session import broadcast_if_bounded


def within_tolerance(
    received_at: Column, sent_at: Column, seconds: int = EVENT_TOLERANCE_SECONDS
) -> Column:
    """Null when either time is missing."""
    delta = F.unix_micros(received_at.cast("timestamp")) - F.unix_micros(sent_at.cast("timestamp"))
    return F.abs(delta) <= seconds * 1_000_000


def iso_timestamp(at: Column) -> Column:
    """Round-trip ISO-8601 text with seven fraction digits, in UTC."""
    return F.concat(
        F.date_format(at.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0+00:00")
    )


def _signed_with(message: Column, provided: Column, ipad: Column, opad: Column) -> Column:
    return F.coalesce(hmac_hex(message, ipad, opad) == provided, F.lit(False))


def verify_timestamped(
    deliveries: DataFrame, keys: DataFrame, key_id: str, legacy_payload_only: bool = False
) -> DataFrame:
    """Adds `signature_valid` for signatures over `<unix seconds>.<payload>`, hex or base64."""
    provided = signature_hex(F.col("signature"))
    pads = key_pads(keys, key_id)
    seconds = F.unix_seconds(F.col("sent_at").cast("timestamp")).cast("string")
    valid = _signed_with(F.concat(seconds, F.lit("."), F.col("payload")), provided, *pads)
    if legacy_payload_only:
        valid = valid | _signed_with(F.col("payload"), provided, *pads)
    return deliveries.withColumn("signature_valid", valid)


def verify_per_instance(
    deliveries: DataFrame, keys: DataFrame, instance: str = "instance_id"
) -> DataFrame:
    """Adds `signature_valid` for signatures over `t=<timestamp>.v1=<payload>`.

    The timestamp is the raw header text or the ISO form of `sent_at`; the secret belongs to
    the instance named in the payload.
    """
    provided = signature_hex(F.col("signature"), allow_base64=False)

    def message(t: Column) -> Column:
        return F.concat(F.lit("t="), t, F.lit(".v1="), F.col("payload"))

    raw = blank_to_null(F.col("raw_timestamp"))
    iso = iso_timestamp(F.col("sent_at"))
    pads = F.col("__ipad"), F.col("__opad")
    valid = _signed_with(message(raw), provided, *pads) | _signed_with(
        message(iso), provided, *pads
    )
    secrets = keys.select(
        F.col("key_id").alias("__key_id"),
        F.col("ipad").alias("__ipad"),
        F.col("opad").alias("__opad"),
    )
    joined = deliveries.join(
        broadcast_if_bounded(secrets), F.col(instance) == F.col("__key_id"), "left"
    )
    return joined.withColumn("signature_valid", valid).drop("__key_id", "__ipad", "__opad")


def verify_payload(deliveries: DataFrame, keys: DataFrame, key_id: str) -> DataFrame:
    """Adds `signature_valid` for hex signatures over the payload alone."""
    provided = signature_hex(F.col("signature"), allow_base64=False)
    valid = _signed_with(F.col("payload"), provided, *key_pads(keys, key_id))
    return deliveries.withColumn("signature_valid", valid)


def rejection(tolerance_seconds: int = EVENT_TOLERANCE_SECONDS) -> Column:
    """First reason to reject a checked delivery, else null."""
    on_time = within_tolerance(F.col("received_at"), F.col("sent_at"), tolerance_seconds)
    return (
        F.when(F.col("sent_at").isNull(), F.lit("REJECTED_MISSING_TIMESTAMP"))
        .when(~F.coalesce(on_time, F.lit(False)), F.lit("REJECTED_TIMESTAMP_EXPIRED"))
        .when(
            blank_to_null(F.col("signature")).isNull(), F.lit("REJECTED_MISSING_SIGNATURE")
        )
        .when(~F.col("signature_valid"), F.lit("REJECTED_INVALID_SIGNATURE"))
    )
