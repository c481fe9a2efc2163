"""HMAC-SHA256 from built-in `sha2`; keys travel as table columns, never as plan literals."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCK = 64


def hmac_pads(secret: str | bytes) -> tuple[bytes, bytes]:
    """Inner and outer pad of one secret; keys longer than a block are hashed first."""
    key = secret.encode() if isinstance(secret, str) else bytes(secret)
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def key_table(spark: SparkSession, secrets: Mapping[str, str | bytes]) -> DataFrame:
    """Rows `(key_id, ipad, opad)`, one per non-blank secret held by the caller."""
    rows = [(k, *hmac_pads(s)) for k, s in secrets.items() if k and s]
    return spark.createDataFrame(rows, "key_id string, ipad binary, opad binary")


def key_pads(keys: DataFrame, key_id: str) -> tuple[Column, Column]:
    """Pads of one key as scalar subqueries; null when there is no such key."""
    one = keys.where(F.col("key_id") == key_id)
    return one.agg(F.max("ipad")).scalar(), one.agg(F.max("opad")).scalar()


def hmac_hex(message: Column, ipad: Column, opad: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of the UTF-8 bytes of `message`."""
    inner = F.sha2(F.concat(ipad, message.cast("string").cast("binary")), 256)
    return F.sha2(F.concat(opad, F.unhex(inner)), 256)


def clean_signature(signature: Column) -> Column:
    """Signature without blanks and without the optional `sha256=` prefix."""
    return F.regexp_replace(F.btrim(signature), "^(?i)sha256=", "")


def signature_hex(signature: Column, allow_base64: bool = True) -> Column:
    """Signature as lower-case hex from hex or base64 text; null when it is neither."""
    clean = clean_signature(signature)
    result = F.when(clean.rlike("^[0-9a-fA-F]{64}$"), F.lower(clean))
    if allow_base64:
        result = result.when(
            clean.rlike("^[A-Za-z0-9+/]{43}=$"), F.lower(F.hex(F.unbase64(clean)))
        )
    return result
