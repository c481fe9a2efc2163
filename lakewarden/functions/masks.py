"""Masking rules as columns. Nulls stay null; whatever a rule cannot handle is redacted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewarden.fixed_values import REDACTED
from lakewarden.functions.crypto import hmac_hex


@dataclass(frozen=True)
class MaskRule:
    rule_type: str
    pattern: str | None = None
    replacement: str | None = None
    key_id: str | None = None


def redact(value: Column, replacement: str = REDACTED) -> Column:
    return F.when(value.isNotNull(), F.lit(replacement))


def mask_email(value: Column) -> Column:
    """`user@host` becomes `u***@host`; anything else is redacted."""
    text = F.btrim(value.cast("string"))
    masked = F.concat(F.substring(text, 1, 1), F.lit("***@"), F.substring_index(text, "@", -1))
    return F.when(text.rlike("^[^@\\s]+@[^@\\s]+$"), masked).otherwise(redact(value))


def mask_last_four(value: Column) -> Column:
    """Only the last four characters stay; values of four or fewer are redacted."""
    text = F.regexp_replace(value.cast("string"), "[\\s-]", "")
    masked = F.concat(F.lit("**** **** **** "), F.right(text, F.lit(4)))
    return F.when(F.length(text) > 4, masked).otherwise(redact(value))


def mask_regex(value: Column, pattern: str, replacement: str) -> Column:
    """Replace every match of `pattern`; a value without a match is redacted."""
    text = value.cast("string")
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, replacement)).otherwise(
        redact(value)
    )


def pseudonym(value: Column, ipad: Column, opad: Column) -> Column:
    """HMAC pseudonym; without a key the value is redacted."""
    digest = hmac_hex(value.cast("string"), ipad, opad)
    return F.when(ipad.isNotNull() & opad.isNotNull(), digest).otherwise(redact(value))


def apply_rule(
    value: Column, rule: MaskRule | None, ipad: Column | None = None, opad: Column | None = None
) -> Column:
    """Mask `value` by `rule`; no rule or an unknown one redacts."""
    kind = (rule.rule_type if rule else "REDACT").strip().upper()
    if kind == "MASK_EMAIL":
        return mask_email(value)
    if kind == "MASK_LAST_FOUR":
        return mask_last_four(value)
    if kind == "HMAC_SHA256" and ipad is not None and opad is not None:
        return pseudonym(value, ipad, opad)
    if kind == "REGEX" and rule.pattern:
        return mask_regex(value, rule.pattern, rule.replacement or REDACTED)
    return redact(value, (rule.replacement if rule else None) or REDACTED)
