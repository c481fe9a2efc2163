"""Text, name and JSON helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewarden.fixed_values import EPOCH_MILLIS_ABOVE

_SCALAR = "^\\s*(?!(true|false)$)[^\\s{\\[]"
IDENTIFIER = "^[a-zA-Z_][a-zA-Z0-9_]*$"


def is_identifier(name: Column) -> Column:
    return F.coalesce(name.rlike(IDENTIFIER), F.lit(False))


def require_identifier(name: str) -> str:
    if not name or not re.fullmatch(IDENTIFIER, name):
        raise ValueError(f"not a valid identifier: {name!r}")
    return name


def blank_to_null(value: Column) -> Column:
    return F.when(F.btrim(value) != "", value)


def first_non_blank(*values: Column) -> Column:
    return F.coalesce(*[blank_to_null(v) for v in values])


def entity_name(raw: Column) -> Column:
    """Lower-case name of `[a-z0-9_.-]`, dashes collapsed and trimmed, at most 63 characters."""
    dashed = F.regexp_replace(F.lower(F.btrim(raw)), "[^a-z0-9_.-]", "-")
    trimmed = F.btrim(F.regexp_replace(dashed, "-+", "-"), F.lit("-"))
    short = F.rtrim(F.left(trimmed, F.lit(63)), F.lit("-"))
    return (
        F.when(F.coalesce(F.btrim(raw), F.lit("")) == "", F.lit("unnamed"))
        .when(short == "", F.lit("entity"))
        .otherwise(short)
    )


def clean_justification(text: Column, max_chars: int | None) -> Column:
    """Optional length cap, then control characters to blanks, then trim."""
    capped = text if max_chars is None else F.left(text, F.lit(max_chars))
    return F.btrim(F.regexp_replace(capped, "[\\x00-\\x1F\\x7F]", " "))


def hash_prefix(text: Column) -> Column:
    return F.left(F.upper(F.sha2(text, 256)), F.lit(12))


def contains_any(text: Column, phrases: Iterable[str], whole_words: bool = False) -> Column:
    """True when `text` holds one of the phrases; optionally only between word boundaries."""
    phrases = list(phrases)
    if whole_words:
        body = "|".join(re.escape(p) for p in phrases)
        return text.rlike(f"(?<!\\w)(?:{body})(?!\\w)")
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | text.contains(phrase)
    return hit


def json_object(text: Column) -> Column:
    """Top-level fields of a JSON object as text, parsed in one pass.

    Null for arrays, scalars and malformed text. Nested values keep their JSON text; a field
    that is JSON null is present with a null value.
    """
    return F.from_json(text, "map<string,string>")


def json_objects(text: Column) -> Column:
    """The objects of a JSON array, each as by `json_object`; null for anything else."""
    return F.when(text.rlike("^\\s*\\["), F.from_json(text, "array<map<string,string>>"))


def json_scalar(fields: Column, *names: str) -> Column:
    """First of the named fields that is a non-blank string or a number."""

    return F.coalesce(*[F.when(fields[n].rlike(_SCALAR), fields[n]) for n in names])


def epoch_to_timestamp(value: Column) -> Column:
    """Epoch seconds, or milliseconds when the number is too large for seconds."""
    return F.when(value > EPOCH_MILLIS_ABOVE, F.timestamp_millis(value)).otherwise(
        F.timestamp_seconds(value)
    )
