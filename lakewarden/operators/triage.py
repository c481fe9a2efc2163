"""Triage of access justifications by an ordered cascade of phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import (
    AUDIT_PHRASES,
    EXFILTRATION_PHRASES,
    INCIDENT_PHRASES,
    INJECTION_PHRASES,
    TRIAGE_MIN_CHARS,
    TRIAGE_REASONS,
    UNJUSTIFIED_PHRASES,
)
from lakewarden.functions.text import clean_justification, contains_any, hash_prefix


def triage(
    requests: DataFrame,
    text: str,
    max_chars: int | None = None,
    whole_words: bool = False,
    limited: str | None = None,
) -> DataFrame:
    """Adds `category`, `confidence`, `triage_reason`, `auto_grant` and `text_hash`.

    Whole texts are read; `max_chars` is for callers that cap justifications on entry, as an
    interactive form does (`TRIAGE_MAX_CHARS`). `limited` names a flag column of rate-limited
    requests, which go to manual review unclassified. Nothing is ever granted automatically.
    The cascade is one projection; the cleaned text is computed once per row.
    """
    source = requests.withColumn("__text", clean_justification(F.col(text), max_chars))
    source = source.withColumn("__low", F.lower("__text"))

    def has(phrases: list[str]):
        return contains_any(F.col("__low"), phrases, whole_words)

    rule = (
        F.when(has(INJECTION_PHRASES), F.lit("injection"))
        .when(has(EXFILTRATION_PHRASES), F.lit("exfiltration"))
        .when(has(AUDIT_PHRASES), F.lit("audit"))
        .when(has(INCIDENT_PHRASES), F.lit("incident"))
        .when(
            (F.length("__text") < TRIAGE_MIN_CHARS) | has(UNJUSTIFIED_PHRASES),
            F.lit("unjustified"),
        )
        .otherwise(F.lit("other"))
    )
    if limited is not None:
        rule = F.when(F.col(limited), F.lit("limited")).otherwise(rule)
    ruled = source.withColumn("__rule", rule)
    name = F.col("__rule")
    category = (
        F.when(name.isin("injection", "exfiltration"), F.lit("SuspiciousExfiltration"))
        .when(name == "audit", F.lit("LegitimateAudit"))
        .when(name == "incident", F.lit("IncidentTriage"))
        .when(name == "unjustified", F.lit("Unjustified"))
        .otherwise(F.lit("Unclassified"))
    )
    confidence = (
        F.when(name == "injection", F.lit(0.99))
        .when(name == "exfiltration", F.lit(0.95))
        .when(name.isin("audit", "incident"), F.lit(0.98))
        .when(name == "unjustified", F.lit(0.90))
        .when(name == "limited", F.lit(0.0))
        .otherwise(F.lit(0.50))
    )
    reason = F.lit(None).cast("string")
    for key, value in TRIAGE_REASONS.items():
        reason = F.when(name == key, F.lit(value)).otherwise(reason)
    return ruled.withColumns(
        {
            "category": category,
            "confidence": confidence,
            "triage_reason": reason,
            "auto_grant": F.lit(False),
            "text_hash": F.when(name == "injection", hash_prefix(F.col("__text"))),
        }
    ).drop("__text", "__low", "__rule")
