"""Tags to sensitivity, masking rules and approval flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import REDACTED


@dataclass(frozen=True)
class TagConfig:
    art9_tags: tuple[str, ...] = ()
    pii_tags: tuple[str, ...] = ()
    rule_of_tag: Mapping[str, str] = field(default_factory=dict)
    hmac_key_id: str | None = None
    activate_new: bool = True


def has_tag(tags: Column, configured: Iterable[str]) -> Column:
    """Any tag equal to a configured one, ignoring case."""
    wanted = [t.lower() for t in configured]
    return F.coalesce(F.exists(tags, lambda t: F.lower(t).isin(wanted)), F.lit(False))


def matches_tag(tag: Column, configured: Iterable[str]) -> Column:
    """Equal, or one is a dotted prefix or suffix of the tag."""
    low = F.lower(tag)
    hit = F.lit(False)
    for c in (c.lower() for c in configured if c.strip()):
        hit = hit | (low == c) | low.endswith(f".{c}") | low.startswith(f"{c}.")
    return hit


def first_rule(tags: Column, rule_of_tag: Mapping[str, str]) -> Column:
    """Rule of the first tag that has one."""
    if not rule_of_tag:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for k, v in rule_of_tag.items() for x in (k.lower(), v)]
    table = F.create_map(*pairs)
    rules = F.transform(tags, lambda t: F.try_element_at(table, F.lower(t)))
    return F.get(F.filter(rules, lambda r: r.isNotNull()), 0)


def rule_parameters(rule: Column, hmac_key_id: str | None) -> dict[str, Column]:
    kind = F.upper(rule)
    return {
        "pattern": F.when(kind == "HMAC_SHA256", F.lit("SHA256")),
        "replacement": F.when(kind == "REDACT", F.lit(REDACTED)),
        "hmac_key_id": F.when(kind == "HMAC_SHA256", F.lit(hmac_key_id).cast("string")),
    }


def map_columns(columns: DataFrame, config: TagConfig) -> DataFrame:
    """Adds `is_sensitive`, `is_art9`, `rule_type` and rule parameters to `columns(tags, ...)`."""
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    mapped = first_rule(tags, config.rule_of_tag)

    def sensitive(t: Column) -> Column:
        low = F.lower(t)
        return (
            matches_tag(t, config.art9_tags)
            | matches_tag(t, config.pii_tags)
            | low.startswith("pii.")
            | low.startswith("personaldata.")
            | (low == "pii")
        )

    flag = mapped.isNotNull() | F.coalesce(F.exists(tags, sensitive), F.lit(False))
    rule = F.when(flag, F.coalesce(mapped, F.lit("REDACT")))
    art9 = F.exists(tags, lambda t: matches_tag(t, config.art9_tags))
    return columns.withColumns(
        {"is_sensitive": flag, "is_art9": F.coalesce(art9, F.lit(False)), "rule_type": rule}
    ).withColumns(rule_parameters(F.col("rule_type"), config.hmac_key_id))


def map_tables(
    tables: DataFrame,
    columns: DataFrame,
    key: str,
    config: TagConfig,
    known: DataFrame | None = None,
) -> DataFrame:
    """Adds `sensitivity`, `requires_four_eyes`, `is_active`, `masking_rules` per table.

    `columns` comes from `map_columns` and carries `key`; `known` holds the keys of tables
    that already exist.
    """
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    per_table = columns.groupBy(key).agg(
        F.max("is_art9").alias("__art9"), F.count("rule_type").alias("masking_rules")
    )
    joined = tables.join(per_table, key, "left")
    if known is None:
        joined = joined.withColumn("__known", F.lit(False))
    else:
        marks = known.select(key).distinct().withColumn("__known", F.lit(True))
        joined = joined.join(marks, key, "left")
    art9 = F.coalesce("__art9", F.lit(False)) | F.exists(
        tags, lambda t: matches_tag(t, config.art9_tags)
    )
    high = art9 | F.exists(
        tags, lambda t: F.lower(t).contains("sensitive") | matches_tag(t, config.pii_tags)
    )
    four_eyes = art9 | F.exists(tags, lambda t: F.lower(t).contains("foureyes"))
    known_flag = F.coalesce("__known", F.lit(False))
    return joined.withColumns(
        {
            "sensitivity": F.when(high, F.lit("HIGH")).otherwise(F.lit("NORMAL")),
            "requires_four_eyes": four_eyes,
            "is_active": known_flag | F.lit(config.activate_new),
            "masking_rules": F.coalesce("masking_rules", F.lit(0).cast("bigint")),
        }
    ).drop("__art9", "__known")
