"""Catalog synchronisation with a merge that only ever tightens protection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import HIGH_SENSITIVITY
from lakewarden.operators.identity import ID, id_key
from lakewarden.operators.tagging import TagConfig, first_rule, has_tag

_RANK = {"PUBLIC": 0, "LOW": 1, "NORMAL": 2, "INTERNAL": 3, "HIGH": 5, "RESTRICTED": 6}
_UNKNOWN_RANK = 4


def sensitivity_rank(level: Column) -> Column:
    """Order of sensitivity levels; an unknown level ranks above all grantable ones."""
    rank = F.lit(_UNKNOWN_RANK)
    for name, value in _RANK.items():
        rank = F.when(F.upper(F.btrim(level)) == name, F.lit(value)).otherwise(rank)
    return F.when(level.isNotNull(), rank)


def stricter(existing: Column, incoming: Column) -> Column:
    keep = F.coalesce(sensitivity_rank(existing) >= sensitivity_rank(incoming), F.lit(False))
    return F.when(keep, existing).otherwise(incoming)


def sync_tables(assets: DataFrame, existing: DataFrame, config: TagConfig) -> DataFrame:
    """Merged table metadata of the synced assets, with `is_art9`, `is_new` and `retained`.

    `assets`: identity, `display_name`, `description`, `source_type`, `tags`,
    `classifications`. `existing`: identity, `sensitivity`, `requires_four_eyes`, `is_active`,
    `source_type`. Both sides join once on the identity, ignoring case.
    """
    old = existing.select(
        id_key().alias("__id"),
        F.col("sensitivity").alias("__sens"),
        F.col("requires_four_eyes").alias("__eyes"),
        F.col("is_active").alias("__active"),
        F.col("source_type").alias("__source"),
        F.lit(True).alias("__known"),
    )
    joined = assets.withColumn("__id", id_key()).join(old, "__id", "left")
    none = F.array().cast("array<string>")
    art9 = has_tag(F.coalesce("tags", none), config.art9_tags) | has_tag(
        F.coalesce("classifications", none), config.art9_tags
    )
    incoming = F.when(art9, F.lit("HIGH")).otherwise(F.coalesce("__sens", F.lit("NORMAL")))
    known = F.coalesce("__known", F.lit(False))
    retained = known & ~art9 & F.upper("__sens").isin(HIGH_SENSITIVITY)
    return joined.select(
        *ID,
        F.coalesce("display_name", "table_name").alias("display_name"),
        "description",
        F.coalesce("__source", "source_type").alias("source_type"),
        stricter(F.col("__sens"), incoming).alias("sensitivity"),
        (art9 | F.coalesce("__eyes", F.lit(False))).alias("requires_four_eyes"),
        F.when(known, F.col("__active"))
        .otherwise(F.lit(config.activate_new))
        .alias("is_active"),
        art9.alias("is_art9"),
        (~known).alias("is_new"),
        F.coalesce(retained, F.lit(False)).alias("retained"),
    )


def sync_columns(
    asset_columns: DataFrame, existing_columns: DataFrame, assets: DataFrame, config: TagConfig
) -> DataFrame:
    """Merged columns of the synced tables.

    `asset_columns`: identity, `column_name`, `data_type`, `description`, `tags`.
    `existing_columns`: identity, `column_name`, `data_type`, `is_sensitive`, `rule_type`.
    A catalog rule replaces an existing one; sensitivity, rules without a replacement and
    columns the catalog no longer lists are kept. `origin` tells which side a row came from.
    """
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    matched = first_rule(tags, config.rule_of_tag)
    new = asset_columns.select(
        id_key().alias("__id"),
        F.lower("column_name").alias("__col"),
        F.struct(
            *ID,
            "column_name",
            "data_type",
            "description",
            matched.alias("rule"),
            (matched.isNotNull() | has_tag(tags, config.pii_tags)).alias("sensitive"),
        ).alias("n"),
    )
    synced = assets.select(id_key().alias("__id")).distinct()
    old = (
        existing_columns.select(
            id_key().alias("__id"),
            F.lower("column_name").alias("__col"),
            F.struct(*ID, "column_name", "data_type", "is_sensitive", "rule_type").alias("o"),
        )
        .join(synced, "__id", "left_semi")
    )
    joined = new.join(old, ["__id", "__col"], "full_outer")

    def side(name: str) -> Column:
        return F.coalesce(F.col(f"n.{name}"), F.col(f"o.{name}"))

    return joined.select(
        *[side(c).alias(c) for c in [*ID, "column_name", "data_type"]],
        F.col("n.description").alias("description"),
        (
            F.coalesce("n.sensitive", F.lit(False)) | F.coalesce("o.is_sensitive", F.lit(False))
        ).alias("is_sensitive"),
        F.coalesce("n.rule", "o.rule_type").alias("rule_type"),
        F.col("n.rule").isNotNull().alias("masked_by_catalog"),
        F.when(F.col("o").isNull(), F.lit("catalog"))
        .when(F.col("n").isNull(), F.lit("retained"))
        .otherwise(F.lit("merged"))
        .alias("origin"),
    )


def sync_counters(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """One row of counters; computed the same for a dry run."""
    t = tables.agg(
        F.count(F.lit(1)).alias("synced_tables"),
        F.count_if("is_art9").alias("art9_tables"),
        F.count_if("retained").alias("retained_tables"),
    )
    c = columns.agg(
        F.count_if(F.col("origin") != "retained").alias("synced_columns"),
        F.count_if("masked_by_catalog").alias("masked_columns"),
    )
    columns_of = c.select(F.struct("*").alias("c")).scalar()
    return t.withColumn("__c", columns_of).select("*", "__c.*").drop("__c")


def bump_epochs(epochs: DataFrame, affected: DataFrame) -> DataFrame:
    """Stored epochs `(domain, schema_name, table_name, epoch)` plus one per affected row."""
    hits = affected.groupBy(*ID).agg(F.count(F.lit(1)).alias("hits"))
    joined = epochs.join(hits, ID, "full_outer")
    return joined.select(
        *ID,
        (F.coalesce("epoch", F.lit(0)) + F.coalesce("hits", F.lit(0)))
        .cast("bigint")
        .alias("epoch"),
    )
