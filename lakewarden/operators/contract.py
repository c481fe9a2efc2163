"""Schema contracts: breaking changes of enforced models against the active schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.text import blank_to_null
from lakewarden.functions.types import contract_type


def breaking_changes(
    models: DataFrame, model_columns: DataFrame, active_columns: DataFrame
) -> DataFrame:
    """Dropped columns and changed types of enforced models.

    `models`: `table_id`, `contract_enforced`; both column sides: `table_id`, `column_name`,
    `data_type`. One full outer join finds both kinds of change.
    """
    enforced = models.where("contract_enforced").select(F.lower("table_id").alias("__t")).distinct()
    active = active_columns.select(
        F.lower("table_id").alias("__t"),
        F.lower("column_name").alias("__c"),
        F.struct("table_id", "column_name", "data_type").alias("a"),
    ).join(enforced, "__t", "left_semi")
    known = active.select("__t").distinct()
    proposed = (
        model_columns.select(
            F.lower("table_id").alias("__t"),
            F.lower("column_name").alias("__c"),
            F.struct("column_name", "data_type").alias("p"),
        )
        .join(known, "__t", "left_semi")
    )
    joined = active.join(proposed, ["__t", "__c"], "left")
    typed = (
        blank_to_null(F.col("a.data_type")).isNotNull()
        & blank_to_null(F.col("p.data_type")).isNotNull()
    )
    mismatch = typed & (contract_type(F.col("a.data_type")) != contract_type(F.col("p.data_type")))
    change = F.when(F.col("p").isNull(), F.lit("DROPPED_COLUMN")).when(
        mismatch, F.lit("DATA_TYPE_MISMATCH")
    )
    return joined.select(
        F.col("a.table_id").alias("table_id"),
        F.col("a.column_name").alias("column_name"),
        change.alias("change_type"),
        F.col("a.data_type").alias("existing_type"),
        F.when(change == "DATA_TYPE_MISMATCH", F.col("p.data_type")).alias("proposed_type"),
    ).where(F.col("change_type").isNotNull())


def new_contracts(models: DataFrame, active_tables: DataFrame) -> DataFrame:
    """Enforced models whose table is not active yet."""
    active = active_tables.select(F.lower("table_id").alias("__t")).distinct()
    enforced = models.where("contract_enforced").withColumn("__t", F.lower("table_id"))
    return enforced.join(active, "__t", "left_anti").select("table_id")


def contract_report(models: DataFrame, changes: DataFrame, new: DataFrame) -> DataFrame:
    """One row: validated models, breaking changes, new models, compatible flag."""
    count = F.count(F.lit(1))
    return models.agg(F.count_if("contract_enforced").alias("validated_models")).select(
        "validated_models",
        changes.agg(count).scalar().alias("breaking_changes"),
        new.agg(count).scalar().alias("new_models"),
        (changes.agg(count).scalar() == 0).alias("compatible"),
    )
