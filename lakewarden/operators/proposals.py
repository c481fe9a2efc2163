"""Protection proposals from dbt models, their review, and descriptions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import REDACTED
from lakewarden.functions.text import blank_to_null

PENDING, APPROVED, REJECTED = "PendingReview", "Approved", "Rejected"


def _meta(key: str) -> Column:
    return F.try_element_at("meta", F.lit(key))


def _any_tag(part: str) -> Column:
    return F.exists("tags", lambda t: F.lower(t).contains(part))


def pii_proposals(columns: DataFrame) -> DataFrame:
    """Columns with personal data: by metadata, by tag or by name."""
    flagged = F.lower(_meta("pii")).isin("true", "1")
    name = F.lower("column_name")
    email = _any_tag("email") | name.contains("email")
    ssn = _any_tag("ssn") | name.contains("ssn")
    pseudonym = _any_tag("pseudonym")
    rule = (
        F.when(email, F.lit("MASK_EMAIL"))
        .when(ssn, F.lit("REDACT"))
        .when(pseudonym, F.lit("HMAC_SHA256"))
        .when(flagged, F.lit("REDACT"))
    )
    source = F.coalesce(
        F.get("tags", 0),
        F.when(_meta("pii").isNotNull(), F.lit("meta.pii=true")),
        F.concat(F.lit("column:"), F.col("column_name")),
    )
    return _proposal(columns.where(rule.isNotNull()), F.col("column_name"), rule, source)


def row_filter_proposals(columns: DataFrame, models: DataFrame) -> DataFrame:
    """Row filters declared on columns and on whole models."""
    rule = F.concat(F.lit("RLS_FILTER:"), _meta("rls_filter"))
    declared = blank_to_null(_meta("rls_filter")).isNotNull()
    source = F.lit("meta.rls_filter")
    on_columns = _proposal(columns.where(declared), F.col("column_name"), rule, source)
    on_models = _proposal(_owned(models).where(declared), F.lit("*"), rule, source)
    return on_columns.unionByName(on_models)


def role_proposals(models: DataFrame) -> DataFrame:
    rule = F.concat(F.lit("CASBIN_ROLES:"), _meta("casbin_roles"))
    declared = blank_to_null(_meta("casbin_roles")).isNotNull()
    return _proposal(
        _owned(models).where(declared), F.lit("*"), rule, F.lit("meta.casbin_roles")
    )


def _owned(models: DataFrame) -> DataFrame:
    return models.withColumn("owner", _meta("owner"))


def _proposal(rows: DataFrame, column: Column, rule: Column, source: Column) -> DataFrame:
    return rows.select(
        "table_id",
        column.alias("column_name"),
        rule.alias("rule_type"),
        F.lit("HIGH").alias("sensitivity"),
        F.col("owner").alias("owner"),
        source.alias("source_tag"),
        F.lit(PENDING).alias("status"),
    )


def _kind(rule: Column) -> Column:
    """Proposals of one kind on one column are duplicates of each other."""
    return (
        F.when(rule.startswith("RLS_FILTER:"), F.lit("rls"))
        .when(rule.startswith("CASBIN_ROLES:"), F.lit("roles"))
        .otherwise(F.lit("mask"))
    )


def new_proposals(
    models: DataFrame, columns: DataFrame, pending: DataFrame, now: datetime
) -> DataFrame:
    """All proposals that are not already waiting for review, with a stable id."""
    found = (
        pii_proposals(columns)
        .unionByName(row_filter_proposals(columns, models))
        .unionByName(role_proposals(models))
        .withColumn("__kind", _kind(F.col("rule_type")))
        .withColumn("__col", F.lower("column_name"))
    )
    waiting = pending.where(F.col("status") == PENDING).select(
        F.lower("table_id").alias("__t"),
        F.lower("column_name").alias("__col"),
        _kind(F.col("rule_type")).alias("__kind"),
    )
    fresh = found.withColumn("__t", F.lower("table_id")).join(
        waiting, ["__t", "__col", "__kind"], "left_anti"
    )
    proposal_id = F.sha2(F.concat_ws("|", "__t", "__col", "rule_type"), 256)
    return fresh.withColumns(
        {"id": proposal_id, "created_at": F.lit(now).cast("timestamp")}
    ).drop("__t", "__col", "__kind")


def pending_proposals(proposals: DataFrame, table_id: str | None = None) -> DataFrame:
    rows = proposals.where(F.col("status") == PENDING)
    return rows if table_id is None else rows.where(F.lower("table_id") == table_id.lower())


def review(proposals: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Proposals after review, and refused decisions with a reason.

    `decisions`: `id`, `decision` (approve or reject), `reviewed_by`, `decided_at`. Only a
    pending proposal can change; of several decisions on one the earliest counts.
    """
    usable = (blank_to_null(F.col("reviewed_by")).isNotNull()) & F.lower("decision").isin(
        "approve", "reject"
    )
    first = (
        decisions.where(usable)
        .groupBy("id")
        .agg(F.min(F.struct("decided_at", "decision", "reviewed_by")).alias("d"))
    )
    joined = proposals.join(first, "id", "left")
    takes = F.col("d").isNotNull() & (F.col("status") == PENDING)
    status = F.when(
        takes,
        F.when(F.lower("d.decision") == "approve", F.lit(APPROVED)).otherwise(F.lit(REJECTED)),
    ).otherwise(F.col("status"))
    updated = joined.select(
        *[c for c in proposals.columns if c != "status"],
        status.alias("status"),
        F.when(takes, F.col("d.reviewed_by")).alias("reviewed_by"),
        takes.alias("changed"),
    )
    known = proposals.select("id", F.col("status").alias("__status"))
    refused = (
        decisions.join(known, "id", "left")
        .join(first.select("id", "d"), "id", "left")
        .withColumn(
            "reason",
            F.when(~usable, F.lit("INVALID_DECISION"))
            .when(F.col("__status").isNull(), F.lit("UNKNOWN_PROPOSAL"))
            .when(F.col("__status") != PENDING, F.lit("NOT_PENDING"))
            .when(
                F.struct("decided_at", "decision", "reviewed_by") != F.col("d"),
                F.lit("NOT_PENDING"),
            ),
        )
        .where(F.col("reason").isNotNull())
        .drop("__status", "d")
    )
    return updated, refused


def approved_masks(updated: DataFrame) -> DataFrame:
    """Masking rules of newly approved proposals; row filters and roles go elsewhere."""
    newly = updated.where(F.col("changed") & (F.col("status") == APPROVED))
    masks = newly.where(_kind(F.col("rule_type")) == "mask")
    return masks.select(
        "table_id",
        "column_name",
        "rule_type",
        F.when(F.col("rule_type") == "REDACT", F.lit(REDACTED)).alias("replacement"),
    )


def approved_filters(updated: DataFrame) -> DataFrame:
    """Row filters and role lists of newly approved proposals."""
    newly = updated.where(F.col("changed") & (F.col("status") == APPROVED))
    kind = _kind(F.col("rule_type"))
    return newly.where(kind != "mask").select(
        "table_id",
        "column_name",
        kind.alias("kind"),
        F.regexp_replace("rule_type", "^[A-Z_]+:", "").alias("value"),
    )


def sync_descriptions(
    tables: DataFrame, columns: DataFrame, models: DataFrame, model_cols: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Descriptions of known tables and columns, replaced where a model documents them.

    `tables`: `table_id`, `description`, `long_description`; `columns` likewise with
    `column_name`. Tables without a model stay as they are. Both sides grow with the catalogue, and
    rows parsed from JSON are estimated far too small, so they meet by shuffles.
    """
    m = models.hint("merge").select(
        F.lower("table_id").alias("__t"),
        F.col("description").alias("__d"),
        _meta("long_description").alias("__l"),
    )
    documented = tables.join(m, F.lower(tables["table_id"]) == F.col("__t"), "left").select(
        *[c for c in tables.columns if c not in ("description", "long_description")],
        F.coalesce("__d", "description").alias("description"),
        F.coalesce("__l", "long_description").alias("long_description"),
    )
    c = model_cols.hint("merge").select(
        F.lower("table_id").alias("__t"),
        F.lower("column_name").alias("__c"),
        F.col("description").alias("__d"),
        _meta("long_description").alias("__l"),
    )
    on = (F.lower(columns["table_id"]) == F.col("__t")) & (
        F.lower(columns["column_name"]) == F.col("__c")
    )
    documented_columns = columns.join(c, on, "left").select(
        *[x for x in columns.columns if x not in ("description", "long_description")],
        F.coalesce("__d", "description").alias("description"),
        F.coalesce("__l", "long_description").alias("long_description"),
    )
    return documented, documented_columns


def ingest_summary(models: DataFrame, proposals: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: parsed models, new proposals, lineage nodes."""
    count = F.count(F.lit(1))
    return models.agg(count.alias("models")).select(
        "models",
        proposals.agg(count).scalar().alias("proposals"),
        nodes.agg(count).scalar().alias("lineage_nodes"),
    )
