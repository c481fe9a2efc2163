"""Governance identity and tenant of externally catalogued tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.text import blank_to_null

ID = ["domain", "schema_name", "table_name"]


@dataclass(frozen=True)
class IdentityConfig:
    service_filter: str | None = None
    domain_of_database: Mapping[str, str] = field(default_factory=dict)
    tenant_of_service: Mapping[str, str] = field(default_factory=dict)
    default_tenant: str | None = None


def id_key(prefix: str = "") -> Column:
    """Lower-case `domain.schema.table` join key."""
    return F.lower(F.concat_ws(".", *[F.col(f"{prefix}{c}") for c in ID]))


def _map_rows(df: DataFrame, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A configured mapping as rows with lower-case keys; blank values are no mapping."""
    rows = {k.strip().lower(): v.strip() for k, v in mapping.items() if v and v.strip()}
    return df.sparkSession.createDataFrame(list(rows.items()), f"{key} string, {value} string")


def resolve_identity(tables: DataFrame, config: IdentityConfig) -> tuple[DataFrame, DataFrame]:
    """Resolved tables and rejects with a reason.

    Input columns: `fqn`, `name`, `service`, `service_fqn`, `database`, `db_schema` (all but
    `fqn` and `name` may be null); further columns are passed through.
    """
    parts = F.split(F.coalesce("fqn", F.lit("")), "\\.")
    n = F.when(blank_to_null(F.col("fqn")).isNull(), F.lit(0)).otherwise(F.size(parts))
    service = F.coalesce(blank_to_null(F.col("service")), F.when(n >= 3, F.get(parts, 0)))
    database = F.coalesce(blank_to_null(F.col("database")), F.when(n >= 4, F.get(parts, 1)))
    schema_part = F.when(n >= 4, F.get(parts, 2)).when(n >= 2, F.get(parts, n - 2))
    schema = F.coalesce(
        blank_to_null(F.col("db_schema")), blank_to_null(schema_part), F.lit("dbo")
    )
    table = F.coalesce(blank_to_null(F.col("name")), F.when(n > 0, F.get(parts, n - 1)))
    base = tables.withColumns(
        {
            "__service": service,
            "__database": database,
            "schema_name": schema,
            "table_name": table,
            "__pair": F.lower(F.concat(service, F.lit("."), database)),
        }
    )
    if config.domain_of_database:
        domains = _map_rows(base, config.domain_of_database, "__dk", "__domain")
        base = base.join(domains, F.col("__pair") == F.col("__dk"), "left").drop("__dk")
    else:
        base = base.withColumn("__domain", F.coalesce("__service", F.lit("default")))
    by_pair = _map_rows(base, config.tenant_of_service, "__tk", "__tenant_pair")
    by_service = _map_rows(base, config.tenant_of_service, "__sk", "__tenant_service")
    base = base.join(by_pair, F.col("__pair") == F.col("__tk"), "left")
    base = base.join(by_service, F.lower("__service") == F.col("__sk"), "left")
    tenant = F.coalesce(
        "__tenant_pair",
        "__tenant_service",
        F.lit((config.default_tenant or "").strip() or None).cast("string"),
    )
    outside = F.lit(False)
    if config.service_filter and config.service_filter.strip():
        wanted = config.service_filter.strip().lower()
        outside = ~(
            F.coalesce(F.lower("__service") == wanted, F.lit(False))
            | F.coalesce(F.lower("service_fqn") == wanted, F.lit(False))
        )
    reason = (
        F.when(outside, F.lit("OUTSIDE_SERVICE_FILTER"))
        .when(F.col("__domain").isNull(), F.lit("NO_DOMAIN_MAPPING"))
        .when(blank_to_null(F.col("table_name")).isNull(), F.lit("EMPTY_TABLE_NAME"))
        .when(tenant.isNull(), F.lit("NO_TENANT_MAPPING"))
    )
    drop = ["service", "database"]
    passed = [c for c in tables.columns if c not in drop]
    out = base.select(
        *passed,
        F.col("__domain").alias("domain"),
        "schema_name",
        "table_name",
        F.coalesce("__service", "__domain").alias("service"),
        F.col("__database").alias("database"),
        tenant.alias("tenant_id"),
        reason.alias("reason"),
    )
    resolved = out.where(F.col("reason").isNull()).drop("reason")
    rejects = out.where(F.col("reason").isNotNull())
    return resolved, rejects


def reject_collisions(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drops every table whose identity is claimed from more than one database.

    Comparing the smallest with the largest database per identity needs one row per task and
    identity, not the set of databases.
    """
    database = F.lower(F.coalesce("database", F.lit("")))
    keyed = resolved.withColumn("__id", id_key())
    collided = (
        keyed.groupBy("__id")
        .agg(F.min(database).alias("lo"), F.max(database).alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("__id")
    )
    accepted = keyed.join(collided, "__id", "left_anti").drop("__id")
    rejected = (
        keyed.join(collided, "__id", "left_semi")
        .drop("__id")
        .withColumn("reason", F.lit("DATABASE_COLLISION"))
    )
    return accepted, rejected
