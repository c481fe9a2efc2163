"""Tenant isolation, row filter and column masking, in that order and fail-closed."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.crypto import key_pads
from lakewarden.functions.masks import MaskRule, apply_rule, redact
from lakewarden.operators.predicates import Predicate

CLEAR, MASK, DENY, DROP = "Clear", "Mask", "Deny", "DROP_COLUMN"


@dataclass(frozen=True)
class ColumnPolicy:
    access: str | None = None
    sensitive: bool = False
    rule: MaskRule | None = None

    @property
    def effective(self) -> str:
        """An explicit level wins; otherwise a sensitive or ruled column is masked."""
        level = self.access or (MASK if self.sensitive or self.rule else CLEAR)
        if level == MASK and self.rule and self.rule.rule_type.upper() == DROP:
            return DENY
        return level


@dataclass(frozen=True)
class TablePolicy:
    allowed: bool = True
    columns: Mapping[str, ColumnPolicy] = field(default_factory=dict)
    row_filter: str | None = None
    tenant_column: str = "tenant_id"
    mask_all: bool = False

    def effective(self, column: str) -> str:
        found = {k.lower(): v for k, v in self.columns.items()}.get(column.lower())
        return found.effective if found else CLEAR

    def rule(self, column: str) -> MaskRule | None:
        found = {k.lower(): v for k, v in self.columns.items()}.get(column.lower())
        return found.rule if found else None


def with_tenant(predicates: Iterable[Predicate], column: str, tenant: str) -> list[Predicate]:
    """Adds the session tenant; a caller's own tenant filter has to agree with it."""
    rest = []
    for p in predicates:
        if p.column.lower() == column.lower():
            if p.op != "==" or str(p.value) != tenant:
                raise PermissionError("tenant filter does not match the session tenant")
            continue
        rest.append(p)
    return [*rest, Predicate(column, "==", tenant)]


def row_filter_column(df: DataFrame, row_filter: str) -> Column:
    """Row filter as a column over raw values. Subqueries are refused."""
    if re.search(r"\bselect\b|;", row_filter, re.IGNORECASE):
        raise PermissionError("row filter must be a plain boolean expression")
    condition = F.expr(row_filter)
    _ = df.where(condition).schema  # unknown columns fail here, before anything runs
    return condition


def apply_row_filter(df: DataFrame, row_filter: str | None) -> DataFrame:
    """Rows for which the filter is true; a null result drops the row."""
    if row_filter is None or not row_filter.strip():
        return df
    return df.where(row_filter_column(df, row_filter))


def mask_columns(
    df: DataFrame,
    policy: TablePolicy,
    columns: Iterable[str] | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Projection with denied columns left out and masked ones replaced."""
    wanted = [c for c in (columns or df.columns) if policy.effective(c) != DENY]
    out = []
    for c in wanted:
        if policy.effective(c) == MASK:
            rule = policy.rule(c)
            ipad, opad = None, None
            if keys is not None and rule and rule.key_id:
                ipad, opad = key_pads(keys, rule.key_id)
            out.append(apply_rule(F.col(c), rule, ipad, opad).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def mask_everything(df: DataFrame, tenant_column: str) -> DataFrame:
    """Ungoverned scan: every column but the tenant is redacted."""
    return df.select(
        *[
            F.col(c) if c.lower() == tenant_column.lower() else redact(F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def allowed_tables(
    tables: DataFrame, decisions: DataFrame, tenant: str | None, shared_domain: str = "default"
) -> DataFrame:
    """Tables of the tenant or the shared domain that no decision denies."""
    if tenant is not None:
        tables = tables.where(
            F.lower("domain").isin(tenant.lower(), shared_domain.lower())
        )
    denied_tables = decisions.where(F.col("column_name").isNull() & ~F.col("is_allowed"))
    return tables.join(denied_tables.select("table_id"), "table_id", "left_anti")


def visible_columns(
    tables: DataFrame,
    columns: DataFrame,
    decisions: DataFrame,
    tenant: str | None,
    shared_domain: str = "default",
) -> DataFrame:
    """Columns a principal may see, per table.

    `tables(table_id, domain)`, `columns(table_id, column_name, is_sensitive, has_rule)`,
    `decisions(table_id, column_name, is_allowed, access)`, where a null `column_name` row
    carries the decision on the table itself. Tables outside the tenant and the shared domain,
    denied tables and denied columns fall away. `tenant=None` is the single-tenant mode.
    """
    allowed = allowed_tables(tables, decisions, tenant, shared_domain)
    levels = decisions.where(F.col("column_name").isNotNull()).select(
        "table_id", F.lower("column_name").alias("__c"), "access"
    )
    access = F.coalesce(
        F.col("access"),
        F.when(F.col("is_sensitive") | F.col("has_rule"), F.lit(MASK)).otherwise(F.lit(CLEAR)),
    )
    named = columns.withColumn("__c", F.lower("column_name"))
    joined = allowed.join(named, "table_id").join(levels, ["table_id", "__c"], "left")
    return (
        joined.withColumn("access", access)
        .where(F.col("access") != DENY)
        .select("table_id", "domain", "column_name", "access")
    )


def visible_tables(
    tables: DataFrame,
    columns: DataFrame,
    decisions: DataFrame,
    tenant: str | None,
    shared_domain: str = "default",
) -> DataFrame:
    """Allowed tables with a visible column, plus allowed tables that have no columns at all."""
    visible = visible_columns(tables, columns, decisions, tenant, shared_domain)
    allowed = allowed_tables(tables, decisions, tenant, shared_domain).select("table_id", "domain")
    shown = allowed.join(visible.select("table_id"), "table_id", "left_semi")
    without_columns = allowed.join(columns.select("table_id"), "table_id", "left_anti")
    return shown.unionByName(without_columns).distinct()
