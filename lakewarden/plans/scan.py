"""Governed scans: gate, admissibility, pruning, tenant, row filter, masks, limit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lakewarden.fixed_values import SCAN_DEFAULT_LIMIT, SCAN_MAX_LIMIT
from lakewarden.operators.governance import (
    CLEAR,
    TablePolicy,
    apply_row_filter,
    mask_columns,
    mask_everything,
    with_tenant,
)
from lakewarden.operators.predicates import Predicate, admit, extract_predicates, to_column
from lakewarden.operators.pruning import mark_files, read_kept, scan_statistics
from lakewarden.sources.registry import LakeTable


@dataclass
class ScanResult:
    rows: DataFrame
    statistics: DataFrame | None = None
    dropped: list[Predicate] = field(default_factory=list)


def clamp_limit(requested: int | None, maximum: int = SCAN_MAX_LIMIT) -> int:
    """Row limit of an interactive request."""
    maximum = maximum if maximum > 0 else SCAN_MAX_LIMIT
    return min(requested if requested and requested > 0 else SCAN_DEFAULT_LIMIT, maximum)


def governed_scan(
    table: DataFrame,
    policy: TablePolicy,
    tenant: str | None,
    arguments: Mapping[str, Any] | None = None,
    columns: Iterable[str] | None = None,
    limit: int | None = None,
    keys: DataFrame | None = None,
    inventory: DataFrame | None = None,
    source: LakeTable | None = None,
) -> ScanResult:
    """Rows one principal may see.

    Without `limit` all rows are returned, as a job wants them; an interactive caller passes
    `clamp_limit(...)`. With `inventory` and `source` only files that can hold matching rows of
    the tenant are opened, and the result carries the pruning statistics. All filters are
    applied to raw rows before any mask, and row by row whatever pruning did.
    """
    if not policy.allowed or tenant is None or not tenant.strip():
        return ScanResult(table.limit(0))
    # a filter on a hidden column would tell its values, so under `mask_all` only the tenant is clear
    clear = [c for c in table.columns if policy.effective(c) == CLEAR and not policy.mask_all]
    asked = extract_predicates(arguments)
    own = [p for p in asked if p.column.lower() == policy.tenant_column.lower()]
    kept, dropped = admit([p for p in asked if p not in own], table.columns, clear)
    predicates = with_tenant([*own, *kept], policy.tenant_column, tenant)
    statistics = None
    rows = table
    if inventory is not None and source is not None:
        types = {f.name: f.dataType for f in table.schema.fields}
        marked = mark_files(inventory, predicates, types, mandatory=[policy.tenant_column])
        statistics = scan_statistics(marked)
        rows = read_kept(
            table.sparkSession, marked, table.schema, source.location, source.format, source.options
        )
    rows = apply_row_filter(rows.where(to_column(rows, predicates)), policy.row_filter)
    if policy.mask_all:
        wanted = list(columns or rows.columns)
        rows = mask_everything(rows.select(*wanted), policy.tenant_column)
    else:
        rows = mask_columns(rows, policy, columns, keys)
    if limit is not None:
        rows = rows.limit(limit)
    return ScanResult(rows, statistics, dropped)


def ungoverned_scan(
    table: DataFrame,
    tenant: str | None,
    tenant_column: str,
    columns: Iterable[str] | None = None,
    arguments: Mapping[str, Any] | None = None,
    limit: int | None = None,
) -> ScanResult:
    """Scan without a decision: the tenant's rows with everything else redacted.

    Filters on redacted columns are dropped and reported.
    """
    policy = TablePolicy(tenant_column=tenant_column, mask_all=True)
    return governed_scan(table, policy, tenant, arguments, columns, limit)


def registered_scan(
    spark: SparkSession,
    tables: Mapping[str, LakeTable],
    name: str,
    policy: TablePolicy,
    tenant: str | None,
    **options: Any,
) -> ScanResult:
    """Governed scan of a configured table; an unknown name gives an empty result."""
    found = next((t for n, t in tables.items() if n.lower() == name.lower()), None)
    if found is None:
        return ScanResult(spark.range(0).select())
    table = spark.read.format(found.format).options(**found.options).load(found.location)
    return governed_scan(table, policy, tenant, source=found, **options)
