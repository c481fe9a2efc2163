"""Catalog and policy synchronisation, dbt ingestion: plan everything, then write once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.operators.catalog_sync import (
    bump_epochs,
    stricter,
    sync_columns,
    sync_counters,
    sync_tables,
)
from lakewarden.operators.contract import breaking_changes, contract_report, new_contracts
from lakewarden.operators.grants import (
    GrantConfig,
    affected_tables,
    auto_grantable,
    effective_rules,
    grant_classes,
    reconcile_classes,
    role_grantees,
    rule_rows,
    team_grantees,
    user_grantees,
    user_role_rows,
)
from lakewarden.operators.identity import ID, IdentityConfig, id_key, reject_collisions, resolve_identity
from lakewarden.operators.lineage import lineage_edges, lineage_nodes
from lakewarden.operators.principals import resolve_teams, resolve_users
from lakewarden.operators.proposals import ingest_summary, new_proposals
from lakewarden.operators.tagging import TagConfig, map_columns, map_tables
from lakewarden.session import checkpoint
from lakewarden.sources.catalog_pages import is_complete
from lakewarden.sources.dbt_manifest import model_columns, model_dependencies, parse_models

Writer = Callable[[str, DataFrame], None]


@dataclass
class CatalogSync:
    tables: DataFrame
    columns: DataFrame
    counters: DataFrame
    warnings: DataFrame
    epochs: DataFrame


def sync_catalog(
    assets: DataFrame,
    asset_columns: DataFrame,
    existing_tables: DataFrame,
    existing_columns: DataFrame,
    epochs: DataFrame,
    config: TagConfig,
    write: Writer | None = None,
    dry_run: bool = False,
) -> CatalogSync:
    """Mirror a catalog into the governance tables; a dry run computes the same and writes nothing."""
    tables = sync_tables(assets, existing_tables, config)
    columns = sync_columns(asset_columns, existing_columns, assets, config)
    warnings = tables.where("retained").select(
        *ID,
        F.concat(F.lit("retained existing sensitivity "), F.col("sensitivity")).alias("warning"),
    )
    result = CatalogSync(
        tables, columns, sync_counters(tables, columns), warnings, bump_epochs(epochs, tables)
    )
    if write is not None and not dry_run:
        write("tables", result.tables)
        write("columns", result.columns)
        write("epochs", result.epochs)
    return result


@dataclass
class PolicySync:
    tables: DataFrame
    columns: DataFrame
    rejects: DataFrame
    actions: DataFrame | None
    affected: DataFrame
    success: bool
    epochs: DataFrame | None = None


def sync_policies(
    entities: Mapping[str, DataFrame],
    held: DataFrame,
    existing_tables: DataFrame,
    identity: IdentityConfig,
    tags: TagConfig,
    grants: GrantConfig,
    role_map: Mapping[str, str],
    team_map: DataFrame,
    user_map: DataFrame,
    now: datetime,
    pull_problems: DataFrame,
    write: Writer | None = None,
    dry_run: bool = False,
    epochs: DataFrame | None = None,
) -> PolicySync:
    """Table protection and access grants from a policy store.

    `entities` holds `tables`, `columns` (keyed by `entity_id`), `policies`, `roles`, `teams`
    and `users`. When `pull_problems` shows an incomplete read, tables are still refreshed but
    no grant is created, extended or revoked. `epochs` are raised by one for every table that the
    sync touched, and written last, so a reader that sees a new epoch finds the new rules.
    """
    resolved, rejects = resolve_identity(entities["tables"], identity)
    accepted, collided = reject_collisions(resolved)
    protected = map_columns(entities["columns"], tags)
    known = existing_tables.select(id_key().alias("__id")).distinct()
    keyed = accepted.withColumn("__id", id_key())
    known_ids = keyed.join(known, "__id", "left_semi").select("entity_id")
    mapped = map_tables(accepted, protected, "entity_id", tags, known=known_ids)
    old = existing_tables.select(
        id_key().alias("__id"),
        F.col("sensitivity").alias("__sens"),
        F.col("requires_four_eyes").alias("__eyes"),
        F.col("is_active").alias("__active"),
    )
    tables = (
        mapped.withColumn("__id", id_key())
        .join(old, "__id", "left")
        .withColumn("sensitivity", stricter(F.col("__sens"), F.col("sensitivity")))
        .withColumn(
            "requires_four_eyes", F.col("requires_four_eyes") | F.coalesce("__eyes", F.lit(False))
        )
        .withColumn("is_active", F.coalesce("__active", "is_active"))
        .drop("__id", "__sens", "__eyes", "__active")
    )
    tables = checkpoint(tables)
    columns = protected.join(tables.select("entity_id", *ID), "entity_id")
    reject_rows = rejects.select("entity_id", "reason").unionByName(
        collided.select("entity_id", "reason")
    )
    complete = is_complete(pull_problems)
    actions = None
    affected = tables.select(*ID).distinct()
    if complete:
        policies, roles = entities["policies"], entities["roles"]
        users = resolve_users(entities["users"], user_map)
        grantees = (
            role_grantees(roles, policies, role_map)
            .unionByName(team_grantees(resolve_teams(entities["teams"], team_map), policies))
            .unionByName(user_grantees(user_role_rows(users), roles, policies))
        )
        rules = effective_rules(rule_rows(policies))
        classes = grant_classes(grantees, rules, tables, auto_grantable(tables, columns), grants)
        actions = reconcile_classes(classes, held, tables.select("tenant_id"), grants, now)
        affected = affected.unionByName(affected_tables(actions)).distinct()
    raised = None if epochs is None else bump_epochs(epochs, affected)
    result = PolicySync(tables, columns, reject_rows, actions, affected, complete, raised)
    if write is not None and not dry_run:
        write("tables", tables)
        write("columns", columns)
        if actions is not None:
            write("grants", actions)
        if raised is not None:
            write("epochs", raised)
    return result


@dataclass
class DbtIngest:
    models: DataFrame
    columns: DataFrame
    proposals: DataFrame
    edges: DataFrame
    nodes: DataFrame
    summary: DataFrame


def ingest_dbt(
    manifests: DataFrame,
    pending: DataFrame,
    now: datetime,
    write: Writer | None = None,
    dry_run: bool = False,
) -> DbtIngest:
    """Models, protection proposals and lineage of dbt manifests."""
    models = parse_models(manifests)
    columns = model_columns(models)
    waiting = pending.limit(0) if dry_run else pending
    proposals = new_proposals(models, columns, waiting, now)
    edges = lineage_edges(models, model_dependencies(models))
    nodes = lineage_nodes(models, edges)
    result = DbtIngest(
        models, columns, proposals, edges, nodes, ingest_summary(models, proposals, nodes)
    )
    if write is not None and not dry_run:
        write("proposals", proposals)
        write("edges", edges)
        write("nodes", nodes)
    return result


def check_contract(
    manifests: DataFrame, active_tables: DataFrame, active_columns: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Breaking changes of enforced models, and the one-row report."""
    models = parse_models(manifests)
    changes = breaking_changes(models, model_columns(models), active_columns)
    return changes, contract_report(models, changes, new_contracts(models, active_tables))
