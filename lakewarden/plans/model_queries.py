"""Registered queries: dbt models, proposals, contracts, lineage and exports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.operators.contract import breaking_changes, contract_report, new_contracts
from lakewarden.operators.export import (
    EntityConfig,
    entity_documents,
    exposures,
    filter_entities,
    fixed_entities,
    jira_tickets,
    latest_schemas,
    lineage_datasets,
    lineage_events,
    schema_rows,
    service_document,
    servicenow_tickets,
    subgraph_entities,
    table_entities,
    ticket_references,
)
from lakewarden.operators.identity import ID
from lakewarden.operators.lineage import child_lists, downstream_impact, lineage_edges, lineage_nodes
from lakewarden.operators.proposals import (
    approved_filters,
    approved_masks,
    ingest_summary,
    new_proposals,
    pending_proposals,
    review,
    sync_descriptions,
)
from lakewarden.plans import inputs
from lakewarden.plans.dialect import PLAIN, SPARK, derive, load
from lakewarden.plans.registry import query
from lakewarden.plans.sync import check_contract, ingest_dbt
from lakewarden.session import checkpoint
from lakewarden.sources.dbt_manifest import model_columns, model_dependencies, parse_models

_NOW = datetime(2000, 1, 1)


def _documents(d) -> str:
    """Manifest documents, one per model, with its columns and dependencies as JSON."""
    q = "'\"'"
    return f"""
      WITH m AS ({inputs.manifest_nodes(d)}),
      c AS (
        SELECT p_partkey, string_agg({q} || column_name || '":{{"data_type":"' || data_type
          || '","tags":[' || CASE WHEN tag_text = 'plain' THEN '' ELSE {q} || tag_text || {q} END
          || '],"meta":{{' || CASE WHEN uses >= 7 THEN '"PII":"true"' WHEN uses = 6 THEN '"pii":0'
             WHEN uses = 5 THEN '"rls_filter":"owner = me","long_description":"seen five times"'
             ELSE '' END || '}}' || CASE WHEN uses = 4 THEN ',"description":"seen four times"'
             ELSE '' END || '}}', ',') AS columns
        FROM ({inputs.catalog_columns(d)}) x GROUP BY p_partkey)
      SELECT m.p_partkey, '{{"nodes":{{"' || m.unique_id || '":{{"name":"' || m.table_name
        || '","database":"' || m.service || '","schema":"' || m.schema_name || '",'
        || '"config":{{"materialized":"' || CASE WHEN m.p_size > 20 THEN 'view' ELSE 'table' END
        || '"}},"contract":{{"enforced":' || CASE WHEN m.enforced THEN 'true' ELSE 'false' END
        || '}},"meta":{{' || CASE WHEN m.owner IS NULL THEN '"x":1' ELSE '"owner":"' || m.owner
             || '"' END
        || CASE WHEN m.model_filter IS NULL THEN '' ELSE ',"rls_filter":"' || m.model_filter || '"' END
        || CASE WHEN m.roles IS NULL THEN '' ELSE ',"casbin_roles":"' || m.roles || '"' END
        || '}},"columns":{{' || coalesce(c.columns, '') || '}},"depends_on":{{"nodes":["model.shop.'
        || CAST({d.idiv("m.p_partkey", "2")} AS STRING) || '","model.shop.'
        || CAST({d.idiv("m.p_partkey", "3")} AS STRING) || '"]}}}}}}}}' AS document
      FROM m LEFT JOIN c ON c.p_partkey = m.p_partkey"""


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_models(derive(spark, sf_dir, _documents(SPARK)))


_MODELS = f"""
    SELECT *, service || '.' || schema_name || '.' || table_name AS table_id
    FROM ({inputs.manifest_nodes(PLAIN)}) n WHERE p_size <= 45"""
_MODEL_COLUMNS = f"""
    SELECT m.table_id, m.owner, c.column_name, c.data_type, c.tag_text, c.uses
    FROM ({_MODELS}) m JOIN ({inputs.catalog_columns(PLAIN)}) c ON c.p_partkey = m.p_partkey"""


@query(
    f"""
    SELECT unique_id, table_id, CASE WHEN p_size > 20 THEN 'view' ELSE 'table' END AS materialization,
      enforced AS contract_enforced, owner FROM ({_MODELS}) m"""
)
def dbt_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _models(spark, sf_dir).select(
        "unique_id",
        "table_id",
        "materialization",
        "contract_enforced",
        F.try_element_at("meta", F.lit("owner")).alias("owner"),
    )


def _pending(d) -> str:
    """Proposals already waiting: for columns of lines that were returned."""
    return f"""
      SELECT upper(t.service || '.' || t.schema_name || '.' || t.table_name) AS table_id,
        upper(e.column_name) AS column_name,
        CASE WHEN e.rule_type IS NULL THEN 'RLS_FILTER:old' ELSE e.rule_type END AS rule_type,
        CASE WHEN e.is_sensitive THEN 'PendingReview' ELSE 'Rejected' END AS status
      FROM ({inputs.existing_columns(d)}) e JOIN ({inputs.catalog_tables(d)}) t
        ON t.p_partkey = e.p_partkey"""


_FOUND = f"""
    WITH mc AS ({_MODEL_COLUMNS}), m AS ({_MODELS}),
    found AS (
      SELECT table_id, column_name, owner, CASE WHEN lower(tag_text) LIKE '%email%'
          OR column_name LIKE '%email%' THEN 'MASK_EMAIL' WHEN column_name LIKE '%ssn%' THEN 'REDACT'
          WHEN tag_text LIKE '%pseudonym%' THEN 'HMAC_SHA256' WHEN uses >= 7 THEN 'REDACT' END
          AS rule_type,
        CASE WHEN tag_text <> 'plain' THEN tag_text WHEN uses >= 6 THEN 'meta.pii=true'
          ELSE 'column:' || column_name END AS source_tag, 'mask' AS kind FROM mc
      UNION ALL
      SELECT table_id, column_name, owner, 'RLS_FILTER:owner = me', 'meta.rls_filter', 'rls'
      FROM mc WHERE uses = 5
      UNION ALL
      SELECT table_id, '*', owner, 'RLS_FILTER:' || model_filter, 'meta.rls_filter', 'rls'
      FROM m WHERE model_filter IS NOT NULL
      UNION ALL
      SELECT table_id, '*', owner, 'CASBIN_ROLES:' || roles, 'meta.casbin_roles', 'roles'
      FROM m WHERE roles IS NOT NULL),
    waiting AS (
      SELECT lower(table_id) AS t, lower(column_name) AS c,
        CASE WHEN rule_type LIKE 'RLS%' THEN 'rls' ELSE 'mask' END AS kind
      FROM ({_pending(PLAIN)}) p WHERE status = 'PendingReview'),
    fresh AS (
      SELECT f.*, sha256(table_id || '|' || column_name || '|' || rule_type) AS id FROM found f
      WHERE rule_type IS NOT NULL AND NOT EXISTS (SELECT 1 FROM waiting w WHERE w.t = f.table_id
        AND w.c = f.column_name AND w.kind = f.kind))"""


def _proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    pending = derive(spark, sf_dir, _pending(SPARK))
    return new_proposals(models, model_columns(models), pending, _NOW)


@query(
    _FOUND
    + """
    SELECT id, table_id, column_name, rule_type, owner, source_tag, 'HIGH' AS sensitivity,
      'PendingReview' AS status FROM fresh"""
)
def dbt_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _proposals(spark, sf_dir).drop("created_at")


@query(
    _FOUND
    + """
    SELECT (SELECT count(*) FROM m) AS models, (SELECT count(*) FROM fresh) AS proposals,
      (SELECT count(*) FROM m) AS lineage_nodes"""
)
def dbt_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    edges = lineage_edges(models, model_dependencies(models))
    return ingest_summary(models, _proposals(spark, sf_dir), lineage_nodes(models, edges))


_SEEN = """
    SELECT *, CASE WHEN column_name = 'ssn' THEN 'Rejected' ELSE 'PendingReview' END AS status
    FROM ({stored}) s"""
_DECISIONS = """
    SELECT id, 'approve' AS decision, CASE WHEN column_name = 'account_no' THEN ' ' ELSE 'ann' END
      AS reviewed_by, CAST(length(table_id) AS BIGINT) AS decided_at
    FROM ({seen}) a WHERE rule_type <> 'MASK_EMAIL'
    UNION ALL
    SELECT id, 'Reject', 'bob', CAST(30 AS BIGINT)
    FROM ({seen}) b WHERE column_name IN ('email_address', '*', 'region')
    UNION ALL
    SELECT 'unknown-' || id, 'reject', 'bob', CAST(30 AS BIGINT)
    FROM ({seen}) c WHERE rule_type = 'HMAC_SHA256'"""


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored proposals, a part of them already rejected, with two reviewers' decisions."""
    proposals = _proposals(spark, sf_dir).select("id", "table_id", "column_name", "rule_type")
    status = F.when(F.col("column_name") == "ssn", F.lit("Rejected"))
    seen = checkpoint(proposals.withColumn("status", status.otherwise(F.lit("PendingReview"))))
    seen.createOrReplaceTempView("lw_seen")
    decisions = spark.sql(_DECISIONS.format(seen="SELECT * FROM lw_seen"))
    return review(seen, decisions)


_SEEN_SQL = _SEEN.format(stored="SELECT id, table_id, column_name, rule_type FROM fresh")
_REVIEW = f"""
    {_FOUND}, seen AS ({_SEEN_SQL}),
    dec AS ({_DECISIONS.format(seen="SELECT * FROM seen")}),
    ok AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY decided_at, decision, reviewed_by)
             AS rn FROM dec WHERE trim(reviewed_by) <> ''),
    reviewed AS (
      SELECT s.*, o.decision, o.reviewed_by, o.id IS NOT NULL AND s.status = 'PendingReview' AS changed
      FROM seen s LEFT JOIN ok o ON o.id = s.id AND o.rn = 1)"""


@query(
    _REVIEW
    + """
    SELECT id, CASE WHEN changed THEN CASE WHEN lower(decision) = 'approve' THEN 'Approved'
        ELSE 'Rejected' END ELSE status END AS status,
      CASE WHEN changed THEN reviewed_by END AS reviewed_by, changed FROM reviewed"""
)
def proposal_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated, _ = _reviewed(spark, sf_dir)
    return updated.select("id", "status", "reviewed_by", "changed")


@query(
    _REVIEW
    + """
    SELECT * FROM (SELECT d.id, d.decision, CASE WHEN trim(d.reviewed_by) = '' THEN 'INVALID_DECISION'
        WHEN s.id IS NULL THEN 'UNKNOWN_PROPOSAL' WHEN s.status <> 'PendingReview' THEN 'NOT_PENDING'
        WHEN o.rn <> 1 THEN 'NOT_PENDING' END AS reason
      FROM dec d LEFT JOIN seen s ON s.id = d.id
      LEFT JOIN ok o ON o.id = d.id AND o.decision = d.decision) x WHERE reason IS NOT NULL"""
)
def proposal_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir)[1].select("id", "decision", "reason")


@query(
    _REVIEW
    + """
    SELECT table_id, column_name, rule_type AS applied, CASE WHEN rule_type = 'REDACT'
        THEN '[REDACTED]' END AS replacement
    FROM reviewed WHERE changed AND decision = 'approve' AND rule_type NOT LIKE '%:%'
    UNION ALL
    SELECT table_id, column_name, CASE WHEN rule_type LIKE 'RLS%' THEN 'rls' ELSE 'roles' END,
      substr(rule_type, instr(rule_type, ':') + 1)
    FROM reviewed WHERE changed AND decision = 'approve' AND rule_type LIKE '%:%'"""
)
def approved_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated, _ = _reviewed(spark, sf_dir)
    masks = approved_masks(updated).withColumnRenamed("rule_type", "applied")
    others = approved_filters(updated).select(
        "table_id", "column_name", F.col("kind").alias("applied"), F.col("value").alias("replacement")
    )
    return masks.unionByName(others)


@query(
    f"""
    SELECT table_id, count(*) AS waiting FROM ({_pending(PLAIN)}) p
    WHERE status = 'PendingReview' GROUP BY 1"""
)
def pending_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = pending_proposals(derive(spark, sf_dir, _pending(SPARK)))
    return pending.groupBy("table_id").agg(F.count(F.lit(1)).alias("waiting"))


# --- descriptions, contracts


def _active_tables(d) -> str:
    return f"""
      SELECT upper(t.service) || '.' || t.schema_name || '.' || t.table_name AS table_id,
        t.display_name AS description, CAST(NULL AS STRING) AS long_description
      FROM ({inputs.existing_tables(d)}) e JOIN ({inputs.catalog_tables(d)}) t
        ON t.p_partkey = e.p_partkey"""


def _active_columns(d) -> str:
    return f"""
      SELECT upper(t.service) || '.' || t.schema_name || '.' || t.table_name AS table_id,
        upper(c.column_name) AS column_name, c.data_type, 'kept' AS description,
        CAST(NULL AS STRING) AS long_description
      FROM ({inputs.existing_columns(d)}) c JOIN ({inputs.catalog_tables(d)}) t
        ON t.p_partkey = c.p_partkey"""


@query(
    f"""
    SELECT a.table_id, a.column_name, a.data_type, CASE WHEN c.uses = 4 THEN 'seen four times'
        ELSE a.description END AS description,
      CASE WHEN c.uses = 5 THEN 'seen five times' END AS long_description
    FROM ({_active_columns(PLAIN)}) a LEFT JOIN ({_MODEL_COLUMNS}) c
      ON c.table_id = lower(a.table_id) AND c.column_name = lower(a.column_name)"""
)
def synced_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    return sync_descriptions(
        derive(spark, sf_dir, _active_tables(SPARK)),
        derive(spark, sf_dir, _active_columns(SPARK)),
        models,
        model_columns(models),
    )[1]


_CONTRACT = f"""
    WITH m AS (SELECT * FROM ({_MODELS}) x WHERE enforced), c AS ({_MODEL_COLUMNS}),
    a AS (SELECT a.* FROM ({_active_columns(PLAIN)}) a JOIN m ON m.table_id = lower(a.table_id)),
    changes AS (
      SELECT a.table_id, a.column_name, 'DATA_TYPE_MISMATCH' AS change_type,
        a.data_type AS existing_type, c.data_type AS proposed_type
      FROM a JOIN c ON c.table_id = lower(a.table_id) AND c.column_name = lower(a.column_name)
      WHERE a.data_type = 'text' AND c.data_type IN ('bigint', 'decimal(12,2)', 'timestamp')
      UNION ALL
      SELECT a.table_id, a.column_name, 'DROPPED_COLUMN', a.data_type, NULL FROM a
      WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.table_id = lower(a.table_id)
        AND c.column_name = lower(a.column_name)))"""


def _changes(spark: SparkSession, sf_dir: str, models: DataFrame) -> DataFrame:
    """The proposed models leave out columns that are seldom used."""
    return breaking_changes(
        models, model_columns(models), derive(spark, sf_dir, _active_columns(SPARK))
    )


@query(_CONTRACT + " SELECT * FROM changes")
def contract_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir, _models(spark, sf_dir))


@query(
    _CONTRACT.replace("c AS (", "c AS (SELECT * FROM (", 1).replace(
        "),\n    a AS", ") z WHERE uses >= 3),\n    a AS", 1
    )
    + f"""
    SELECT (SELECT count(*) FROM m) AS validated_models, (SELECT count(*) FROM changes)
        AS breaking_changes,
      (SELECT count(*) FROM m WHERE table_id NOT IN (SELECT lower(table_id)
        FROM ({_active_tables(PLAIN)}) t)) AS new_models,
      (SELECT count(*) FROM changes) = 0 AS compatible"""
)
def contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _models(spark, sf_dir)
    uses = derive(spark, sf_dir, inputs.catalog_columns(SPARK)).where("uses < 3")
    rare = uses.join(
        derive(spark, sf_dir, inputs.catalog_tables(SPARK)), "p_partkey"
    ).select(
        F.concat_ws(".", "service", "schema_name", "table_name").alias("table_id"), "column_name"
    )
    kept = model_columns(models).join(rare, ["table_id", "column_name"], "left_anti")
    changes = breaking_changes(models, kept, derive(spark, sf_dir, _active_columns(SPARK)))
    active = derive(spark, sf_dir, _active_tables(SPARK))
    return contract_report(models, changes, new_contracts(models, active))


@query(
    _CONTRACT
    + f"""
    SELECT (SELECT count(*) FROM m) AS validated_models, (SELECT count(*) FROM changes)
        AS breaking_changes,
      (SELECT count(*) FROM m WHERE table_id NOT IN (SELECT lower(table_id)
        FROM ({_active_tables(PLAIN)}) t)) AS new_models,
      (SELECT count(*) FROM changes) = 0 AS compatible"""
)
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole contract check of manifests against the active tables and columns."""
    tables, columns = derive(spark, sf_dir, _active_tables(SPARK)), derive(spark, sf_dir, _active_columns(SPARK))
    return check_contract(derive(spark, sf_dir, _documents(SPARK)), tables, columns)[1]


# --- lineage


_EDGES = f"""
    SELECT DISTINCT p.table_id AS parent, m.table_id AS child
    FROM ({_MODELS}) m JOIN ({_MODELS}) p ON lower(p.unique_id) IN
      ('model.shop.' || (m.p_partkey // 2), 'model.shop.' || (m.p_partkey // 3))"""


def _edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    models = _models(spark, sf_dir)
    return models, lineage_edges(models, model_dependencies(models))


@query(_EDGES)
def dbt_lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)[1]


@query(_EDGES)
def lineage_child_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of every node as lists in parts, opened again into edges."""
    lists = child_lists(_edges(spark, sf_dir)[1], per_row=2)
    return lists.select("parent", F.explode("children").alias("child"))


_NODES = f"""
    SELECT m.table_id, m.table_name AS name, 'Table' AS type, coalesce(e.n, 0) AS downstream,
      m.owner AS owner_team
    FROM ({_MODELS}) m LEFT JOIN (SELECT parent, count(*) AS n FROM ({_EDGES}) x GROUP BY 1) e
      ON e.parent = m.table_id"""


@query(_NODES)
def dbt_ingest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of a whole ingestion of the manifests."""
    manifests, pending = derive(spark, sf_dir, _documents(SPARK)), derive(spark, sf_dir, _pending(SPARK))
    done = ingest_dbt(manifests, pending, _NOW)
    return done.nodes.drop("owner_email")


@query(_NODES)
def dbt_lineage_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage_nodes(*_edges(spark, sf_dir)).drop("owner_email")


_GRAPH = """
    SELECT DISTINCT 'region ' || CAST(n_regionkey AS STRING) AS parent,
      'nation ' || CAST(n_nationkey AS STRING) AS child FROM {nation}
    UNION ALL
    SELECT 'nation ' || CAST(c_nationkey AS STRING), 'customer ' || CAST(c_custkey AS STRING)
    FROM {customer}
    UNION ALL
    SELECT 'customer ' || CAST(o_custkey AS STRING), 'order ' || CAST(o_orderkey AS STRING)
    FROM {orders}"""


@query(
    f"""
    WITH RECURSIVE g AS ({_GRAPH.format(nation="nation", customer="customer", orders="orders")}),
    reach AS (
      SELECT 'region ' || r_regionkey AS root, 'region ' || r_regionkey AS node, 0 AS depth FROM region
      UNION ALL
      SELECT r.root, g.child, r.depth + 1 FROM reach r JOIN g ON g.parent = r.node)
    SELECT root, node, min(depth) AS depth FROM reach WHERE depth > 0 GROUP BY 1, 2"""
)
def lineage_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"nation": "lw_nation", "customer": "lw_customer", "orders": "lw_orders"}
    edges = derive(spark, sf_dir, _GRAPH.format(**names))
    roots = load(spark, sf_dir, "region").select(
        F.concat(F.lit("region "), F.col("r_regionkey").cast("string")).alias("root")
    )
    return downstream_impact(edges, roots)


# --- exports


_ENTITY = EntityConfig(owner="group:stewards", system="warehouse")


def _governed_tables(d) -> str:
    return f"""
      SELECT c.service AS domain, c.schema_name, c.table_name,
        CASE WHEN c.p_size > 25 THEN c.display_name ELSE '' END AS display_name,
        CAST(NULL AS STRING) AS description,
        CASE WHEN c.p_type = 'PROMO' THEN 'Promoted ' || c.display_name END AS long_description,
        CASE WHEN c.p_type = 'MEDIUM' THEN 'SQL Server (2022)' ELSE 'Table' END AS source_type,
        CASE WHEN c.p_size > 40 THEN 'Data  Catalog!' END AS documentation_source,
        coalesce(e.sensitivity, '') AS sensitivity,
        coalesce(e.requires_four_eyes, false) AS requires_four_eyes,
        coalesce(e.is_active, true) AS is_active, c.p_partkey
      FROM ({inputs.catalog_tables(d)}) c LEFT JOIN ({inputs.existing_tables(d)}) e
        ON e.p_partkey = c.p_partkey"""


def _sunsets(d) -> str:
    """Sunset rules: one per order line of the tables, by plain or qualified name."""
    return f"""
      SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS position,
        'rule-' || CAST(l_orderkey AS STRING) AS rule_id,
        CASE WHEN l_linenumber > 4 THEN upper(schema_name || '.' || table_name)
             ELSE table_name END AS target, {d.micros("min(l_shipdate)")} AS sunset_us
      FROM {d.table("lineitem")} JOIN ({inputs.catalog_tables(d)}) c ON c.p_partkey = l_partkey
      WHERE l_discount >= 0.1
      GROUP BY l_orderkey, l_linenumber, schema_name, table_name"""


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derive(spark, sf_dir, _governed_tables(SPARK)).drop("p_partkey")
    rules = derive(spark, sf_dir, _sunsets(SPARK)).select(
        "position",
        "rule_id",
        "target",
        F.lit(None).cast("timestamp").alias("deprecated_at"),
        F.timestamp_micros("sunset_us").alias("sunset_at"),
        F.lit(None).cast("string").alias("replacement"),
    )
    return table_entities(tables, rules, _ENTITY, _NOW)


_ENTITIES = f"""
    WITH t AS ({_governed_tables(PLAIN)}), r AS (
      SELECT p_partkey, arg_min(rule_id, position) AS rule_id, arg_min(sunset_us, position) AS us
      FROM (SELECT t.p_partkey, s.* FROM t JOIN ({_sunsets(PLAIN)}) s
        ON lower(s.target) IN (t.table_name, t.schema_name || '.' || t.table_name)) x GROUP BY 1)
    SELECT 'data-' || schema_name || '-' || table_name AS name,
      CASE WHEN display_name <> '' THEN display_name ELSE schema_name || '.' || table_name END AS title,
      coalesce(long_description, 'Governed enterprise data entity ''' || schema_name || '.'
        || table_name || '''.') AS description,
      'data-product,table' || CASE WHEN source_type <> 'Table' THEN ',sql-server-2022' ELSE '' END
        || CASE WHEN requires_four_eyes OR sensitivity IN ('HIGH', 'RESTRICTED')
           THEN ',four-eyes-required,pii' ELSE '' END
        || CASE WHEN documentation_source IS NOT NULL THEN ',data-catalog' ELSE '' END
        || CASE WHEN sensitivity <> '' THEN ',sensitivity-' || lower(sensitivity) ELSE '' END AS tags,
      CASE WHEN NOT is_active OR coalesce(r.us, 9e17) <= 946684800000000 THEN 'deprecated'
        ELSE 'production' END AS lifecycle, r.rule_id,
      CASE WHEN requires_four_eyes THEN 'true' ELSE 'false' END AS four_eyes
    FROM t LEFT JOIN r ON r.p_partkey = t.p_partkey"""


@query(_ENTITIES)
def export_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    annotations = F.col("annotations")
    return filter_entities(_entities(spark, sf_dir), "api", "OpenAPI").select(
        "name",
        "title",
        "description",
        F.array_join("tags", ",").alias("tags"),
        "lifecycle",
        annotations["lakewarden.io/sunsetting-rule-id"].alias("rule_id"),
        annotations["lakewarden.io/requires-four-eyes"].alias("four_eyes"),
    )


@query(
    f"""
    SELECT name, title, lifecycle, 'group:stewards' AS owner FROM ({_ENTITIES}) e
    UNION ALL SELECT 'gateway', 'Gateway', 'production', 'group:stewards'"""
)
def export_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    apis = spark.createDataFrame(
        [("Gateway", "Gateway", "All data.", "graphql", "type Query", ["api", "API"])],
        "name string, title string, description string, type string, definition string, "
        "tags array<string>",
    )
    entities = _entities(spark, sf_dir).unionByName(fixed_entities(apis, _ENTITY))
    body = F.from_json(
        "document", "struct<metadata:struct<title:string>,spec:struct<lifecycle:string,owner:string>>"
    )
    return entity_documents(entities).select(
        "name",
        body["metadata"]["title"].alias("title"),
        body["spec"]["lifecycle"].alias("lifecycle"),
        body["spec"]["owner"].alias("owner"),
    )


def _schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema versions: every order of a customer registers one of that customer's service."""
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("Svc "), F.col("o_custkey").cast("string")).alias("service"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.col("o_orderdate").cast("timestamp").alias("registered_at"),
        F.when(F.col("o_orderstatus") == "F", F.lit("clerk")).otherwise(F.lit("")).alias("registered_by"),
        (F.col("o_orderpriority") != "5-LOW").alias("is_active"),
        F.lit("type Query { ping: String }").alias("sdl"),
    )


_LATEST = """
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
      CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders"""


@query(
    f"""
    SELECT 'subgraph-svc-' || o_custkey AS name, CASE WHEN o_orderpriority <> '5-LOW' THEN 'production'
        ELSE 'deprecated' END AS lifecycle,
      CASE WHEN o_orderstatus = 'F' THEN 'user:clerk' ELSE 'group:stewards' END AS owner,
      'Federated Subgraph ''Svc ' || o_custkey || ''' (v' || o_orderkey || ').' AS description
    FROM ({_LATEST}) o WHERE rn = 1"""
)
def export_subgraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = subgraph_entities(_schemas(spark, sf_dir), _ENTITY)
    return entities.select("name", "lifecycle", "owner", "description")


@query(
    f"""
    SELECT 'Svc ' || o_custkey AS service, CAST(o_orderkey AS VARCHAR) AS version
    FROM ({_LATEST}) o WHERE rn = 1"""
)
def latest_service_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_schemas(_schemas(spark, sf_dir)).select("service", "version")


@query(
    f"""
    SELECT CASE WHEN downstream > 0 THEN 'inputs' ELSE 'outputs' END AS side, table_id AS name
    FROM ({_NODES}) n"""
)
def export_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = lineage_nodes(*_edges(spark, sf_dir))
    events = lineage_events(
        lineage_datasets(nodes, "tenant-main"),
        "tenant-main",
        "governance_sync",
        "https://example.org/lakewarden",
        _NOW,
        per_event=500,
    )
    names = "array<struct<name:string>>"
    body = F.from_json("event", f"struct<inputs:{names},outputs:{names}>")
    sides = [
        events.select(F.lit(side).alias("side"), F.explode(body[side]["name"]).alias("name"))
        for side in ("inputs", "outputs")
    ]
    return sides[0].unionByName(sides[1])


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, inputs.catalog_tables(SPARK)).select(
        "p_partkey", F.col("service").alias("domain"), "schema_name", "table_name"
    )


@query(
    f"""
    WITH t AS (SELECT p_partkey, service || '_' || schema_name || '_' || table_name AS entity, p_size
               FROM ({inputs.catalog_tables(PLAIN)}) x),
    c AS (SELECT * FROM ({inputs.catalog_columns(PLAIN)}) y WHERE uses >= 6)
    SELECT entity, coalesce(column_name, 'id') AS property,
      CASE WHEN column_name IS NULL THEN 'Edm.Int32' WHEN data_type = 'bigint' THEN 'Edm.Int64'
        WHEN data_type = 'timestamp' THEN 'Edm.DateTimeOffset' ELSE 'Edm.String' END AS edm_type,
      column_name IS NULL OR p_size > 10 AND column_name = 'account_no' AS is_key,
      NOT (column_name IS NULL OR p_size > 10 AND column_name = 'account_no') AS nullable,
      CASE WHEN column_name = 'note' THEN 'free text' END AS description
    FROM t LEFT JOIN c ON c.p_partkey = t.p_partkey"""
)
def export_schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _identified(spark, sf_dir)
    columns = (
        derive(spark, sf_dir, inputs.catalog_columns(SPARK))
        .where("uses >= 6")
        .join(tables, "p_partkey")
        .select(
            *ID,
            "column_name",
            "data_type",
            F.when(F.col("column_name") == "note", F.lit("free text")).otherwise(F.lit(" ")).alias(
                "description"
            ),
        )
    )
    keys = (
        derive(spark, sf_dir, "SELECT p_partkey FROM lw_part WHERE p_size > 10")
        .join(tables, "p_partkey")
        .select(*ID, F.lit("ACCOUNT_NO").alias("column_name"))
    )
    return schema_rows(tables, columns, keys)


@query(
    f"""
    SELECT service || '_' || schema_name || '_' || table_name AS name, 'EntitySet' AS kind,
      service || '/' || schema_name || '/' || table_name AS url
    FROM ({inputs.catalog_tables(PLAIN)}) t"""
)
def export_service_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_document(_identified(spark, sf_dir))


@query(
    f"""
    SELECT table_id, '{{"name":"governed_' || schema_name || '_' || table_name
      || '","type":"application","maturity":"high","description":"Managed table ''' || table_id
      || '''.","depends_on":["ref(''' || table_name || ''')"],"meta":{{' ||
      CASE WHEN n IS NULL THEN '' ELSE '"monthly_queries":' || n || ',' END
      || '"top_consumers":["bi"],"governance_tier":"gold"}}}}' AS exposure
    FROM (SELECT *, service || '.' || schema_name || '.' || table_name AS table_id
          FROM ({inputs.catalog_tables(PLAIN)}) x) t
    LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) u
      ON u.l_partkey = t.p_partkey"""
)
def dbt_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _identified(spark, sf_dir)
    sold = (
        load(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).alias("monthly_queries"))
    )
    usage = tables.join(sold, "p_partkey", "left").select(
        *ID,
        "monthly_queries",
        F.lit(None).cast("double").alias("p99_latency_ms"),
        F.array(F.lit("bi")).alias("top_consumers"),
        F.lit("gold").alias("governance_tier"),
    )
    return exposures(tables.drop("p_partkey"), usage)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.lower("o_orderstatus").alias("tenant_id"),
        F.concat(F.lit("S-1-"), F.col("o_custkey").cast("string")).alias("requester"),
        F.concat(F.lit("sales.dbo."), F.lower(F.substring("o_orderpriority", 3, 4))).alias("target_table"),
        F.lit(30).alias("days"),
        F.lit("quarterly audit").alias("justification"),
        F.when(F.col("o_orderstatus") != "P", F.lit("LegitimateAudit")).alias("category"),
        F.when(F.col("o_orderstatus") != "P", F.lit(0.98)).alias("confidence"),
        F.col("o_orderdate").cast("timestamp").alias("requested_at"),
    )


_TICKET_TAIL = """'Requested Duration: 30 days\\nJustification: quarterly audit\\nTriage Category: '
      || CASE WHEN o_orderstatus <> 'P' THEN 'LegitimateAudit\\nTriage Confidence: 98%'
         ELSE 'Standard\\nTriage Confidence: N/A' END"""
_TARGET = "'sales.dbo.' || lower(substr(o_orderpriority, 3, 4))"


@query(
    f"""
    SELECT o_orderkey AS request_id, '{{"short_description":"[Access Request] ' || {_TARGET}
      || '","description":"Tenant: ' || lower(o_orderstatus) || '\\nRequester SID: S-1-' || o_custkey
      || '\\nTarget Table: ' || {_TARGET} || '\\n' || {_TICKET_TAIL}
      || '","urgency":"2","priority":"2","correlation_id":"REQ-' || lower(o_orderstatus) || '-S-1-'
      || o_custkey || '-' || (epoch_us(o_orderdate) // 1000000) || '"}}' AS body,
      '{{"fields":{{"project":{{"key":"SEC"}},"summary":"[Access Request] ' || {_TARGET}
      || ' for S-1-' || o_custkey || '","description":{{"type":"doc","version":1,"content":['
      || '{{"type":"paragraph","content":[{{"type":"text","text":"Requester SID: S-1-' || o_custkey
      || '\\nTenant: ' || lower(o_orderstatus) || '\\nTarget Table: ' || {_TARGET} || '\\n'
      || {_TICKET_TAIL} || '"}}]}}]}},"issuetype":{{"name":"Task"}}}}}}' AS issue
    FROM orders"""
)
def ticket_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _requests(spark, sf_dir)
    issues = jira_tickets(requests, "Access Request").withColumnRenamed("body", "issue")
    return servicenow_tickets(requests, "Access Request", "REQ").join(issues, "request_id")


@query(
    """
    SELECT o_orderkey AS request_id,
      CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'SEC-' || o_orderkey
        WHEN o_orderstatus = 'P' THEN NULL ELSE 'CHG' || o_orderkey END AS ticket_id,
      CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '5-LOW'
        THEN 'https://itsm.example/browse/SEC-' || o_orderkey
        WHEN o_orderstatus = 'P' THEN NULL
        ELSE 'https://itsm.example/nav_to.do?uri=change_request.do?sys_id=s' || o_orderkey END
        AS ticket_url,
      CASE WHEN o_orderstatus = 'F' THEN 'ITSM_UNAVAILABLE'
        WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN 'INVALID_RESPONSE' END AS error_code
    FROM orders"""
)
def ticket_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
      SELECT o_orderkey AS request_id,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'Jira' ELSE 'ServiceNow' END AS system,
        CASE WHEN o_orderstatus = 'F' THEN 503 ELSE 201 END AS http_status,
        CASE WHEN o_orderpriority = '5-LOW' THEN '{"id":"9","key":"SEC-' || o_orderkey || '"}'
          WHEN o_orderstatus = 'P' THEN '{"ok":true}'
          ELSE '{"result":{"sys_id":"s' || o_orderkey || '","number":"CHG' || o_orderkey || '"}}' END
          AS body
      FROM lw_orders"""
    return ticket_references(derive(spark, sf_dir, text), "https://itsm.example/")
