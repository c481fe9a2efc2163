"""Registered queries: catalog pages, synchronisation, identities, principals, grants."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.operators.grants import (
    GrantConfig,
    affected_tables,
    auto_grantable,
    desired_grants,
    effective_rules,
    grant_classes,
    reconcile_classes,
    role_grantees,
    rule_tables,
    team_grantees,
    user_grantees,
)
from lakewarden.operators.identity import ID, IdentityConfig, reject_collisions, resolve_identity
from lakewarden.operators.principals import resolve_teams, resolve_users
from lakewarden.operators.tagging import TagConfig, map_columns, map_tables
from lakewarden.plans import inputs
from lakewarden.plans.dialect import PLAIN, SPARK, derive, load
from lakewarden.plans.registry import query
from lakewarden.plans.sync import CatalogSync, sync_catalog
from lakewarden.session import checkpoint
from lakewarden.sources.catalog_pages import (
    alation_assets,
    atlas_assets,
    collibra_assets,
    pull_problems,
)

_RULES = {"pii.email": "MASK_EMAIL", "PersonalData.Id": "REDACT", "pseudonym": "HMAC_SHA256"}
_TAGS = TagConfig(
    art9_tags=("gdpr_art9", "GDPR.Art9"),
    pii_tags=("PII", "contact"),
    rule_of_tag=_RULES,
    hmac_key_id="k1",
    activate_new=False,
)
_NOW = datetime(2000, 1, 1)
_RULE_SQL = """
    coalesce(list_filter(list_transform(string_split(tag_text, ','), lambda t: CASE lower(t)
      WHEN 'pii.email' THEN 'MASK_EMAIL' WHEN 'personaldata.id' THEN 'REDACT'
      WHEN 'pseudonym' THEN 'HMAC_SHA256' END), lambda r: r IS NOT NULL)[1], NULL)"""


def _named(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Adds the identity of the catalogued table to rows per part."""
    names = tables.select("p_partkey", F.col("service").alias("domain"), "schema_name", "table_name")
    return rows.join(names, "p_partkey")


def _tags() -> F.Column:
    return F.split("tag_text", ",")


# --- catalog pages


def _pages(d) -> str:
    """API pages of three catalog products, one page per part."""
    key = "CAST(p_partkey AS STRING)"
    return f"""
      SELECT p_partkey, p_size,
        '{{"entities":[{{"attributes":{{"qualifiedName":"' || lower(replace(p_brand, '#', '_'))
          || CASE WHEN p_size > 25 THEN '/' || lower(p_type) || '/t' || {key} ELSE '' END
          || '","name":"t' || {key} || '"}},"classificationNames":['
          || CASE WHEN p_size > 40 THEN '"GDPR","Art9"' ELSE '' END || ']}}]}}' AS atlas,
        '{{"results":[{{"id":"' || {key} || '","name":"' || p_name || '"}},{{"id":"x"}}]}}' AS collibra,
        CASE WHEN p_size > 25 THEN '' ELSE '{{"results":' END
          || '[{{"id":' || {key} || ',"name":"t' || {key} || '","ds_id":'
          || CASE WHEN p_size > 45 THEN '"' || CAST(p_size AS STRING) || '; drop"'
             WHEN p_size > 40 THEN '-3' WHEN p_size > 20 THEN '"007"'
             ELSE CAST(p_size AS STRING) END
          || CASE WHEN p_type = 'SMALL' THEN '' ELSE ',"schema_name":"' || lower(p_type) || '"' END
          || ',"tags":["a",{{"name":"b"}},{{"x":1}}]}},{{"id":1,"name":" ","ds_id":7}}]'
          || CASE WHEN p_size > 25 THEN '' ELSE '}}' END AS alation
      FROM {d.table("part")}"""


@query(
    """
    SELECT lower(replace(p_brand, '#', '_')) AS domain,
      CASE WHEN p_size > 25 THEN lower(p_type) ELSE 'dbo' END AS schema_name,
      't' || p_partkey AS table_name, CASE WHEN p_size > 40 THEN 'GDPR,Art9' ELSE '' END AS tags,
      'MicrosoftPurview' AS source_type, CAST(NULL AS VARCHAR) AS external_id FROM part
    UNION ALL
    SELECT 'collibra', 'dbo', p_name, '', 'Collibra', CAST(p_partkey AS VARCHAR) FROM part
    UNION ALL
    SELECT 'collibra', 'dbo', 'unknown', '', 'Collibra', 'x' FROM part
    UNION ALL
    SELECT CASE WHEN p_size > 20 OR p_size = 7 THEN 'clinic' ELSE 'sales' END,
      CASE WHEN p_type = 'SMALL' THEN 'dbo' ELSE lower(p_type) END, 't' || p_partkey, 'a,b',
      'Alation', CAST(p_partkey AS VARCHAR)
    FROM part WHERE p_size <= 40 AND (p_size > 20 OR p_size IN (7, 8))"""
)
def catalog_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive(spark, sf_dir, _pages(SPARK))
    alation, _ = alation_assets(
        pages.select(F.col("alation").alias("payload")), {"7": "clinic", "8": "sales", "9": " "}
    )
    assets = (
        atlas_assets(pages.select(F.col("atlas").alias("payload")))
        .unionByName(collibra_assets(pages.select(F.col("collibra").alias("payload"))))
        .unionByName(alation)
    )
    return assets.select(
        "domain",
        "schema_name",
        "table_name",
        F.array_join("classifications", ",").alias("tags"),
        "source_type",
        "external_id",
    )


@query(
    """
    SELECT count(*) AS named_items,
      count(*) FILTER (p_size > 40 OR p_size <= 20 AND p_size NOT IN (7, 8)) AS skipped_unmapped
    FROM part"""
)
def alation_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive(spark, sf_dir, _pages(SPARK)).select(F.col("alation").alias("payload"))
    return alation_assets(pages, {"7": "clinic", "8": "sales", "9": " "})[1]


_PULLS = """
    SELECT o_custkey AS pull_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1
        AS page_no,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'again' ELSE 'c' || CAST(o_orderkey AS STRING) END
        AS cursor,
      CASE WHEN o_totalprice > 100000 THEN 250 ELSE 100 END AS items
    FROM {orders}"""


@query(
    f"""
    WITH p AS ({_PULLS.format(orders="orders")}),
    c AS (SELECT pull_id, max(n) AS uses FROM (SELECT pull_id, cursor, count(*) AS n FROM p
          GROUP BY 1, 2) x GROUP BY 1),
    s AS (SELECT pull_id, count(*) AS pages, CAST(sum(items) AS BIGINT) AS items,
            arg_max(items, page_no) AS last_items, count(*) FILTER (items < 250) AS shorts
          FROM p GROUP BY 1)
    SELECT pull_id, pages, s.items, CASE WHEN uses > 1 THEN 'REPEATED_CURSOR'
      WHEN last_items >= 250 THEN 'LAST_PAGE_FULL' WHEN shorts > 1 THEN 'SHORT_PAGE_INSIDE' END
      AS problem FROM s JOIN c USING (pull_id)"""
)
def pull_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive(spark, sf_dir, _PULLS.format(orders="lw_orders"))
    return pull_problems(pages, page_size=250).withColumn("items", F.col("items").cast("bigint"))


# --- catalog synchronisation


def _sync(spark: SparkSession, sf_dir: str) -> CatalogSync:
    tables = derive(spark, sf_dir, inputs.catalog_tables(SPARK))
    assets = tables.select(
        F.col("service").alias("domain"),
        "schema_name",
        "table_name",
        "display_name",
        F.lit(None).cast("string").alias("description"),
        F.lit("Collibra").alias("source_type"),
        _tags().alias("tags"),
        F.array().cast("array<string>").alias("classifications"),
    )
    columns = _named(derive(spark, sf_dir, inputs.catalog_columns(SPARK)), tables).select(
        *ID,
        "column_name",
        "data_type",
        F.lit(None).cast("string").alias("description"),
        _tags().alias("tags"),
    )
    known = _named(derive(spark, sf_dir, inputs.existing_tables(SPARK)), tables)
    known_columns = _named(derive(spark, sf_dir, inputs.existing_columns(SPARK)), tables)
    epochs = known.select(*ID, F.lit(3).cast("bigint").alias("epoch"))
    return sync_catalog(
        assets,
        columns,
        known.withColumn("schema_name", F.upper("schema_name")),
        known_columns.withColumn("column_name", F.upper("column_name")),
        epochs,
        _TAGS,
        dry_run=True,
    )


_SYNC_TABLES = f"""
    SELECT c.p_partkey, c.service AS domain, c.schema_name, c.table_name,
      coalesce(e.source_type, 'Collibra') AS source_type,
      CASE WHEN c.p_size >= 45 THEN 'HIGH' ELSE coalesce(e.sensitivity, 'NORMAL') END AS sensitivity,
      c.p_size >= 45 OR coalesce(e.requires_four_eyes, false) AS requires_four_eyes,
      coalesce(e.is_active, false) AS is_active, c.p_size >= 45 AS is_art9,
      e.p_partkey IS NULL AS is_new, coalesce(e.sensitivity IN ('HIGH', 'RESTRICTED'), false)
        AS retained
    FROM ({inputs.catalog_tables(PLAIN)}) c
    LEFT JOIN ({inputs.existing_tables(PLAIN)}) e ON e.p_partkey = c.p_partkey"""


@query(f"SELECT * EXCLUDE (p_partkey) FROM ({_SYNC_TABLES}) t")
def catalog_sync_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sync(spark, sf_dir).tables.drop("display_name", "description")


_SYNC_COLUMNS = f"""
    SELECT t.service AS domain, t.schema_name, t.table_name,
      coalesce(n.column_name, upper(o.column_name)) AS column_name,
      coalesce(n.data_type, o.data_type) AS data_type,
      coalesce(n.rule IS NOT NULL OR list_has_any(list_transform(string_split(n.tag_text, ','),
        lambda x: lower(x)), ['pii', 'contact']), false) OR coalesce(o.is_sensitive, false)
        AS is_sensitive,
      coalesce(n.rule, o.rule_type) AS rule_type, n.rule IS NOT NULL AS masked_by_catalog,
      CASE WHEN o.p_partkey IS NULL THEN 'catalog' WHEN n.p_partkey IS NULL THEN 'retained'
        ELSE 'merged' END AS origin
    FROM (SELECT *, {_RULE_SQL} AS rule FROM ({inputs.catalog_columns(PLAIN)}) x) n
    FULL JOIN ({inputs.existing_columns(PLAIN)}) o
      ON o.p_partkey = n.p_partkey AND o.column_name = n.column_name
    JOIN ({inputs.catalog_tables(PLAIN)}) t ON t.p_partkey = coalesce(n.p_partkey, o.p_partkey)"""


@query(_SYNC_COLUMNS)
def catalog_sync_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sync(spark, sf_dir).columns.drop("description")


@query(
    f"""
    SELECT (SELECT count(*) FROM ({_SYNC_TABLES}) t) AS synced_tables,
      (SELECT count(*) FILTER (is_art9) FROM ({_SYNC_TABLES}) t) AS art9_tables,
      (SELECT count(*) FILTER (retained) FROM ({_SYNC_TABLES}) t) AS retained_tables,
      (SELECT count(*) FILTER (origin <> 'retained') FROM ({_SYNC_COLUMNS}) c) AS synced_columns,
      (SELECT count(*) FILTER (masked_by_catalog) FROM ({_SYNC_COLUMNS}) c) AS masked_columns"""
)
def catalog_sync_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sync(spark, sf_dir).counters


@query(
    f"""
    SELECT domain, schema_name, table_name,
      'retained existing sensitivity ' || sensitivity AS warning
    FROM ({_SYNC_TABLES}) t WHERE retained"""
)
def catalog_sync_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sync(spark, sf_dir).warnings


@query(
    f"""
    SELECT domain, schema_name, table_name, CAST(CASE WHEN is_new THEN 1 ELSE 4 END AS BIGINT)
      AS epoch FROM ({_SYNC_TABLES}) t"""
)
def catalog_sync_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sync(spark, sf_dir).epochs


# --- identities


def _entity_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive(spark, sf_dir, inputs.entity_tables(SPARK))
    return raw.withColumnRenamed("database_name", "database").withColumn(
        "service_fqn", F.col("service")
    )


def _identity(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    config = IdentityConfig(
        domain_of_database={
            **{f"SVC_brand{n}.db_{t}": f"dom{n}" for n in range(1, 21) for t in ("small", "promo")},
            **{f"svc_brand{n}.db_large": f"big{n}" for n in range(1, 26)},
            "legacy.db_economy": "old",
        },
        tenant_of_service={
            **{f"svc_brand{n}": f"tenant{n}" for n in range(1, 16)},
            **{f"svc_brand{n}.DB_large": "tenant-large" for n in range(1, 11)},
            "legacy": "  ",
        },
    )
    return resolve_identity(_entity_tables(spark, sf_dir), config)


_IDENTITY = f"""
    WITH e AS (
      SELECT *, string_split(fqn, '.') AS parts, len(string_split(fqn, '.')) AS n
      FROM ({inputs.entity_tables(PLAIN)}) x),
    r AS (
      SELECT entity_id, coalesce(service, CASE WHEN n >= 3 THEN parts[1] END) AS service,
        coalesce(database_name, CASE WHEN n >= 4 THEN parts[2] END) AS database,
        coalesce(db_schema, CASE WHEN n >= 4 THEN parts[3] ELSE parts[n - 1] END) AS schema_name,
        CASE WHEN name = '' THEN parts[n] ELSE name END AS table_name FROM e),
    m AS (
      SELECT *, regexp_extract(service, 'svc_brand([0-9]+)', 1) AS b FROM r),
    k AS (
      SELECT *, CASE WHEN b <> '' AND CAST(b AS INT) BETWEEN 1 AND 20
          AND database IN ('db_small', 'db_promo') THEN 'dom' || b
        WHEN b <> '' AND CAST(b AS INT) BETWEEN 1 AND 25 AND database = 'db_large' THEN 'big' || b
        WHEN service = 'legacy' AND database = 'db_economy' THEN 'old' END AS domain,
        CASE WHEN b <> '' AND CAST(b AS INT) BETWEEN 1 AND 10 AND database = 'db_large'
          THEN 'tenant-large'
        WHEN b <> '' AND CAST(b AS INT) BETWEEN 1 AND 15 THEN 'tenant' || b END AS tenant_id FROM m),
    f AS (SELECT *, CASE WHEN domain IS NULL THEN 'NO_DOMAIN_MAPPING' WHEN tenant_id IS NULL
            THEN 'NO_TENANT_MAPPING' END AS reason FROM k)"""


@query(
    _IDENTITY
    + """
    SELECT entity_id, domain, schema_name, table_name, service, database, tenant_id
    FROM f WHERE reason IS NULL"""
)
def identity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, _ = _identity(spark, sf_dir)
    return resolved.select("entity_id", *ID, "service", "database", "tenant_id")


@query(_IDENTITY + " SELECT entity_id, reason FROM f WHERE reason IS NOT NULL")
def identity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identity(spark, sf_dir)[1].select("entity_id", "reason")


def _collisions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    missing = [F.lit(None).cast("string").alias(c) for c in
               ("service", "service_fqn", "database", "db_schema")]
    raw = derive(spark, sf_dir, inputs.colliding_tables(SPARK)).select("*", *missing)
    resolved, _ = resolve_identity(raw, IdentityConfig(default_tenant="main"))
    return reject_collisions(resolved)


_COLLISIONS = f"""
    WITH t AS (SELECT entity_id, split_part(fqn, '.', 1) AS domain, split_part(fqn, '.', 2) AS db,
        name FROM ({inputs.colliding_tables(PLAIN)}) x),
    c AS (SELECT domain, name FROM t GROUP BY 1, 2 HAVING count(DISTINCT db) > 1)"""


@query(
    _COLLISIONS
    + """
    SELECT entity_id, domain, 'main' AS schema_name, name AS table_name FROM t
    WHERE (domain, name) NOT IN (SELECT (domain, name) FROM c)"""
)
def collision_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collisions(spark, sf_dir)[0].select("entity_id", *ID)


@query(
    _COLLISIONS
    + """
    SELECT entity_id, 'DATABASE_COLLISION' AS reason FROM t
    WHERE (domain, name) IN (SELECT (domain, name) FROM c)"""
)
def collision_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collisions(spark, sf_dir)[1].select("entity_id", "reason")


# --- tags to protection


def _protected_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, inputs.catalog_columns(SPARK)).withColumn("tags", _tags())
    return map_columns(rows, _TAGS)


_PROTECTED = f"""
    SELECT p_partkey, column_name, tag_text LIKE '%GDPR.Art9%' AS is_art9,
      CASE WHEN tag_text = 'contact,PII.Email' THEN 'MASK_EMAIL'
        WHEN tag_text = 'PersonalData.Id' THEN 'REDACT' WHEN tag_text = 'pseudonym'
        THEN 'HMAC_SHA256' WHEN tag_text IN ('GDPR.Art9.Health', 'pii') THEN 'REDACT' END
        AS rule_type FROM ({inputs.catalog_columns(PLAIN)}) c"""


@query(
    f"""
    SELECT *, rule_type IS NOT NULL AS is_sensitive,
      CASE WHEN rule_type = 'HMAC_SHA256' THEN 'SHA256' END AS pattern,
      CASE WHEN rule_type = 'REDACT' THEN '[REDACTED]' END AS replacement,
      CASE WHEN rule_type = 'HMAC_SHA256' THEN 'k1' END AS hmac_key_id FROM ({_PROTECTED}) p"""
)
def column_protection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _protected_columns(spark, sf_dir).drop("tags", "tag_text", "data_type", "uses")


_MAPPED = f"""
    SELECT c.p_partkey, c.tenant_id, c.service AS domain, c.schema_name, c.table_name,
      CASE WHEN coalesce(a.art9, false) OR p_size >= 45 OR tag_text IN
        ('Tier.Gold,PII', 'Classification.Sensitive') THEN 'HIGH' ELSE 'NORMAL' END AS sensitivity,
      coalesce(a.art9, false) OR p_size >= 45 OR tag_text = 'FourEyes.Required'
        AS requires_four_eyes, p_size <= 40 AS is_active,
      coalesce(a.rules, 0) AS masking_rules
    FROM ({inputs.catalog_tables(PLAIN)}) c
    LEFT JOIN (SELECT p_partkey, bool_or(is_art9) AS art9, count(rule_type) AS rules
               FROM ({_PROTECTED}) p GROUP BY 1) a ON a.p_partkey = c.p_partkey"""


def _mapped_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derive(spark, sf_dir, inputs.catalog_tables(SPARK)).select(
        "p_partkey",
        "tenant_id",
        F.col("service").alias("domain"),
        "schema_name",
        "table_name",
        _tags().alias("tags"),
    )
    known = derive(spark, sf_dir, inputs.existing_tables(SPARK))
    columns = _protected_columns(spark, sf_dir)
    return map_tables(tables, columns, "p_partkey", _TAGS, known=known).drop("tags")


@query(_MAPPED)
def table_protection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped_tables(spark, sf_dir)


# --- principals


_SIDS = f"""
    WITH m AS (SELECT kind, key, min(sid) AS sid FROM ({inputs.principal_map(PLAIN)}) x
               GROUP BY 1, 2 HAVING count(DISTINCT sid) = 1),
    u AS (SELECT *, lower(trim(email)) AS mail FROM ({inputs.principals(PLAIN)}) y),
    s AS (SELECT mail FROM u GROUP BY 1 HAVING count(*) > 1),
    resolved AS (
      SELECT u.c_custkey, u.id, coalesce(a.sid, b.sid) AS sid FROM u
      LEFT JOIN m a ON a.kind = 'id' AND a.key = u.id
      LEFT JOIN m b ON b.kind = 'email' AND b.key = u.mail
        AND u.mail NOT IN (SELECT mail FROM s))"""


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = derive(spark, sf_dir, inputs.principals(SPARK))
    return resolve_users(users, derive(spark, sf_dir, inputs.principal_map(SPARK)))


@query(_SIDS + " SELECT c_custkey, sid FROM resolved")
def user_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(spark, sf_dir).select("c_custkey", "sid")


_TEAM_MAP = """
    SELECT 'name' AS kind, n_name AS key, 'G-name-' || CAST(n_nationkey AS STRING) AS sid
    FROM {nation} UNION ALL
    SELECT 'fqn', 'org.' || lower(n_name), 'G-fqn-' || CAST(n_nationkey AS STRING)
    FROM {nation} WHERE n_regionkey >= 3 UNION ALL
    SELECT 'id', md5('team' || CAST(n_nationkey AS STRING)), 'G-id-' || CAST(c_custkey AS STRING)
    FROM {nation} JOIN {customer} ON c_nationkey = n_nationkey WHERE c_acctbal > 9900"""


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams = load(spark, sf_dir, "nation").select(
        F.md5(F.concat(F.lit("team"), F.col("n_nationkey").cast("string"))).alias("id"),
        F.concat(F.lit("org."), F.lower("n_name")).alias("fqn"),
        F.col("n_name").alias("name"),
        "n_nationkey",
    )
    text = _TEAM_MAP.format(nation="lw_nation", customer="lw_customer")
    return resolve_teams(teams, derive(spark, sf_dir, text))


_TEAM_SIDS = f"""
    SELECT n_nationkey, coalesce(a.sid, CASE WHEN n_regionkey >= 3 THEN 'G-fqn-' || n_nationkey END,
      'G-name-' || n_nationkey) AS sid
    FROM nation LEFT JOIN (SELECT key, min(sid) AS sid
      FROM ({_TEAM_MAP.format(nation="nation", customer="customer")}) t
      WHERE kind = 'id' GROUP BY 1 HAVING count(DISTINCT sid) = 1) a
      ON a.key = md5('team' || n_nationkey)"""


@query(_TEAM_SIDS)
def team_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _teams(spark, sf_dir).select("n_nationkey", "sid")


# --- grants


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, inputs.policy_rules(SPARK)).select(
        "policy_id",
        "policy_name",
        "enabled",
        "effect",
        F.col("cond").alias("condition"),
        F.split("operations", ",").alias("operations"),
        F.array("resource").alias("resources"),
    )


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, inputs.supplier_roles(SPARK)).select(
        "id",
        "name",
        "gateway_role",
        F.array(F.struct(F.col("ref_id").alias("id"), F.col("ref_name").alias("name"))).alias("policies"),
    )


_GRANTS = f"""
    {_SIDS},
    rules AS (
      SELECT DISTINCT policy_id, policy_name, CASE WHEN lower(effect) = 'deny' THEN 'Deny'
        ELSE 'Allow' END AS effect, lower(resource) AS resource
      FROM ({inputs.policy_rules(PLAIN)}) p
      WHERE enabled AND cond = '' AND (operations LIKE '%ViewAll%'
        OR lower(effect) = 'deny' AND lower(operations) = 'all')),
    tabs AS ({_MAPPED}),
    applicable AS (
      SELECT DISTINCT policy_id, effect, tenant_id, domain, schema_name, table_name
      FROM rules JOIN tabs ON resource = 'table' OR resource = lower(table_name)
        OR resource = lower(schema_name || '.' || table_name)
        OR resource = lower(domain || '.' || schema_name || '.' || table_name)),
    pol AS (SELECT DISTINCT policy_id, lower(policy_name) AS pname
            FROM ({inputs.policy_rules(PLAIN)}) p),
    uniq AS (SELECT pname, min(policy_id) AS policy_id FROM pol GROUP BY 1 HAVING count(*) = 1),
    roles AS ({inputs.supplier_roles(PLAIN)}),
    role_policy AS (
      SELECT r.id, r.name, r.gateway_role, coalesce(a.policy_id, b.policy_id) AS policy_id
      FROM roles r LEFT JOIN pol a ON a.policy_id = r.ref_id
      LEFT JOIN uniq b ON b.pname = lower(r.ref_name)),
    grantees AS (
      SELECT 'Role' AS grantee_type, upper(gateway_role) AS grantee, policy_id FROM role_policy
      UNION
      SELECT 'Group', upper(sid), md5('nation-policy' || n_nationkey) FROM ({_TEAM_SIDS}) g
      UNION
      SELECT 'User', upper(x.sid), rp.policy_id
      FROM resolved x JOIN ({inputs.user_roles(PLAIN)}) ur ON ur.user_id = x.id
      JOIN role_policy rp ON rp.id = ur.role_id
        OR ur.role_id IS NULL AND lower(rp.name) = lower(ur.role_name)
      WHERE x.sid IS NOT NULL),
    desired AS (
      SELECT DISTINCT tenant_id, domain, schema_name, table_name, grantee_type, grantee, effect
      FROM grantees JOIN applicable USING (policy_id)),
    prot AS (SELECT DISTINCT p_partkey FROM ({_PROTECTED}) p WHERE rule_type IS NOT NULL),
    grantable AS (
      SELECT domain, schema_name, table_name FROM tabs WHERE NOT requires_four_eyes
      AND sensitivity = 'NORMAL' AND p_partkey NOT IN (SELECT p_partkey FROM prot)),
    effective AS (
      SELECT d.* FROM desired d LEFT JOIN grantable g USING (domain, schema_name, table_name)
      WHERE d.effect = 'Deny' OR g.domain IS NOT NULL)"""


def _grantees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Grantees with their policies, and the effective rules."""
    rules = checkpoint(_rules(spark, sf_dir))
    policies = rules.select(
        F.col("policy_id").alias("id"), F.col("policy_name").alias("name")
    ).distinct()
    roles = checkpoint(_roles(spark, sf_dir))
    refs = F.array(
        F.struct(
            F.md5(F.concat(F.lit("nation-policy"), F.col("n_nationkey").cast("string"))).alias("id"),
            F.lit(None).cast("string").alias("name"),
        )
    )
    teams = _teams(spark, sf_dir).withColumn("policies", refs)
    held = derive(spark, sf_dir, inputs.user_roles(SPARK)).join(
        _users(spark, sf_dir).select("id", "sid"), F.col("id") == F.col("user_id")
    )
    allowed = roles.select(F.col("name").alias("role"), F.col("gateway_role").alias("grantee"))
    of_roles = role_grantees(roles, policies, allowed)
    grantees = of_roles.unionByName(team_grantees(teams, policies)).unionByName(
        user_grantees(held, roles, policies)
    )
    return grantees, effective_rules(rules)


@query(_GRANTS + " SELECT * FROM desired")
def grants_desired(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _mapped_tables(spark, sf_dir).select("tenant_id", *ID)
    grantees, rules = _grantees(spark, sf_dir)
    return desired_grants(grantees, rule_tables(rules, tables)).drop("grantee_name")


def _grantable(spark: SparkSession, sf_dir: str, tables: DataFrame) -> DataFrame:
    names = tables.select("p_partkey", *ID)
    columns = _protected_columns(spark, sf_dir).join(names, "p_partkey")
    return auto_grantable(tables, columns)


@query(_GRANTS + " SELECT * FROM grantable")
def auto_grantable_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grantable(spark, sf_dir, _mapped_tables(spark, sf_dir))


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = checkpoint(_mapped_tables(spark, sf_dir))
    config = GrantConfig(auto_create=True, interval_minutes=30)
    grantees, rules = _grantees(spark, sf_dir)
    classes = grant_classes(grantees, rules, tables, _grantable(spark, sf_dir, tables), config)
    held = derive(spark, sf_dir, inputs.held_grants(SPARK)).withColumn(
        "valid_to", F.timestamp_micros("valid_to_us")
    )
    return reconcile_classes(classes, held, tables, config, _NOW)


_RECONCILE = f"""
    {_GRANTS},
    held AS (
      SELECT h.*, upper(h.grantee) AS g FROM ({inputs.held_grants(PLAIN)}) h
      WHERE marker = 'policy-sync' AND valid_to_us > 946684800000000
        AND tenant_id IN (SELECT tenant_id FROM tabs)),
    ranked AS (
      SELECT h.*, row_number() OVER (PARTITION BY tenant_id, domain, schema_name, table_name, g, effect
        ORDER BY id) AS rn FROM held h),
    existing AS (
      SELECT r.*, r.rn = 1 AND e.grantee IS NOT NULL AS kept
      FROM ranked r LEFT JOIN effective e ON e.tenant_id = r.tenant_id AND e.domain = r.domain
        AND e.schema_name = r.schema_name AND e.table_name = r.table_name AND e.grantee = r.g
        AND e.effect = r.effect AND e.grantee_type = 'Role'),
    acts AS (
      SELECT CASE WHEN NOT kept THEN 'revoke' WHEN effect = 'Allow'
          OR valid_to_us < 946684800000000 + 30 * 86400000000 THEN 'extend' ELSE 'keep' END AS action,
        id, tenant_id, domain, schema_name, table_name, grantee_type, g AS grantee, effect, valid_to_us
      FROM existing
      UNION ALL
      SELECT 'create', NULL, e.tenant_id, e.domain, e.schema_name, e.table_name, e.grantee_type,
        e.grantee, e.effect, NULL
      FROM effective e LEFT JOIN (SELECT DISTINCT tenant_id, domain, schema_name, table_name, g, effect
        FROM existing WHERE kept) k ON e.grantee_type = 'Role' AND k.tenant_id = e.tenant_id
        AND k.domain = e.domain AND k.schema_name = e.schema_name AND k.table_name = e.table_name
        AND k.g = e.grantee AND k.effect = e.effect WHERE k.g IS NULL)"""


@query(
    _RECONCILE
    + """
    SELECT action, id, tenant_id, domain, schema_name, table_name, grantee_type, grantee, effect,
      CASE WHEN action = 'create' THEN CAST(946684500 AS BIGINT) END AS valid_from_s,
      CASE WHEN action = 'revoke' THEN 946684800 WHEN action = 'keep' THEN valid_to_us // 1000000
        WHEN effect = 'Deny' THEN 946684800 + 365 * 86400 ELSE 946684800 + 3600 END AS valid_to_s
    FROM acts"""
)
def grant_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = _actions(spark, sf_dir)
    return actions.withColumns(
        {"valid_from_s": F.unix_seconds("valid_from"), "valid_to_s": F.unix_seconds("valid_to")}
    ).drop("valid_from", "valid_to")


@query(
    _RECONCILE
    + """
    SELECT DISTINCT domain, schema_name, table_name FROM acts WHERE action IN ('create', 'revoke')"""
)
def grant_affected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affected_tables(_actions(spark, sf_dir))
