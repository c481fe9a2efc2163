"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

CATALOG_SECRET = "catalog-event-secret"
TICKET_SECRET = "ticket-secret-"


def catalog_tables(d) -> str:
    """One catalogued table per part: full name, service, database, tags."""
    return f"""
      SELECT p_partkey,
        'svc_' || lower(replace(p_brand, '#', '')) || '.db_' || lower(p_type) || '.'
          || split_part(p_name, ' ', 1) || '.' || split_part(p_name, ' ', 2) || '_'
          || CAST(p_partkey AS STRING) AS fqn,
        'svc_' || lower(replace(p_brand, '#', '')) AS service,
        'db_' || lower(p_type) AS database_name,
        split_part(p_name, ' ', 1) AS schema_name,
        split_part(p_name, ' ', 2) || '_' || CAST(p_partkey AS STRING) AS table_name,
        CASE WHEN p_size >= 45 THEN 'gdpr_art9,clinical'
             WHEN p_type = 'SMALL' THEN 'Tier.Gold,PII'
             WHEN p_type = 'LARGE' THEN 'FourEyes.Required'
             WHEN p_size <= 3 THEN 'Classification.Sensitive'
             ELSE 'public' END AS tag_text,
        'tenant-' || lower(p_type) AS tenant_id,
        p_name AS display_name, p_size, p_type, p_brand
      FROM {d.table("part")}"""


_COLUMN_NAME = """CASE {n} WHEN 1 THEN 'email_address' WHEN 2 THEN 'ssn' WHEN 3 THEN 'account_no'
        WHEN 4 THEN 'amount' WHEN 5 THEN 'region' WHEN 6 THEN 'note' ELSE 'created_at' END"""
_COLUMN_TYPE = """CASE {n} WHEN 1 THEN 'varchar(255)' WHEN 2 THEN 'text' WHEN 3 THEN 'bigint'
        WHEN 4 THEN 'decimal(12,2)' WHEN 5 THEN 'varchar' WHEN 6 THEN 'text' ELSE 'timestamp' END"""


def catalog_columns(d) -> str:
    """Columns of the catalogued tables: one per part and line number in use."""
    return f"""
      SELECT l_partkey AS p_partkey,
        {_COLUMN_NAME.format(n="l_linenumber")} AS column_name,
        {_COLUMN_TYPE.format(n="l_linenumber")} AS data_type,
        CASE l_linenumber
          WHEN 1 THEN CASE WHEN max(l_discount) >= 0.1 THEN 'contact,PII.Email' ELSE 'mail' END
          WHEN 2 THEN CASE WHEN max(l_discount) >= 0.1 THEN 'GDPR.Art9.Health'
                           WHEN max(l_discount) < 0.05 THEN 'PersonalData.Id' ELSE 'ref' END
          WHEN 3 THEN CASE WHEN min(l_quantity) < 5 THEN 'pseudonym' ELSE 'key' END
          WHEN 5 THEN CASE WHEN max(l_tax) > 0.07 THEN 'pii' ELSE 'geo' END
          ELSE 'plain' END AS tag_text,
        count(*) AS uses
      FROM {d.table("lineitem")} GROUP BY l_partkey, l_linenumber"""


def existing_tables(d) -> str:
    """Tables the governance store already knows."""
    return f"""
      SELECT p_partkey, p_type, p_brand,
        CASE WHEN p_size <= 5 THEN 'RESTRICTED' WHEN p_size <= 10 THEN 'HIGH'
             WHEN p_size <= 15 THEN 'LOW' WHEN p_size <= 20 THEN 'CONFIDENTIAL'
             ELSE 'NORMAL' END AS sensitivity,
        p_type = 'PROMO' AS requires_four_eyes,
        p_type <> 'ECONOMY' AS is_active,
        CASE WHEN p_type = 'MEDIUM' THEN 'Oracle' END AS source_type
      FROM {d.table("part")} WHERE p_size <= 40"""


def existing_columns(d) -> str:
    """Columns the governance store already knows: those of lines that were returned."""
    return f"""
      SELECT l_partkey AS p_partkey,
        {_COLUMN_NAME.format(n="l_linenumber")} AS column_name,
        CASE WHEN max(l_discount) >= 0.08 THEN 'text'
             ELSE {_COLUMN_TYPE.format(n="l_linenumber")} END AS data_type,
        max(l_tax) > 0.06 AS is_sensitive,
        CASE WHEN max(l_discount) >= 0.09 THEN 'REDACT' END AS rule_type
      FROM {d.table("lineitem")} WHERE l_returnflag = 'R'
      GROUP BY l_partkey, l_linenumber"""


def colliding_tables(d) -> str:
    """Tables whose name does not tell their database: some identities collide."""
    return f"""
      SELECT CAST(p_partkey AS STRING) AS entity_id,
        'svc_' || lower(replace(p_brand, '#', '')) || '.db_' || lower(p_type) || '.main.'
          || replace(p_name, ' ', '_') || '_'
          || CAST({d.idiv("p_partkey", "2000")} AS STRING) AS fqn,
        replace(p_name, ' ', '_') || '_' || CAST({d.idiv("p_partkey", "2000")} AS STRING) AS name
      FROM {d.table("part")}"""


def entity_tables(d) -> str:
    """Policy-store tables with full names of two to four parts and optional references."""
    return f"""
      SELECT CAST(p_partkey AS STRING) AS entity_id,
        CASE WHEN p_size <= 10 THEN split_part(p_name, ' ', 1) || '.t' || CAST(p_partkey AS STRING)
             WHEN p_size <= 20 THEN 'svc_' || lower(replace(p_brand, '#', '')) || '.'
               || split_part(p_name, ' ', 1) || '.t' || CAST(p_partkey AS STRING)
             ELSE 'svc_' || lower(replace(p_brand, '#', '')) || '.db_' || lower(p_type) || '.'
               || split_part(p_name, ' ', 1) || '.t' || CAST(p_partkey AS STRING) END AS fqn,
        CASE WHEN p_size = 50 THEN '' ELSE 'T' || CAST(p_partkey AS STRING) END AS name,
        CASE WHEN p_size <= 5 THEN 'legacy' END AS service,
        CASE WHEN p_size <= 15 THEN 'db_' || lower(p_type) END AS database_name,
        CASE WHEN p_size >= 48 THEN 'override' END AS db_schema
      FROM {d.table("part")}"""


def principals(d) -> str:
    """Users: e-mails are shared between some customers and differ in case."""
    return f"""
      SELECT c_custkey, md5('user' || CAST(c_custkey AS STRING)) AS id,
        CASE WHEN c_nationkey < 12 THEN 'USER' ELSE ' user' END
          || CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) || '@'
          || lower(c_mktsegment) || '.example' AS email
      FROM {d.table("customer")}"""


def principal_map(d) -> str:
    """Explicit identifiers: by id, by e-mail, and some keys with two identifiers."""
    return f"""
      SELECT 'id' AS kind, md5('user' || CAST(c_custkey AS STRING)) AS key,
        'S-1-' || CAST(c_custkey AS STRING) AS sid
      FROM {d.table("customer")} WHERE c_acctbal > 6000
      UNION ALL
      SELECT 'id', md5('user' || CAST(c_custkey AS STRING)), 'S-9-' || CAST(c_custkey AS STRING)
      FROM {d.table("customer")} WHERE c_acctbal > 9000
      UNION ALL
      SELECT 'email', 'user' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) || '@'
          || lower(c_mktsegment) || '.example',
        'S-2-' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING)
      FROM {d.table("customer")} WHERE c_acctbal BETWEEN 1000 AND 7000"""


def policy_rules(d) -> str:
    """One rule per supplier policy and table it mainly supplies, one per nation policy."""
    return f"""
      WITH supplied AS (
        SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS q
        FROM {d.table("lineitem")} GROUP BY l_partkey, l_suppkey),
      best AS (SELECT l_partkey, max(q * 1000000 + l_suppkey) AS top FROM supplied
               GROUP BY l_partkey),
      main AS (SELECT s.l_partkey, s.l_suppkey FROM supplied s JOIN best b
               ON s.l_partkey = b.l_partkey AND s.q * 1000000 + s.l_suppkey = b.top)
      SELECT md5('policy' || CAST(s_suppkey AS STRING)) AS policy_id,
        CASE WHEN s_nationkey = 3 THEN 'Shared Policy'
             ELSE 'Policy ' || CAST(s_suppkey AS STRING) END AS policy_name,
        s_acctbal > -500 AS enabled,
        CASE WHEN s_nationkey < 5 THEN 'deny' ELSE 'Allow' END AS effect,
        CASE WHEN s_nationkey = 7 THEN 'isOwner()' ELSE '' END AS cond,
        CASE WHEN s_nationkey = 9 THEN 'EditAll' WHEN s_nationkey = 4 THEN 'all'
             WHEN s_nationkey = 11 THEN 'All' ELSE 'EditTags,ViewAll' END AS operations,
        CASE WHEN c.p_type IN ('SMALL', 'LARGE') THEN c.table_name
             WHEN c.p_type = 'PROMO' THEN upper(c.schema_name || '.' || c.table_name)
             ELSE c.service || '.' || c.schema_name || '.' || c.table_name END AS resource
      FROM main JOIN {d.table("supplier")} s ON s.s_suppkey = main.l_suppkey
      JOIN ({catalog_tables(d)}) c ON c.p_partkey = main.l_partkey
      UNION ALL
      SELECT md5('nation-policy' || CAST(n_nationkey AS STRING)), 'Nation ' || n_name, true,
        'deny', '', 'ViewAll', CASE WHEN n_regionkey = 0 THEN 'Table' ELSE 'all' END
      FROM {d.table("nation")}"""


def supplier_roles(d) -> str:
    """One role per supplier, referring to its policy by id or by name."""
    return f"""
      SELECT md5('role' || CAST(s_suppkey AS STRING)) AS id, s_name AS name,
        CASE WHEN s_acctbal > 2000 THEN md5('policy' || CAST(s_suppkey AS STRING)) END AS ref_id,
        CASE WHEN s_nationkey = 3 THEN 'SHARED POLICY'
             ELSE 'POLICY ' || CAST(s_suppkey AS STRING) END AS ref_name,
        'reader_' || lower(replace(s_name, '#', '_')) AS gateway_role
      FROM {d.table("supplier")}"""


def user_roles(d) -> str:
    """Roles of a user: the suppliers of the customer's latest order, by id or by name."""
    return f"""
      WITH latest AS (SELECT o_custkey, max(o_orderkey) AS o_orderkey
                      FROM {d.table("orders")} GROUP BY o_custkey)
      SELECT DISTINCT md5('user' || CAST(l.o_custkey AS STRING)) AS user_id,
        CASE WHEN s.s_acctbal > 5000 THEN md5('role' || CAST(s.s_suppkey AS STRING)) END AS role_id,
        upper(s.s_name) AS role_name
      FROM latest l JOIN {d.table("lineitem")} i ON i.l_orderkey = l.o_orderkey
      JOIN {d.table("supplier")} s ON s.s_suppkey = i.l_suppkey"""


def held_grants(d) -> str:
    """Grants held so far: one per line item, so many are copies of one grant."""
    return f"""
      SELECT md5(CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) || '/'
          || CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) || '/'
          || CAST({d.micros("l_shipdate")} AS STRING)) AS id,
        CASE WHEN l_tax > 0.07 THEN 'manual' ELSE 'policy-sync' END AS marker,
        CASE WHEN l_linenumber = 7 THEN 'tenant-foreign' ELSE c.tenant_id END AS tenant_id,
        c.service AS domain, c.schema_name, c.table_name,
        'Role' AS grantee_type,
        'reader_' || lower(replace(s.s_name, '#', '_')) AS grantee,
        CASE WHEN s.s_nationkey < 5 THEN 'Deny' ELSE 'Allow' END AS effect,
        {d.micros("max(l_shipdate)")} AS valid_to_us
      FROM {d.table("lineitem")} JOIN ({catalog_tables(d)}) c ON c.p_partkey = l_partkey
      JOIN {d.table("supplier")} s ON s.s_suppkey = l_suppkey
      GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_tax, c.tenant_id,
        c.service, c.schema_name, c.table_name, s.s_name, s.s_nationkey"""


def deliveries(d) -> str:
    """Signed catalog events of all payload shapes, some late, unsigned or forged."""
    us = d.micros("ts")
    user = "CAST(user_id AS STRING)"
    group = "CAST(user_id % 3 AS STRING)"
    base = f"""
      SELECT event_id, event_type, user_id, value, {us} AS received_us,
        CASE WHEN value < 1 THEN NULL WHEN value > 200 THEN {us} - 400000000
             ELSE {us} - 1000000 * (user_id % 290) END AS sent_us,
        CASE event_type
          WHEN 'click' THEN '{{"eventId":"click-' || {group} || '","entityType":"table",'
            || '"entityFullyQualifiedName":"dw.sales.public.orders_' || {user} || '"}}'
          WHEN 'view' THEN '{{"id":' || CAST(event_id AS STRING) || ',"entityType":"Table",'
            || '"entityFullyQualifiedName":"sales.t_' || {user} || '"}}'
          WHEN 'signup' THEN '{{"assetName":"asset_' || {user} || '","domainName":'
            || CASE WHEN value > 50 THEN 'null' ELSE '"crm"' END || '}}'
          WHEN 'purchase' THEN '[{{"id":"p-' || {group} || '","eventType":"x","data":'
            || '{{"qualifiedName":"fin/a/acc_' || {user} || '"}}}},{{"id":"q","eventType":"y",'
            || '"data":{{"qualifiedName":"fin/acc"}}}}]'
          ELSE CASE WHEN value > 50 THEN 'not json {{' ELSE
            '{{"changeEventId":"c-' || {group} || '","entityType":"dashboard"}}' END
        END AS payload
      FROM {d.table("events")}"""
    seconds = d.idiv("sent_us", "1000000")
    digest = d.hmac(f"CAST({seconds} AS STRING) || '.' || payload", CATALOG_SECRET)
    return f"""
      SELECT event_id, event_type, received_us, sent_us, payload,
        CASE WHEN value > 150 THEN '' WHEN value BETWEEN 5 AND 8 THEN upper({d.sha256("payload")})
             WHEN event_type = 'view' THEN {d.base64(digest)}
             WHEN event_type = 'click' THEN 'sha256=' || {digest}
             ELSE upper({digest}) END AS signature
      FROM ({base}) b"""


def ticket_deliveries(d) -> str:
    """Status changes of order requests from three ticket systems, one per line item group."""
    key = "CAST(l_orderkey AS STRING)"
    instance = "'inst-' || lower(substr(o_orderpriority, 3, 1))"
    base = f"""
      SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_shipmicros) AS received_us,
        max(l_discount) AS discount, max(l_tax) AS tax, max(o_orderpriority) AS o_orderpriority
      FROM (SELECT l_orderkey, l_linenumber, {d.micros("l_shipdate")} AS l_shipmicros, l_discount,
              l_tax, o_orderpriority
            FROM {d.table("lineitem")} JOIN {d.table("orders")} ON o_orderkey = l_orderkey) x
      GROUP BY l_orderkey, l_linenumber"""
    shaped = f"""
      SELECT l_orderkey * 10 + l_linenumber AS delivery_id, received_us, tax, discount,
        received_us - CASE WHEN discount >= 0.1 THEN 301000000 ELSE 1000000 END AS sent_us,
        {instance} AS instance,
        CASE WHEN l_linenumber <= 2 THEN '{{"ticketId":"CHG' || {key} || '","instanceId":"'
            || {instance} || '","action":"'
            || CASE WHEN discount > 0.05 THEN 'approve' WHEN tax > 0.06 THEN 'escalate'
                    ELSE 'REJECT' END
            || '","reason":"by ' || CAST(n AS STRING) || '","eventId":"ev' || {key}
            || '","approver":" boss ' || CAST(l_linenumber AS STRING) || '"}}'
          WHEN l_linenumber <= 4 THEN '{{"number":"CHG' || {key} || '","instance_name":"'
            || {instance} || '",' || CASE WHEN tax > 0.04 THEN '"approval":"approved"'
              WHEN tax > 0.02 THEN '"state":4' ELSE '"state":"approved"' END
            || ',"work_notes":"note","sys_updated_by":"sn' || CAST(l_linenumber AS STRING) || '"}}'
          WHEN l_linenumber <= 6 THEN '{{"issue":{{"key":"CHG' || {key}
            || '","fields":{{"status":{{"name":"' || CASE WHEN tax > 0.04 THEN 'Authorized'
              ELSE 'Done' END || '"}},"resolution":' || CASE WHEN discount > 0.05
              THEN '{{"name":"Won''t do"}}' ELSE 'null' END || '}}}},"baseUrl":"' || {instance}
            || '","user":{{"displayName":"Ann","accountId":"jira-' || {key} || '"}}}}'
          ELSE '{{"instanceId":"' || {instance} || '"}}' END AS payload
      FROM ({base}) b"""
    header = "'T' || CAST(sent_us AS STRING)"
    digest = d.hmac(f"'t=' || {header} || '.v1=' || payload", TICKET_SECRET + "x")
    return f"""
      SELECT delivery_id, received_us, sent_us, payload, {header} AS raw_timestamp,
        CASE WHEN tax = 0.01 THEN 'inst-other' WHEN tax = 0.02 THEN '' ELSE instance END AS instance,
        CASE WHEN tax = 0.03 AND discount < 0.02 THEN {d.sha256("payload")}
             ELSE 'SHA256=' || upper({digest}) END AS signature
      FROM ({shaped}) s"""


def change_envelopes(d) -> str:
    """Change messages of user accounts, wrapped or not, some without source or tenant."""
    us = d.micros("ts")
    body = f"""'{{"op":"' || CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd'
          WHEN 'view' THEN 'r' WHEN 'click' THEN 'x' ELSE 'u' END || '","before":'
        || CASE WHEN event_type = 'error' THEN '{{"user_id":' || CAST(user_id AS STRING)
             || ',"tenant_id":"old"}}' ELSE 'null' END
        || ',"after":' || CASE WHEN event_type = 'error' THEN 'null' ELSE '{{"user_id":'
             || CAST(user_id AS STRING) || ',"last_type":"' || event_type || '","hits":'
             || CAST(event_id AS STRING) || CASE WHEN value > 40 THEN ',"tenant_id":"t'
             || CAST(user_id % 7 AS STRING) || '"' ELSE '' END || ',"extra":' || props || '}}' END
        || CASE WHEN value < 2 THEN '' ELSE ',"source":{{"name":"crm","schema":"app","table":"users_'
             || CAST(user_id % 5 AS STRING) || '","ts_ms":'
             || CAST({d.idiv(us, "1000")} AS STRING) || '}}' END || '}}'"""
    return f"""
      SELECT event_id, user_id, {us} AS received_us,
        CASE WHEN value > 300 THEN 'broken {{' WHEN event_type = 'purchase' THEN {body}
             ELSE '{{"schema":{{"type":"struct"}},"payload":' || {body} || '}}' END AS message
      FROM {d.table("events")}"""


def account_changes(d) -> str:
    """Version-ordered changes of customer accounts; several share a version."""
    return f"""
      SELECT event_id, {d.idiv(d.micros("ts"), "3600000000")} - 473352 AS version,
        CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'view' THEN 'x'
             ELSE 'U' END AS op,
        user_id AS c_custkey, value
      FROM {d.table("events")}"""


def manifest_nodes(d) -> str:
    """dbt manifest documents, one per part brand and type, holding a model per part."""
    return f"""
      SELECT c.p_partkey, c.service, c.schema_name, c.table_name, c.p_brand, c.p_type, c.p_size,
        CASE WHEN c.p_size > 45 THEN 'macro.' WHEN c.p_size > 35 THEN 'seed.' ELSE 'Model.' END
          || 'shop.' || CAST(c.p_partkey AS STRING) AS unique_id,
        c.p_size <= 25 AS enforced,
        CASE WHEN c.p_type = 'PROMO' THEN 'team-' || lower(c.p_brand) END AS owner,
        CASE WHEN c.p_type = 'SMALL' THEN 'region = ''EU''' END AS model_filter,
        CASE WHEN c.p_type = 'LARGE' THEN 'analyst,auditor' END AS roles
      FROM ({catalog_tables(d)}) c"""
