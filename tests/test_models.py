from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from lakewarden.operators import export
from lakewarden.operators.export import EntityConfig
from lakewarden.operators.lineage import child_lists, downstream_impact
from lakewarden.operators.proposals import approved_filters, approved_masks, pending_proposals, review, sync_descriptions
from lakewarden.plans.sync import check_contract, ingest_dbt

NOW = datetime(2026, 3, 1)
PENDING = "table_id string, column_name string, rule_type string, status string"


def manifest(**more):
    customers = {
        "name": "raw_clients",
        "database": "postgres",
        "schema": "raw",
        "description": "All customers",
        "config": {"materialized": "view"},
        "contract": {"enforced": True},
        "tags": ["x", " "],
        "meta": {"Owner": "crm", "n": 1},
        "columns": {
            "customer_id": {"name": "customer_id", "data_type": "integer"},
            "email_address": {"data_type": "varchar", "tags": ["pii"], "meta": {"pii": True}, "description": "mail"},
            "tax_id": {"data_type": "varchar", "tags": ["ssn"]},
            "ref": {"data_type": "text", "tags": ["pseudonym_key"]},
            "tagged": {"tags": ["pii"]},
            "region": {"meta": {"rls_filter": "region = 'EU'", "PII": "1"}},
        },
        **more,
    }
    orders = {
        "name": "mart_sales",
        "database": "postgres",
        "schema": "analytics",
        "meta": {"casbin_roles": "analyst", "rls_filter": "x = 1"},
        "depends_on": {"nodes": ["MODEL.shop.raw_clients", "source.other", ""]},
    }
    return {"nodes": {"model.shop.raw_clients": customers, "Seed.shop.mart_sales": orders, "macro.shop.m": {"name": "m"}}}


def documents(spark, *manifests):
    return spark.createDataFrame([(json.dumps(m),) for m in manifests], "document string")


def ingest(spark, pending=(), **options):
    return ingest_dbt(documents(spark, manifest()), spark.createDataFrame(list(pending), PENDING), NOW, **options)


def test_ingest(spark, rows):
    got = ingest(spark)
    assert rows(got.models, "table_id", "materialization", "contract_enforced", "tags") == [
        ("postgres.analytics.mart_sales", "table", False, []),
        ("postgres.raw.raw_clients", "view", True, ["x"]),
    ]
    assert rows(got.proposals, "column_name", "rule_type", "source_tag", "owner") == sorted([
        ("*", "CASBIN_ROLES:analyst", "meta.casbin_roles", None),
        ("*", "RLS_FILTER:x = 1", "meta.rls_filter", None),
        ("email_address", "MASK_EMAIL", "pii", "crm"),
        ("ref", "HMAC_SHA256", "pseudonym_key", "crm"),
        ("region", "REDACT", "meta.pii=true", "crm"),
        ("region", "RLS_FILTER:region = 'EU'", "meta.rls_filter", "crm"),
        ("tax_id", "REDACT", "ssn", "crm"),
    ], key=repr)
    assert rows(got.edges) == [("postgres.raw.raw_clients", "postgres.analytics.mart_sales")]
    assert rows(got.nodes, "name", "downstream", "owner_team") == [("mart_sales", 0, None), ("raw_clients", 1, "crm")]
    assert rows(child_lists(got.edges), "parent", "children") == [
        ("postgres.raw.raw_clients", ["postgres.analytics.mart_sales"])
    ]
    wide = spark.range(100).selectExpr("'p' AS parent", "CAST(id AS STRING) AS child")
    spread = child_lists(wide, per_row=10)
    assert spread.count() > 5 and spread.select(F.explode("children")).distinct().count() == 100
    assert got.summary.first().asDict() == {"models": 2, "proposals": 7, "lineage_nodes": 2}


def test_pending_proposals_are_not_repeated(spark, rows):
    waiting = [
        ("POSTGRES.raw.raw_clients", "EMAIL_address", "REDACT", "PendingReview"),
        ("postgres.raw.raw_clients", "region", "REDACT", "PendingReview"),
        ("postgres.raw.raw_clients", "tax_id", "REDACT", "Rejected"),
        ("postgres.analytics.mart_sales", "*", "CASBIN_ROLES:old", "PendingReview"),
    ]
    names = {(r.column_name, r.rule_type[:4]) for r in ingest(spark, waiting).proposals.collect()}
    assert names == {("*", "RLS_"), ("ref", "HMAC"), ("region", "RLS_"), ("tax_id", "REDA")}
    written = []
    dry = ingest(spark, waiting, write=lambda n, d: written.append(n), dry_run=True)
    assert dry.proposals.count() == 7 and written == []


def test_review(spark, rows):
    proposals = ingest(spark).proposals.select("id", "table_id", "column_name", "rule_type", "status")
    ids = {(r.column_name, r.rule_type[:3]): r.id for r in proposals.collect()}
    decisions = spark.createDataFrame(
        [
            (ids["tax_id", "RED"], "approve", "ann", 1),
            (ids["tax_id", "RED"], "reject", "bob", 2),
            (ids["region", "RLS"], "Approve", "ann", 1),
            (ids["ref", "HMA"], "reject", "ann", 1),
            (ids["email_address", "MAS"], "approve", " ", 1),
            ("nothing", "approve", "ann", 1),
        ],
        "id string, decision string, reviewed_by string, decided_at bigint",
    )
    updated, refused = review(proposals, decisions)
    assert {r.status for r in updated.where("changed").collect()} == {"Approved", "Rejected"}
    assert rows(refused, "decision", "reason") == [
        ("approve", "INVALID_DECISION"),
        ("approve", "UNKNOWN_PROPOSAL"),
        ("reject", "NOT_PENDING"),
    ]
    assert rows(approved_masks(updated), "column_name", "rule_type", "replacement") == [("tax_id", "REDACT", "[REDACTED]")]
    assert rows(approved_filters(updated), "column_name", "kind", "value") == [("region", "rls", "region = 'EU'")]
    settled = updated.select(*proposals.columns)
    _, again = review(settled, decisions.where("decision = 'reject'"))
    assert {r.reason for r in again.collect()} == {"NOT_PENDING"}
    assert pending_proposals(settled, "POSTGRES.raw.raw_clients").count() == 2


def test_descriptions(spark, rows):
    got = ingest(spark)
    tables = spark.createDataFrame(
        [("postgres.raw.RAW_clients", "old", None), ("a.b.c", "kept", "long")],
        "table_id string, description string, long_description string",
    )
    columns = spark.createDataFrame(
        [("postgres.raw.raw_clients", "Email_Address", "old", None), ("postgres.raw.raw_clients", "tax_id", "old", None)],
        "table_id string, column_name string, description string, long_description string",
    )
    t, c = sync_descriptions(tables, columns, got.models, got.columns)
    assert rows(t, "description") == [("All customers",), ("kept",)]
    assert rows(c, "column_name", "description") == [("Email_Address", "mail"), ("tax_id", "old")]


def contract(spark, active, **more):
    columns = [("postgres.raw.raw_clients", n, t) for n, t in active]
    active_columns = spark.createDataFrame(columns, "table_id string, column_name string, data_type string")
    return check_contract(documents(spark, manifest(**more)), active_columns.select("table_id"), active_columns)


def test_contract(spark, rows):
    same = [("CUSTOMER_ID", "INT"), ("email_address", "text"), ("tax_id", " ")]
    changes, report = contract(spark, same)
    assert changes.count() == 0 and report.first().compatible
    changes, report = contract(spark, [*same, ("phone_number", "varchar"), ("ref", "bigint")])
    assert rows(changes) == [
        ("postgres.raw.raw_clients", "phone_number", "DROPPED_COLUMN", "varchar", None),
        ("postgres.raw.raw_clients", "ref", "DATA_TYPE_MISMATCH", "bigint", "text"),
    ]
    assert report.first().asDict() == {"validated_models": 1, "breaking_changes": 2, "new_models": 0, "compatible": False}
    changes, report = contract(spark, [("gone", "int")], contract={"enforced": False})
    assert changes.count() == 0 and report.first().validated_models == 0
    changes, report = contract(spark, [])
    assert report.first().new_models == 1 and report.first().compatible


def test_downstream_impact(spark, rows):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("x", "y")], "parent string, child string"
    )
    roots = spark.createDataFrame([("a",), ("x",), ("leaf",)], "root string")
    assert rows(downstream_impact(edges, roots)) == [("a", "b", 1), ("a", "c", 1), ("x", "y", 1)]
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(12)], "parent string, child string")
    got = downstream_impact(chain, spark.createDataFrame([("0",)], "root string"))
    assert got.count() == 12 and got.agg(F.max("depth")).first()[0] == 12


CONFIG = EntityConfig(namespace="ns", owner="group:o", system="sys")
TABLE = (
    "domain string, schema_name string, table_name string, display_name string, description string, long_description string, "
    "source_type string, documentation_source string, sensitivity string, requires_four_eyes boolean, is_active boolean"
)
SUNSET = "position int, rule_id string, target string, deprecated_at timestamp, sunset_at timestamp, replacement string"


def test_entities(spark, rows):
    tables = spark.createDataFrame(
        [
            ("d", "Sales", "Orders", "", None, "long", "Table", " ", "HIGH", False, True),
            ("d", "x" * 70, "!", "Nice", "text", None, "SQL Server", "Wiki", None, True, False),
        ],
        TABLE,
    )
    rules = spark.createDataFrame(
        [
            (2, "late", "orders", NOW, datetime(2020, 1, 1), None),
            (1, "first", "sales.ORDERS", NOW, datetime(2030, 1, 1), "new_orders"),
        ],
        SUNSET,
    )
    got = {r.table: r for r in export.table_entities(tables, rules, CONFIG, NOW).withColumn("table", F.col("title")).collect()}
    orders = got["Sales.Orders"]
    assert orders.name == "data-sales-orders" and orders.lifecycle == "production" and orders.description == "long"
    assert orders.tags == ["data-product", "table", "four-eyes-required", "pii", "sensitivity-high"]
    assert orders.annotations["lakewarden.io/sunsetting-rule-id"] == "first"
    assert orders.annotations["lakewarden.io/sunsetting-replacement"] == "new_orders"
    other = got["Nice"]
    assert len(other.name) <= 63 and other.lifecycle == "deprecated" and "wiki" in other.tags
    entities = export.table_entities(tables, rules.limit(0), CONFIG, NOW)
    assert export.filter_entities(entities, name="Data Sales-Orders").count() == 1
    assert export.filter_entities(entities, kind="component").count() == 0
    document = json.loads(export.entity_documents(entities).where("name = 'data-sales-orders'").first().document)
    assert document["metadata"]["namespace"] == "ns" and document["spec"]["owner"] == "group:o"


def test_subgraphs(spark):
    schemas = spark.createDataFrame(
        [("Svc A", "1", datetime(2026, 1, 1), "ann", True, "old"), ("Svc A", "2", datetime(2026, 2, 1), " ", False, "new")],
        "service string, version string, registered_at timestamp, registered_by string, is_active boolean, sdl string",
    )
    (entity,) = export.subgraph_entities(schemas, CONFIG).collect()
    assert (entity.name, entity.lifecycle, entity.owner, entity.definition) == ("subgraph-svc-a", "deprecated", "group:o", "new")


def test_lineage_event(spark):
    nodes = ingest(spark).nodes
    events = export.lineage_events(export.lineage_datasets(nodes, "t"), "t", "job", "https://example.org", NOW)
    (event,) = [json.loads(r.event) for r in events.collect()]
    assert [i["name"] for i in event["inputs"]] == ["postgres.raw.raw_clients"]
    assert [o["name"] for o in event["outputs"]] == ["postgres.analytics.mart_sales"]
    assert event["eventType"] == "COMPLETE" and json.loads(event["inputs"][0]["facets"])["type"] == "Table"
    many = spark.range(100).select(
        F.lit("input").alias("role"), F.lit("n").alias("namespace"), F.col("id").cast("string").alias("name"), F.lit("{}").alias("facets")
    )
    split = [json.loads(r.event) for r in export.lineage_events(many, "n", "j", "p", NOW, per_event=20).collect()]
    assert len(split) > 1 and sum(len(e["inputs"]) for e in split) == 100


def test_schema_rows(spark, rows):
    ident = "domain string, schema_name string, table_name string"
    tables = spark.createDataFrame([("sales", "dbo", "invoices"), ("sales", "dbo", "empty"), ("sales", "dbo", "keyless")], ident)
    columns = spark.createDataFrame(
        [
            ("sales", "dbo", "invoices", "Id", "integer", "key"),
            ("sales", "dbo", "invoices", "customer", "varchar", " "),
            ("sales", "dbo", "invoices", "amount", "decimal", None),
            ("sales", "dbo", "invoices", "issued_on", "date", None),
            ("sales", "dbo", "invoices", "created_at", "timestamp", None),
            ("sales", "dbo", "keyless", "ID", "bigint", None),
        ],
        ident + ", column_name string, data_type string, description string",
    )
    keys = spark.createDataFrame([("sales", "dbo", "invoices", "id")], ident + ", column_name string")
    got = export.schema_rows(tables, columns, keys)
    assert rows(got, "entity", "property", "edm_type", "nullable") == [
        ("sales_dbo_empty", "id", "Edm.Int32", False),
        ("sales_dbo_invoices", "Id", "Edm.Int32", False),
        ("sales_dbo_invoices", "amount", "Edm.Decimal", True),
        ("sales_dbo_invoices", "created_at", "Edm.DateTimeOffset", True),
        ("sales_dbo_invoices", "customer", "Edm.String", True),
        ("sales_dbo_invoices", "issued_on", "Edm.Date", True),
        ("sales_dbo_keyless", "ID", "Edm.Int64", False),
    ]
    assert ("sales_dbo_empty", "EntitySet", "sales/dbo/empty") in rows(export.service_document(tables))


def test_tickets(spark):
    requests = spark.createDataFrame(
        [(1, "t", "S-1", "a.b.c", 7, 'say "hi"', None, None, NOW), (2, "t", "S-1", "a.b.c", 7, "x", "LegitimateAudit", 0.98, NOW)],
        "request_id int, tenant_id string, requester string, target_table string, days int, justification string, category string, confidence double, requested_at timestamp",
    )
    record = {r.request_id: json.loads(r.body) for r in export.servicenow_tickets(requests, "Access", "REQ").collect()}
    assert record[1]["short_description"] == "[Access] a.b.c" and record[1]["urgency"] == "2"
    assert record[1]["description"].endswith("Triage Category: Standard\nTriage Confidence: N/A")
    assert "98%" in record[2]["description"] and 'say "hi"' in record[1]["description"]
    assert record[1]["correlation_id"].startswith("REQ-t-S-1-")
    issue = json.loads(export.jira_tickets(requests, "Access").where("request_id = 1").first().body)["fields"]
    assert issue["project"] == {"key": "SEC"} and issue["issuetype"] == {"name": "Task"}
    assert issue["description"]["content"][0]["content"][0]["text"].startswith("Requester SID: S-1\nTenant: t")
    responses = spark.createDataFrame(
        [
            (1, "ServiceNow", 201, '{"result":{"sys_id":"s","number":"CHG1"}}'),
            (2, "ServiceNow", 201, "{}"),
            (3, "Jira", 201, '{"id":"9"}'),
            (4, "Jira", 500, "boom"),
        ],
        "request_id int, system string, http_status int, body string",
    )
    got = {r.request_id: (r.ticket_id, r.ticket_url, r.error_code) for r in export.ticket_references(responses, "https://i/").collect()}
    assert got == {
        1: ("CHG1", "https://i/nav_to.do?uri=change_request.do?sys_id=s", None),
        2: (None, None, "INVALID_RESPONSE"),
        3: ("9", "https://i/browse/9", None),
        4: (None, None, "ITSM_UNAVAILABLE"),
    }


def test_exposures(spark):
    tables = spark.createDataFrame([("d", "S", "T")], "domain string, schema_name string, table_name string")
    usage = tables.selectExpr("*", "5L AS monthly_queries", "1.5D AS p99_latency_ms", "array('bi') AS top_consumers", "'gold' AS governance_tier")
    plain = json.loads(export.exposures(tables).first().exposure)
    assert plain["name"] == "governed_s_t" and plain["depends_on"] == ["ref('T')"] and "meta" not in plain
    assert json.loads(export.exposures(tables, usage).first().exposure)["meta"]["monthly_queries"] == 5
