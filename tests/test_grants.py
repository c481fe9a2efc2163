from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.grants import (
    GRANT_KEY,
    GrantConfig,
    auto_grantable,
    effective_rules,
    reconcile_grants,
    resolve_policy_refs,
    rule_rows,
    rule_tables,
)
from lakewarden.operators.identity import IdentityConfig
from lakewarden.operators.principals import mapping_rows
from lakewarden.operators.tagging import TagConfig
from lakewarden.plans.sync import sync_policies
from lakewarden.sources.catalog_pages import pull_problems

NOW = datetime(2026, 3, 1, 12)
RULE = "struct<name:string,effect:string,condition:string,resources:array<string>,operations:array<string>>"
POLICY = f"id string, name string, enabled boolean, rules array<{RULE}>"
REFS = "array<struct<id:string,name:string>>"
HELD = (
    "id int, marker string, tenant_id string, domain string, schema_name string, table_name string, "
    "grantee_type string, grantee string, effect string, valid_to timestamp"
)


def rule(effect="allow", resources=("orders",), operations=("ViewAll",), condition=""):
    return ("r", effect, condition, list(resources), list(operations))


def test_rule_effects(spark, rows):
    policies = spark.createDataFrame(
        [
            ("1", "a", True, [rule(), rule("Deny", ["X"], ["all"]), rule("allow", ["y"], ["All"])]),
            ("2", "b", False, [rule()]),
            ("3", "c", True, [rule(condition="isOwner()"), rule("audit"), rule(operations=["EditTags"])]),
            ("1", "z", True, [rule(resources=["ignored"])]),
        ],
        POLICY,
    )
    assert rows(effective_rules(rule_rows(policies))) == [("1", "Allow", "orders"), ("1", "Deny", "x")]


def test_rules_meet_tables(spark, rows):
    tables = spark.createDataFrame(
        [("t", "d", "s", f"orders{i}" if i else "Orders") for i in range(40)],
        "tenant_id string, domain string, schema_name string, table_name string",
    )
    rules = spark.createDataFrame(
        [("n", "Allow", "orders"), ("q", "Allow", "s.orders1"), ("f", "Deny", "d.s.orders2"), ("w", "Deny", "table"), ("a", "Allow", "all")],
        "policy_id string, effect string, resource string",
    )
    got = rule_tables(rules, tables, salts=4).groupBy("policy_id").count()
    assert rows(got) == [("f", 1), ("n", 1), ("q", 1), ("w", 40)]


def test_policy_references(spark, rows):
    policies = spark.createDataFrame(
        [("1", "A", True, []), ("2", "Dup", True, []), ("3", "dup", True, [])], POLICY
    )
    refs = spark.createDataFrame(
        [("by id", "1", None), ("by name", None, "a"), ("ambiguous", None, "DUP"), ("id first", "2", "a"), ("gone", "9", "a")],
        "who string, ref_id string, ref_name string",
    )
    assert rows(resolve_policy_refs(refs, policies)) == [("by id", "1"), ("by name", "1"), ("gone", "1"), ("id first", "2")]


def complete(spark):
    return spark.createDataFrame([("users", 1, 3, None)], "pull_id string, pages int, items int, problem string")


def world(spark, role_rules, held=(), problems=None, auto=True, columns=(), tags=(), **options):
    tables = spark.createDataFrame(
        [("e1", "sales_svc.salesdb.dbo.orders", "orders", None, None, None, None, list(tags))],
        "entity_id string, fqn string, name string, service string, service_fqn string, database string, db_schema string, tags array<string>",
    )
    cols = spark.createDataFrame(
        [("e1", n, t) for n, t in columns], "entity_id string, column_name string, tags array<string>"
    )
    entities = {
        "tables": tables,
        "columns": cols,
        "policies": spark.createDataFrame([("p1", "OrderPolicy", True, role_rules)], POLICY),
        "roles": spark.createDataFrame([("r1", "OrderReader", [("p1", None)])], f"id string, name string, policies {REFS}"),
        "teams": spark.createDataFrame([("t1", "org.x", "x", [(None, "orderpolicy")])], f"id string, fqn string, name string, policies {REFS}"),
        "users": spark.createDataFrame([("u1", "A@x.y", [(None, "orderreader")])], f"id string, email string, roles {REFS}"),
    }
    return sync_policies(
        entities,
        spark.createDataFrame(list(held), HELD),
        spark.createDataFrame([], "domain string, schema_name string, table_name string, sensitivity string, requires_four_eyes boolean, is_active boolean"),
        IdentityConfig(default_tenant="main"),
        TagConfig(pii_tags=("pii",), art9_tags=("art9",)),
        GrantConfig(auto_create=auto, interval_minutes=30),
        {"orderreader": "OrderReaderRole"},
        mapping_rows(spark, {"fqn:org.x": "S-group"}, ("id", "fqn", "name")),
        mapping_rows(spark, {"a@X.y": "S-user"}, ("id", "email")),
        NOW,
        complete(spark) if problems is None else problems,
        **options,
    )


def key(grantee, effect="Allow", kind="Role", tenant="main"):
    return (tenant, "sales_svc", "dbo", "orders", kind, grantee, effect)


def actions(result):
    return sorted((r.action, r.grantee_type, r.grantee, r.id or 0) for r in result.actions.collect())


def test_grants_are_created_for_roles_groups_and_users(spark):
    result = world(spark, [rule()])
    assert actions(result) == [
        ("create", "Group", "S-GROUP", 0),
        ("create", "Role", "ORDERREADERROLE", 0),
        ("create", "User", "S-USER", 0),
    ]
    made = result.actions.first()
    assert made.valid_from == NOW - timedelta(minutes=5) and made.valid_to == NOW + timedelta(minutes=60)
    assert result.affected.count() == 1 and result.success


def test_reconcile_keeps_extends_and_revokes(spark):
    soon, far = NOW + timedelta(minutes=10), NOW + timedelta(days=200)
    held = [
        (1, "policy-sync", *key("orderreaderrole"), soon),
        (2, "policy-sync", *key("OrderReaderRole"), soon),
        (3, "policy-sync", *key("OrderReader"), soon),
        (4, "manual", *key("OrderReader"), soon),
        (5, "policy-sync", *key("S-GONE", kind="User"), soon),
        (6, "policy-sync", *key("S-user", kind="User", tenant="foreign"), soon),
        (7, "policy-sync", *key("S-user", kind="User"), NOW - timedelta(minutes=1)),
    ]
    result = world(spark, [rule()], held)
    assert actions(result) == [
        ("create", "Group", "S-GROUP", 0),
        ("create", "User", "S-USER", 0),
        ("extend", "Role", "ORDERREADERROLE", 1),
        ("revoke", "Role", "ORDERREADER", 3),
        ("revoke", "Role", "ORDERREADERROLE", 2),
        ("revoke", "User", "S-GONE", 5),
    ]
    denies = [
        (1, "policy-sync", *key("ORDERREADERROLE", "Deny"), far),
        (2, "policy-sync", *key("S-GROUP", "Deny", "Group"), NOW + timedelta(days=29)),
    ]
    result = world(spark, [rule("deny")], denies, auto=False)
    assert actions(result) == [
        ("create", "User", "S-USER", 0),
        ("extend", "Group", "S-GROUP", 2),
        ("keep", "Role", "ORDERREADERROLE", 1),
    ]
    by_id = {r.id: r.valid_to for r in result.actions.collect()}
    assert by_id[1] == far and by_id[2] == NOW + timedelta(days=365)


def test_reconcile_is_idempotent(spark, rows):
    first = world(spark, [rule(), rule("deny")])
    stored = first.actions.where("action = 'create'").withColumn(
        "id", F.row_number().over(__import__("pyspark").sql.Window.orderBy(*GRANT_KEY))
    )
    held = [
        (r.id, "policy-sync", *[r[c] for c in GRANT_KEY], r.valid_to) for r in stored.collect()
    ]
    again = world(spark, [rule(), rule("deny")], held)
    assert {a for a, *_ in actions(again)} == {"extend", "keep"}
    assert len(actions(again)) == 6


def test_automatic_grants_can_be_switched_off(spark):
    held = [(1, "policy-sync", *key("ORDERREADERROLE"), NOW + timedelta(minutes=5))]
    assert actions(world(spark, [rule()], held, auto=False)) == [("revoke", "Role", "ORDERREADERROLE", 1)]


@pytest.mark.parametrize(
    "protection", [{"columns": [("c", ["PII"])]}, {"tags": ["FourEyes"]}]
)
def test_protected_tables_are_never_granted_automatically(spark, protection):
    assert actions(world(spark, [rule()], **protection)) == []
    assert len(actions(world(spark, [rule("deny")], **protection))) == 3


def test_auto_grantable_levels(spark, rows):
    levels = ["NORMAL", "low", " Public", "INTERNAL", "HIGH", "RESTRICTED", "CUSTOM", None, ""]
    tables = spark.createDataFrame(
        [("d", "s", f"{i}", level, False) for i, level in enumerate(levels)],
        "domain string, schema_name string, table_name string, sensitivity string, requires_four_eyes boolean",
    )
    none = spark.createDataFrame(
        [("d", "s", "0", False, None), ("d", "s", "1", True, None)],
        "domain string, schema_name string, table_name string, is_sensitive boolean, rule_type string",
    )
    got = [r.table_name for r in auto_grantable(tables, none).collect()]
    assert sorted(got) == ["0", "2", "3", "7", "8"]


def test_failed_read_changes_no_grant(spark):
    pull = spark.createDataFrame([("users", 0, "a", 250)], "pull_id string, page_no int, cursor string, items int")
    written = []
    held = [(1, "policy-sync", *key("ORDERREADERROLE"), NOW + timedelta(minutes=5))]
    result = world(
        spark, [rule()], held, problems=pull_problems(pull, 250), write=lambda n, df: written.append(n)
    )
    assert not result.success and result.actions is None and written == ["tables", "columns"]
    dry = []
    world(spark, [rule()], write=lambda n, df: dry.append(n), dry_run=True)
    assert dry == []


def test_every_tenant_gets_its_own_deny(spark, rows):
    tables = spark.createDataFrame(
        [("A", "d1", "s", "t"), ("B", "d2", "s", "t")], "tenant_id string, domain string, schema_name string, table_name string"
    )
    rules = spark.createDataFrame([("p", "Deny", "t")], "policy_id string, effect string, resource string")
    from lakewarden.operators.grants import desired_grants

    grantees = spark.createDataFrame([("Role", "x", "p")], "grantee_type string, grantee string, policy_id string")
    desired = desired_grants(grantees, rule_tables(rules, tables))
    held = spark.createDataFrame([(1, "policy-sync", "C", "d", "s", "t", "Role", "X", "Deny", NOW + timedelta(days=1))], HELD)
    got = reconcile_grants(desired, held, tables, GrantConfig(), NOW)
    assert rows(got, "action", "tenant_id") == [("create", "A"), ("create", "B")]


def test_unknown_read_changes_no_grant_and_epochs_rise(spark, rows):
    nothing = complete(spark).limit(0)
    assert not world(spark, [rule()], problems=nothing).success
    epochs = spark.createDataFrame([("sales_svc", "dbo", "orders", 4), ("d", "s", "other", 1)], "domain string, schema_name string, table_name string, epoch bigint")
    written = {}
    result = world(spark, [rule()], epochs=epochs, write=lambda n, df: written.update({n: df}))
    assert result.success and list(written)[-1] == "epochs"
    assert rows(written["epochs"]) == [("d", "s", "other", 1), ("sales_svc", "dbo", "orders", 5)]


@pytest.mark.parametrize("seed", range(3))
def test_classes_plan_the_same_actions(spark, rows, seed):
    from lakewarden.operators.grants import desired_grants, effective_grants, grant_classes, reconcile_classes

    r = random.Random(seed)
    policies, effects = [f"p{i}" for i in range(6)], ["Allow", "Deny"]
    rules = {(r.choice(policies), r.choice(effects), r.choice(["table", "d.s.t1", "d.s.t2", "t3", "s.t4", "d.s.t5"])) for _ in range(r.randint(0, 9))}
    grantees = {(r.choice(["Role", "User"]), r.choice(["ann", "Ann", "bob", "eve", "dan"]), r.choice(policies)) for _ in range(r.randint(0, 14))}
    tables = [(f"tenant{i % 2}", "d", "s", f"t{i}") for i in range(7)]
    held = [
        (f"h{i}", "policy-sync" if r.random() < 0.9 else "manual", f"tenant{r.randint(0, 2)}", "d", "s", f"t{r.randint(0, 7)}", r.choice(["Role", "User"]), r.choice(["ANN", "bob", "eve"]), r.choice(effects), NOW + timedelta(days=r.choice([-1, 5, 200])))
        for i in range(r.randint(0, 60))
    ]
    rule_rows = spark.createDataFrame(sorted(rules), "policy_id string, effect string, resource string")
    grantee_rows = spark.createDataFrame(sorted(grantees), "grantee_type string, grantee string, policy_id string")
    table_rows = spark.createDataFrame(tables, "tenant_id string, domain string, schema_name string, table_name string")
    held_rows = spark.createDataFrame(held, "id string, marker string, tenant_id string, domain string, schema_name string, table_name string, grantee_type string, grantee string, effect string, valid_to timestamp")
    grantable = table_rows.where("table_name in ('t1', 't3', 't4')").select("domain", "schema_name", "table_name")
    config = GrantConfig(auto_create=seed % 3 > 0)
    desired = desired_grants(grantee_rows, rule_tables(rule_rows, table_rows))
    want = reconcile_grants(effective_grants(desired, grantable, config), held_rows, table_rows, config, NOW)
    classes = grant_classes(grantee_rows, rule_rows, table_rows, grantable, config)
    got = reconcile_classes(classes, held_rows, table_rows, config, NOW)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_held_grants_are_read_once(spark, rows, tmp_path):
    """Finding the further copies takes the held grants as stored, not as they are made, once more."""
    from lakewarden.operators.grants import grant_classes, reconcile_classes

    table_rows = spark.createDataFrame([("t", "d", "s", "a")], "tenant_id string, domain string, schema_name string, table_name string")
    rule_rows = spark.createDataFrame([("p", "Deny", "a")], "policy_id string, effect string, resource string")
    grantee_rows = spark.createDataFrame([("Role", "ann", "p")], "grantee_type string, grantee string, policy_id string")
    held = [(i, "policy-sync", "t", "d", "s", "a", "Role", "Ann", "Deny", NOW + timedelta(days=200)) for i in range(3)]
    spark.createDataFrame(held, HELD).write.parquet(str(tmp_path / "held"))
    held_rows = spark.read.parquet(str(tmp_path / "held"))
    classes = grant_classes(grantee_rows, rule_rows, table_rows, table_rows.select("domain", "schema_name", "table_name"), GrantConfig())
    got = reconcile_classes(classes, held_rows, table_rows, GrantConfig(), NOW)
    assert not [f for f in got.inputFiles() if str(tmp_path) in f]
    assert rows(got, "action", "id") == [("keep", 0), ("revoke", 1), ("revoke", 2)]
