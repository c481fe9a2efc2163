from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.catalog_sync import bump_epochs, sensitivity_rank, stricter
from lakewarden.operators.identity import IdentityConfig, reject_collisions, resolve_identity
from lakewarden.operators.principals import mapping_rows, resolve_teams, resolve_users
from lakewarden.operators.tagging import TagConfig, map_columns, map_tables, matches_tag
from lakewarden.plans.sync import sync_catalog
from lakewarden.sources.catalog_pages import (
    alation_assets,
    atlas_assets,
    collibra_assets,
    entity_pages,
    find_asset,
    pull_problems,
    require_complete,
    split_oversized,
)

TAGS = TagConfig(
    art9_tags=("gdpr_art9", "biometric"),
    pii_tags=("PII.Email", "phone"),
    rule_of_tag={"PII.Email": "MASK_EMAIL"},
    hmac_key_id="k1",
)
ASSET = (
    "domain string, schema_name string, table_name string, display_name string, description string, "
    "source_type string, tags array<string>, classifications array<string>"
)
ASSET_COLUMN = (
    "domain string, schema_name string, table_name string, column_name string, data_type string, "
    "description string, tags array<string>"
)
KNOWN = (
    "domain string, schema_name string, table_name string, sensitivity string, "
    "requires_four_eyes boolean, is_active boolean, source_type string"
)
KNOWN_COLUMN = (
    "domain string, schema_name string, table_name string, column_name string, data_type string, "
    "is_sensitive boolean, rule_type string"
)
EPOCH = "domain string, schema_name string, table_name string, epoch bigint"


def sync(spark, assets, columns, known=(), known_columns=(), config=TAGS, **options):
    return sync_catalog(
        spark.createDataFrame(assets, ASSET),
        spark.createDataFrame(columns, ASSET_COLUMN),
        spark.createDataFrame(list(known), KNOWN),
        spark.createDataFrame(list(known_columns), KNOWN_COLUMN),
        spark.createDataFrame([], EPOCH),
        config,
        **options,
    )


HEALTH = ("clinic_lake", "dbo", "visit_files")


def health(spark, **options):
    return sync(
        spark,
        [(*HEALTH, None, None, "Collibra", ["gdpr_art9", "clinical"], [])],
        [
            (*HEALTH, "scan_marks", "text", None, ["biometric"]),
            (*HEALTH, "guest_email", "text", None, ["PII.Email"]),
        ],
        **options,
    )


def test_special_category_table(spark):
    written = {}
    got = health(spark, write=lambda name, df: written.update({name: df.count()}))
    table = got.tables.first()
    assert (table.sensitivity, table.requires_four_eyes, table.is_active) == ("HIGH", True, True)
    assert table.display_name == "visit_files"
    rules = {r.column_name: (r.is_sensitive, r.rule_type) for r in got.columns.collect()}
    assert rules == {"scan_marks": (False, None), "guest_email": (True, "MASK_EMAIL")}
    counters = got.counters.first().asDict()
    assert counters == {
        "synced_tables": 1,
        "art9_tables": 1,
        "retained_tables": 0,
        "synced_columns": 2,
        "masked_columns": 1,
    }
    assert got.epochs.first().epoch == 1 and written == {"tables": 1, "columns": 2, "epochs": 1}


def test_dry_run_counts_but_writes_nothing(spark):
    def fail(name, df):
        raise AssertionError(name)

    got = health(spark, write=fail, dry_run=True)
    assert got.counters.first().synced_columns == 2


PAYROLL = ("finance", "dbo", "payroll")


def test_sync_only_tightens_and_is_idempotent(spark, rows):
    asset = [("Finance", "DBO", "Payroll", "Pay", None, "Collibra", [], [])]
    column = [("Finance", "DBO", "Payroll", "SSN", "text", None, [])]
    known = [(*PAYROLL, "HIGH", True, False, "Oracle")]
    known_columns = [(*PAYROLL, "ssn", "char(9)", True, "REDACT"), (*PAYROLL, "name", "text", False, None)]
    got = sync(spark, asset, column, known, known_columns)
    table = got.tables.first()
    assert (table.sensitivity, table.requires_four_eyes, table.is_active) == ("HIGH", True, False)
    assert table.source_type == "Oracle" and got.warnings.count() == 1
    assert rows(got.columns, "column_name", "is_sensitive", "rule_type", "origin") == [
        ("SSN", True, "REDACT", "merged"),
        ("name", False, None, "retained"),
    ]
    stored = [tuple(r) for r in got.tables.select(*[f.split()[0] for f in KNOWN.split(", ")]).collect()]
    stored_columns = [
        tuple(r) for r in got.columns.select(*[f.split()[0] for f in KNOWN_COLUMN.split(", ")]).collect()
    ]
    again = sync(spark, asset, column, stored, stored_columns)
    assert rows(again.tables.drop("is_new")) == rows(got.tables.drop("is_new"))
    assert rows(again.columns, "column_name", "is_sensitive", "rule_type") == rows(
        got.columns, "column_name", "is_sensitive", "rule_type"
    )


LEVELS = ["PUBLIC", "LOW", "NORMAL", "INTERNAL", "CUSTOM", "HIGH", "RESTRICTED", None]


def test_ratchet_never_loosens(spark):
    pairs = spark.createDataFrame([(a, b) for a in LEVELS for b in LEVELS], "a string, b string")
    merged = pairs.withColumn("m", stricter(F.col("a"), F.col("b")))
    ranks = merged.select(
        *[F.coalesce(sensitivity_rank(F.col(c)), F.lit(-1)).alias(c) for c in ("a", "b", "m")]
    )
    assert all(r.m >= r.a or r.a == -1 for r in ranks.where("b <> -1").collect())
    assert all(r.m >= r.b for r in ranks.collect())


def test_new_tables_stay_inactive_unless_asked(spark):
    from dataclasses import replace

    closed = replace(TAGS, activate_new=False)
    assert health(spark, config=closed).tables.first().is_active is False


def test_epochs_add_up(spark, rows):
    epochs = spark.createDataFrame([("a", "b", "c", 5), ("a", "b", "d", 1)], EPOCH)
    hits = spark.createDataFrame([("a", "b", "c"), ("a", "b", "c"), ("x", "y", "z")], EPOCH.rsplit(",", 1)[0])
    assert rows(bump_epochs(epochs, hits)) == [("a", "b", "c", 7), ("a", "b", "d", 1), ("x", "y", "z", 1)]


def pages(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "payload string")


def test_catalog_pages(spark, rows):
    atlas = pages(
        spark,
        {"entities": [{"attributes": {"qualifiedName": "d/s/t", "name": "t"}, "classificationNames": ["A", None]}, {"attributes": {"name": None}}]},
        {"other": 1},
    )
    assert rows(atlas_assets(atlas), "domain", "schema_name", "table_name", "classifications") == [
        ("d", "s", "t", ["A"]),
        ("default", "dbo", "unknown", []),
    ]
    collibra = collibra_assets(pages(spark, {"results": [{"id": "1", "name": "n"}, {}]}))
    assert rows(collibra, "domain", "table_name", "external_id") == [
        ("collibra", "n", "1"),
        ("collibra", "unknown", None),
    ]
    items = [
        {"id": 1, "name": "patients", "schema_name": "clinical", "ds_id": 7, "tags": ["a", {"name": "b"}, {}]},
        {"id": 2, "name": "x", "ds_id": 8},
        {"id": 3, "name": "x", "ds_id": "7; drop"},
        {"id": 4, "name": "x"},
        {"id": 5, "name": "y", "ds_id": "07"},
        {"id": 6, "name": " ", "ds_id": 7},
    ]
    for page in (items, {"results": items}):
        assets, summary = alation_assets(pages(spark, page), {"7": "clinic"})
        assert rows(assets, "domain", "schema_name", "table_name", "classifications") == [
            ("clinic", "clinical", "patients", ["a", "b"]),
            ("clinic", "dbo", "y", []),
        ]
        assert summary.first().skipped_unmapped == 3
    assert find_asset(assets, "clinic", "dbo", "y").count() == 1
    entities = entity_pages(pages(spark, {"data": [{"id": "1"}, {"id": "2"}]}), "struct<id:string>")
    assert rows(entities) == [("1",), ("2",)]
    good, big = split_oversized(pages(spark, {"a": "x" * 50}, {}), cap=20)
    assert (good.count(), big.count()) == (1, 1)


def test_pull_completeness(spark, rows):
    pulls = {
        "whole": [("a", 250), ("b", 1)],
        "loop": [("a", 250), ("a", 250), ("b", 1)],
        "cut": [("a", 250), ("b", 250)],
        "hole": [("a", 250), None, ("b", 3)],
        "short": [("a", 3), ("b", 3)],
        "one": [(None, 5)],
    }
    data = [
        (name, n, *page) for name, listed in pulls.items() for n, page in enumerate(listed) if page
    ]
    df = spark.createDataFrame(data, "pull_id string, page_no int, cursor string, items int")
    problems = pull_problems(df, 250)
    assert dict(rows(problems, "pull_id", "problem")) == {
        "whole": None,
        "loop": "REPEATED_CURSOR",
        "cut": "LAST_PAGE_FULL",
        "hole": "MISSING_PAGE",
        "short": "SHORT_PAGE_INSIDE",
        "one": None,
    }
    assert dict(rows(pull_problems(df, 250, max_pages=1), "pull_id", "problem"))["whole"] == "TOO_MANY_PAGES"
    require_complete(problems.where("pull_id = 'whole'"))
    with pytest.raises(RuntimeError):
        require_complete(problems)


ENTITY = "entity_id int, fqn string, name string, service string, service_fqn string, database string, db_schema string"


def test_identities(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "svc.db.sch.t", "t", None, None, None, None),
            (2, "svc.sch.t2", "t2", None, None, None, None),
            (3, "sch.t3", None, None, None, None, None),
            (4, "t4", "t4", "Other", "full.other", None, "x"),
            (5, "", " ", None, None, None, None),
        ],
        ENTITY,
    )
    resolved, rejects = resolve_identity(df, IdentityConfig(default_tenant="main"))
    assert rows(resolved, "entity_id", "domain", "schema_name", "table_name", "database") == [
        (1, "svc", "sch", "t", "db"),
        (2, "svc", "sch", "t2", None),
        (3, "default", "sch", "t3", None),
        (4, "Other", "x", "t4", None),
    ]
    assert rows(rejects, "entity_id", "reason") == [(5, "EMPTY_TABLE_NAME")]
    only, out = resolve_identity(df, IdentityConfig(service_filter=" FULL.other ", default_tenant="m"))
    assert rows(only, "entity_id") == [(4,)] and out.count() == 4
    mapped = IdentityConfig(domain_of_database={"SVC.db": "dom"}, tenant_of_service={"svc.DB": "t1", "svc": "t2"})
    resolved, rejects = resolve_identity(df, mapped)
    assert rows(resolved, "entity_id", "domain", "tenant_id") == [(1, "dom", "t1")]
    assert {r.reason for r in rejects.collect()} == {"NO_DOMAIN_MAPPING"}
    _, rejects = resolve_identity(df.where("entity_id = 1"), IdentityConfig())
    assert rejects.first().reason == "NO_TENANT_MAPPING"


def test_collisions(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "svc.prod.public.users", "users", None, None, None, None),
            (2, "svc.sandbox.public.users", "USERS", None, None, None, None),
            (3, "svc.prod.public.orders", "orders", None, None, None, None),
            (4, "svc.PROD.public.orders", "orders", None, None, None, None),
        ],
        ENTITY,
    )
    resolved, _ = resolve_identity(df, IdentityConfig(default_tenant="m"))
    accepted, rejected = reject_collisions(resolved)
    assert rows(accepted, "entity_id") == [(3,), (4,)] and rows(rejected, "entity_id") == [(1,), (2,)]
    mapped, _ = resolve_identity(
        df, IdentityConfig(domain_of_database={"svc.prod": "svc_prod"}, default_tenant="m")
    )
    assert rows(reject_collisions(mapped)[0], "entity_id", "domain")[0] == (1, "svc_prod")


def test_tag_mapping(spark, rows):
    df = spark.createDataFrame(
        [(t,) for t in ("GDPR.Art9", "gdpr.art9.Health", "X.GDPR.Art9", "GDPR.Art99", "")], "t string"
    )
    got = df.select(matches_tag(F.col("t"), ["GDPR.Art9", " "])).collect()
    assert [r[0] for r in got] == [True, True, True, False, False]
    config = TagConfig(
        art9_tags=("Art9",),
        pii_tags=("Secret",),
        rule_of_tag={"pii.email": "MASK_EMAIL", "PII.Pseudonym": "HMAC_SHA256"},
        hmac_key_id="k1",
        activate_new=False,
    )
    columns = spark.createDataFrame(
        [
            (1, "email", ["PII.Email"]),
            (1, "ssn", ["PII.Sensitive"]),
            (1, "account", ["x", "PII.Pseudonym"]),
            (1, "plain", None),
            (2, "gene", ["Health.Art9"]),
        ],
        "entity_id int, column_name string, tags array<string>",
    )
    mapped = map_columns(columns, config)
    assert rows(mapped, "column_name", "rule_type", "replacement", "hmac_key_id") == [
        ("account", "HMAC_SHA256", None, "k1"),
        ("email", "MASK_EMAIL", None, None),
        ("gene", "REDACT", "[REDACTED]", None),
        ("plain", None, None, None),
        ("ssn", "REDACT", "[REDACTED]", None),
    ]
    tables = spark.createDataFrame(
        [(1, []), (2, []), (3, ["Tier.FourEyes"]), (4, ["VerySensitive"]), (5, ["a.secret"])],
        "entity_id int, tags array<string>",
    )
    known = spark.createDataFrame([(3,)], "entity_id int")
    got = map_tables(tables, mapped, "entity_id", config, known)
    assert rows(got, "entity_id", "sensitivity", "requires_four_eyes", "is_active", "masking_rules") == [
        (1, "NORMAL", False, False, 3),
        (2, "HIGH", True, False, 1),
        (3, "NORMAL", True, True, 0),
        (4, "HIGH", False, False, 0),
        (5, "HIGH", False, False, 0),
    ]


G1, G2, G3 = ("11111111-1111-1111-1111-111111111111", "22222222-2222-2222-2222-222222222222", "33333333-3333-3333-3333-333333333333")


def test_principals(spark, rows):
    teams = spark.createDataFrame(
        [(G1, "org.a", "a"), (G2, "org.b", "b"), (G3, "org.c", "c")], "id string, fqn string, name string"
    )
    mapping = mapping_rows(
        spark,
        {f"id:{G1}": "S-id", "fqn:org.a": "S-fqn", "name:a": "S-n", "org.b": "S-b", "name:c": "S-1", " name:c": "S-2", "id:bad": "S", "x": " "},
        ("id", "fqn", "name"),
    )
    assert rows(resolve_teams(teams, mapping), "name", "sid") == [("a", "S-id"), ("b", "S-b"), ("c", None)]
    users = spark.createDataFrame(
        [(G1, "x@a.b"), (G2, "Dup@a.b"), (G3, " dup@A.b "), ("4", "One@a.b "), ("5", None)], "id string, email string"
    )
    mapping = mapping_rows(
        spark,
        {G1: "S-id", "email:X@a.b": "S-mail", "dup@a.b": "S-dup", "ONE@a.b": "S-one", "someone": "S-name"},
        ("id", "email"),
    )
    assert rows(resolve_users(users, mapping), "id", "sid") == sorted(
        [(G1, "S-id"), (G2, None), (G3, None), ("4", "S-one"), ("5", None)], key=repr
    )
