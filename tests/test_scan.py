from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.functions.crypto import key_table
from lakewarden.functions.masks import MaskRule
from lakewarden.operators.entity_set import (
    InvalidQueryOption,
    clamp_top,
    envelope,
    keyset_page,
    page,
    total_count,
)
from lakewarden.operators.governance import (
    ColumnPolicy,
    TablePolicy,
    row_filter_column,
    visible_columns,
    visible_tables,
)
from lakewarden.operators.predicates import Predicate, admit, extract_predicates
from lakewarden.operators.pruning import mark_files, read_kept, scan_statistics
from lakewarden.plans.scan import clamp_limit, governed_scan, registered_scan, ungoverned_scan
from lakewarden.sources.inventory import allowed_buckets, build_inventory, check_buckets
from lakewarden.sources.registry import LakeTable, TableRegistry
from lakewarden.sources.table_metadata import (
    current_snapshots,
    parse_manifest,
    parse_table_metadata,
    read_documents,
)

FILE = (
    "file_path string, partition map<string,string>, record_count bigint, "
    "lower_bounds map<string,string>, upper_bounds map<string,string>"
)
#: One file a week, the two newest on or after 1 April.
DATES = [str(date(2027, 4, 9) - timedelta(weeks=w)) for w in range(10)]


def kept(marked):
    return sorted(r.file_path for r in marked.where("keep").collect())


def test_date_and_tenant_pruning(spark):
    files = spark.createDataFrame(
        [(f"f{i + 1}", {"orderdate": d}, 1, {}, {}) for i, d in enumerate(DATES)], FILE
    )
    marked = mark_files(files, [Predicate("orderDate", ">=", "2027-04-01")], {"orderDate": T.DateType()})
    assert kept(marked) == ["f1", "f2"]
    stats = scan_statistics(marked).first()
    assert (stats.scanned_files, stats.pruned_files, stats.pruned_percent) == (2, 8, 80.0)
    tenants = spark.createDataFrame(
        [(f"t{i}", {"tenantid": f"tenant-{i}"}, 1, {}, {}) for i in range(1, 11)], FILE
    )
    one = mark_files(tenants, [Predicate("tenantId", "==", "tenant-3")], {"tenantId": T.StringType()})
    assert kept(one) == ["t3"]


def test_typed_bounds_and_all_operators(spark):
    files = spark.createDataFrame(
        [("f", {}, 1, {"amount": "10.0"}, {"amount": "999.0"}), ("bad", {}, 1, {"amount": "x"}, {"amount": "9"})],
        FILE,
    )
    types = {"amount": T.DoubleType()}

    def keeps(*predicates):
        return kept(mark_files(files, [Predicate("amount", *p) for p in predicates], types))

    assert keeps((">=", "50")) == ["bad", "f"]
    assert keeps((">=", "1000")) == ["bad"]
    assert keeps((">=", "50"), ("<", "60")) == ["bad", "f"]
    assert keeps((">", "20"), ("<", "10")) == ["bad"]
    assert keeps(("!=", "10")) == ["bad", "f"]
    same = spark.createDataFrame([("f", {}, 1, {"amount": "10"}, {"amount": "10"})], FILE)
    assert kept(mark_files(same, [Predicate("amount", "!=", 10)], types)) == []


def test_mandatory_evidence(spark):
    files = spark.createDataFrame(
        [
            ("a", {"tenantid": "tenant-a"}, 1, {}, {}),
            ("none", {}, 1, {}, {}),
            ("half", {}, 1, {"tenantid": "tenant-a"}, {}),
            ("b", {"tenantid": "tenant-b"}, 1, {}, {}),
            ("bounds", {}, 1, {"tenantid": "tenant-a"}, {"tenantid": "tenant-c"}),
        ],
        FILE,
    )
    types = {"tenantId": T.StringType()}
    wanted = [Predicate("tenantId", "==", "tenant-a")]
    assert kept(mark_files(files, wanted, types, ["tenantId"])) == ["a", "bounds"]
    assert kept(mark_files(files, [], types, ["tenantId"])) == []


def test_predicates():
    asked = {"where": {"a": {"gte": 1, "lt": 5}, "b": None, "c": 2}, "c": 3, "d": 4, "limit": 9, "offset": 1}
    assert extract_predicates(asked) == [
        Predicate("a", ">=", 1),
        Predicate("a", "<", 5),
        Predicate("c", "==", 2),
        Predicate("d", "==", 4),
    ]
    with pytest.raises(PermissionError):
        admit([Predicate("x", "==", 1)], ["a"], ["a"])
    assert admit([Predicate("a", "==", 1), Predicate("B", "==", 1)], ["a", "b"], ["a"]) == (
        [Predicate("a", "==", 1)],
        [Predicate("B", "==", 1)],
    )


def sales(spark):
    return spark.createDataFrame(
        [
            ("tenant-a", 1, "EU", "x@y.z", "n1"),
            ("tenant-a", 2, "SECRET-REGION", "bad", None),
            ("tenant-b", 3, "EU", "q@y.z", "n3"),
        ],
        "tenantId string, id int, region string, mail string, note string",
    )


POLICY = TablePolicy(
    columns={
        "region": ColumnPolicy(sensitive=True),
        "mail": ColumnPolicy(rule=MaskRule("MASK_EMAIL")),
        "note": ColumnPolicy(rule=MaskRule("HMAC_SHA256", key_id="k")),
    },
    tenant_column="tenantId",
)


def test_row_filter_sees_raw_values_and_masks_come_last(spark, rows):
    from dataclasses import replace

    hidden = replace(POLICY, row_filter="region <> 'SECRET-REGION'")
    got = governed_scan(sales(spark), hidden, "tenant-a", columns=["id", "region", "mail"])
    assert rows(got.rows) == [(1, "[REDACTED]", "x***@y.z")]
    other = replace(POLICY, row_filter="region <> 'OTHER'")
    both = governed_scan(sales(spark), other, "tenant-a", columns=["id", "region"]).rows
    assert rows(both) == [(1, "[REDACTED]"), (2, "[REDACTED]")]
    with pytest.raises(PermissionError):
        row_filter_column(sales(spark), "id in (select 1)")


def test_scan_fails_closed(spark, rows):
    table = sales(spark)
    assert governed_scan(table, POLICY, None).rows.count() == 0
    assert governed_scan(table, POLICY, "  ").rows.count() == 0
    assert governed_scan(table, TablePolicy(allowed=False, tenant_column="tenantId"), "tenant-a").rows.count() == 0
    with pytest.raises(PermissionError):
        governed_scan(table, POLICY, "tenant-a", {"where": {"tenantId": "tenant-b"}})
    with pytest.raises(PermissionError):
        governed_scan(table, POLICY, "tenant-a", {"where": {"unknown": 1}})
    same = governed_scan(table, POLICY, "tenant-a", {"tenantId": "tenant-a"}).rows
    assert same.count() == 2
    masked = governed_scan(table, POLICY, "tenant-a", {"region": "EU"})
    assert masked.rows.count() == 2
    assert masked.dropped == [Predicate("region", "==", "EU")]
    assert governed_scan(table, POLICY, "tenant-a", {"id": "no number"}).rows.count() == 0


def test_access_levels_and_keys(spark, rows):
    policy = TablePolicy(
        columns={
            "region": ColumnPolicy(access="Clear", sensitive=True),
            "mail": ColumnPolicy(access="Deny"),
            "note": ColumnPolicy(rule=MaskRule("DROP_COLUMN")),
        },
        tenant_column="tenantId",
    )
    got = governed_scan(sales(spark), policy, "tenant-a").rows
    assert got.columns == ["tenantId", "id", "region"]
    keys = key_table(spark, {"k": "s"})
    noted = governed_scan(sales(spark), POLICY, "tenant-a", columns=["id", "note"], keys=keys).rows
    note = dict(rows(noted))
    assert len(note[1]) == 64 and note[2] is None
    unkeyed = governed_scan(sales(spark), POLICY, "tenant-a", columns=["id", "note"]).rows
    assert dict(rows(unkeyed))[1] == "[REDACTED]"


def test_ungoverned_scan_and_limits(spark, rows):
    got = ungoverned_scan(sales(spark), "tenant-b", "tenantId").rows
    assert rows(got) == [("tenant-b",) + ("[REDACTED]",) * 4]
    assert [clamp_limit(n) for n in (None, 0, 10, 99_999)] == [1000, 1000, 10, 50_000]
    assert clamp_limit(None, 50) == 50
    assert governed_scan(sales(spark), POLICY, "tenant-a", limit=1).rows.count() == 1


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake") / "orders")
    df = spark.range(0, 1000).select(
        F.col("id"),
        (F.col("id") / 10).cast("int").alias("amount"),
        F.concat(F.lit("tenant-"), (F.col("id") / 250).cast("int")).alias("tenantId"),
        F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") / 100).cast("int")).alias("day"),
    )
    df.repartitionByRange(10, "id").write.parquet(root)
    return root


def test_pruned_scan_equals_full_scan(spark, rows, lake):
    table = spark.read.parquet(lake)
    inventory = build_inventory(table, ["tenantId", "amount", "day"])
    assert inventory.count() == 10
    source = LakeTable(lake)
    policy = TablePolicy(tenant_column="tenantId")
    asked = {"where": {"amount": {"gte": 30}, "day": {"lt": "2026-01-05"}}}
    full = governed_scan(table, policy, "tenant-1", asked)
    pruned = governed_scan(table, policy, "tenant-1", asked, inventory=inventory, source=source)
    assert rows(pruned.rows) == rows(full.rows) and full.rows.count() == 100
    stats = pruned.statistics.first()
    assert stats.pruned_files > stats.scanned_files > 0


def test_pruned_scan_of_a_partitioned_table(spark, rows, tmp_path):
    root = str(tmp_path / "by tenant")
    tenants = F.element_at(F.array(F.lit("a"), F.lit("b b"), F.lit("c+d%e")), (F.col("id") % 3 + 1).cast("int"))
    df = spark.range(150).select("id", (F.col("id") / 10).cast("int").alias("amount"), tenants.alias("tenant_id"))
    df.repartition(6, "amount").write.partitionBy("tenant_id").parquet(root)
    table = spark.read.parquet(root)
    inventory = build_inventory(table, ["amount"], ["tenant_id"])
    assert inventory.count() > 6
    for tenant in ("a", "b b", "c+d%e"):
        policy = TablePolicy(tenant_column="tenant_id")
        asked = {"where": {"amount": {"gte": 5}}}
        full = governed_scan(table, policy, tenant, asked)
        pruned = governed_scan(table, policy, tenant, asked, inventory=inventory, source=LakeTable(root))
        assert rows(pruned.rows) == rows(full.rows) and full.rows.count() > 30
        assert pruned.rows.columns == table.columns


def test_kept_files_are_read_whole(spark, rows, lake):
    table = spark.read.parquet(lake)
    inventory = build_inventory(table, ["amount"])
    marked = mark_files(inventory, [Predicate("amount", "<", 35)], {"amount": T.IntegerType()})
    listed = read_kept(spark, marked, table.schema, lake)
    assert listed.count() == 400 and rows(listed) == rows(table.where("id < 400"))
    none = mark_files(inventory, [Predicate("amount", ">", 5000)], {"amount": T.IntegerType()})
    assert read_kept(spark, none, table.schema, lake).count() == 0


def test_filters_reach_the_parquet_scan(spark, lake):
    policy = TablePolicy(tenant_column="tenantId")
    asked = {"where": {"amount": {"gte": 30}}}
    got = governed_scan(spark.read.parquet(lake), policy, "tenant-1", asked, columns=["id"]).rows
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(amount,30)" in plan and "EqualTo(tenantId,tenant-1)" in plan
    assert "day" not in plan.split("ReadSchema")[1]


def test_registry(spark, lake):
    registry = TableRegistry({"Orders": LakeTable(lake)})
    assert registry.read(spark, "orders").count() == 1000
    assert registry.read(spark, "nothing").count() == 0
    tables = {"Orders": LakeTable(lake)}
    policy = TablePolicy(tenant_column="tenantId")
    assert registered_scan(spark, tables, "ORDERS", policy, "tenant-1").rows.count() == 250
    assert registered_scan(spark, tables, "other", policy, "tenant-1").rows.count() == 0


def test_metadata_documents(spark, rows, tmp_path):
    metadata = {
        "format-version": 2,
        "table-uuid": "u",
        "location": "s3://lake/orders",
        "current-schema-id": 1,
        "schemas": [
            {"schema-id": 0, "fields": []},
            {"schema-id": 1, "fields": [{"id": 1, "name": "orderId", "type": "string", "required": True}]},
        ],
        "default-spec-id": 0,
        "partition-specs": [
            {"spec-id": 0, "fields": [{"source-id": 1, "field-id": 1000, "name": "orderDate", "transform": "identity"}]}
        ],
        "current-snapshot-id": 5,
        "snapshots": [{"snapshot-id": 5, "timestamp-ms": 1, "manifest-list": "s3://lake/orders/metadata/s.json"}],
    }
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "v1.json").write_text(json.dumps(metadata, indent=1))
    documents = read_documents(spark, str(tmp_path / "m"))
    parsed = parse_table_metadata(documents)
    row = parsed.first()
    assert [f.name for f in row.fields] == ["orderId"] and len(row.partition_fields) == 1
    assert rows(current_snapshots(parsed), "manifest_location") == [("s3://lake/orders/metadata/s.json",)]
    assert read_documents(spark, str(tmp_path / "m"), max_bytes=10).first().document is None
    entries = {"entries": [{"file_path": "s3://lake/orders/data/a"}, {"file_path": "s3://x/a", "record_count": 7}]}
    manifests = spark.createDataFrame(
        [("m", json.dumps(entries), "s3://lake/orders")], "location string, document string, anchor string"
    )
    files = parse_manifest(manifests, "anchor")
    assert rows(files, "file_path", "file_format", "record_count", "file_size", "violation") == [
        ("s3://lake/orders/data/a", "PARQUET", 1000, 1024, None),
        ("s3://x/a", "PARQUET", 7, 1024, "AUTHORITY_MISMATCH"),
    ]


def test_bucket_allow_list(spark, rows):
    files = spark.createDataFrame([("s3://a/x",), ("s3://b/x",), ("abfs://c/x",)], "file_path string")
    none = spark.createDataFrame([], "bucket string")
    locations = spark.createDataFrame([("s3://a/t",), ("abfs://z/t",)], "location string")
    checked = check_buckets(files, allowed_buckets(none, locations))
    assert rows(checked, "file_path", "bucket_allowed") == [
        ("abfs://c/x", True),
        ("s3://a/x", True),
        ("s3://b/x", False),
    ]
    free = check_buckets(files, allowed_buckets(none, locations.limit(0)))
    assert all(r.bucket_allowed for r in free.collect())


def parts(spark):
    return spark.createDataFrame([(i, f"name{i}", i % 3) for i in range(10)], "id int, name string, size int")


def test_entity_set_pages(spark, rows):
    df = parts(spark)
    assert [r.id for r in page(df, ["id"], order_by=[("size", "desc")], top=3).collect()] == [2, 5, 8]
    assert [r.id for r in page(df, ["id"], top=0).collect()] == [0]
    assert [clamp_top(n) for n in (None, 0, 5, 5000)] == [100, 1, 5, 1000]
    assert [r.id for r in page(df, ["id"], skip=7).collect()] == [7, 8, 9]
    for bad in ({"top": -1}, {"skip": -1}, {"select": "id;x"}, {"select": "other"}, {"filters": [("id", "like", 1)]}):
        with pytest.raises(InvalidQueryOption):
            page(df, ["id"], **bad)
    filtered = page(df, ["id"], "id,name", [("name", "contains", "me1"), ("size", "eq", "1")])
    assert rows(filtered) == [(1, "name1")]


def test_keyset_walk_covers_every_row_once(spark):
    df, seen, after = parts(spark), [], None
    while True:
        got = keyset_page(df, ["size", "id"], after, top=4).collect()
        if not got:
            break
        seen += [r.id for r in got]
        after = [got[-1]["size"], got[-1]["id"]]
    assert sorted(seen) == list(range(10)) and len(seen) == 10


def test_envelope(spark):
    df = parts(spark)
    rows_ = page(df, ["id"], ["id"], top=2)
    got = envelope(rows_, ["id"], "https://r/", "d", "s", "t", total_count(df)).first()
    assert got.context == "https://r/$metadata#d_s_t" and got.total_count == 10
    assert json.loads(got.value) == [{"id": 0}, {"id": 1}]
    assert envelope(rows_, ["id"], "https://r", "d", "s", "t").first().total_count is None


def test_visible_tables(spark, rows):
    tables = spark.createDataFrame([(1, "A"), (2, "default"), (3, "b"), (4, "a"), (5, "a"), (6, "a")], "table_id int, domain string")
    columns = spark.createDataFrame(
        [(1, "x", False, False), (1, "y", True, False), (2, "x", False, False), (3, "x", False, False), (4, "x", False, False), (6, "x", False, False)],
        "table_id int, column_name string, is_sensitive boolean, has_rule boolean",
    )
    decisions = spark.createDataFrame(
        [(4, None, False, None), (6, "X", True, "Deny"), (1, "Y", True, "Clear")],
        "table_id int, column_name string, is_allowed boolean, access string",
    )
    visible = visible_columns(tables, columns, decisions, "a")
    assert rows(visible, "table_id", "column_name", "access") == [(1, "x", "Clear"), (1, "y", "Clear"), (2, "x", "Clear")]
    foreign = spark.createDataFrame([(7, "b"), (8, "a")], "table_id int, domain string")
    denied = decisions.unionByName(spark.createDataFrame([(8, None, False, None)], decisions.schema))
    listed = visible_tables(tables.unionByName(foreign), columns, denied, "a")
    assert {r.table_id for r in listed.collect()} == {1, 2, 5}


def test_hidden_columns_cannot_be_probed(spark):
    table = sales(spark)
    hidden = next(c for c in table.columns if c != "tenantId")
    value = table.select(F.col(hidden).cast("string")).first()[0]
    all_rows = ungoverned_scan(table, "tenant-b", "tenantId").rows.count()
    got = ungoverned_scan(table, "tenant-b", "tenantId", arguments={"where": {hidden: value, "tenantId": "tenant-b"}})
    assert got.rows.count() == all_rows and [p.column for p in got.dropped] == [hidden]
    assert ungoverned_scan(table, "tenant-b", "tenantId", limit=1).rows.count() == min(1, all_rows)


@pytest.mark.parametrize(
    "path", ["s3://b/lake/t/data/%zz/%2e%2e/%2e%2e/other/x.parquet", "s3://b/t/%2E./x", "s3://b/t/a%5c..%2Fx", "s3://b/t/%zz%00x"]
)
def test_bad_escapes_hide_no_traversal(spark, path):
    from lakewarden.functions.paths import contains_traversal

    frame = spark.createDataFrame([(path,), ("s3://b/t/100%/a..b/x.parquet",)], "p string")
    assert [r[0] for r in frame.select(contains_traversal(F.col("p"))).collect()] == [True, False]
