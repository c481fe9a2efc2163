"""Registered queries: scans, pruning, masking, paging, locations, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.functions.crypto import key_table
from lakewarden.functions.masks import MaskRule, apply_rule
from lakewarden.functions.paths import location_violation
from lakewarden.operators.entity_set import envelope, keyset_page, page, total_count
from lakewarden.operators.governance import (
    DENY,
    MASK,
    ColumnPolicy,
    TablePolicy,
    visible_columns,
    visible_tables,
)
from lakewarden.operators.predicates import Predicate
from lakewarden.operators.pruning import mark_files, scan_statistics
from lakewarden.plans import inputs
from lakewarden.plans.dialect import PLAIN, SPARK, derive, load
from lakewarden.plans.registry import query
from lakewarden.plans.scan import governed_scan, ungoverned_scan
from lakewarden.sources.inventory import (
    allowed_buckets,
    build_inventory,
    check_buckets,
    inventory_from_footers,
)
from lakewarden.sources.registry import LakeTable
from lakewarden.sources.table_metadata import (
    current_snapshots,
    parse_manifest,
    parse_table_metadata,
)

_KEY = "pseudonym-key"


def _orders_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_mktsegment").alias("tenant_id"),
        "c_name",
        "o_totalprice",
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
    )


@query(
    f"""
    SELECT o_orderkey, c_mktsegment AS tenant_id, {PLAIN.hmac("c_name", _KEY)} AS c_name,
      o_totalprice, o_orderstatus, '[REDACTED]' AS o_orderpriority
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' AND o_totalprice >= 50000 AND o_totalprice < 400000
      AND o_orderstatus <> 'P'"""
)
def governed_scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = TablePolicy(
        columns={
            "c_name": ColumnPolicy(rule=MaskRule("HMAC_SHA256", key_id="names")),
            "o_orderpriority": ColumnPolicy(sensitive=True),
            "o_orderdate": ColumnPolicy(access=DENY),
        },
        row_filter="o_orderstatus <> 'P'",
    )
    asked = {"where": {"o_totalprice": {"gte": 50000, "lt": 400000}, "o_orderpriority": "2-HIGH"}}
    keys = key_table(spark, {"names": _KEY})
    table = _orders_by_segment(spark, sf_dir)
    return governed_scan(table, policy, "BUILDING", asked, keys=keys).rows


_FILES = """
    SELECT 's3://lake/lineitem/' || strftime(l_shipdate, '%Y-%m') || '/' || l_returnflag
        || l_linestatus AS file_path, count(*) AS record_count,
      min(l_shipdate) AS lo_date, max(l_shipdate) AS hi_date,
      min(l_quantity) AS lo_qty, max(l_quantity) AS hi_qty, min(l_returnflag) AS flag
    FROM lineitem GROUP BY 1"""


def _lineitem_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as if stored in one file per ship month, flag and status."""
    lineitem = load(spark, sf_dir, "lineitem").withColumn(
        "evidence", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    )
    path = F.concat(
        F.lit("s3://lake/lineitem/"),
        F.date_format("l_shipdate", "yyyy-MM"),
        F.lit("/"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
    )
    return build_inventory(
        lineitem,
        bounds=["l_shipdate", "l_quantity"],
        partition=["l_returnflag", "evidence"],
        file_path=path,
    )


def _lineitem_types(spark: SparkSession, sf_dir: str) -> dict:
    schema = load(spark, sf_dir, "lineitem").schema
    types = {f.name: f.dataType for f in schema.fields}
    return {**types, "evidence": types["l_returnflag"]}


@query(
    f"""
    WITH f AS ({_FILES}), k AS (
      SELECT *, flag <> 'N' AND hi_date >= TIMESTAMP '1998-01-01' AND lo_date < TIMESTAMP '2000-06-15'
        AND hi_qty >= 45 AS keep FROM f)
    SELECT count(*) FILTER (keep) AS scanned_files, count(*) FILTER (NOT keep) AS pruned_files,
      count(*) FILTER (NOT keep) * 100.0 / count(*) AS pruned_percent,
      CAST(sum(CASE WHEN keep THEN record_count END) AS BIGINT) AS kept_records FROM k"""
)
def prune_inventory_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicates = [
        Predicate("l_returnflag", "!=", "N"),
        Predicate("l_shipdate", ">=", "1998-01-01"),
        Predicate("l_shipdate", "<", "2000-06-15"),
        Predicate("l_quantity", ">=", "45"),
    ]
    types = _lineitem_types(spark, sf_dir)
    return scan_statistics(mark_files(_lineitem_files(spark, sf_dir), predicates, types))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 45 AND l_discount <> 0.05"""
)
def pruned_scan_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Governed scan that opens only files whose real bounds allow it."""
    table = load(spark, sf_dir, "lineitem")
    policy = TablePolicy(tenant_column="l_returnflag", row_filter="l_discount <> 0.05")
    scan = governed_scan(
        table,
        policy,
        "R",
        {"where": {"l_quantity": {"gte": 45}}},
        columns=["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"],
        inventory=inventory_from_footers(
            spark, f"{sf_dir}/lineitem.parquet", table.schema, ["l_returnflag", "l_quantity"]
        ),
        source=LakeTable(f"{sf_dir}/lineitem.parquet"),
    )
    return scan.rows


@query(
    f"""
    SELECT file_path, record_count FROM ({_FILES}) f
    WHERE flag = 'R' AND hi_qty > 49.5"""
)
def mandatory_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicates = [Predicate("evidence", "==", "R"), Predicate("l_quantity", ">", 49.5)]
    marked = mark_files(
        _lineitem_files(spark, sf_dir),
        predicates,
        _lineitem_types(spark, sf_dir),
        mandatory=["evidence"],
    )
    return marked.where("keep").select("file_path", "record_count")


@query(
    " UNION ALL ".join(
        f"""
    SELECT '{t}' AS name, count(*) AS record_count, CAST(min({low}) AS VARCHAR) AS lower_bound,
      CAST(max({low}) AS VARCHAR) AS upper_bound FROM {t}"""
        for t, low in (("lineitem", "l_orderkey"), ("customer", "c_name"), ("documents", "doc_id"))
    )
)
def footer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bounds of whole tables from the footers of their files."""
    parts = []
    for name, column in (("lineitem", "l_orderkey"), ("customer", "c_name"), ("documents", "doc_id")):
        table = load(spark, sf_dir, name)
        files = inventory_from_footers(spark, f"{sf_dir}/{name}.parquet", table.schema, [column])
        kind = table.schema[column].dataType
        low, high = (F.col(f"{side}_bounds")[column].cast(kind) for side in ("lower", "upper"))
        parts.append(
            files.agg(
                F.lit(name).alias("name"),
                F.sum("record_count").alias("record_count"),
                F.min(low).cast("string").alias("lower_bound"),
                F.max(high).cast("string").alias("upper_bound"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """
    SELECT file_path, flag AS l_returnflag,
      strftime(lo_date, '%Y-%m-%d') AS lo_date, strftime(hi_date, '%Y-%m-%d') AS hi_date,
      lo_qty, hi_qty, record_count FROM (""" + _FILES + ") f"
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_files(spark, sf_dir).select(
        "file_path",
        F.col("partition")["l_returnflag"].alias("l_returnflag"),
        F.left(F.col("lower_bounds")["l_shipdate"], F.lit(10)).alias("lo_date"),
        F.left(F.col("upper_bounds")["l_shipdate"], F.lit(10)).alias("hi_date"),
        F.col("lower_bounds")["l_quantity"].cast("double").alias("lo_qty"),
        F.col("upper_bounds")["l_quantity"].cast("double").alias("hi_qty"),
        "record_count",
    )


@query(
    """
    SELECT '[REDACTED]' AS c_custkey, '[REDACTED]' AS c_name, '[REDACTED]' AS c_nationkey,
      '[REDACTED]' AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'"""
)
def mask_all_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ungoverned_scan(load(spark, sf_dir, "customer"), "MACHINERY", "c_mktsegment").rows


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def dropped_column_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A masked column whose rule is to drop it is denied, so it is not in the scan."""
    policy = TablePolicy(
        columns={"c_acctbal": ColumnPolicy(sensitive=True, rule=MaskRule("DROP_COLUMN"))}, tenant_column="c_mktsegment"
    )
    return governed_scan(load(spark, sf_dir, "customer"), policy, "BUILDING", {}).rows


_EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"


@query(
    f"""
    SELECT doc_id, substr(mail, 1, 1) || '***@' || split_part(mail, '@', 2) AS masked
    FROM (SELECT doc_id, {PLAIN.first_match("text", _EMAIL)} AS mail FROM documents) m"""
)
def mask_email_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = derive(
        spark,
        sf_dir,
        f"SELECT doc_id, {SPARK.first_match('text', _EMAIL)} AS mail FROM lw_documents",
    )
    return found.select(
        "doc_id", apply_rule(F.col("mail"), MaskRule("MASK_EMAIL")).alias("masked")
    )


@query(
    """
    SELECT s_suppkey, '**** **** **** ' || right(s_name, 4) AS last_four,
      regexp_replace(s_name, '[0-9]+', '#', 'g') AS by_pattern,
      '[REDACTED]' AS unknown_rule, '[REDACTED-GDPR-ART9]' AS special FROM supplier"""
)
def mask_rules_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("s_name")
    return load(spark, sf_dir, "supplier").select(
        "s_suppkey",
        apply_rule(name, MaskRule("MASK_LAST_FOUR")).alias("last_four"),
        apply_rule(name, MaskRule("REGEX", "[0-9]+", "#")).alias("by_pattern"),
        apply_rule(name, MaskRule("SHUFFLE")).alias("unknown_rule"),
        apply_rule(name, MaskRule("REDACT", replacement="[REDACTED-GDPR-ART9]")).alias("special"),
    )


@query(f"SELECT c_custkey, {PLAIN.hmac('c_name', _KEY)} AS pseudonym FROM customer")
def hmac_pseudonym_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = TablePolicy(
        columns={"pseudonym": ColumnPolicy(MASK, rule=MaskRule("HMAC_SHA256", key_id="k"))},
        tenant_column="tenant",
    )
    table = load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("pseudonym"), F.lit("all").alias("tenant")
    )
    keys = key_table(spark, {"k": _KEY})
    scan = governed_scan(table, policy, "all", columns=["c_custkey", "pseudonym"], keys=keys)
    return scan.rows


@query(
    """
    SELECT s_suppkey, '[REDACTED]' AS n_name, s_acctbal
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE n_regionkey = 1 AND n_name <> 'NATION_1' AND s_acctbal > 0"""
)
def rls_before_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation")
    table = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "n_name", "s_acctbal", F.col("n_regionkey").cast("string").alias("tenant_id")
    )
    policy = TablePolicy(
        columns={"n_name": ColumnPolicy(sensitive=True)},
        row_filter="n_name <> 'NATION_1' AND s_acctbal > 0",
    )
    return governed_scan(table, policy, "1", columns=["s_suppkey", "n_name", "s_acctbal"]).rows


@query(
    """
    SELECT p_partkey, p_name, p_retailprice FROM part
    WHERE p_name LIKE '%ring%' AND p_size > 10 AND p_type <> 'PROMO'
    ORDER BY p_size DESC, p_partkey LIMIT 25 OFFSET 10"""
)
def entity_set_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page(
        load(spark, sf_dir, "part"),
        keys=["p_partkey"],
        select="p_partkey, p_name, p_retailprice",
        filters=[("p_name", "contains", "ring"), ("p_size", "gt", 10), ("p_type", "ne", "PROMO")],
        order_by=[("p_size", "desc")],
        top=25,
        skip=10,
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'O' AND (o_custkey > 100 OR (o_custkey = 100 AND o_orderkey > 500))
    ORDER BY o_custkey, o_orderkey LIMIT 1000"""
)
def entity_set_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyset_page(
        load(spark, sf_dir, "orders"),
        keys=["o_custkey", "o_orderkey"],
        after=[100, 500],
        select=["o_orderkey", "o_custkey", "o_totalprice"],
        filters=[("o_orderstatus", "eq", "O")],
        top=5000,
    )


@query("SELECT count(*) AS total_count FROM orders WHERE o_totalprice > 250000")
def entity_set_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_count(load(spark, sf_dir, "orders"), [("o_totalprice", "gt", 250000)])


@query(
    """
    WITH rows AS (SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#4'
                  ORDER BY p_partkey LIMIT 20)
    SELECT 'https://data.example/odata/$metadata#shop_main_part' AS context,
      (SELECT count(*) FROM part WHERE p_brand = 'Brand#4') AS total_count,
      '[' || string_agg('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '"}', ','
                        ORDER BY p_partkey) || ']' AS value FROM rows"""
)
def entity_set_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    wanted = [("p_brand", "eq", "Brand#4")]
    rows = page(part, ["p_partkey"], ["p_partkey", "p_name"], wanted, top=20)
    count = total_count(part, wanted)
    return envelope(
        rows, ["p_partkey"], "https://data.example/odata/", "shop", "main", "part", count
    )


def _decisions(d) -> str:
    """Table decisions from parts, column levels from what was sold."""
    return f"""
      SELECT p_partkey AS table_id, CAST(NULL AS STRING) AS column_name, p_type <> 'PROMO' AS is_allowed,
        CAST(NULL AS STRING) AS access FROM {d.table("part")}
      UNION ALL
      SELECT p_partkey, upper(column_name), true,
        CASE WHEN uses >= 8 THEN 'Deny' WHEN uses >= 6 THEN 'Mask' ELSE 'Clear' END
      FROM ({inputs.catalog_columns(d)}) c WHERE uses >= 5"""


def _governed_columns(d) -> str:
    return f"""
      SELECT p_partkey AS table_id, column_name, tag_text LIKE '%PII%' AS is_sensitive,
        tag_text LIKE '%pseudonym%' AS has_rule FROM ({inputs.catalog_columns(d)}) c"""


_VISIBLE = f"""
    WITH t AS ({inputs.catalog_tables(PLAIN)}), d AS ({_decisions(PLAIN)}),
    c AS ({_governed_columns(PLAIN)}), v AS (
      SELECT t.p_partkey AS table_id, t.service AS domain, c.column_name,
        coalesce(d.access, CASE WHEN c.is_sensitive OR c.has_rule THEN 'Mask' ELSE 'Clear' END)
          AS access
      FROM t JOIN c ON c.table_id = t.p_partkey
      LEFT JOIN d ON d.table_id = c.table_id AND lower(d.column_name) = c.column_name
      WHERE t.p_type <> 'PROMO')
    SELECT * FROM v WHERE access <> 'Deny'"""


def _visibility(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    tables = derive(spark, sf_dir, inputs.catalog_tables(SPARK)).select(
        F.col("p_partkey").alias("table_id"), F.col("service").alias("domain")
    )
    columns = derive(spark, sf_dir, _governed_columns(SPARK))
    decisions = derive(spark, sf_dir, _decisions(SPARK))
    return tables, columns, decisions


@query(_VISIBLE)
def visible_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible_columns(*_visibility(spark, sf_dir), None)


@query(
    f"""
    WITH t AS ({inputs.catalog_tables(PLAIN)}), c AS ({_governed_columns(PLAIN)})
    SELECT DISTINCT table_id, domain FROM ({_VISIBLE}) x WHERE domain IN ('svc_brand4', 'svc_brand23')
    UNION
    SELECT p_partkey, service FROM t WHERE service IN ('svc_brand4', 'svc_brand23') AND p_type <> 'PROMO'
      AND p_partkey NOT IN (SELECT table_id FROM c)"""
)
def visible_table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, columns, decisions = _visibility(spark, sf_dir)
    return visible_tables(tables, columns, decisions, "SVC_Brand4", "svc_brand23")


def _references(d) -> str:
    """File references of a lake whose tables follow the crawled hosts."""
    host = "split_part(url, '/', 3)"
    root = f"'s3://lake/' || {host}"
    page_id = "CAST(page_id AS STRING)"
    return f"""
      SELECT page_id,
        CASE page_id % 9 WHEN 0 THEN {root} || '/data/' || {page_id} || '.parquet'
          WHEN 1 THEN {root} || '_evil/data/x.parquet'
          WHEN 2 THEN {root} || '/data/%2e%2E/x.parquet'
          WHEN 3 THEN url
          WHEN 4 THEN '/etc/' || {host}
          WHEN 5 THEN 's3://other/' || {host} || '/data/x.parquet'
          WHEN 6 THEN 'data/' || {page_id} || '.parquet'
          WHEN 7 THEN 'file:///data/' || {host} || '/' || {page_id} || '.parquet'
          ELSE 's3a+x:/' || {host} END AS file_path,
        CASE WHEN page_id % 9 = 3 THEN 'HTTPS://' || upper({host}) || '/en'
          WHEN page_id % 9 = 7 THEN '/data/' || {host} || '/metadata/v3.metadata.json'
          ELSE {root} || '/metadata/v2.metadata.json' END AS table_location
      FROM {d.table("pages")}"""


@query(
    f"""
    SELECT page_id, file_path, CASE page_id % 9 WHEN 1 THEN 'OUTSIDE_TABLE'
        WHEN 2 THEN 'PATH_TRAVERSAL' WHEN 4 THEN 'RESTRICTED_PATH' WHEN 5 THEN 'AUTHORITY_MISMATCH'
        WHEN 6 THEN 'LOCAL_FOR_REMOTE' WHEN 8 THEN 'LOCAL_FOR_REMOTE'
        WHEN 3 THEN CASE WHEN file_path LIKE 'http:%' THEN 'SCHEME_MISMATCH'
          WHEN split_part(split_part(split_part(file_path, '#', 1), '?', 1), '/', 4) <> 'en'
            THEN 'OUTSIDE_TABLE' END
      END AS violation FROM ({_references(PLAIN)}) r"""
)
def location_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = derive(spark, sf_dir, _references(SPARK))
    reason = location_violation(F.col("file_path"), F.col("table_location"))
    return refs.select("page_id", "file_path", reason.alias("violation"))


@query(
    """
    SELECT page_id, host AS bucket, host LIKE '%.example.com' OR host = 'shared.example.org'
      AS bucket_allowed
    FROM (SELECT page_id, split_part(url, '/', 3) AS host FROM pages) p"""
)
def bucket_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    host = F.split_part("url", F.lit("/"), F.lit(3))
    locations = pages.where(host.endswith(".example.com")).select(
        F.concat(F.lit("s3://"), host, F.lit("/orders/metadata")).alias("location")
    )
    configured = spark.createDataFrame([("shared.example.org",)], "bucket string")
    files = pages.select(
        "page_id", F.concat(F.lit("s3://"), host, F.lit("/x.parquet")).alias("file_path")
    )
    checked = check_buckets(files, allowed_buckets(configured, locations))
    return checked.select("page_id", "bucket", "bucket_allowed")


def _manifests(d) -> str:
    """Manifest documents, one per ship date, with an entry per flag and status."""
    us = d.micros("l_shipdate")
    return f"""
      SELECT 's3://lake/lineitem/metadata/' || CAST(ship AS STRING) || '.json' AS location,
        '{{"entries":[' || string_agg('{{"file_path":"s3://lake/'
          || CASE WHEN flag = 'N' THEN 'orders' ELSE 'lineitem' END || '/data/'
          || CAST(ship AS STRING) || flag || status || '.parquet",'
          || CASE WHEN flag = 'A' THEN '"record_count":' || CAST(n AS STRING) || ',' ELSE '' END
          || '"partition":{{"Flag":"' || flag || '"}},"lower_bounds":{{"l_orderkey":"'
          || CAST(lo AS STRING) || '"}},"upper_bounds":{{"l_orderkey":"' || CAST(hi AS STRING)
          || '"}}}}', ',') || ']}}' AS document
      FROM (SELECT {us} AS ship, l_returnflag AS flag, l_linestatus AS status, count(*) AS n,
              min(l_orderkey) AS lo, max(l_orderkey) AS hi
            FROM {d.table("lineitem")} GROUP BY l_shipdate, l_returnflag, l_linestatus) g
      GROUP BY ship"""


@query(
    """
    SELECT 's3://lake/' || CASE WHEN l_returnflag = 'N' THEN 'orders' ELSE 'lineitem' END
        || '/data/' || epoch_us(l_shipdate) || l_returnflag || l_linestatus || '.parquet' AS file_path,
      'PARQUET' AS file_format,
      CASE WHEN l_returnflag = 'A' THEN count(*) ELSE 1000 END AS record_count,
      CAST(1024 AS BIGINT) AS file_size, l_returnflag AS flag,
      CAST(min(l_orderkey) AS VARCHAR) AS lo, CAST(max(l_orderkey) AS VARCHAR) AS hi,
      CASE WHEN l_returnflag = 'N' THEN 'OUTSIDE_TABLE' END AS violation
    FROM lineitem GROUP BY l_shipdate, l_returnflag, l_linestatus"""
)
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = derive(spark, sf_dir, _manifests(SPARK)).withColumn(
        "anchor", F.lit("s3://lake/lineitem/metadata/v1.metadata.json")
    )
    return parse_manifest(documents, "anchor").select(
        "file_path",
        "file_format",
        "record_count",
        "file_size",
        F.col("partition")["flag"].alias("flag"),
        F.col("lower_bounds")["l_orderkey"].alias("lo"),
        F.col("upper_bounds")["l_orderkey"].alias("hi"),
        "violation",
    )


def _metadata_documents(d) -> str:
    """Table-metadata documents, one per part; some without ids or a matching snapshot."""
    key = "CAST(p_partkey AS STRING)"
    return f"""
      SELECT p_partkey, {key} AS location, '{{"format-version":2,"table-uuid":"u' || {key} || '",'
        || CASE WHEN p_size > 25 THEN '"current-schema-id":1,' ELSE '' END
        || '"schemas":[{{"schema-id":0,"fields":[{{"id":1,"name":"old_' || {key}
        || '","type":"long","required":true}}]}},{{"schema-id":1,"fields":[{{"id":1,"name":"new_'
        || {key} || '","type":"long","required":false}},{{"id":2,"name":"x","type":"string"}}]}}],'
        || '"current-snapshot-id":' || CAST(p_size AS STRING)
        || ',"snapshots":[{{"snapshot-id":7,"timestamp-ms":1,"manifest-list":"s3://lake/7"}},'
        || '{{"snapshot-id":' || CASE WHEN p_type = 'PROMO' THEN '-5' ELSE CAST(p_size AS STRING) END
        || ',"timestamp-ms":2,"manifest-list":"s3://lake/' || {key} || '"}}]}}' AS document
      FROM {d.table("part")} WHERE p_size <> 7"""


@query(
    """
    SELECT 'u' || p_partkey AS table_uuid, CAST(0 AS BIGINT) AS last_sequence,
      CASE WHEN p_size > 25 THEN 'new_' || p_partkey || ',x' ELSE 'old_' || p_partkey END AS fields,
      CASE WHEN p_type <> 'PROMO' THEN 's3://lake/' || p_partkey END AS manifest_location
    FROM part WHERE p_size <> 7"""
)
def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = parse_table_metadata(derive(spark, sf_dir, _metadata_documents(SPARK)))
    current = current_snapshots(metadata).select("table_uuid", "manifest_location")
    names = F.array_join(F.transform("fields", lambda f: f["name"]), ",")
    return metadata.join(current, "table_uuid", "left").select(
        "table_uuid", "last_sequence", names.alias("fields"), "manifest_location"
    )
