"""Registered queries: gates and limits of scans, names, keys, schemes, payload caps, entity pages, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.functions.paths import schemes_compatible, unsafe_key
from lakewarden.functions.text import is_identifier
from lakewarden.operators.governance import ColumnPolicy, TablePolicy
from lakewarden.plans.dialect import load
from lakewarden.plans.registry import query
from lakewarden.plans.scan import clamp_limit, governed_scan, registered_scan, ungoverned_scan
from lakewarden.sources.catalog_pages import entity_pages, find_asset
from lakewarden.sources.deliveries import quarantine_oversized
from lakewarden.sources.registry import LakeTable, TableRegistry


@query(
    """
    SELECT 'denied' AS gate, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'no tenant', 0
    UNION ALL SELECT 'unknown table', 0
    UNION ALL SELECT 'registered', count(*) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
    UNION ALL SELECT 'top level filter', count(*) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
    UNION ALL SELECT 'hidden filter', count(*) FROM orders WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT 'no decision', count(*) FROM orders WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT 'limit', least(1000, count(*)) FROM orders WHERE o_orderpriority = '2-HIGH'"""
)
def scan_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a scan gives for each kind of decision, filter and limit."""
    orders = load(spark, sf_dir, "orders")
    policy = TablePolicy(tenant_column="o_orderpriority")
    hidden = TablePolicy(columns={"o_orderstatus": ColumnPolicy(sensitive=True)}, tenant_column="o_orderpriority")
    tables = {"Orders": LakeTable(f"{sf_dir}/orders.parquet")}
    top = {"o_orderstatus": "O"}
    registered = registered_scan(spark, tables, "ORDERS", policy, "1-URGENT", arguments={"where": {"o_orderstatus": "F"}})
    scans = {
        "denied": governed_scan(orders, TablePolicy(allowed=False), "1-URGENT").rows,
        "no tenant": governed_scan(orders, policy, " ").rows,
        "unknown table": TableRegistry(tables).read(spark, "other", orders.schema),
        "registered": registered.rows,
        "top level filter": governed_scan(orders, policy, "1-URGENT", top).rows,
        "hidden filter": governed_scan(orders, hidden, "2-HIGH", top).rows,
        "no decision": ungoverned_scan(orders, "2-HIGH", "o_orderpriority", arguments=top).rows,
        "limit": governed_scan(orders, policy, "2-HIGH", limit=clamp_limit(None)).rows,
    }
    counted = [rows.agg(F.lit(gate).alias("gate"), F.count(F.lit(1)).alias("n")) for gate, rows in scans.items()]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


@query(
    """
    SELECT page_id, regexp_matches(split_part(url, '/', 4), '^[a-zA-Z_][a-zA-Z0-9_]*$') AS is_name,
      regexp_matches(url, '[?#%]') OR list_contains(string_split(url, '/'), '..') AS is_unsafe,
      split_part(url, ':', 1) = 'https' AS same_scheme, split_part(url, ':', 1) = 'http' AS lake_scheme
    FROM pages"""
)
def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, storage keys and schemes as the crawled addresses have them."""
    scheme = F.split_part("url", F.lit(":"), F.lit(1))
    lake = F.when(scheme == "http", F.lit("abfs")).otherwise(scheme)
    return load(spark, sf_dir, "pages").select(
        "page_id",
        is_identifier(F.split_part("url", F.lit("/"), F.lit(4))).alias("is_name"),
        unsafe_key(F.col("url")).alias("is_unsafe"),
        schemes_compatible(scheme, F.lit("HTTPS")).alias("same_scheme"),
        schemes_compatible(lake, F.lit("abfss")).alias("lake_scheme"),
    )


@query(
    """
    SELECT conv_id, turn, CASE WHEN strlen(text) <= 120 THEN 'accepted' ELSE 'quarantined' END AS status
    FROM conversations"""
)
def capped_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a delivery: within the cap, or in quarantine."""
    turns = load(spark, sf_dir, "conversations").withColumnRenamed("text", "payload")
    accepted, rest = quarantine_oversized(turns, cap=120)
    marked = accepted.withColumn("status", F.lit("accepted")).unionByName(rest.withColumn("status", F.lit("quarantined")))
    return marked.select("conv_id", "turn", "status")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_size AS level FROM part")
def entity_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as landed pages of entities, opened again into rows."""
    item = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("level"))
    pages = load(spark, sf_dir, "part").groupBy((F.col("p_partkey") / 50).cast("bigint").alias("page"))
    landed = pages.agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("payload"))
    return entity_pages(landed, "struct<id:string,name:string,level:int>")


@query(
    """
    SELECT p_partkey, p_brand AS domain, p_type AS schema_name, p_name AS table_name
    FROM part WHERE p_brand = 'Brand#2' AND p_type = 'PROMO' AND p_name = (
      SELECT min(p_name) FROM part WHERE p_brand = 'Brand#2' AND p_type = 'PROMO')"""
)
def asset_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table of a catalog by its exact identifier, as the reference mode asks for it."""
    assets = load(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("domain"), F.col("p_type").alias("schema_name"), F.col("p_name").alias("table_name")
    )
    inside = (F.col("domain") == "Brand#2") & (F.col("schema_name") == "PROMO")
    name = assets.where(inside).agg(F.min("table_name")).first()[0]
    return find_asset(assets, "Brand#2", "PROMO", name or "")
