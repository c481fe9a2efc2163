"""dbt manifest documents to model, column and dependency rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.text import blank_to_null

_COLUMN = (
    "struct<name:string,data_type:string,description:string,tags:array<string>,"
    "meta:map<string,string>>"
)
_NODE = (
    "struct<name:string,`database`:string,`schema`:string,description:string,"
    "config:struct<materialized:string>,contract:struct<enforced:string>,tags:array<string>,"
    f"meta:map<string,string>,columns:map<string,{_COLUMN}>,depends_on:struct<nodes:array<string>>>"
)
_MANIFEST = f"struct<nodes:map<string,{_NODE}>>"
MODEL_KEY = "(?i)^(model|seed)\\."


def _strings(values: Column) -> Column:
    return F.filter(
        F.coalesce(values, F.array().cast("array<string>")),
        lambda t: blank_to_null(t).isNotNull(),
    )


def _meta(values: Column) -> Column:
    """Metadata with lower-case keys, as lookups ignore case; the last spelling wins."""
    entries = F.transform(
        F.map_entries(F.coalesce(values, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    latest = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(latest)


def parse_models(manifests: DataFrame, document: str = "document") -> DataFrame:
    """Model and seed nodes, one row each, with nested columns and dependencies."""
    nodes = manifests.select(F.explode(F.from_json(document, _MANIFEST)["nodes"]).alias("id", "n"))
    n = nodes.where(F.col("id").rlike(MODEL_KEY))
    return n.select(
        F.col("id").alias("unique_id"),
        F.coalesce("n.name", F.lit("")).alias("name"),
        F.coalesce(F.col("n.database"), F.lit("")).alias("domain"),
        F.coalesce(F.col("n.schema"), F.lit("")).alias("schema_name"),
        F.coalesce(F.col("n.config.materialized"), F.lit("table")).alias("materialization"),
        F.col("n.description").alias("description"),
        _strings(F.col("n.tags")).alias("tags"),
        _meta(F.col("n.meta")).alias("meta"),
        F.col("n.columns").alias("columns"),
        _strings(F.col("n.depends_on.nodes")).alias("depends_on"),
        (F.coalesce(F.col("n.contract.enforced"), F.lit("")) == "true").alias("contract_enforced"),
    ).withColumn("table_id", F.concat_ws(".", "domain", "schema_name", "name"))


def model_columns(models: DataFrame) -> DataFrame:
    """One row per model column."""
    c = models.select(
        "unique_id",
        "table_id",
        F.get(F.map_values(F.map_filter("meta", lambda k, _: k == "owner")), 0).alias("owner"),
        F.explode("columns").alias("column_name", "c"),
    )
    return c.select(
        "unique_id",
        "table_id",
        "owner",
        "column_name",
        F.col("c.data_type").alias("data_type"),
        F.col("c.description").alias("description"),
        _strings(F.col("c.tags")).alias("tags"),
        _meta(F.col("c.meta")).alias("meta"),
    )


def model_dependencies(models: DataFrame) -> DataFrame:
    """`(unique_id, table_id, parent_unique_id)` per dependency."""
    return models.select("unique_id", "table_id", F.explode("depends_on").alias("parent_unique_id"))
