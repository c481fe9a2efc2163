"""Landed catalog API pages to catalog assets, plus completeness checks over paged pulls."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import MAX_PAYLOAD_BYTES, PULL_MAX_PAGES
from lakewarden.functions.text import blank_to_null

ASSET_COLUMNS = [
    "domain",
    "schema_name",
    "table_name",
    "display_name",
    "external_id",
    "source_type",
    "classifications",
]


def split_oversized(pages: DataFrame, cap: int = MAX_PAYLOAD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Pages within the read cap and pages beyond it."""
    size = F.octet_length("payload")
    return pages.where(size <= cap), pages.where(size > cap)


def atlas_assets(pages: DataFrame) -> DataFrame:
    """Atlas search pages (`payload`): `domain/schema/...` qualified names."""
    schema = (
        "struct<entities:array<struct<attributes:struct<qualifiedName:string,name:string>,"
        "classificationNames:array<string>>>>"
    )
    e = pages.select(F.explode(F.from_json("payload", schema)["entities"]).alias("e"))
    parts = F.split(F.col("e.attributes.qualifiedName"), "/")
    name = F.col("e.attributes.name")
    return e.select(
        F.coalesce(F.get(parts, 0), F.lit("default")).alias("domain"),
        F.coalesce(F.get(parts, 1), F.lit("dbo")).alias("schema_name"),
        F.coalesce(name, F.lit("unknown")).alias("table_name"),
        name.alias("display_name"),
        F.lit(None).cast("string").alias("external_id"),
        F.lit("MicrosoftPurview").alias("source_type"),
        F.coalesce(
            F.array_compact("e.classificationNames"), F.array().cast("array<string>")
        ).alias("classifications"),
    )


def collibra_assets(pages: DataFrame) -> DataFrame:
    """Collibra asset pages (`payload`) in one fixed domain and schema."""
    schema = "struct<results:array<struct<id:string,name:string>>>"
    e = pages.select(F.explode(F.from_json("payload", schema)["results"]).alias("e"))
    name = F.coalesce(F.col("e.name"), F.lit("unknown"))
    return e.select(
        F.lit("collibra").alias("domain"),
        F.lit("dbo").alias("schema_name"),
        name.alias("table_name"),
        name.alias("display_name"),
        F.col("e.id").alias("external_id"),
        F.lit("Collibra").alias("source_type"),
        F.array().cast("array<string>").alias("classifications"),
    )


def alation_items(pages: DataFrame) -> DataFrame:
    """Alation table pages (`payload`, an array or `{results: [...]}`): one row per item."""
    item = "struct<id:string,name:string,schema_name:string,ds_id:string,tags:array<string>>"
    is_array = F.col("payload").rlike("^\\s*\\[")
    items = F.when(is_array, F.from_json("payload", f"array<{item}>")).otherwise(
        F.from_json("payload", f"struct<results:array<{item}>>")["results"]
    )
    return pages.select(F.explode(items).alias("i")).select("i.*")


def alation_assets(
    pages: DataFrame, domain_of_source: Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Assets of mapped data sources, and a one-row count of all and of skipped items."""
    items = alation_items(pages)
    spark = pages.sparkSession
    mapping = spark.createDataFrame(
        [(k, v) for k, v in domain_of_source.items() if v and v.strip()],
        "source_id string, domain string",
    )
    # numbers arrive as their JSON text; only plain non-negative integers count
    digits = F.when(
        F.col("ds_id").rlike("^[0-9]+$"), F.col("ds_id").try_cast("bigint").cast("string")
    )
    named = items.where(blank_to_null(F.col("name")).isNotNull()).withColumn("__ds", digits)
    joined = named.join(mapping, F.col("__ds") == F.col("source_id"), "left")
    tag_name = F.transform(
        F.coalesce("tags", F.array().cast("array<string>")),
        lambda t: F.when(t.startswith("{"), F.get_json_object(t, "$.name")).otherwise(t),
    )
    assets = joined.where(F.col("domain").isNotNull()).select(
        "domain",
        F.coalesce("schema_name", F.lit("dbo")).alias("schema_name"),
        F.col("name").alias("table_name"),
        F.col("name").alias("display_name"),
        F.col("id").alias("external_id"),
        F.lit("Alation").alias("source_type"),
        F.filter(tag_name, lambda t: t.isNotNull() & (F.btrim(t) != "")).alias("classifications"),
    )
    summary = joined.agg(
        F.count(F.lit(1)).alias("named_items"),
        F.count_if(F.col("domain").isNull()).alias("skipped_unmapped"),
    )
    return assets, summary


def find_asset(assets: DataFrame, domain: str, schema_name: str, table_name: str) -> DataFrame:
    """The asset of exactly this identifier."""
    return assets.where(
        (F.col("domain") == domain)
        & (F.col("schema_name") == schema_name)
        & (F.col("table_name") == table_name)
    )


def entity_pages(pages: DataFrame, item_schema: str) -> DataFrame:
    """Items of `{data: [...]}` pages (`payload`) of one entity kind."""
    parsed = F.from_json("payload", f"struct<data:array<{item_schema}>>")["data"]
    return pages.select(F.explode(parsed).alias("i")).select("i.*")


def pull_problems(
    pages: DataFrame, page_size: int, max_pages: int = PULL_MAX_PAGES
) -> DataFrame:
    """One row per pull (`pull_id`) of landed pages `(pull_id, page_no, cursor, items)`.

    A pull is complete when no cursor repeats, the page bound is kept, pages are gapless and
    only the last page is short. `problem` is null for a complete pull. The hot pull is reduced
    per task first: cursors are counted once per distinct value, not collected.
    """
    per_cursor = pages.groupBy("pull_id", "cursor").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("items").alias("items"),
        F.max("page_no").alias("last_page"),
        F.count_if(F.col("items") < page_size).alias("short_pages"),
        F.max_by("items", "page_no").alias("last_items"),
        F.max(F.when(F.col("items") >= page_size, F.col("page_no"))).alias("last_full"),
    )
    pulls = per_cursor.groupBy("pull_id").agg(
        F.sum("n").alias("pages"),
        F.sum("items").alias("items"),
        F.max("last_page").alias("last_page"),
        F.max_by("last_items", "last_page").alias("last_items"),
        F.sum("short_pages").alias("short_pages"),
        F.max(F.when(F.col("cursor").isNotNull(), F.col("n"))).alias("cursor_uses"),
    )
    problem = (
        F.when(F.col("pages") > max_pages, F.lit("TOO_MANY_PAGES"))
        .when(F.col("cursor_uses") > 1, F.lit("REPEATED_CURSOR"))
        .when(F.col("last_page") + 1 != F.col("pages"), F.lit("MISSING_PAGE"))
        .when(F.col("last_items") >= page_size, F.lit("LAST_PAGE_FULL"))
        .when(F.col("short_pages") > 1, F.lit("SHORT_PAGE_INSIDE"))
    )
    return pulls.select("pull_id", "pages", "items", problem.alias("problem"))


def is_complete(problems: DataFrame) -> bool:
    """Whether all pulls are known and complete; no pull at all is not a complete read."""
    found = problems.agg(F.count(F.lit(1)).alias("n"), F.count("problem").alias("bad")).first()
    return found["n"] > 0 and found["bad"] == 0


def require_complete(problems: DataFrame) -> None:
    """Raise before any write when a pull is incomplete; no partial sync."""
    bad = problems.where(F.col("problem").isNotNull()).limit(10).collect()
    if bad:
        raise RuntimeError(
            "incomplete pull: " + "; ".join(f"{r.pull_id}: {r.problem}" for r in bad)
        )
