"""Table-metadata JSON and manifest JSON to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.fixed_values import MAX_OBJECT_BYTES
from lakewarden.functions.paths import location_violation

_METADATA = """
struct<`format-version`:int, `table-uuid`:string, `location`:string,
  `last-sequence-number`:bigint, `last-updated-ms`:bigint, `current-snapshot-id`:bigint,
  `current-schema-id`:int,
  `schemas`:array<struct<`schema-id`:int,
      `fields`:array<struct<`id`:int,`name`:string,`type`:string,`required`:boolean>>>>,
  `default-spec-id`:int,
  `partition-specs`:array<struct<`spec-id`:int,
      `fields`:array<struct<`source-id`:int,`field-id`:int,`name`:string,`transform`:string>>>>,
  `snapshots`:array<struct<`snapshot-id`:bigint,`timestamp-ms`:bigint,`manifest-list`:string>>>
"""
_MANIFEST = """
struct<`entries`:array<struct<`file_path`:string,`file_format`:string,`record_count`:bigint,
  `file_size_in_bytes`:bigint,`partition`:map<string,string>,
  `lower_bounds`:map<string,string>,`upper_bounds`:map<string,string>>>>
"""


def read_documents(spark: SparkSession, path: str, max_bytes: int = MAX_OBJECT_BYTES) -> DataFrame:
    """One row per landed JSON file: `(location, document, oversized)`; oversized text is null."""
    files = spark.read.text(path, wholetext=True)
    oversized = F.col("_metadata.file_size") > max_bytes
    return files.select(
        F.col("_metadata.file_path").alias("location"),
        F.when(~oversized, F.col("value")).alias("document"),
        oversized.alias("oversized"),
    )


def parse_table_metadata(documents: DataFrame) -> DataFrame:
    """One row per metadata document `(location, document)` with the current schema and spec."""
    m = F.from_json("document", _METADATA)
    base = documents.select(F.col("location").alias("metadata_location"), m.alias("m"))
    schema_id = F.coalesce(F.col("m.current-schema-id"), F.lit(0))
    spec_id = F.coalesce(F.col("m.default-spec-id"), F.lit(0))
    fields = F.get(
        F.filter(F.col("m.schemas"), lambda s: F.coalesce(s["schema-id"], F.lit(0)) == schema_id), 0
    )["fields"]
    spec = F.get(
        F.filter(
            F.col("m.partition-specs"), lambda s: F.coalesce(s["spec-id"], F.lit(0)) == spec_id
        ),
        0,
    )["fields"]
    return base.select(
        "metadata_location",
        F.col("m.table-uuid").alias("table_uuid"),
        F.coalesce(F.col("m.format-version"), F.lit(2)).alias("format_version"),
        F.coalesce(F.col("m.location"), F.lit("")).alias("location"),
        F.coalesce(F.col("m.last-sequence-number"), F.lit(0).cast("bigint")).alias("last_sequence"),
        F.col("m.last-updated-ms").alias("last_updated_ms"),
        F.coalesce(F.col("m.current-snapshot-id"), F.lit(-1).cast("bigint")).alias("snapshot_id"),
        fields.alias("fields"),
        spec.alias("partition_fields"),
        F.col("m.snapshots").alias("snapshots"),
    )


def current_snapshots(metadata: DataFrame) -> DataFrame:
    """The snapshot a table currently points to; tables without one give no row."""
    s = metadata.select(
        "metadata_location",
        "table_uuid",
        "snapshot_id",
        F.explode("snapshots").alias("s"),
    )
    return s.where(
        (F.col("s.snapshot-id") == F.col("snapshot_id"))
        & (F.coalesce(F.btrim(F.col("s.manifest-list")), F.lit("")) != "")
    ).select(
        "metadata_location",
        "table_uuid",
        "snapshot_id",
        F.col("s.timestamp-ms").alias("timestamp_ms"),
        F.col("s.manifest-list").alias("manifest_location"),
    )


def _lower_keys(m: str):
    return F.transform_keys(
        F.coalesce(F.col(m), F.create_map().cast("map<string,string>")), lambda k, _: F.lower(k)
    )


def parse_manifest(manifests: DataFrame, table_location: str | None = None) -> DataFrame:
    """Data files of manifest documents `(location, document)`.

    `table_location` is the trust anchor: the name of a column of `manifests` holding the
    configured table location, against which each file path is checked (`violation`).
    """
    anchor = F.col(table_location) if table_location else F.lit(None).cast("string")
    entries = manifests.select(
        F.col("location").alias("manifest_location"),
        anchor.alias("table_location"),
        F.explode(F.from_json("document", _MANIFEST)["entries"]).alias("e"),
    ).select("manifest_location", "table_location", "e.*")
    return entries.select(
        "manifest_location",
        F.coalesce("file_path", F.lit("")).alias("file_path"),
        F.coalesce("file_format", F.lit("PARQUET")).alias("file_format"),
        _lower_keys("partition").alias("partition"),
        F.coalesce("record_count", F.lit(1000).cast("bigint")).alias("record_count"),
        F.coalesce("file_size_in_bytes", F.lit(1024).cast("bigint")).alias("file_size"),
        _lower_keys("lower_bounds").alias("lower_bounds"),
        _lower_keys("upper_bounds").alias("upper_bounds"),
        location_violation(F.col("file_path"), F.col("table_location")).alias("violation"),
    )
