"""Affected tables, delivery status, routing of policy events, job-run events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.text import (
    blank_to_null,
    epoch_to_timestamp,
    json_object,
    json_objects,
    json_scalar,
)
from lakewarden.operators.identity import ID
from lakewarden.operators.verify import within_tolerance

_TABLE = "struct<domain:string,schema_name:string,table_name:string>"


def _table(domain: Column, schema_name: Column, table_name: Column) -> Column:
    return F.struct(
        domain.alias("domain"), schema_name.alias("schema_name"), table_name.alias("table_name")
    )


def with_parsed_payload(deliveries: DataFrame) -> DataFrame:
    """Adds `fields` and `items`, the payload parsed once as an object or array of objects."""
    payload = F.col("payload")
    return deliveries.withColumns({"fields": json_object(payload), "items": json_objects(payload)})


def affected_tables(fields: Column, items: Column) -> Column:
    """Array of tables a payload speaks of, for its three shapes; malformed JSON gives none.

    A change event of a table by full name, an asset with its domain, or an array of
    notifications with a slash-separated qualified name. `fields` and `items` are the payload
    parsed by `json_object` and `json_objects`.
    """
    none = F.array().cast(f"array<{_TABLE}>")
    is_table = F.lower(fields["entityType"]) == "table"
    parts = F.split(blank_to_null(fields["entityFullyQualifiedName"]), "\\.")
    n = F.size(parts)
    by_name = F.when(
        is_table & (n >= 3),
        F.array(_table(F.get(parts, 0), F.get(parts, n - 2), F.get(parts, n - 1))),
    ).when(is_table & (n == 2), F.array(_table(F.get(parts, 0), F.lit("public"), F.get(parts, 1))))
    asset = blank_to_null(fields["assetName"])
    domain = F.coalesce(fields["domainName"], F.lit("default"))
    by_asset = F.when(
        asset.isNotNull() & F.map_contains_key(fields, "domainName"),
        F.array(_table(domain, F.lit("public"), asset)),
    )
    names = F.transform(
        F.filter(items, lambda i: F.map_contains_key(i, "eventType")),
        lambda i: F.get_json_object(i["data"], "$.qualifiedName"),
    )
    by_items = F.transform(
        F.filter(names, lambda q: q.contains("/")),
        lambda q: _table(
            F.substring_index(q, "/", 1), F.lit("public"), F.substring_index(q, "/", -1)
        ),
    )
    return F.concat(
        F.coalesce(by_name, none), F.coalesce(by_asset, none), F.coalesce(by_items, none)
    )


def delivery_status(rejected: Column, is_duplicate: Column, tables: Column) -> Column:
    return (
        F.when(rejected.isNotNull(), rejected)
        .when(is_duplicate, F.lit("IGNORED_DUPLICATE_EVENT"))
        .when(F.size(tables) == 0, F.lit("IGNORED_NO_RELEVANT_TABLES"))
        .otherwise(F.lit("INVALIDATED"))
    )


def invalidations(processed: DataFrame) -> DataFrame:
    """One row per table and event that took effect, from `status` and `tables`."""
    return (
        processed.where(F.col("status") == "INVALIDATED")
        .select("received_at", F.explode("tables").alias("t"))
        .select("received_at", "t.*")
    )


def epoch_increments(invalidated: DataFrame) -> DataFrame:
    """Epoch increments per table; a partial count, the same for batch and stream."""
    return invalidated.groupBy(*ID).agg(F.count(F.lit(1)).alias("increments"))


def policy_events(deliveries: DataFrame) -> DataFrame:
    """Change events of the policy store with `route` and `reject_reason`.

    A table event refreshes one table, a change of a principal or policy needs a full
    synchronisation, anything else is only acknowledged.
    """
    parsed = deliveries.withColumn("__f", json_object(F.col("payload")))
    f = F.col("__f")
    on_time = within_tolerance(F.col("received_at"), F.col("event_time"))
    reason = (
        F.when(~F.col("signature_valid"), F.lit("INVALID_SIGNATURE"))
        .when(F.col("event_id").isNull() | F.col("event_time").isNull(), F.lit("MISSING_ID_OR_TIME"))
        .when(~on_time, F.lit("EXPIRED"))
    )
    kind = F.col("entity_type")
    route = (
        F.when((kind == "table") & F.col("entity_fqn").isNotNull(), F.lit("REFRESH_TABLE"))
        .when(kind.isin("policy", "role", "team", "user"), F.lit("FULL_SYNC"))
        .otherwise(F.lit("ACKNOWLEDGE"))
    )
    return (
        parsed.withColumns(
            {
                "event_id": json_scalar(f, "id"),
                "event_time": epoch_to_timestamp(f["timestamp"].try_cast("bigint")),
                "entity_type": F.lower(f["entityType"]),
                "entity_fqn": blank_to_null(f["entityFullyQualifiedName"]),
            }
        )
        .withColumn("reject_reason", reason)
        .withColumn("route", F.when(F.col("reject_reason").isNull(), route))
        .drop("__f")
    )


def run_events(deliveries: DataFrame) -> DataFrame:
    """Job-run events: type, run id, status and reject reason; `timestamp` is ISO text."""
    parsed = deliveries.withColumn("__f", json_object(F.col("payload")))
    f = F.col("__f")
    data = F.from_json(f["data"], "struct<runId:string,runStatus:string>")
    on_time = within_tolerance(F.col("received_at"), F.col("event_time"))
    reason = (
        F.when(~F.col("signature_valid"), F.lit("INVALID_SIGNATURE"))
        .when(f.isNull(), F.lit("MALFORMED"))
        .when(F.col("event_id").isNull() | F.col("event_time").isNull(), F.lit("MISSING_ID_OR_TIME"))
        .when(~on_time, F.lit("EXPIRED"))
    )
    return (
        parsed.withColumns(
            {
                "event_id": json_scalar(f, "eventId"),
                "event_time": F.try_to_timestamp(f["timestamp"]),
                "event_type": F.coalesce(f["eventType"], F.lit("job_run.completed")),
                "run_id": data["runId"],
                "run_status": F.coalesce(data["runStatus"], F.lit("Unknown")),
            }
        )
        .withColumn("reject_reason", reason)
        .drop("__f")
    )
