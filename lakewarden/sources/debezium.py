"""Debezium-style envelopes to typed change events; batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BODY = (
    "op:string, before:map<string,string>, after:map<string,string>,"
    "source:struct<name:string,`schema`:string,`table`:string,ts_ms:bigint>"
)
_ENVELOPE = f"struct<payload:struct<{_BODY}>, {_BODY}, __corrupt:string>"


def _tenant(row: Column) -> Column:
    hits = F.map_values(F.map_filter(row, lambda k, _: F.lower(k) == "tenant_id"))
    return F.get(hits, 0)


def parse_envelopes(
    raw: DataFrame,
    json: str = "value",
    received_at: str = "received_at",
    default_tenant: str | None = None,
) -> DataFrame:
    """Events with `event_id`, table parts, operation, tenant, before/after maps and time.

    Row values keep their JSON text. Malformed messages stay in the result with `malformed`
    set, so the caller can quarantine them. The event id is a digest, so replays get the same id.
    """
    parsed = raw.withColumn(
        "__e", F.from_json(json, _ENVELOPE, {"columnNameOfCorruptRecord": "__corrupt"})
    )
    e = F.col("__e")
    wrapped = e["payload"].isNotNull()

    def pick(name: str) -> Column:
        return F.when(wrapped, e["payload"][name]).otherwise(e[name])

    source = pick("source")
    operation = (
        F.when(pick("op") == "c", F.lit("Insert"))
        .when(pick("op") == "d", F.lit("Delete"))
        .when(pick("op") == "r", F.lit("Snapshot"))
        .otherwise(F.lit("Update"))
    )
    domain = F.coalesce(source["name"], F.lit("default"))
    schema_name = F.coalesce(source["schema"], F.lit("public"))
    table_name = F.coalesce(source["table"], F.lit("unknown"))
    received_ms = F.unix_millis(F.col(received_at).cast("timestamp"))
    ts_ms = F.coalesce(source["ts_ms"], received_ms)
    before, after = pick("before"), pick("after")
    tenant = F.coalesce(_tenant(after), _tenant(before), F.lit(default_tenant).cast("string"))
    events = parsed.withColumns(
        {
            "domain": domain,
            "schema_name": schema_name,
            "table_name": table_name,
            "operation": operation,
            "tenant_id": tenant,
            "before": before,
            "after": after,
            "ts_ms": ts_ms,
            "event_time": F.timestamp_millis(ts_ms),
            "malformed": e["__corrupt"].isNotNull() | F.col(json).isNull(),
        }
    )
    digest = F.sha2(
        F.concat_ws(
            "|", "domain", "schema_name", "table_name", F.col("ts_ms").cast("string"), F.col(json)
        ),
        256,
    )
    return events.withColumn("event_id", digest).drop("__e")


def typed_row(row: Column, schema: str) -> Column:
    """A before/after map as a typed struct of the caller's schema; what does not fit is null."""
    fields = []
    for f in T.StructType.fromDDL(schema).fields:
        text = F.try_element_at(row, F.lit(f.name))
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        value = F.from_json(text, f.dataType) if nested else text.try_cast(f.dataType)
        fields.append(value.alias(f.name))
    return F.struct(*fields)
