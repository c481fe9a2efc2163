"""Exports of governed metadata as rows and JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import HIGH_SENSITIVITY
from lakewarden.functions.text import blank_to_null, entity_name
from lakewarden.functions.types import edm_type
from lakewarden.operators.identity import ID


@dataclass(frozen=True)
class EntityConfig:
    namespace: str = "default"
    owner: str = "group:data-governance"
    system: str = "data-governance"
    annotation_prefix: str = "lakewarden.io"
    location: str = "url:/catalog-entities"


def _distinct_ignoring_case(values: Column) -> Column:
    """First spelling of every value."""
    return F.filter(
        values,
        lambda v, i: ~F.exists(F.slice(values, F.lit(1), i), lambda e: F.lower(e) == F.lower(v)),
    )


def _annotations(pairs: Mapping[str, Column]) -> Column:
    entries = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in pairs.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def _stamp(at: Column) -> Column:
    return F.date_format(at.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _managed(config: EntityConfig) -> Column:
    return F.concat(F.lit(f"{config.location}/"), F.col("name"))


def _entity(rows: DataFrame, config: EntityConfig, **columns: Column) -> DataFrame:
    return rows.select(
        F.lit("API").alias("kind"),
        F.col("name"),
        F.lit(config.namespace).alias("namespace"),
        columns["title"].alias("title"),
        columns["description"].alias("description"),
        columns["tags"].alias("tags"),
        columns["annotations"].alias("annotations"),
        columns["type"].alias("type"),
        columns["lifecycle"].alias("lifecycle"),
        columns["owner"].alias("owner"),
        F.lit(config.system).alias("system"),
        columns["definition"].cast("string").alias("definition"),
    )


def fixed_entities(apis: DataFrame, config: EntityConfig) -> DataFrame:
    """Entities of hand-listed APIs: `name`, `title`, `description`, `type`, `definition`, `tags`."""
    rows = apis.withColumn("name", entity_name(F.col("name")))
    return _entity(
        rows,
        config,
        title=F.col("title"),
        description=F.col("description"),
        tags=_distinct_ignoring_case(F.col("tags")),
        annotations=_annotations({"backstage.io/managed-by-location": _managed(config)}),
        type=F.col("type"),
        lifecycle=F.lit("production"),
        owner=F.lit(config.owner),
        definition=F.col("definition"),
    )


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """Newest registered schema of every service."""
    rest = [c for c in schemas.columns if c != "service"]
    newest = F.max_by(F.struct(*rest), F.struct("registered_at", "version")).alias("s")
    return schemas.groupBy("service").agg(newest).select("service", "s.*")


def subgraph_entities(schemas: DataFrame, config: EntityConfig) -> DataFrame:
    """Entities of the newest schema per service: `service`, `version`, `registered_at`,
    `registered_by`, `is_active`, `sdl`."""
    rows = latest_schemas(schemas).withColumn(
        "name", entity_name(F.concat(F.lit("subgraph-"), F.col("service")))
    )
    p = config.annotation_prefix
    by = blank_to_null(F.col("registered_by"))
    tags = F.array(
        F.lit("graphql"), F.lit("subgraph"), F.lit("federation"), entity_name(F.col("service"))
    )
    return _entity(
        rows,
        config,
        title=F.concat(F.col("service"), F.lit(" Subgraph API")),
        description=F.concat(
            F.lit("Federated Subgraph '"), F.col("service"), F.lit("' (v"), F.col("version"), F.lit(").")
        ),
        tags=tags,
        annotations=_annotations(
            {
                "backstage.io/managed-by-location": _managed(config),
                f"{p}/subgraph": F.col("service"),
                f"{p}/version": F.col("version"),
                f"{p}/registered-at": _stamp(F.col("registered_at")),
                f"{p}/registered-by": by,
            }
        ),
        type=F.lit("graphql"),
        lifecycle=F.when(F.col("is_active"), F.lit("production")).otherwise(F.lit("deprecated")),
        owner=F.coalesce(F.concat(F.lit("user:"), by), F.lit(config.owner)),
        definition=F.col("sdl"),
    )


def first_sunset_rules(tables: DataFrame, rules: DataFrame) -> DataFrame:
    """Identity and the first rule (`position`) naming a table or `schema.table`."""
    forms = F.array_distinct(
        F.array(
            F.lower("table_name"), F.lower(F.concat_ws(".", "schema_name", "table_name"))
        )
    )
    keyed = tables.select(*ID, F.explode(forms).alias("__target"))
    named = rules.select(F.lower("target").alias("__target"), F.struct(*rules.columns).alias("r"))
    hits = keyed.join(named, "__target")
    return hits.groupBy(*ID).agg(F.min_by("r", "r.position").alias("rule"))


def table_entities(
    tables: DataFrame, rules: DataFrame, config: EntityConfig, now: datetime
) -> DataFrame:
    """Entities of governed tables, deprecated once their sunset has passed or when inactive.

    `tables`: identity, `display_name`, `description`, `long_description`, `source_type`,
    `documentation_source`, `sensitivity`, `requires_four_eyes`, `is_active`. `rules`:
    `position`, `rule_id`, `target`, `deprecated_at`, `sunset_at`, `replacement`.
    """
    rows = tables.join(first_sunset_rules(tables, rules), ID, "left").withColumn(
        "name",
        entity_name(F.concat(F.lit("data-"), F.col("schema_name"), F.lit("-"), F.col("table_name"))),
    )
    high = F.upper("sensitivity").isin(HIGH_SENSITIVITY)
    guarded = F.col("requires_four_eyes") | F.coalesce(high, F.lit(False))
    documented = blank_to_null(F.col("documentation_source"))
    level = blank_to_null(F.col("sensitivity"))
    tags = F.array_compact(
        F.array(
            F.lit("data-product"),
            F.lit("table"),
            entity_name(F.col("source_type")),
            F.when(guarded, F.lit("four-eyes-required")),
            F.when(guarded, F.lit("pii")),
            F.when(documented.isNotNull(), entity_name(documented)),
            F.when(level.isNotNull(), entity_name(F.concat(F.lit("sensitivity-"), level))),
        )
    )
    p = config.annotation_prefix
    qualified = F.concat_ws(".", "schema_name", "table_name")
    sunset = F.coalesce(F.lit(now).cast("timestamp") >= F.col("rule.sunset_at"), F.lit(False))
    annotations = _annotations(
        {
            "backstage.io/managed-by-location": _managed(config),
            f"{p}/source-type": F.col("source_type"),
            f"{p}/schema-name": F.col("schema_name"),
            f"{p}/table-name": F.col("table_name"),
            f"{p}/sensitivity": F.col("sensitivity"),
            f"{p}/requires-four-eyes": F.col("requires_four_eyes").cast("string"),
            f"{p}/documentation-source": documented,
            f"{p}/sunsetting-rule-id": F.col("rule.rule_id").cast("string"),
            f"{p}/sunsetting-deprecated-at": _stamp(F.col("rule.deprecated_at")),
            f"{p}/sunsetting-sunset-at": _stamp(F.col("rule.sunset_at")),
            f"{p}/sunsetting-replacement": blank_to_null(F.col("rule.replacement")),
        }
    )
    default_text = F.concat(F.lit("Governed enterprise data entity '"), qualified, F.lit("'."))
    return _entity(
        rows,
        config,
        title=F.coalesce(blank_to_null(F.col("display_name")), qualified),
        description=F.coalesce("description", "long_description", default_text),
        tags=_distinct_ignoring_case(tags),
        annotations=annotations,
        type=F.lit("openapi"),
        lifecycle=F.when(sunset | ~F.col("is_active"), F.lit("deprecated")).otherwise(
            F.lit("production")
        ),
        owner=F.lit(config.owner),
        definition=F.lit(None),
    )


def filter_entities(
    entities: DataFrame, kind: str | None = None, type_: str | None = None, name: str | None = None
) -> DataFrame:
    """By kind, type, or name as given or in its normalised form."""
    if kind and kind.strip():
        entities = entities.where(F.lower("kind") == kind.lower())
    if type_ and type_.strip():
        entities = entities.where(F.lower("type") == type_.lower())
    if name is not None:
        wanted = F.lower(F.lit(name))
        entities = entities.where(
            (F.lower("name") == wanted) | (F.lower("name") == entity_name(F.lit(name)))
        )
    return entities


def entity_documents(entities: DataFrame) -> DataFrame:
    """One JSON document per entity, which is also a valid YAML document."""
    return entities.select(
        "name",
        F.to_json(
            F.struct(
                F.lit("backstage.io/v1alpha1").alias("apiVersion"),
                "kind",
                F.struct(
                    "name", "namespace", "title", "description", "tags", "annotations"
                ).alias("metadata"),
                F.struct("type", "lifecycle", "owner", "system", "definition").alias("spec"),
            )
        ).alias("document"),
    )


def lineage_datasets(nodes: DataFrame, namespace: str) -> DataFrame:
    """Datasets of a lineage run: nodes with children are inputs, leaves are outputs."""
    return nodes.select(
        F.when(F.col("downstream") > 0, F.lit("input")).otherwise(F.lit("output")).alias("role"),
        F.lit(namespace).alias("namespace"),
        F.col("table_id").alias("name"),
        F.to_json(F.struct(F.col("type"), F.col("name").alias("name"))).alias("facets"),
    )


def lineage_events(
    datasets: DataFrame,
    namespace: str,
    job: str,
    producer: str,
    event_time: datetime,
    per_event: int = 10_000,
) -> DataFrame:
    """Run events as JSON rows, each holding at most `per_event` datasets.

    One event for a whole graph would be gathered in one task, so a large graph is spread over
    several events of the same run. Which event a dataset joins depends on its name alone.
    """
    total = datasets.agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * 2 / F.lit(per_event))).alias("n")
    ).scalar()
    part = F.pmod(F.xxhash64("role", "name"), total.cast("bigint")).alias("part")
    item = F.struct("namespace", "name", F.col("facets"))

    def of(role: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("role") == role, item)))

    grouped = datasets.withColumn("part", part).groupBy("part")
    rows = grouped.agg(of("input").alias("inputs"), of("output").alias("outputs"))
    stamp = event_time.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    body = F.struct(
        F.lit("COMPLETE").alias("eventType"),
        F.lit(stamp).alias("eventTime"),
        F.lit(producer).alias("producer"),
        F.lit("https://openlineage.io/spec/1-0-2/OpenLineage.json").alias("schemaUrl"),
        F.struct(F.lit(namespace).alias("namespace"), F.lit(job).alias("name")).alias("job"),
        "inputs",
        "outputs",
    )
    return rows.select("part", F.to_json(body).alias("event"))


def exposures(tables: DataFrame, usage: DataFrame | None = None, prefix: str = "governed") -> DataFrame:
    """dbt exposures as JSON rows; `usage`: identity, `monthly_queries`, `p99_latency_ms`,
    `top_consumers`, `governance_tier`."""
    joined = tables if usage is None else tables.join(usage, ID, "left")
    name = F.lower(F.concat_ws("_", F.lit(prefix), "schema_name", "table_name"))
    table_id = F.concat_ws(".", *ID)
    fields = [
        name.alias("name"),
        F.lit("application").alias("type"),
        F.lit("high").alias("maturity"),
        F.concat(F.lit("Managed table '"), table_id, F.lit("'.")).alias("description"),
        F.array(F.concat(F.lit("ref('"), F.col("table_name"), F.lit("')"))).alias("depends_on"),
    ]
    if usage is not None:
        fields.append(
            F.struct("monthly_queries", "p99_latency_ms", "top_consumers", "governance_tier").alias(
                "meta"
            )
        )
    return joined.select(table_id.alias("table_id"), F.to_json(F.struct(*fields)).alias("exposure"))


def service_document(tables: DataFrame) -> DataFrame:
    return tables.select(
        F.concat_ws("_", *ID).alias("name"),
        F.lit("EntitySet").alias("kind"),
        F.concat_ws("/", *ID).alias("url"),
    )


def schema_rows(tables: DataFrame, columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Entity properties: EDM type, key flag, nullability; `id` stands in where columns lack.

    `keys`: identity and `column_name` per key column; a table without keys has the key `id`.
    """
    keyed = keys.select(*ID, F.lower("column_name").alias("__c"), F.lit(True).alias("__key"))
    with_keys = keys.select(*ID).distinct().withColumn("__has", F.lit(True))
    named = columns.withColumn("__c", F.lower("column_name"))
    listed = (
        tables.select(*ID, F.lit(True).alias("__t"))
        .join(named, ID, "left")
        .join(keyed, [*ID, "__c"], "left")
        .join(with_keys, ID, "left")
    )
    missing = F.col("column_name").isNull()
    is_key = (
        F.coalesce("__key", F.lit(False))
        | (F.col("__has").isNull() & (F.coalesce("__c", F.lit("id")) == "id"))
        | missing
    )
    return listed.select(
        F.concat_ws("_", *ID).alias("entity"),
        F.coalesce("column_name", F.lit("id")).alias("property"),
        F.when(missing, F.lit("Edm.Int32")).otherwise(edm_type(F.col("data_type"))).alias("edm_type"),
        is_key.alias("is_key"),
        (~is_key).alias("nullable"),
        blank_to_null(F.col("description")).alias("description"),
    )


def _ticket_text(order: Sequence[str]) -> Column:
    percent = F.coalesce(
        F.concat(F.round(F.col("confidence") * 100).cast("int").cast("string"), F.lit("%")),
        F.lit("N/A"),
    )
    lines = {
        "Tenant": F.col("tenant_id"),
        "Requester SID": F.col("requester"),
        "Target Table": F.col("target_table"),
        "Requested Duration": F.concat(F.col("days").cast("string"), F.lit(" days")),
        "Justification": F.col("justification"),
        "Triage Category": F.coalesce("category", F.lit("Standard")),
        "Triage Confidence": percent,
    }
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), lines[k]) for k in order])


_TAIL = ["Requested Duration", "Justification", "Triage Category", "Triage Confidence"]


def servicenow_tickets(requests: DataFrame, label: str, prefix: str) -> DataFrame:
    """Outbox rows `(request_id, body)`; `requests`: `request_id`, `tenant_id`, `requester`,
    `target_table`, `days`, `justification`, `category`, `confidence`, `requested_at`."""
    seconds = F.unix_seconds(F.col("requested_at").cast("timestamp")).cast("string")
    body = F.struct(
        F.concat(F.lit(f"[{label}] "), F.col("target_table")).alias("short_description"),
        _ticket_text(["Tenant", "Requester SID", "Target Table", *_TAIL]).alias("description"),
        F.lit("2").alias("urgency"),
        F.lit("2").alias("priority"),
        F.concat_ws("-", F.lit(prefix), "tenant_id", "requester", seconds).alias("correlation_id"),
    )
    return requests.select("request_id", F.to_json(body).alias("body"))


def jira_tickets(
    requests: DataFrame, label: str, project: str = "SEC", issue_type: str = "Task"
) -> DataFrame:
    """Outbox rows `(request_id, body)` with the description as a document tree."""
    text = _ticket_text(["Requester SID", "Tenant", "Target Table", *_TAIL])
    leaf = F.struct(F.lit("text").alias("type"), text.alias("text"))
    paragraph = F.struct(F.lit("paragraph").alias("type"), F.array(leaf).alias("content"))
    document = F.struct(
        F.lit("doc").alias("type"), F.lit(1).alias("version"), F.array(paragraph).alias("content")
    )
    summary = F.concat(
        F.lit(f"[{label}] "), F.col("target_table"), F.lit(" for "), F.col("requester")
    )
    fields = F.struct(
        F.struct(F.lit(project).alias("key")).alias("project"),
        summary.alias("summary"),
        document.alias("description"),
        F.struct(F.lit(issue_type).alias("name")).alias("issuetype"),
    )
    return requests.select("request_id", F.to_json(F.struct(fields.alias("fields"))).alias("body"))


def ticket_references(responses: DataFrame, base_url: str, table: str = "change_request") -> DataFrame:
    """Reference or error code per response `(request_id, system, http_status, body)`."""
    root = base_url.rstrip("/")
    record = F.from_json(
        "body", "struct<result:struct<sys_id:string,number:string>,key:string,id:string>"
    )
    rows = responses.withColumn("__r", record)
    ok = F.col("http_status").between(200, 299)
    now = F.lower("system") == "servicenow"
    result = F.col("__r.result")
    issue = F.coalesce("__r.key", "__r.id")
    error = F.when(~ok, F.lit("ITSM_UNAVAILABLE")).when(
        now & result.isNull(), F.lit("INVALID_RESPONSE")
    )
    ticket = F.when(
        now, F.coalesce(result["number"], result["sys_id"], F.lit("SN-TICKET"))
    ).otherwise(F.coalesce(issue, F.lit("JIRA-TICKET")))
    link = F.when(
        now,
        F.concat(
            F.lit(f"{root}/nav_to.do?uri={table}.do?sys_id="),
            F.coalesce(result["sys_id"], F.lit("")),
        ),
    ).otherwise(F.concat(F.lit(f"{root}/browse/"), F.coalesce(issue, F.lit(""))))
    good = error.isNull()
    return rows.select(
        "request_id",
        F.when(good, ticket).alias("ticket_id"),
        F.when(good, link).alias("ticket_url"),
        error.alias("error_code"),
    )
