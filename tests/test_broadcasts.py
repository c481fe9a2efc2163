"""Joins of tables that grow are not broadcast for want of a right estimate."""

from __future__ import annotations

from lakewarden.operators.proposals import sync_descriptions
from lakewarden.operators.tickets import bind_requests
from lakewarden.plans.queries import QUERIES
from lakewarden.plans.registry import TASK_BYTES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_descriptions_meet_by_shuffles(spark):
    known = ["concat('t', id) AS table_id", "'old' AS description", "CAST(NULL AS STRING) AS long_description"]
    found = ["concat('T', id) AS table_id", "'new' AS description", "map('x', 'y') AS meta"]
    tables, models = (spark.range(1).selectExpr(*c) for c in (known, found))
    columns, model_cols = (spark.range(1).selectExpr(*c, "concat('c', id) AS column_name") for c in (known, found))
    for df in sync_descriptions(tables, columns, models, model_cols):
        assert "BroadcastHashJoin" not in plan_of(df)
        assert [r.description for r in df.collect()] == ["new"]


def test_a_million_parts_are_not_broadcast(spark, tmp_path):
    part = spark.range(1_200_000).selectExpr("id AS p_partkey", "concat('hot bolt', id % 9) AS p_name")
    part.write.parquet(f"{tmp_path}/part.parquet")
    before = spark.conf.get("spark.sql.sources.fileCompressionFactor")
    try:
        QUERIES["team_identifiers"](spark, "/root/testdata/sf0.001")
        parts = spark.read.parquet(f"{tmp_path}/part.parquet")
        plan = plan_of(parts.join(parts.select("p_partkey"), "p_partkey"))
    finally:
        spark.conf.set("spark.sql.sources.fileCompressionFactor", before)
    assert "BroadcastHashJoin" not in plan


def test_tasks_of_registered_queries_read_little(spark):
    """Whatever the tables' size, a task of a registered query reads few bytes of a file or a shuffle."""
    before = {limit: spark.conf.get(limit) for limit in TASK_BYTES}
    try:
        for limit in TASK_BYTES:
            spark.conf.unset(limit)
        QUERIES["contract_changes"](spark, "/root/testdata/sf0.001")
        assert {limit: spark.conf.get(limit) for limit in TASK_BYTES} == TASK_BYTES
        assert all(int(size.removesuffix("m")) <= 32 for size in TASK_BYTES.values())
    finally:
        for limit, size in before.items():
            spark.conf.set(limit, size)


def test_deliveries_are_not_dealt_by_their_instance(spark):
    checked = [("i1", f"t{n}", "APPROVE", None) for n in range(4)] + [("i2", "t0", "APPROVE", None)]
    checked = spark.createDataFrame(checked, "instance_id string, ticket_id string, action string, reject_reason string")
    instances = spark.createDataFrame([("I1", "a")], "instance_id string, tenant_id string")
    requests = spark.createDataFrame([(0, "t0", "a", "x")], "request_id int, ticket_id string, tenant_id string, status string")
    bound = bind_requests(checked, instances, requests)
    assert "hashpartitioning(lower(instance_id" not in plan_of(bound)
    found = sorted((r.instance_id, r.ticket_id, r.reject_reason) for r in bound.collect())
    unknown = [("i1", f"t{n}", "UNKNOWN_TICKET") for n in (1, 2, 3)]
    assert found == [("i1", "t0", None), *unknown, ("i2", "t0", "UNMAPPED_INSTANCE")]
