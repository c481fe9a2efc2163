"""Keyed streams against their batch operators, with replayed and re-ordered micro-batches."""

from __future__ import annotations

import hashlib
import hmac
import json
import random
from datetime import datetime, timedelta, timezone
from itertools import permutations

import pytest

from lakewarden.functions.crypto import key_table
from lakewarden.operators.dedupe import mark_duplicates
from lakewarden.operators.rate_limit import limit_calls
from lakewarden.plans.events import process_ticket_events
from lakewarden.streaming.events import first_deliveries
from lakewarden.streaming.rate_limit import limit_stream
from lakewarden.streaming.tables import read_table
from lakewarden.streaming.tickets import current_requests, keep_transitions, marked_ticket_stream

T0 = datetime(2026, 3, 1, 12, tzinfo=timezone.utc)


def land(df, path, n):
    df.coalesce(1).write.mode("append").parquet(f"{path}/part={n}")


def stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def collected(spark, df, name, checkpoint):
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def test_redelivery_after_the_time_to_live_counts_again(spark, rows, tmp_path):
    schema = "n int, key string, received_at timestamp"
    minutes = [[0, 3, 14], [15, 20], [36, 50, 51], [90]]
    items, n = [], 0
    for part in minutes:
        items.append([])
        for m in part:
            for key in ("a", "b"):
                items[-1].append((n, key, T0 + timedelta(minutes=m, seconds=key == "b")))
                n += 1
    for i, part in enumerate(items):
        land(spark.createDataFrame(part, schema), str(tmp_path / "in"), i)
    got = collected(spark, first_deliveries(stream(spark, schema, tmp_path / "in"), "key", 900), "redelivered", str(tmp_path / "cp"))
    everything = spark.createDataFrame([x for part in items for x in part], schema)
    batch = mark_duplicates(everything, "key", "received_at", "n", 900).where("not is_duplicate")
    assert rows(got, "n") == rows(batch, "n") and got.count() == 8


@pytest.mark.parametrize("seed", range(2))
def test_hot_caller_is_walked_by_chunks(spark, rows, tmp_path, seed):
    r = random.Random(seed)
    calls = [(i, "hot" if i % 3 == 0 else f"u{i % 11}", T0 + timedelta(milliseconds=100 * i + r.randint(0, 50))) for i in range(900)]
    schema = "id int, who string, at timestamp"
    for n in range(3):  # every file holds its calls in no order
        part = calls[n * 300 : n * 300 + 300]
        r.shuffle(part)
        land(spark.createDataFrame(part, schema), str(tmp_path / "in"), n)
    for conf in ("spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        spark.conf.set(conf, "20")
    try:
        flagged = limit_stream(stream(spark, schema, tmp_path / "in"), "who", "at", size=4, seconds=5, chunk_seconds=7)
        got = collected(spark, flagged, f"limited{seed}", str(tmp_path / "cp"))
    finally:
        for conf in ("spark.sql.execution.arrow.transformWithStateInPandas.maxRecordsPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"):
            spark.conf.unset(conf)
    batch = limit_calls(spark.createDataFrame(calls, schema), "who", "at", "id", 4, 5)
    assert rows(got, "id", "is_limited") == rows(batch, "id", "is_limited")
    assert {x.is_limited for x in got.where("who = 'hot'").collect()} == {True, False}


DELIVERY = "n int, payload string, signature string, sent_at timestamp, raw_timestamp string, instance string, received_at timestamp"


def ticket(n, minutes, ticket_id, action="APPROVE", instance="sn1", secret="k1", **more):
    at = T0 + timedelta(minutes=minutes)
    text = json.dumps({"ticketId": ticket_id, "instanceId": instance, "action": action, **more})
    raw = f"{int(at.timestamp())}"
    signed = hmac.new(secret.encode(), f"t={raw}.v1={text}".encode(), hashlib.sha256).hexdigest()
    return (n, text, signed, at, raw, None, at)


PARTS = [
    [ticket(1, 0, "T1", eventId="e1", approver="ann"), ticket(2, 1, "T2", "reject"), ticket(3, 2, "T1", "REJECT", eventId="e1")],
    [ticket(4, 5, "T1", "REJECT"), ticket(5, 6, "T3", eventId="e3", secret="wrong"), ticket(6, 7, "T3", eventId="e3")],
    [ticket(7, 16, "T1", "REJECT", eventId="e1"), ticket(8, 8, "T4", "maybe", eventId="e8"), ticket(9, 9, "T4", eventId="e8"), ticket(10, 4, "T5"), ticket(11, 3, "T3", "REJECT", eventId="e9")],
]


@pytest.mark.parametrize("order", list(permutations(range(3)))[::2])
def test_tickets_agree_in_every_order_of_batches(spark, rows, tmp_path, order):
    keys = key_table(spark, {"sn1": "k1"})
    instances = spark.createDataFrame([("SN1", "A")], "instance_id string, tenant_id string")
    requests = spark.createDataFrame(
        [(i, f"T{i}", "A", "ACTIVE" if i == 5 else "PENDING_EXTERNAL_APPROVAL") for i in range(1, 6)],
        "request_id int, ticket_id string, tenant_id string, status string",
    )
    tick = ticket(99, 24 * 60, "T9")  # a much later delivery lets the watermark pass the others
    landed = [PARTS[n] for n in order] + [[tick]]
    root = str(tmp_path / "transitions")
    for n, part in enumerate(landed):
        land(spark.createDataFrame(part, DELIVERY), str(tmp_path / "in"), n)
    deliveries = stream(spark, DELIVERY, tmp_path / "in")
    marked = marked_ticket_stream(deliveries, keys, instances, requests, "n", late="1 hour")
    keep_transitions(marked, root, "n", str(tmp_path / "cp")).awaitTermination()
    everything = spark.createDataFrame([x for part in landed for x in part], DELIVERY)
    batch = process_ticket_events(everything, keys, instances, requests, "n")
    got = read_table(spark, root, batch.schema.add("batch_id", "long"))
    columns = ["n", "request_id", "outcome", "new_status", "reject_text", "actor"]
    assert rows(got, *columns) == rows(batch, *columns)
    status = {x.request_id: x.status for x in current_requests(requests, got).collect()}
    assert status == {1: "ACTIVE", 2: "REJECTED", 3: "REJECTED", 4: "ACTIVE", 5: "ACTIVE"}


def test_a_repeated_micro_batch_writes_the_same(spark, rows, tmp_path):
    from lakewarden.streaming.tables import write_batch

    root, schema = str(tmp_path / "t"), "n int, v string, batch_id bigint"
    assert read_table(spark, root, schema).count() == 0
    for batch_id, v in ((0, "a"), (1, "b"), (1, "c")):
        write_batch(spark.createDataFrame([(batch_id, v)], "n int, v string"), root, batch_id)
    assert rows(read_table(spark, root, schema)) == [(0, "a", 0), (1, "c", 1)]
