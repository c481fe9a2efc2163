from __future__ import annotations

import base64
import hashlib
import hmac
import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakewarden.fixed_values import TRIAGE_MAX_CHARS
from lakewarden.functions.crypto import key_table
from lakewarden.operators.routing import epoch_increments, policy_events, run_events
from lakewarden.operators.tickets import (
    bound_status_changes,
    parse_status_changes,
    stored_status_changes,
    tenant_epochs,
)
from lakewarden.operators.triage import triage
from lakewarden.operators.verify import iso_timestamp, rejection, verify_payload, verify_timestamped
from lakewarden.plans.events import (
    catalog_epochs,
    process_catalog_events,
    process_ticket_events,
    triage_requests,
)
from lakewarden.sources.deliveries import (
    DELIVERY_SCHEMA,
    quarantine_oversized,
    read_deliveries,
    stream_deliveries,
)
from lakewarden.streaming.events import catalog_event_stream, epoch_stream, ticket_event_stream
from lakewarden.streaming.rate_limit import triage_stream

T0 = datetime(2026, 3, 1, 12, 0, 0, tzinfo=timezone.utc)
SECRET = "s3cret"


def sign(message, secret=SECRET):
    return hmac.new(secret.encode(), message.encode(), hashlib.sha256).hexdigest()


def delivery(n, payload, sent=T0, received=T0, signature=None, instance=None, raw=None):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    if signature is None and sent is not None:
        signature = sign(f"{int(sent.timestamp())}.{text}")
    return (n, text, signature, sent, raw, instance, received)


def frame(spark, items):
    return spark.createDataFrame(
        items,
        "n int, payload string, signature string, sent_at timestamp, raw_timestamp string, "
        "instance string, received_at timestamp",
    )


CHANGE = {"eventType": "x", "entityType": "table", "entityFullyQualifiedName": "sales_dw.public.orders"}


def statuses(spark, items, **options):
    keys = key_table(spark, {"catalog": SECRET})
    done = process_catalog_events(frame(spark, items), keys, "catalog", "n", **options)
    return {r.n: r.status for r in done.collect()}, done


def test_catalog_event_checks(spark):
    text = json.dumps(CHANGE)
    late = T0 - timedelta(minutes=6)
    got, done = statuses(
        spark,
        [
            delivery(1, CHANGE),
            delivery(2, {**CHANGE, "id": 1}, signature="ab" * 32),
            delivery(3, {**CHANGE, "id": 2}, sent=late),
            delivery(4, {**CHANGE, "id": 3}, sent=None, signature="ab" * 32),
            delivery(5, {**CHANGE, "id": 4}, signature=" "),
            delivery(6, [{"eventType": "e", "data": {"qualifiedName": "ledger/books"}}]),
            delivery(7, {"entityType": "dashboard"}),
            delivery(8, "not json"),
            delivery(9, text, received=T0 + timedelta(minutes=1)),
            delivery(10, text, signature=sign(text)),
        ],
    )
    assert got == {
        1: "INVALIDATED",
        2: "REJECTED_INVALID_SIGNATURE",
        3: "REJECTED_TIMESTAMP_EXPIRED",
        4: "REJECTED_MISSING_TIMESTAMP",
        5: "REJECTED_MISSING_SIGNATURE",
        6: "INVALIDATED",
        7: "IGNORED_NO_RELEVANT_TABLES",
        8: "IGNORED_NO_RELEVANT_TABLES",
        9: "IGNORED_DUPLICATE_EVENT",
        10: "REJECTED_INVALID_SIGNATURE",
    }
    epochs = {(r.domain, r.schema_name, r.table_name): r.increments for r in catalog_epochs(done).collect()}
    assert epochs == {("sales_dw", "public", "orders"): 1, ("ledger", "public", "books"): 1}


def test_base64_and_legacy_signatures(spark):
    text = json.dumps(CHANGE)
    raw = hmac.new(SECRET.encode(), f"{int(T0.timestamp())}.{text}".encode(), hashlib.sha256).digest()
    items = [
        delivery(1, text, signature=base64.b64encode(raw).decode()),
        delivery(2, json.dumps({**CHANGE, "id": "z"}), signature=sign(json.dumps({**CHANGE, "id": "z"}))),
    ]
    assert statuses(spark, items)[0][2] == "REJECTED_INVALID_SIGNATURE"
    assert set(statuses(spark, items, legacy_payload_only=True)[0].values()) == {"INVALIDATED"}


def test_replay_with_new_timestamp_and_rejected_first_try(spark):
    event = {**CHANGE, "id": "e1"}
    later, much_later = T0 + timedelta(minutes=2), T0 + timedelta(minutes=20)
    got, _ = statuses(
        spark,
        [
            delivery(1, event, signature="00" * 32),
            delivery(2, event, received=T0 + timedelta(seconds=1)),
            delivery(3, event, sent=later, received=later),
            delivery(4, event, sent=much_later, received=much_later),
        ],
    )
    assert [got[n] for n in (1, 2, 3, 4)] == [
        "REJECTED_INVALID_SIGNATURE",
        "INVALIDATED",
        "IGNORED_DUPLICATE_EVENT",
        "INVALIDATED",
    ]


def test_affected_table_shapes(spark):
    from lakewarden.operators.routing import affected_tables, with_parsed_payload

    cases = {
        '{"entityType":"TABLE","entityFullyQualifiedName":"a.b.c.d"}': [("a", "c", "d")],
        '{"entityType":"table","entityFullyQualifiedName":"a.b"}': [("a", "public", "b")],
        '{"entityType":"table","entityFullyQualifiedName":"a"}': [],
        '{"assetName":"t","domainName":null}': [("default", "public", "t")],
        '{"assetName":"t"}': [],
        '{"assetName":" ","domainName":"d"}': [],
        '[{"eventType":"e","data":{"qualifiedName":"a/x/b"}},{"data":{"qualifiedName":"q/r"}},5]': None,
        '[{"eventType":"e","data":{"qualifiedName":"a/x/b"}},{"eventType":"f","data":{}}]': [("a", "public", "b")],
    }
    df = spark.createDataFrame([(p,) for p in cases], "payload string")
    parsed = with_parsed_payload(df).select("payload", affected_tables(F.col("fields"), F.col("items")).alias("t"))
    for row in parsed.collect():
        if cases[row.payload] is not None:
            assert [tuple(t) for t in row.t] == cases[row.payload], row.payload


@pytest.mark.parametrize("flip", [0, 7, -1])
def test_tampered_payload_never_verifies(spark, flip):
    text = json.dumps(CHANGE)
    changed = list(text)
    changed[flip] = "~"
    good = delivery(1, text)
    bad = (2, "".join(changed), *good[2:])
    checked = verify_timestamped(frame(spark, [good, bad]), key_table(spark, {"k": SECRET}), "k")
    assert {r.n: r.signature_valid for r in checked.collect()} == {1: True, 2: False}
    unknown = verify_timestamped(frame(spark, [good]), key_table(spark, {"k": SECRET}), "other")
    assert unknown.select(rejection()).first()[0] == "REJECTED_INVALID_SIGNATURE"


def test_policy_and_run_events(spark):
    def body(**fields):
        return json.dumps(fields)

    second, milli = int(T0.timestamp()), int(T0.timestamp() * 1000)
    bodies = [
        body(id="a", timestamp=milli, entityType="table", entityFullyQualifiedName="a.b.c"),
        body(id="b", timestamp=second, entityType="Role"),
        body(id="c", timestamp=second, entityType="glossary"),
        body(timestamp=second, entityType="user"),
        body(id="d", timestamp=second - 301, entityType="user"),
    ]
    items = [delivery(i, b, signature="SHA256=" + sign(b).upper()) for i, b in enumerate(bodies)]
    checked = verify_payload(frame(spark, items), key_table(spark, {"k": SECRET}), "k")
    got = {r.n: (r.route, r.reject_reason) for r in policy_events(checked).collect()}
    assert got == {
        0: ("REFRESH_TABLE", None),
        1: ("FULL_SYNC", None),
        2: ("ACKNOWLEDGE", None),
        3: (None, "MISSING_ID_OR_TIME"),
        4: (None, "EXPIRED"),
    }
    runs = [
        body(eventId="r", timestamp="2026-03-01T12:01:00Z", data={"runId": "9", "runStatus": "Success"}),
        body(timestamp="2026-03-01T12:01:00Z"),
        "[",
    ]
    items = [delivery(i, b, signature=sign(b)) for i, b in enumerate(runs)]
    checked = verify_payload(frame(spark, items), key_table(spark, {"k": SECRET}), "k")
    got = {r.n: (r.event_type, r.run_id, r.run_status, r.reject_reason) for r in run_events(checked).collect()}
    assert got[0] == ("job_run.completed", "9", "Success", None)
    assert got[1][3] == "MISSING_ID_OR_TIME" and got[2][3] == "MALFORMED"


TICKETS = [
    ({"ticketId": "T1", "instanceId": "i", "action": "APPROVE", "eventId": "e", "approver": "bob"}, ("T1", "i", "APPROVE", None, "ITSM", "e", "bob")),
    ({"TicketId": "T2", "InstanceId": "i"}, ("T2", "i", "REJECT", None, "ITSM", None, None)),
    ({"number": "C1", "instance_name": "i", "approval": "Approved", "close_notes": "ok", "sys_updated_by": "x"}, ("C1", "i", "APPROVE", "ok", "ServiceNow", None, "x")),
    ({"sys_id": "S", "instance_id": "i", "state": 4, "work_notes": "no"}, ("S", "i", "REJECT", "no", "ServiceNow", None, None)),
    ({"number": "C2", "instance_name": "i", "state": "approved"}, ("C2", "i", "APPROVE", None, "ServiceNow", None, None)),
    ({"issue": {"key": "J1", "fields": {"status": {"name": "Approved"}, "resolution": None}}, "baseUrl": "i", "user": {"accountId": "a"}}, ("J1", "i", "APPROVE", None, "Jira", None, "a")),
    ({"issue": {"key": "J2", "fields": {"status": {"name": "Authorized"}, "resolution": {"name": "Won't do"}}}, "baseUrl": "i"}, ("J2", "i", "REJECT", "Won't do", "Jira", None, None)),
    ({"instanceId": "i"}, (None, "i", "REJECT", None, "ITSM", None, None)),
    ("{", (None, None, "REJECT", None, "ITSM", None, None)),
]


def test_ticket_shapes(spark):
    df = frame(spark, [delivery(i, p) for i, (p, _) in enumerate(TICKETS)])
    got = parse_status_changes(df).orderBy("n").select(
        "ticket_id", "instance_id", "action", "reason", "system", "event_id", "approver"
    )
    assert [tuple(r) for r in got.collect()] == [w for _, w in TICKETS]


def ticket(n, payload, minutes=0, raw="h", instance=None, secret="k1", iso=False):
    at = T0 + timedelta(minutes=minutes)
    text = json.dumps(payload)
    stamp = at.strftime("%Y-%m-%dT%H:%M:%S.%f") + "0+00:00" if iso else raw
    return (n, text, sign(f"t={stamp}.v1={text}", secret), at, raw, instance, at)


def test_ticket_transitions(spark):
    def change(ticket_id, action="APPROVE", instance="sn1", **more):
        return {"ticketId": ticket_id, "instanceId": instance, "action": action, **more}

    items = [
        ticket(1, change("T1", eventId="e1", approver="ann")),
        ticket(2, change("T1", eventId="e1", approver="ann"), minutes=1),
        ticket(3, change("T1", "REJECT"), minutes=2),
        ticket(4, change("T2", "reject"), iso=True),
        ticket(5, change("T3", instance="sn2")),
        ticket(6, change("T3", instance="sn9"), secret="k9"),
        ticket(7, change("T4", "maybe", eventId="e7")),
        ticket(8, change("T4", eventId="e7"), minutes=1),
        ticket(9, change("T5")),
        ticket(10, change("T2"), secret="wrong"),
        ticket(11, change("T2"), instance="other"),
        ticket(12, change("T6")),
    ]
    keys = key_table(spark, {"sn1": "k1", "sn2": "k1", "sn9": "k9"})
    instances = spark.createDataFrame([("SN1", "A"), ("sn2", "B")], "instance_id string, tenant_id string")
    requests = spark.createDataFrame(
        [
            (1, "T1", "A", "PENDING_EXTERNAL_APPROVAL"),
            (2, "T2", "A", "pending_external_approval"),
            (3, "T3", "A", "PENDING_EXTERNAL_APPROVAL"),
            (4, "T4", "A", "PENDING_EXTERNAL_APPROVAL"),
            (5, "T5", "A", "ACTIVE"),
        ],
        "request_id int, ticket_id string, tenant_id string, status string",
    )
    done = process_ticket_events(frame(spark, items), keys, instances, requests, "n")
    got = {r.n: r for r in done.collect()}
    assert {n: r.outcome for n, r in got.items()} == {
        1: "APPROVED",
        2: "REPLAY",
        3: "ALREADY_DECIDED",
        4: "REJECTED",
        5: "UNKNOWN_TICKET",
        6: "UNMAPPED_INSTANCE",
        7: "UNKNOWN_ACTION",
        8: "APPROVED",
        9: "ALREADY_DECIDED",
        10: "INVALID_SIGNATURE",
        11: "INSTANCE_MISMATCH",
        12: "UNKNOWN_TICKET",
    }
    assert (got[1].new_status, got[1].actor) == ("ACTIVE", "ITSM_ITSM:sn1:ann")
    assert (got[4].new_status, got[4].reject_text, got[4].actor) == ("REJECTED", "Rejected via ITSM webhook", "ITSM_ITSM:sn1")
    assert [tuple(r) for r in tenant_epochs(done).collect()] == [("A", 2)]


def test_stored_tickets_equal_bound_ones(spark, rows):
    payloads = [{"ticketId": f"T{n % 5}", "instanceId": "sn1", "action": "APPROVE", "eventId": f"e{n}"} for n in range(12)]
    items = [ticket(n, p, secret="k1" if n % 4 else "wrong") for n, p in enumerate([*payloads, {"instanceId": "sn1"}])]
    keys = key_table(spark, {"sn1": "k1"})
    instances = spark.createDataFrame([("SN1", "A")], "instance_id string, tenant_id string")
    open_ones = [(n, f"T{n}", "A", "pending_external_approval") for n in range(4)]
    requests = spark.createDataFrame([*open_ones, (9, "T1", "A", "ACTIVE")], "request_id int, ticket_id string, tenant_id string, status string")

    def scratch():
        return set(Path(spark.conf.get("spark.checkpoint.dir")).glob("scratch-*"))

    before = scratch()
    given = frame(spark, items), keys, instances, requests, "n"
    got, bound = stored_status_changes(*given), bound_status_changes(*given)
    assert scratch() == before
    same = ("n", "received_at", "tenant_id", "request_id", "request_status", "ticket_id", "reject_reason")
    assert rows(got, *same) == rows(bound, *same)
    assert got.columns == bound.columns
    told = {(r.n, r.request_id): (r.action, r.reject_reason, r.request_status) for r in got.collect()}
    assert told[1, 1][0] == "APPROVE" and told[1, 9][0] is None and told[4, None] == (None, "INVALID_SIGNATURE", None)


def test_iso_timestamp(spark):
    df = spark.createDataFrame([(T0 + timedelta(microseconds=1),)], "t timestamp")
    assert df.select(iso_timestamp(F.col("t"))).first()[0] == "2026-03-01T12:00:00.0000010+00:00"


def land(spark, items, path, files=3):
    frame(spark, items).select(
        "payload", "signature", "sent_at", "raw_timestamp", "instance", "received_at"
    ).coalesce(1).write.json(path)


def test_catalog_stream_equals_batch(spark, rows, tmp_path):
    items = [delivery(i, {**CHANGE, "id": f"e{i % 6}", "entityFullyQualifiedName": f"d.s.t{i % 3}"}, received=T0 + timedelta(seconds=i)) for i in range(20)]
    items.append(delivery(99, {**CHANGE, "id": "bad"}, signature="00" * 32))
    for n, part in enumerate((items[:7], items[7:14], items[14:])):
        land(spark, part, str(tmp_path / "in" / f"part={n}"))
    keys = key_table(spark, {"catalog": SECRET})
    stream = stream_deliveries(spark, str(tmp_path / "in" / "*"), files_per_trigger=1)
    out = catalog_event_stream(stream, keys, "catalog")
    query = out.writeStream.format("memory").queryName("invalidated").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = process_catalog_events(
        read_deliveries(spark, str(tmp_path / "in" / "*")).withColumn("n", F.monotonically_increasing_id()),
        keys,
        "catalog",
        "n",
    )
    assert rows(epoch_increments(spark.table("invalidated"))) == rows(catalog_epochs(batch))
    counted = epoch_stream(out).writeStream.format("memory").queryName("epochs").outputMode("complete")
    counted.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("epochs").agg(F.sum("increments")).first()[0] == 6


def test_ticket_stream(spark, tmp_path):
    items = [ticket(i, {"ticketId": "T", "instanceId": "sn1", "n": i % 4}) for i in range(8)]
    land(spark, items, str(tmp_path / "in"))
    keys = key_table(spark, {"sn1": "k1"})
    out = ticket_event_stream(stream_deliveries(spark, str(tmp_path / "in")), keys)
    out.select("ticket_id").writeStream.format("memory").queryName("changes").trigger(
        availableNow=True
    ).start().awaitTermination()
    assert spark.table("changes").count() == 4


def test_oversized_payloads_are_set_aside(spark):
    df = spark.createDataFrame([("x" * 20,), ("x",), (None,)], "payload string")
    good, big = quarantine_oversized(df, cap=10)
    assert (good.count(), big.count()) == (2, 1)
    assert "payload" in DELIVERY_SCHEMA


CASES = {
    "Please BYPASS audit": ("SuspiciousExfiltration", 0.99),
    "will leak the audit": ("SuspiciousExfiltration", 0.95),
    "SOX review of the incident": ("LegitimateAudit", 0.98),
    "p1 test in production": ("IncidentTriage", 0.98),
    "the latest figures": ("Unjustified", 0.90),
    "short": ("Unjustified", 0.90),
    "monthly revenue report": ("Unclassified", 0.50),
    "x" * 501 + " audit": ("LegitimateAudit", 0.98),
}


def test_triage(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "text string")
    got = {r.text: (r.category, r.confidence) for r in triage(df, "text").collect()}
    assert got == CASES
    capped = triage(df, "text", max_chars=TRIAGE_MAX_CHARS).where(F.length("text") > 500).first()
    assert capped.category == "Unclassified"
    words = triage(df, "text", whole_words=True).where("text = 'the latest figures'").first()
    assert words.category == "Unclassified"
    hashed = triage(df, "text").where("text_hash is not null").collect()
    assert len(hashed) == 1 and len(hashed[0].text_hash) == 12


def test_rate_limited_triage_in_batch_and_stream(spark, rows, tmp_path):
    data = [(i, "u1", T0 + timedelta(seconds=i // 10), "audit of books") for i in range(25)]
    df = spark.createDataFrame(data, "id int, who string, at timestamp, text string")
    batch = triage_requests(df, "who", "at", "id", "text")
    limited = batch.where("is_limited").collect()
    assert len(limited) == 5 and {r.category for r in limited} == {"Unclassified"}
    assert {r.confidence for r in limited} == {0.0}
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    triage_stream(stream, "who", "at", "text").writeStream.format("memory").queryName("triaged").outputMode(
        "append"
    ).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("triaged"), "id", "is_limited") == rows(batch, "id", "is_limited")


def test_repeated_events_are_skipped(spark, rows):
    from lakewarden.plans.events import skip_repeated

    schema = "n int, event_id string, received_at timestamp, reject_reason string, route string"
    at = [datetime(2026, 1, 1, 0, m) for m in (0, 1, 2, 16, 17)]
    events = [(0, "a", at[0], "EXPIRED", None), (1, "a", at[1], None, "FULL_SYNC"), (2, "a", at[2], None, "FULL_SYNC"), (3, "a", at[3], None, "FULL_SYNC"), (4, "a", at[4], None, "FULL_SYNC"), (5, "b", at[4], None, "ACKNOWLEDGE")]
    got = skip_repeated(spark.createDataFrame(events, schema), "n")
    duplicate = "IGNORED_DUPLICATE_EVENT"
    assert rows(got, "n", "reject_reason", "route") == [(0, "EXPIRED", None), (1, None, "FULL_SYNC"), (2, duplicate, None), (3, duplicate, None), (4, None, "FULL_SYNC"), (5, None, "ACKNOWLEDGE")]
    again = got.select("n", "event_id", "received_at", "reject_reason")
    assert skip_repeated(again, "n").columns == again.columns
