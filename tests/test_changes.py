from __future__ import annotations

import json
from datetime import datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewarden.operators.cdc_apply import activity_windows, apply_changes, latest_changes
from lakewarden.sources.change_feed import (
    change_batch,
    clamp_batch,
    feed_events,
    feed_versions,
    next_watermark,
    resume_version,
)
from lakewarden.sources.debezium import parse_envelopes
from lakewarden.sources.feed_source import ChangeFeed
from lakewarden.streaming import tables
from lakewarden.streaming.cdc import (
    activity_stream,
    cdc_events,
    keep_activity,
    keep_snapshot,
    read_activity,
    read_snapshot,
    typed_changes,
)
from lakewarden.streaming.feed import publish_feed


def envelope(op, after=None, before=None, wrap=True, **source):
    body = {"op": op, "before": before, "after": after, "source": source or None}
    return json.dumps({"schema": {}, "payload": body} if wrap else body)


def raw(spark, messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "n int, value string")
    return df.withColumn("received_at", F.timestamp_seconds(F.lit(1_700_000_000)))


def test_envelopes(spark):
    messages = [
        envelope("c", {"id": 1, "Tenant_ID": "t1", "o": {"x": [1]}}, name="crm", schema="app", table="u", ts_ms=5),
        envelope("d", None, {"id": 1, "tenant_id": "old"}, wrap=False),
        envelope("r", {"id": 2}),
        envelope("zz", {"id": 2, "tenant_id": None}, {"tenant_id": "b"}),
        '{"after":{"id":9}}',
        "broken {",
    ]
    got = parse_envelopes(raw(spark, messages), default_tenant="dflt").orderBy("n").collect()
    assert [r.operation for r in got] == ["Insert", "Delete", "Snapshot", "Update", "Update", "Update"]
    assert [r.tenant_id for r in got] == ["t1", "old", "dflt", "b", "dflt", "dflt"]
    assert [r.malformed for r in got] == [False] * 5 + [True]
    assert (got[0].domain, got[0].schema_name, got[0].table_name, got[0].ts_ms) == ("crm", "app", "u", 5)
    assert (got[1].domain, got[1].schema_name, got[1].table_name) == ("default", "public", "unknown")
    assert got[1].ts_ms == 1_700_000_000_000 and got[0].after["o"] == '{"x":[1]}'
    again = parse_envelopes(raw(spark, messages)).orderBy("n").collect()
    assert [r.event_id for r in got] == [r.event_id for r in again]


def test_apply_changes(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 10)], "id int, v string, version int")
    events = spark.createDataFrame(
        [
            (1, "a2", 11, "Update"),
            (1, "a3", 12, "Update"),
            (2, None, 13, "Delete"),
            (2, "late", 13, "Update"),
            (3, "stale", 9, "Update"),
            (4, "new", 11, "Insert"),
            (5, None, 11, "Delete"),
        ],
        "id int, v string, version int, operation string",
    )
    once = apply_changes(target, events, ["id"], ["version"], version="version")
    assert rows(once) == [(1, "a3", 12), (3, "c", 10), (4, "new", 11)]
    assert rows(apply_changes(once, events.where("id <> 2"), ["id"], ["version"], version="version")) == rows(once)
    assert latest_changes(events, ["id"], ["version"]).count() == 5
    free = apply_changes(target, events.where("id = 3"), ["id"], ["version"])
    assert (3, "stale", 9) in rows(free)


def feed(spark):
    changes = spark.createDataFrame(
        [(1, "I", 1, 1), (2, "U", 2, 1), (3, "D", 3, 1), (3, "U", 1, 1), (3, "x", 4, 2), (4, "U", 2, 1)],
        "version long, op string, k1 int, k2 int",
    )
    base = spark.createDataFrame(
        [(1, 1, "t1", "PKv"), (2, 1, None, "b"), (4, 2, "t2", "c")],
        "k1 int, k2 int, tenant_id string, pk_note string",
    )
    return changes, base


def test_change_batches_end_at_a_version(spark, rows):
    changes, base = feed(spark)
    batch = change_batch(changes, base, ["k1", "k2"], 0, 3)
    assert sorted(r.version for r in batch.collect()) == [1, 2, 3, 3, 3]
    assert next_watermark(batch, 0).first()[0] == 3
    rest = change_batch(changes, base, ["k1", "k2"], 3, 3)
    assert [r.version for r in rest.collect()] == [4]
    empty = change_batch(changes, base, ["k1", "k2"], 4)
    assert empty.count() == 0 and next_watermark(empty, 4).first()[0] == 4
    assert [clamp_batch(n) for n in (None, 0, 9000)] == [500, 500, 5000]
    with pytest.raises(ValueError):
        change_batch(changes, base, ["k1; drop"], 0)


def test_feed_events(spark):
    changes, base = feed(spark)
    batch = change_batch(changes, base, ["k1", "k2"], 0)
    got = {r.event_id: r for r in feed_events(batch, "d", "t", ["k1", "k2"]).collect()}
    gone = got["d_t_3_3_1"]
    assert gone.operation == "Delete" and json.loads(gone.before) == {"k1": 3, "k2": 1} and gone.after is None
    assert got["d_t_3_4_2"].operation == "Update" and got["d_t_3_4_2"].tenant_id == "t2"
    assert json.loads(got["d_t_1_1_1"].after)["pk_note"] == "PKv"
    versions = feed_versions(changes).first()
    assert (versions.current_version, versions.min_valid_version) == (4, 1)
    assert resume_version(5, 10) == (9, True) and resume_version(12, 10) == (12, False)
    assert resume_version(5, None) == (5, False) and resume_version(-1, 0) == (0, True)


FEED = "version long, op string, k1 int, k2 int"


def published(spark, tmp_path, base, publish):
    spark.dataSource.register(ChangeFeed)
    stream = spark.readStream.format("change_feed").schema(FEED).load(str(tmp_path / "feed"))
    query = publish_feed(stream, base, ["k1", "k2"], "d", "t", publish, str(tmp_path / "cp"))
    query.awaitTermination()


def test_the_checkpoint_keeps_the_version(spark, tmp_path):
    changes, base = feed(spark)
    land = lambda condition: changes.where(condition).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    seen = []
    land("version = 1")
    published(spark, tmp_path, base, lambda e, n: seen.append({r.event_id for r in e.collect()}))
    assert seen == [{"d_t_1_1_1"}]
    land("version in (2, 3)")
    published(spark, tmp_path, base, lambda e, n: seen.append({r.event_id for r in e.collect()}))
    assert len(seen) == 2 and len(seen[1]) == 4 and not seen[0] & seen[1]
    published(spark, tmp_path, base, lambda e, n: seen.append({r.event_id for r in e.collect()}))
    assert len(seen) == 2


def test_stopped_between_publish_and_commit(spark, tmp_path):
    """The same event ids come again and none is lost, also when later versions land meanwhile."""
    changes, base = feed(spark)
    changes.where("version <= 3").coalesce(2).write.parquet(str(tmp_path / "feed"))
    seen = []

    def stopped(events, batch_id):
        seen.append({r.event_id for r in events.collect()})
        changes.where("version > 3").write.mode("append").parquet(str(tmp_path / "feed"))
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        published(spark, tmp_path, base, stopped)
    for _ in range(2):  # a run finishes the open micro-batch; what landed meanwhile may wait for the next run
        published(spark, tmp_path, base, lambda e, n: seen.append({r.event_id for r in e.collect()}))
    assert len(seen[0]) == 5 and seen[1] == seen[0]
    assert seen[2:] == [{"d_t_4_2_1"}]


def test_a_feed_that_dropped_versions_needs_a_resync(spark, tmp_path):
    from lakewarden.sources.feed_source import FeedReader

    changes, _ = feed(spark)
    path = str(tmp_path / "feed")
    changes.where("version = 4").write.parquet(path)
    reader = FeedReader({"path": path}, changes.schema)
    assert (reader.initialOffset(), reader.latestOffset()) == ({"version": 3}, {"version": 4})
    with pytest.raises(RuntimeError, match="resync"):
        reader.partitions({"version": 1}, {"version": 4})
    assert FeedReader({"path": str(tmp_path / "none")}, changes.schema).latestOffset() == {"version": -1}


ROW = "id bigint, name string"


def test_stream_equals_batch(spark, rows, tmp_path):
    messages = [envelope("c", {"id": i % 5, "name": f"n{i}"}, name="a", table="t", ts_ms=1_700_000_000_000 + i) for i in range(20)]
    messages += [envelope("d", None, {"id": 3}, name="a", table="t", ts_ms=1_700_000_000_100), "bad {"]
    landed = tmp_path / "in"
    landed.mkdir()
    for n, part in enumerate((messages[:8], messages[8:15], messages[15:])):
        (landed / f"{n}.txt").write_text("\n".join(part))
    now = F.timestamp_seconds(F.lit(1_700_000_000))
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(landed)).withColumn("received_at", now)
    changes = typed_changes(cdc_events(stream), ROW)
    root, kept = str(tmp_path / "snap"), ROW + ", ts_ms bigint"
    for _ in range(2):
        query = keep_snapshot(changes, root, kept, ["id"], ["ts_ms"], str(tmp_path / "cp"), version="ts_ms", buckets=4)
        query.awaitTermination()
    batch = typed_changes(cdc_events(raw(spark, messages)), ROW)
    empty = spark.createDataFrame([], ROW + ", ts_ms bigint")
    want = apply_changes(empty, batch, ["id"], ["ts_ms"], version="ts_ms")
    assert rows(read_snapshot(spark, root, kept), *want.columns) == rows(want) and want.count() == 4
    windows = activity_stream(cdc_events(stream)).writeStream.format("memory").queryName("activity")
    windows.outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    counted = activity_windows(
        cdc_events(raw(spark, messages)), "event_time", ["domain", "schema_name", "table_name", "operation"]
    )
    assert rows(spark.table("activity")) == rows(counted)


@pytest.mark.parametrize("order", list(permutations(range(3))))
def test_any_order_of_batches_gives_the_same_snapshot(spark, rows, order):
    schema = "id bigint, name string, ts_ms bigint, operation string"
    batches = [
        [(1, "old", 5, "Update"), (2, "x", 1, "Insert"), (4, "a", 1, "Insert")],
        [(1, None, 9, "Delete"), (2, "y", 4, "Update"), (3, None, 2, "Delete")],
        [(1, "older", 7, "Update"), (2, None, 3, "Delete"), (3, "z", 1, "Insert"), (4, "b", 2, "Update")],
    ]
    kept = spark.createDataFrame([], "id bigint, name string, ts_ms bigint, gone boolean")
    for n in order:
        frame = spark.createDataFrame(batches[n], schema)
        kept = apply_changes(kept, frame, ["id"], ["ts_ms"], version="ts_ms", deleted="gone")
    assert rows(kept.where("not gone"), "id", "name", "ts_ms") == [(2, "y", 4), (4, "b", 2)]


def test_snapshot_rewrites_touched_partitions_only(spark, rows, tmp_path):
    root, kept = str(tmp_path / "t"), StructType.fromDDL("id bigint, v string, deleted boolean")

    def put(frame, batch_id):
        def merge(old, batch):
            return old.join(batch, "id", "left_anti").unionByName(batch)

        tables.upsert_batch(frame, batch_id, root, kept, ["id"], merge, buckets=8)

    def files():
        return {p.parent.name: p.name for p in (tmp_path / "t").rglob("*.parquet")}

    put(spark.range(40).selectExpr("id", "'a' AS v", "id = 7 AS deleted"), 0)
    assert read_snapshot(spark, root, "id bigint, v string").count() == 39
    before = files()
    put(spark.createDataFrame([(3, "b", False)], kept), 1)
    after = files()
    assert len(before) == 8 and sum(after[b] != before[b] for b in after) == 1
    now = read_snapshot(spark, root, "id bigint, v string")
    assert rows(now.where("id in (3, 4)")) == [(3, "b"), (4, "a")] and now.count() == 39


def test_stopped_while_partitions_are_replaced(spark, rows, tmp_path, monkeypatch):
    """A partition was removed and its new rows not moved in: the micro-batch brings them back."""
    import shutil

    root, kept = str(tmp_path / "t"), StructType.fromDDL("id bigint, v string, deleted boolean")

    def merge(old, batch):
        return old.join(batch, "id", "left_anti").unionByName(batch)

    def put(v, batch_id):
        frame = spark.range(3).selectExpr("id", f"'{v}' AS v", "false AS deleted")
        tables.upsert_batch(frame, batch_id, root, kept, ["id"], merge, buckets=2)

    first = spark.range(20).selectExpr("id", "'a' AS v", "false AS deleted")
    tables.upsert_batch(first, 0, root, kept, ["id"], merge, buckets=2)
    replace = tables.overwrite_partitions

    def stop(df, path, *by):
        shutil.rmtree(next((tmp_path / "t").glob("bucket=*")))
        raise RuntimeError("stopped")

    monkeypatch.setattr(tables, "overwrite_partitions", stop)
    with pytest.raises(RuntimeError):
        put("b", 1)
    monkeypatch.setattr(tables, "overwrite_partitions", replace)
    assert read_snapshot(spark, root, "id bigint, v string").count() < 20
    put("b", 1)
    now = read_snapshot(spark, root, "id bigint, v string")
    assert now.count() == 20 and rows(now.where("v = 'b'"), "id") == [(0,), (1,), (2,)]


def test_on_time_and_late_rows_are_all(spark, rows, tmp_path):
    schema = "n int, event_time timestamp, domain string, schema_name string, table_name string, operation string"
    minutes = [[0, 1, 2, 30], [25, 26, 3, 31, None], [60, 30, 54, 55, 56], [1, 100]]
    n = 0
    for i, part in enumerate(minutes):
        items = []
        for m in part:
            at = None if m is None else datetime(2026, 1, 1, m // 60, m % 60, 30)
            items.append((n, at, "d", "s", "t", "Update"))
            n += 1
        spark.createDataFrame(items, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    for _ in range(2):
        keep_activity(stream, str(tmp_path / "out"), str(tmp_path / "cp"), late_seconds=300).awaitTermination()
    counted = read_activity(spark, str(tmp_path / "out"))
    late = tables.read_table(spark, str(tmp_path / "out" / "late"), schema + ", batch_id bigint")
    # 5 minutes behind the greatest time of earlier batches: minute 3 after 30, none, minute 1 after 60
    assert sorted(r.n for r in late.collect()) == [6, 8, 14]
    assert counted.agg(F.sum("events")).first()[0] + late.count() == n
