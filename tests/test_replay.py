"""Two-key replays against a walk over the deliveries, one by one."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import chains
from lakewarden.operators.components import connected_components
from lakewarden.operators.replay import deciding_keys, mark_joint_replays, shared_keys

T0 = datetime(2026, 3, 1, tzinfo=timezone.utc)
SCHEMA = "n int, e string, s string, at timestamp"


def walked(rows, ttl, strict):
    free, flags = {}, {}
    for n, e, s, at in sorted(rows, key=lambda r: (r[3], r[0])):
        keys = [k for k in (e and "e" + e, s and "s" + s) if k]
        held = any(k in free and (at <= free[k] if strict else at < free[k]) for k in keys)
        flags[n] = bool(keys) and held
        if not held:
            free.update({k: at + timedelta(seconds=ttl) for k in keys})
    return flags


def marked(spark, rows, ttl, strict=False):
    got = mark_joint_replays(spark.createDataFrame(rows, SCHEMA), "e", "s", "at", "n", ttl, strict)
    return {r.n: r.is_duplicate for r in got.collect()}


def random_rows(seed):
    r = random.Random(seed)
    keys, signatures, span = r.choice([(1, 1), (2, 3), (6, 6), (20, 30)]), r.choice([2, 5, 40]), r.choice([30, 200, 2000])
    rows = []
    for n in range(r.randint(1, 150)):
        e = None if r.random() < 0.2 else f"k{r.randint(0, keys[0])}"
        s = None if r.random() < 0.2 else f"k{r.randint(0, signatures)}"
        rows.append((n, e, s, T0 + timedelta(seconds=r.randint(0, span))))
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_joint_replays_equal_a_walk(spark, seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(chains.chain_anchors, "__defaults__", (3, 4))
    rows, strict = random_rows(seed), seed % 3 == 0
    assert marked(spark, rows, 20, strict) == walked(rows, 20, strict)


def test_refused_by_signature_gives_the_event_back(spark):
    at = [T0 + timedelta(minutes=m) for m in range(6)]
    rows = [(0, "a", "x", at[0]), (1, "b", "x", at[1]), (2, "b", "y", at[2]), (3, "b", None, at[3]), (4, "a", "y", at[4]), (5, None, None, at[5])]
    assert marked(spark, rows, 900) == {0: False, 1: True, 2: False, 3: True, 4: True, 5: False}


def test_one_event_with_ever_new_signatures(spark):
    # all deliveries of the hot event follow one chain; no signature decides anything
    rows = [(n, "hot", f"s{n}", T0 + timedelta(seconds=n)) for n in range(300)]
    assert marked(spark, rows, 60) == walked(rows, 60, False)


def test_no_deliveries(spark):
    assert marked(spark, [], 60) == {}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(f"n{r.randint(0, 60):03d}", f"n{r.randint(0, 60):03d}") for _ in range(r.randint(1, 50))]
    edges += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)]
    name = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(name[a], name[b])
            changed |= name[a] != low or name[b] != low
            name[a] = name[b] = low
    got = connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b")
    assert {x.node: x.component for x in got.collect()} == name


def test_deliveries_without_an_event_are_spread(spark):
    rows = spark.createDataFrame([(None, f"2:s{n}", n, n) for n in range(200)], "k1 string, k2 string, __at bigint, n int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = deciding_keys(rows).select("key1", "key2", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r.part for r in found} == {0, 1}
    assert {(r.key1, r.key2) for r in found} == {(None, f"2:s{n}") for n in range(200)}


@pytest.mark.parametrize("seed", range(2))
def test_digests_as_keys_equal_a_walk(spark, seed):
    rows = random_rows(seed + 7)
    given = spark.createDataFrame(rows, SCHEMA)
    digests = {k: F.when(F.col(k).isNotNull(), F.unhex(F.sha2(k, 256))) for k in ("e", "s")}
    got = mark_joint_replays(given.withColumns(digests), "e", "s", "at", "n", 20)
    assert {r.n: r.is_duplicate for r in got.collect()} == walked(rows, 20, False)


def test_keys_of_one_delivery_are_dropped(spark):
    # keys on two deliveries stay, and those of rows without a time
    rows = [("1:a", "2:x", 1, 0), ("1:a", "2:y", 2, 1), ("1:b", "2:z", 3, 2), (None, "2:z", 4, 3), ("1:c", None, 5, 4), ("1:d", None, None, 5)]
    kept = shared_keys(spark.createDataFrame(rows, "k1 string, k2 string, __at bigint, n int"), "n").collect()
    assert {r.n: (r.k1, r.k2) for r in kept} == {
        0: ("1:a", None), 1: ("1:a", None), 2: (None, "2:z"), 3: (None, "2:z"), 4: (None, None), 5: ("1:d", None),
    }


def test_no_shuffle_is_left_behind(spark):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffles()
    rows = random_rows(3)
    given = spark.createDataFrame(rows, SCHEMA)
    marked_rows = mark_joint_replays(given, "e", "s", "at", "n", 20)
    assert shuffles() <= before
    assert {r.n: r.is_duplicate for r in marked_rows.collect()} == walked(rows, 20, False)
