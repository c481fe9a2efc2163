from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import chains, dedupe, rate_limit
from lakewarden.operators.chains import chain_anchors
from lakewarden.operators.dedupe import mark_duplicates
from lakewarden.operators.rate_limit import limit_calls

SECOND = 1_000_000


def brute_anchors(times, gap, strict):
    out, anchor = {}, None
    for t in sorted(set(times)):
        if anchor is None or (t - anchor > gap if strict else t - anchor >= gap):
            anchor = t
        out[t] = anchor
    return out


def sample(seed, keys=4, n=300, span=4000):
    rng = random.Random(seed)
    return [(f"k{rng.randrange(keys)}", rng.randrange(span) * 7) for _ in range(n)]


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("hot_points", [0, 10, 10_000])
def test_chain_matches_brute_force(spark, strict, hot_points):
    data = sample(1) + [("periodic", 10 * i) for i in range(500)] + [("once", 5)]
    points = spark.createDataFrame(data, "k string, t bigint").distinct()
    sizes = points.groupBy("k").agg(F.count("*").alias("n"))
    got = chain_anchors(
        points.join(sizes, "k"), ["k"], "t", "n", 95, strict, hot_points=hot_points, chunk_gaps=3
    ).collect()
    for key in {k for k, _ in data}:
        want = brute_anchors([t for k, t in data if k == key], 95, strict)
        assert {r.t: r.anchor for r in got if r.k == key} == want


def brute_duplicates(events, ttl):
    last, out = {}, {}
    for key, t, i in sorted(events, key=lambda e: (e[1], e[2])):
        if key is None:
            out[i] = False
        elif key in last and (ttl is None or t - last[key] <= ttl):
            out[i] = True
        else:
            last[key] = t
            out[i] = False
    return out


@pytest.mark.parametrize("ttl", [900, None])
@pytest.mark.parametrize("hot", [0, 10_000])
def test_dedupe_matches_brute_force(spark, monkeypatch, ttl, hot):
    monkeypatch.setattr(
        dedupe, "chain_anchors", lambda *a, **k: chains.chain_anchors(*a, hot_points=hot, chunk_gaps=2, **k)
    )
    rng = random.Random(3)
    events = [
        (rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(20_000), i) for i in range(400)
    ] + [("burst", 100, 1000 + i) for i in range(50)]
    df = spark.createDataFrame(events, "key string, t bigint, id bigint").withColumn(
        "at", F.timestamp_seconds("t")
    )
    got = {r.id: r.is_duplicate for r in mark_duplicates(df, "key", "at", "id", ttl).collect()}
    assert got == brute_duplicates(events, ttl)


def brute_limits(calls, size=20, seconds=60):
    state, out = {}, {}
    for who, t, i in sorted(calls, key=lambda c: (c[1], c[2])):
        tokens, last = state.get(who, (size, t))
        tokens, last = rate_limit.refill(tokens, last, t, size, seconds)
        out[i] = tokens < 1
        state[who] = (max(tokens - 1, 0), last)
    return out


@pytest.mark.parametrize("hot", [0, 10_000])
def test_rate_limit_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(
        rate_limit, "chain_anchors", lambda *a, **k: chains.chain_anchors(*a, hot_points=hot, chunk_gaps=4, **k)
    )
    rng = random.Random(5)
    calls = [("hot", rng.randrange(200 * SECOND), i) for i in range(600)]
    calls += [("slow", rng.randrange(4000 * SECOND), 1000 + i) for i in range(60)]
    calls += [("burst", 5 * SECOND, 2000 + i) for i in range(21)] + [("burst", 66 * SECOND, 3000 + i) for i in range(30)]
    df = spark.createDataFrame(calls, "who string, us bigint, id bigint").withColumn(
        "at", F.timestamp_micros("us")
    )
    got = {r.id: r.is_limited for r in limit_calls(df, "who", "at", "id").collect()}
    assert got == brute_limits(calls)
    assert sum(got[2000 + i] for i in range(21)) == 1


def test_refill_clock_moves_only_when_a_token_is_added():
    assert rate_limit.refill(0, 0, 2_999_999, 20, 60) == (0, 0)
    assert rate_limit.refill(0, 0, 3_000_000, 20, 60) == (1, 3_000_000)
    assert rate_limit.refill(5, 0, 10**9, 20, 60) == (20, 10**9)
