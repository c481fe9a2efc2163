"""Downstream impact against a search in plain Python, breadth first and over the condensed graph."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from lakewarden.operators import lineage


def searched(edges, roots):
    children, found = defaultdict(set), set()
    for a, b in edges:
        children[a].add(b)
    for root in roots:
        depth, level = {root: 0}, [root]
        while level:
            below = depth[level[0]] + 1
            level = sorted({c for n in level for c in children[n] if c not in depth})
            depth.update(dict.fromkeys(level, below))
        found |= {(root, n, d) for n, d in depth.items() if d}
    return sorted(found)


def impact(spark, edges, roots, **options):
    frame = spark.createDataFrame(edges, "parent string, child string")
    got = lineage.downstream_impact(frame, spark.createDataFrame([(r,) for r in roots], "root string"), **options)
    return sorted(tuple(r) for r in got.collect())


def long_ways(seed):
    """Runs of nodes that meet, part, close to cycles or end, some hanging on nothing."""
    r = random.Random(seed)
    edges, hubs = [], [f"h{i}" for i in range(6)]
    for n in range(9):
        run = [r.choice(hubs + [f"free{n}"]), *(f"r{n}_{i}" for i in range(r.choice([0, 1, 2, 7, 20]))), r.choice(hubs + [f"end{n}"])]
        edges += list(zip(run, run[1:]))
    ring = [f"ring{i}" for i in range(5)]
    return edges + list(zip(ring, ring[1:] + ring[:1])) + [("h0", "h0"), ("h1", "h2"), ("h1", "h2")], hubs[:3] + ["r0_0", "nowhere", "ring0"]


@pytest.mark.parametrize("seed, levels", [(1, 0), (2, 0), (3, 2), (4, 8)])
def test_impact_equals_a_search(spark, monkeypatch, seed, levels):
    monkeypatch.setattr(lineage, "LEVELS", levels)
    edges, roots = long_ways(seed)
    assert impact(spark, edges, roots) == searched(edges, roots)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, store = [], lineage.checkpoint
    monkeypatch.setattr(lineage, "checkpoint", lambda df: rounds.append(1) or store(df))
    edges = [(f"n{i}", f"n{i + 1}") for i in range(10_000)]
    assert impact(spark, edges, ["n0"]) == sorted(("n0", f"n{i}", i) for i in range(1, 10_001))
    assert len(rounds) < 60
    with pytest.raises(RuntimeError):
        impact(spark, edges[:40], ["n0"], max_depth=30)
    assert len(impact(spark, edges[:40], ["n0"], max_depth=40)) == 40
