from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import repeated_text, shingle_join


def sets_of(rows):
    out = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        out.append({tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set())
    return out


def brute_components(rows):
    sets = sets_of(rows)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 90 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    ids: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), ids.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("small,salted", [(24, 50_000), (1, 2)])
def test_components(odd, odd_rows, rows, monkeypatch, small, salted):
    monkeypatch.setattr(shingle_join, "SMALL", small)
    monkeypatch.setattr(shingle_join, "LIST", salted)
    assert rows(shingle_join.with_components(odd)) == brute_components(odd_rows)


def chain_rows():
    """Near copies that drift: each links with its neighbours only, and many share every common shingle."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(120)]
    out = []
    for i in range(40):
        out.append((i, " ".join(words)))
        words[3 * i % 120] = f"v{r.random()}"
    return out + [(100 + i, " ".join(words[:60]) + f" tail{i} {'x ' * (i % 7)}") for i in range(30)]


def test_drifting_copies_keep_every_link(spark, rows, monkeypatch):
    monkeypatch.setattr(shingle_join, "SMALL", 2)
    docs = chain_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(shingle_join.with_components(frame)) == brute_components(docs)


@pytest.mark.parametrize("small,salted", [(24, 50_000), (2, 4)])
def test_many_near_copies_of_many_sizes(spark, rows, monkeypatch, small, salted):
    monkeypatch.setattr(shingle_join, "SMALL", small)
    monkeypatch.setattr(shingle_join, "LIST", salted)
    r = random.Random(8)
    docs = []
    for _ in range(6):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(15, 160))]
        for _ in range(30):
            copy = base[: len(base) - r.randint(0, len(base) // 8)]
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(["x", "y", f"v{r.random()}"])
            docs.append((len(docs), " ".join(copy + ["tail"] * r.randint(0, 1))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(shingle_join.with_components(frame)) == brute_components(docs)


@pytest.mark.parametrize("small", [24, 2, 1])
def test_members_of_two_groups_meet(spark, rows, monkeypatch, small):
    """Two groups of one prefix each share rare shingles only; members that no pivot stands for link across them."""
    monkeypatch.setattr(shingle_join, "SMALL", small)
    rare = [f"r{i}" for i in range(30)]
    common = [["joint", "same", *(f"{x}{i}" for i in range(68))] for x in "ab"]
    docs = [(2 * k + i, " ".join([*first, *rare[1:], *c])) for k, first in enumerate([["r0"], ["other"]]) for i, c in enumerate(common)]
    docs += [(10 + k, " ".join([*common[k % 2], *(f"t{k}x{i}" for i in range(40))])) for k in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    want = brute_components(docs)
    assert [w[2] for w in sorted(want)[:4]] == [0, 1, 0, 1]
    assert rows(shingle_join.with_components(frame)) == want


def test_prefixes_of_links_meet():
    r = np.random.default_rng(1)
    classes = r.integers(0, 12, 64).astype(np.uint8)
    for _ in range(300):
        a = np.unique(r.integers(0, 1 << 60, int(r.integers(1, 80))).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.97], r.integers(0, 1 << 60, int(r.integers(0, 4))).astype(np.uint64)]))
        if len(b) and shingle_join.similar(len(a), len(b), len(np.intersect1d(a, b))):
            x, y = (shingle_join.ordered(s, classes)[: shingle_join.prefix_length(len(s))] for s in (a, b))
            common = len(np.intersect1d(x, y))
            upto = common + max(len(a) - len(x), len(b) - len(y))
            assert common and shingle_join.similar(len(a), len(b), upto)


@pytest.mark.parametrize("rows_per_batch", [1, 3, 7, 1000])
def test_lists_over_batches(spark, rows, monkeypatch, rows_per_batch):
    """Whatever batches a list is cut into, only shingles of one group go, and long lists are known as such."""
    monkeypatch.setattr(shingle_join, "SMALL", 4)
    sizes = [1, 2, 4, 5, 1, 9, 1, 3, 12]
    prefixes: dict = {}
    for token, n in enumerate(sizes):
        for i in range(n):
            prefixes.setdefault((token * 5 + i * 3) % 13, []).append(token)
    got_sizes = Counter(t for p in prefixes.values() for t in set(p))
    docs = spark.createDataFrame([(i, sorted(set(p))) for i, p in prefixes.items()], "row long, prefix array<long>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
    try:
        groups = docs.select(docs["row"].alias("pivot"), F.lit(0).cast("long").alias("size"))
        got = shingle_join.shingle_lists(docs, groups).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = sorted((t, i, n > 4) for i, p in prefixes.items() for t in set(p) for n in [got_sizes[t]] if n > 1)
    assert sorted((r["token"], r["pivot"], r["many"]) for r in got) == want


def test_sketches_never_rule_a_link_out():
    r = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(r.integers(0, 1 << 60, int(r.integers(1, 900))).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < r.random()], r.integers(0, 1 << 60, int(r.integers(0, 40))).astype(np.uint64)]))
        x, y = (shingle_join.folded(s).view(np.uint64) for s in (a, b))
        assert len(x) == shingle_join.FOLDED
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_frequent_shingles_make_no_pairs_that_cannot_link(spark):
    """Sets of one size that share the same frequent shingle and differ elsewhere come out of the join on it only if alike."""
    base = np.arange(200, dtype=np.uint64) << np.uint64(20)
    other = [np.concatenate([base[:150], (np.arange(50, dtype=np.uint64) + np.uint64(200 + 50 * i)) << np.uint64(20)]) for i in range(6)]
    sets = [base, np.append(base[:198], other[0][-2:]), *other]
    assert shingle_join.similar(200, 200, 198)
    found = [(7, i, 200, 200, i, shingle_join.folded(s).tolist()) for i, s in enumerate(sets)]
    labelled = spark.createDataFrame(found, "token long, node long, size long, most long, root long, folded array<long>")
    assert [(p["a"], p["b"]) for p in shingle_join._across(labelled, "token").collect()] == [(0, 1)]


def test_one_of_each_component_stays(odd, odd_rows):
    kept = shingle_join.keep_one(odd)
    assert kept.columns == odd.columns
    want = brute_components(odd_rows)
    blank = sum(n == 0 for _, n, _ in want)
    with_set = {c for _, n, c in want if n}
    got = [r["doc_id"] for r in kept.collect()]
    assert len(got) == blank + len(with_set)
    assert {c for c in with_set if c is not None} <= set(got)


def brute_removed(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    n = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for key, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_windows_of_cut_anchors_are_no_rows(odd, odd_rows, rows, monkeypatch):
    """Shards of one anchor meet by arrays of digests in several ranges; no row is made for a window."""
    monkeypatch.setattr(repeated_text, "PER_RANGE", 50)
    got = repeated_text.removed(odd, per_anchor=1, shard=2000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "FlatMapGroupsInPandas" in plan
    want = repeated_text.removed(odd)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows(got.select(columns)) == rows(want.select(columns))


@pytest.mark.parametrize("per_anchor,shard", [(1500, 1 << 20), (1, 2000)])
def test_repeated_strings(odd, odd_rows, rows, per_anchor, shard):
    got = repeated_text.removed(odd, per_anchor=per_anchor, shard=shard)
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_removed(odd_rows, 400)


def test_short_length_and_stripes(odd, odd_rows, rows, monkeypatch):
    monkeypatch.setattr(repeated_text, "STRIPE", 1000)
    got = repeated_text.removed(odd, length=100)
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_removed(odd_rows, 100)


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array(seed):
    r = np.random.default_rng(seed)
    parts = [bytes(r.integers(97, 97 + int(r.integers(1, 4)), int(r.integers(1, 60))).tolist()) for _ in range(int(r.integers(1, 6)))]
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    suffixes = [bytes(data[i : i + left[i]]) for i in range(len(data))]
    rank = repeated_text.suffix_ranks(data, left, int(sizes.max()))
    want = sorted(suffixes)
    assert [want.index(s) for s in suffixes] == rank.tolist()
    order = np.argsort(rank, kind="stable")
    shared = repeated_text.common_prefixes(data, left, order, lanes=int(r.integers(1, 9)))
    for a, b in zip(order[:-1], order[1:], strict=True):
        n = 0
        while n < min(left[a], left[b]) and suffixes[a][n] == suffixes[b][n]:
            n += 1
        assert shared[b] == n


def test_empty(empty):
    assert shingle_join.with_components(empty).count() == 0 and shingle_join.keep_one(empty).count() == 0
    assert repeated_text.removed(empty).count() == 0


def test_sketches_and_sizes_never_rule_out_a_link():
    r = np.random.default_rng(5)
    linked = 0
    for _ in range(400):
        n = int(r.integers(1, 1500))
        a = np.unique(r.integers(0, 1 << 60, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.95], r.integers(0, 1 << 60, int(r.integers(0, 1 + n // 10))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        apart = shingle_join.differing(shingle_join.sketch(a), shingle_join.sketch(b))
        assert apart <= len(a) + len(b) - 2 * common
        linked += shingle_join.similar(len(a), len(b), common)
    assert linked > 50
    x, y = (r.integers(0, 1 << 60, 600).astype(np.uint64) for _ in "ab")
    assert 19 * shingle_join.differing(shingle_join.sketch(x), shingle_join.sketch(y)) > 1200


def test_texts_meet_only_for_pairs_that_may_link(spark, rows, monkeypatch):
    """Sets that share rare shingles, but are too unlike or of too unlike sizes, never meet their texts."""
    met = {}
    real = shingle_join.stored

    def stored(frame, name):
        out = real(frame, name)
        met.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(shingle_join, "stored", stored)
    docs = [(i, f"here is a rare line {i // 3} " + " ".join(f"w{i % 3}x{i}x{k}" for k in range([300, 300, 90][i % 3]))) for i in range(30)]
    docs += [(100, docs[0][1]), (101, docs[0][1] + " more")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(shingle_join.with_components(frame)) == brute_components(docs)
    assert met["join-first"][0] < 20  # each with its own group of three, without the third, whose size is too small
    assert met["join-pairs"] == [1, 0]
