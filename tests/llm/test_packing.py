from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from lakewarden.llm import packing


def brute_rooms(sizes, capacity):
    rooms = []
    for n in sorted(sizes, reverse=True):
        best = min((b for b, room in enumerate(rooms) if room >= n), key=lambda b: rooms[b], default=None)
        if best is None:
            rooms.append(capacity)
            best = len(rooms) - 1
        rooms[best] -= n
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([8, 16, 30, 100])
    sizes = [r.randint(1, capacity) for _ in range(r.randint(0, 150))]
    runs, windows = packing.best_fit(dict(Counter(sizes)), capacity), defaultdict(list)
    for length, n in Counter(sizes).items():
        mine = sorted(x for x in runs if x[0] == length)
        for rank in range(n):
            _, first, window, per, offset = [x for x in mine if x[1] <= rank][-1]
            windows[window + (rank - first) // per].append((offset + (rank - first) % per * length, length))
    for pieces in windows.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in windows.values()) == brute_rooms(sizes, capacity)
    assert sorted(windows) == list(range(len(windows)))


def test_pieces_round_trip(odd, odd_rows):
    path = packing.tokenizer_path()
    words = packing.WordIds(path)
    want = Counter()
    for r in odd_rows:
        ids = [*words.tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 64):
            part = ids[s : s + 64]
            want[r[0], s, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)), len(ids)] += 1
    got = packing.packed(odd, path, capacity=64).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        ends = [0]
        for offset, n in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + n)
        assert ends[-1] <= 64
    assert sorted(64 - sum(n for _, n in p) for p in sequences.values()) == brute_rooms([k[2] for k, n in want.items() for _ in range(n)], 64)


def test_ranks_over_many_buckets(odd, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 7)
    got = packing.packed(odd, packing.tokenizer_path(), capacity=64).collect()
    places = [(r["sequence_id"], r["offset"]) for r in got]
    assert len(set(places)) == len(places)


def test_empty(empty):
    assert packing.packed(empty, packing.tokenizer_path()).count() == 0
