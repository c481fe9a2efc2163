"""Filter audit, lexical search and swap packing against plain Python."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import byte_words, common, filter_audit, lexical_search, packing, pii, shingle_join, swap_packing, word_ids
from lakewarden.llm.word_ids import WordIds

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def odd_texts(seed: int, n: int = 60) -> list[str | None]:
    r = random.Random(seed)
    marks = ["a", "B", "é", "漢", "😀", " ", " ", "\t", "\x0b", " ", "#", "0", "x" * 9, "Y" * 64, "z" * 65, "z" * 200, "\x00", ".", "\x85"]
    return [None, "", " "] + ["".join(r.choice(marks) for _ in range(r.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_counts_of_one_pass(seed):
    texts = odd_texts(seed)
    got = filter_audit.measured(pa.chunked_array([pa.array(["cut off", *texts])]).combine_chunks().slice(1))
    plain = [t or "" for t in texts]
    assert got["n_words"].tolist() == [len(WORD.findall(t)) for t in plain]
    assert got["n_distinct"].tolist() == [len(set(WORD.findall(t))) for t in plain]
    assert got["n_capitals"].tolist() == [len(re.findall("[A-Z]", t)) for t in plain]
    assert got["n_chars"].tolist() == [len(t) for t in plain]
    assert got["n_symbols"].tolist() == [len(re.findall(r"[#$%&*|]", t)) for t in plain]


def test_equal_hashes_do_no_harm(monkeypatch):
    monkeypatch.setattr(byte_words, "hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    texts = odd_texts(1)
    got = filter_audit.measured(pa.array(texts))
    assert got["n_distinct"].tolist() == [len(set(WORD.findall(t or ""))) for t in texts]


def test_no_texts_at_all():
    got = filter_audit.measured(pa.array([], pa.string()))
    assert all(len(v) == 0 for v in got.values())


def brute_audit(docs, labels):
    least, good, toxic = {}, set(), set()
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, q, x in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if x == 1 else set()
    failed = []
    for i, t, source in docs:
        t = t or ""
        w = WORD.findall(t)
        flags = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        failed.append((source or "", {k for k, v in flags.items() if v}, i is not None and i in good, i is not None and i in toxic))
    rows, shapley = {}, Counter()
    for part in {p for p, *_ in failed}:
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                mine = [f for f in failed if f[0] == part]
                before = set(order[: step - 1])
                removed = [f for f in mine if letter in f[1] and not f[1] & before]
                rows[part, "".join(order), step] = (
                    sum(not f[1] & (before | {letter}) for f in mine),
                    len(removed),
                    sum(letter in f[1] and bool(f[1] & before) for f in mine),
                    sum(f[1] == {letter} for f in mine),
                    sum(f[2] for f in removed),
                    sum(f[3] for f in removed),
                )
                shapley[part, letter] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def audited(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()}


def test_audit(spark, odd, odd_rows):
    r = random.Random(2)
    more = [(100 + i, " ".join(r.choice(["Ab", "cd", "ef#", "gh"] + [f"w{k}" for k in range(r.choice([5, 90]))]) for _ in range(r.choice([20, 60, 70]))), "en", r.choice([None, "", "s1"]), 0, "r", 0, "s", "n", "g") for i in range(60)]
    more += [(300 + i, more[i % 7][1], *more[i][2:]) for i in range(30)] + [more[5], more[5]]
    docs = odd.union(spark.createDataFrame(more, odd.schema))
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in [*range(50), *range(100, 140), *range(100, 120)]] + [(None, 1, 1)]
    got = audited(filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == brute_audit([(x[0], x[1], x[3]) for x in [*odd_rows, *more]], labels)


def test_audit_of_nothing(spark, empty):
    assert filter_audit.audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def brute_search(docs, items, best):
    held = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [(i, Counter(w), len(w)) for i, w in held if w]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, w, _ in held for t in w)
    rows = []
    for item, text in items:
        found = []
        for i, w, n in held:
            m, score = 25 + (75 * n * n_docs) // n_terms, 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if w[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * w[t]) // (1000 * w[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        rows += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:best], 1)]
    return Counter(rows)


ITEMS = [(0, "The the THE passage écrit 漢字 one_two x9"), (1, None), (2, "..."), (3, "zzzunknown"), (4, "an id is missing here"), (4, "an id is missing here"), (None, "the line stands"), (5, "A" * 900), (6, "é" * 70 + " é")]


@pytest.mark.parametrize("limit", [4 << 20, 40])
def test_search(spark, odd, odd_rows, monkeypatch, limit):
    monkeypatch.setattr(lexical_search, "AT_ONCE", 60)
    monkeypatch.setattr(lexical_search.blocks, "__defaults__", (limit,))
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, doc_id string")
    got = lexical_search.search(odd, items, best=4)
    assert Counter(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == brute_search([x[:2] for x in odd_rows], ITEMS, 4)


def test_scores_beyond_doubles(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = [(i, text + " only" * i) for i in range(30)] + [(99, "other words")] * 3
    items = [(1, text * 1), (2, " ".join([text] * 3000))]
    counts = spark.createDataFrame(docs, "doc_id long, text string")
    got = lexical_search.search(counts, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_search(docs, items, 10)


def test_search_of_nothing(spark, empty, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_word_ids_are_the_tokenizers(seed):
    words = WordIds(packing.tokenizer_path())
    r = random.Random(seed)
    marks = ["a", "B", "é", "É", "ß", "İ", "İ", "K", "'s", "'T", ",", ".", "1", "٣", "漢", "́", " ", "\t", "\x0b", "\x1c", "\x85", " ", "​", "<|endoftext|>", "<|ENDOFTEXT|>", "ª", "#", "-", "_", "Q" * 70]
    texts = ["".join(r.choice(marks) for _ in range(r.randint(0, 30))) for _ in range(300)] + [None, "", "Word, word. WORD,, word"]
    ids, sizes = words.encode(texts)
    want = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_word_ids_of_much_text_take_bounded_memory():
    """However much text comes at once, what is held beside it and its ids belongs to a slice of it."""
    words = WordIds(packing.tokenizer_path())
    texts = ["some words of a text, again and again. " * 500] * 300
    words.encode(texts[:1])
    tracemalloc.start()
    ids, sizes = words.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(sizes.tolist())) == 1 and len(ids) == 300 * sizes[0]
    assert peak < 10 * sum(map(len, texts)) + 64 * word_ids.SLICE


def test_long_units_are_not_remembered_without_end(monkeypatch):
    """What a worker remembers is bounded by its bytes as well, not by the number of units alone."""
    monkeypatch.setattr(word_ids, "REMEMBERED_BYTES", 1 << 16)
    words = WordIds(packing.tokenizer_path())
    for i in range(12):
        text = " ".join(f"{i}x{j}" + "é7" * 200 for j in range(20))
        ids, _ = words.encode([text])
        assert ids.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words.at[words.n] < (1 << 16) + 2 * len(text.encode())


def _largest_batch(docs):
    def size(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.nbytes for b in batches)])], names=["n"])

    return docs.mapInArrow(size, "n long").first()[0]


@pytest.mark.parametrize(
    "use",
    [lambda d: packing.cut(d, packing.tokenizer_path()), pii.find, pii.redact, shingle_join.joined],
    ids=["cut", "find", "redact", "joined"],
)
def test_texts_go_to_workers_in_small_batches(spark, use):
    """A worker gets some 2 MB of text at a time, not 10 000 rows whatever their size."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    docs = spark.range(600, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word "), "id", F.lit(" ")), 2_000).alias("text"))
    use(docs if use is not shingle_join.joined else docs.limit(2))
    try:
        assert _largest_batch(docs) < 2 * common.BATCH
    finally:
        spark.conf.unset(limit)


def test_words_of_shingles_are_not_kept():
    """A worker holds nothing of the texts it has seen."""
    tracemalloc.start()
    for i in range(20):
        shingle_join.shingles(" ".join(f"w{i}x{j}" for j in range(5_000)).encode())
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 2 << 20


def lengths_of(bins):
    held = Counter()
    for kind, n in bins.items():
        for length, per in kind:
            held[length] += per * n
    return held


@pytest.mark.parametrize("seed", range(60))
def test_exchanges_keep_pieces_and_empty_bins(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 30, 100])
    low = r.choice([1, capacity // 5])
    counts = Counter(r.randint(low, r.choice([capacity, capacity // 2])) for _ in range(r.randint(0, 120)))
    start = swap_packing.best_fit(dict(counts), capacity)
    end = swap_packing.improve(start, capacity)
    for bins in (start, end):
        assert lengths_of(bins) == counts
        assert all(0 < swap_packing.fill(k) <= capacity and n > 0 for k, n in bins.items())
    squares = [sum(swap_packing.fill(k) ** 2 * n for k, n in bins.items()) for bins in (start, end)]
    assert end.total() <= start.total() and squares[1] >= squares[0]
    if end.total() > -(-sum(x * n for x, n in counts.items()) // capacity):  # then no exchange helps
        open_bins = [k for k, n in end.items() for _ in range(min(n, 2)) if swap_packing.fill(k) < capacity]
        for i, a in enumerate(open_bins):
            for j, b in enumerate(open_bins):
                assert i == j or swap_packing.fill(a) < swap_packing.fill(b) or swap_packing.best_exchange(a, b, capacity) is None


def test_start_is_best_fit():
    for seed in range(20):
        r = random.Random(seed)
        sizes = [r.randint(1, 30) for _ in range(r.randint(1, 90))]
        rooms: list[int] = []
        for n in sorted(sizes, reverse=True):
            best = min((b for b, room in enumerate(rooms) if room >= n), key=lambda b: rooms[b], default=None)
            if best is None:
                rooms.append(30)
                best = len(rooms) - 1
            rooms[best] -= n
        got = swap_packing.best_fit(dict(Counter(sizes)), 30)
        assert sorted(30 - swap_packing.fill(k) for k, n in got.items() for _ in range(n)) == sorted(rooms)


def test_exchange_empties_what_best_fit_leaves():
    # best fit needs a bin more than the optimum for these
    improved = 0
    for seed in range(200):
        r = random.Random(seed)
        counts = Counter(r.choice([7, 8, 9, 11, 13, 14, 17, 19, 22]) for _ in range(40))
        start = swap_packing.best_fit(dict(counts), 50)
        improved += swap_packing.improve(start, 50).total() < start.total()
    assert improved >= 10


def test_pieces_in_sequences(odd, odd_rows):
    path, capacity = packing.tokenizer_path(), 64
    tokenizer, want, sizes = WordIds(path).tokenizer, Counter(), Counter()
    for r in odd_rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), capacity):
            part = ids[s : s + capacity]
            want[r[0], s // capacity, s, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))] += 1
            sizes[len(part)] += 1
    for bucket in (20_000, 7):
        swap_packing.BUCKET = bucket
        got = swap_packing.packed(odd, path, capacity=capacity).collect()
        assert Counter(tuple(r)[:5] for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for pieces in sequences.values():
            end = 0
            for offset, n in sorted(pieces):
                assert offset == end
                end += n
            assert end <= capacity
        assert len(sequences) <= swap_packing.best_fit(dict(sizes), capacity).total()
    swap_packing.BUCKET = 20_000


def test_packing_nothing(empty):
    assert swap_packing.packed(empty, packing.tokenizer_path()).count() == 0
