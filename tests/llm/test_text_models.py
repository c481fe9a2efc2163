from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import line_quality, lm_scoring, nearest, pii


def brute_base(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@pytest.fixture(scope="session")
def field():
    return pii.default_field()


def test_base_spans(odd, odd_rows, rows, field):
    got = pii.find(odd, field=field).collect()
    want = []
    for r in odd_rows:
        base = brute_base(r[1] or "")
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        want.append((r[0], *[sum(k == i for _, k, _ in base) for i in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        every = r["spans"].split(",") if r["spans"] else []
        starts = [int(x.split(":")[1]) for x in every]
        assert starts == sorted(starts)
    assert any("secret" in r["spans"] for r in got)


def test_odd_matches(field):
    texts = ["+1 (269) 555-3296 452413226", "a@b a@b.c 1.2.3.4.5 300.1.1.1 4111-1111-1111-1111 4111 1111 1111 1112", "é x@y.zz 00.001.2.255 " + "1" * 5000 + ".2.3.4", ""]
    for text in texts:
        assert pii.base_spans(text) == brute_base(text if len(text) < 4000 else text.replace("1" * 5000, "9" * 5000)[: len(text)]) if len(text) < 4000 else len(pii.base_spans(text)) == 2


def test_field_on_held_out_lines(field):
    hits = total = wrong = 0
    tagger = pii.Tagger(field)
    for text, spans in pii.labelled_table(300, seed=99):
        found = {(s, e) for s, k, e in tagger.tag([text])[0] if pii.KINDS[k] in pii.ADDED}
        for s, e, kind in spans:
            if kind in pii.ADDED:
                total += 1
                hits += any(a < e and s < b for a, b in found)
        wrong += sum(not any(a < e and s < b for s, e, _ in spans) for a, b in found)
    assert hits / total > 0.95 and wrong / total < 0.03


def test_viterbi_and_shortcut_are_exact(field):
    r = np.random.default_rng(0)
    for _ in range(30):
        sizes = r.integers(1, 6, int(r.integers(1, 5)))
        unary, move = r.normal(size=(sizes.sum(), 3)), r.normal(size=(3, 3))
        starts = np.cumsum(sizes) - sizes
        got = pii.viterbi(unary, starts, sizes, move)
        for s, n in zip(starts, sizes, strict=True):
            paths = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T
            score = [sum(unary[s + i, p[i]] for i in range(n)) + sum(move[p[i], p[i + 1]] for i in range(n - 1)) for p in paths]
            assert (got[s : s + n] == paths[int(np.argmax(score))]).all()
    texts = [t for t, _ in pii.labelled_table(60, seed=5)]
    short, full = pii.Tagger(field), pii.Tagger(field)
    full.gain = 1e9
    assert short.tag(texts) == full.tag(texts)


def test_redact(odd, field):
    clean = pii.redact(odd, field=field)
    assert clean.schema == odd.schema
    got = clean.filter("text like '%[EMAIL]%'").first()
    assert got["text"].startswith("write to [EMAIL] or [PHONE], host [IP]") and "[SECRET]" in got["text"] and got["n_chars"] == len(got["text"])
    assert clean.filter("text is null").count() == odd.filter("text is null").count() and clean.count() == odd.count()


def test_scores_by_brute_force(odd, odd_rows):
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in odd_rows]
    held = [h if r[0] is not None else True for h, r in zip(held, odd_rows, strict=True)]
    texts = [(r[1] or "").encode() for r in odd_rows]
    words = [[*t.lower().split(), None] for t in texts]
    count = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    tokens, kinds = sum(count.values()), len(count)
    n = {k: defaultdict(Counter) for k in range(5)}
    for t, h in zip(texts, held, strict=True):
        s = b"\xff" * 4 + t + b"\xff"
        for p in range(4, len(s) if not h else 0):
            for k in range(5):
                n[k][s[p - k : p]][s[p]] += 1

    def code(s, p):
        out, gone = 0.0, set()
        for k in (4, 3, 2, 1, 0):
            seen = {b: v for b, v in n[k].get(s[p - k : p], {}).items() if b not in gone}
            if seen:
                total, d = sum(seen.values()), len(seen)
                if s[p] in seen:
                    return out + math.log10(seen[s[p]] / (total + d))
                out += math.log10(d / (total + d))
                gone |= set(seen)
        return out - math.log10(256 - len(gone))

    want = []
    for r, t, ws, h in zip(odd_rows, texts, words, held, strict=True):
        base = sum(math.log10((count[w] + 0.1) / (tokens + 0.1 * (kinds + 1))) for w in ws)
        s = b"\xff" * 4 + t + b"\xff"
        want.append((r[0], h, len(ws), sum(count[w] > 0 for w in ws), tokens, round(base, 6), round(sum(code(s, p) for p in range(4, len(s))), 1)))
    got = lm_scoring.scored(odd, hot=20).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[2])
    got = sorted(((*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 1)) for r in got), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6], abs=0.11)


def test_forward_backward():
    r = np.random.default_rng(3)
    owner = np.repeat([0, 1, 2], [4, 1, 3])
    unary, stay = r.normal(size=8), 0.7
    good, total, equal = line_quality.marginals(unary, owner, stay)
    at, z, same = np.zeros(8), 0.0, 0.0
    for o in range(3):
        u = unary[owner == o]
        paths = np.array(np.meshgrid(*[range(2)] * len(u))).reshape(len(u), -1).T
        links = (paths[:, 1:] == paths[:, :-1]).sum(1)
        w = np.exp(paths @ u + stay * links)
        at[owner == o] = (w[:, None] * paths).sum(0) / w.sum()
        z += np.log(w.sum())
        same += (w * links).sum() / w.sum()
    assert np.allclose(good, at) and total == pytest.approx(z) and equal == pytest.approx(same)


def test_quality_held_out(spark):
    import random

    r = random.Random(1)
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        lines = []
        for _ in range(r.randint(1, 6)):
            w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(r.randint(5, 20))]
            lines.append(" ".join(x.upper() + "!!" for x in w) if bad and r.random() < 0.8 else " ".join(w).capitalize() + ".")
        rows.append((i, "\n".join(lines)))
        marks.append((i, 0 if bad else 1))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*marks, (None, 1), (5000, None)], "doc_id long, quality int")
    got = line_quality.scored(docs, line_quality.fit(docs, labels)).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["predicted"] == marks[r["doc_id"]][1] for r in held) / len(held) > 0.9


def test_quality_of_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40)], "doc_id long, quality int")
    weights = line_quality.fit(odd, labels)
    got = line_quality.scored(odd, weights).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    none = line_quality.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in line_quality.scored(odd, none).collect()} == {0.5}
    assert line_quality.scored(empty, weights).count() == 0


def vectors(n=1500, dim=24):
    r = np.random.default_rng(8)
    v = r.normal(size=(n, dim)).astype(np.float32)
    v[100:140] = v[100]  # a group of equal vectors
    return v


def test_recall_and_scores(spark, rows):
    v = vectors()
    odd = [(2000, None), (2050, []), (2100, [0.0] * 24), (2150, [None] + [1.0] * 23), (2200, [float("nan")] + [1.0] * 23), (2250, [1.0, 2.0]), (None, v[3].tolist())]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + odd, "vec_id long, embedding array<float>")
    got = nearest.search(table, lists=16, probes=10).collect()
    every = np.vstack([v, v[3:4]]).astype(float)
    ids = [*range(len(v)), 1 << 60]
    hits = 0
    by = defaultdict(dict)
    for r in got:
        by[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(by) == list(range(0, 1500, 50))
    for q, found in by.items():
        score = every @ every[q] / (np.linalg.norm(every, axis=1) * np.linalg.norm(every[q]))
        best = sorted((i for i in range(len(every)) if i != q), key=lambda i: (-round(score[i], 12), ids[i]))[:5]
        assert sorted(found) == [1, 2, 3, 4, 5]
        assert [found[k][1] for k in range(1, 6)] == sorted((s for _, s in found.values()), reverse=True)
        for i, s in found.values():
            assert s == pytest.approx(score[len(v) if i is None else i], abs=1e-12)
        hits += len({ids[b] for b in best} & {1 << 60 if i is None else i for i, _ in found.values()})
    assert hits / (5 * len(by)) >= 0.9
    assert [by[100][k][0] for k in range(1, 6)] == [101, 102, 103, 104, 105]


def test_few_and_no_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in nearest.search(table).collect()] == [(0, 1, 1)]
    assert nearest.search(table.limit(0)).count() == 0
    assert nearest.search(table.filter("vec_id = 0")).count() == 0


def test_empty(empty, field):
    assert pii.find(empty, field=field).count() == 0 and pii.redact(empty, field=field).count() == 0
    assert lm_scoring.scored(empty).count() == 0
    assert F is not None
