from __future__ import annotations

import zlib
from collections import Counter

import corpus_pipeline
from lakewarden.llm import mixing, packing, pii

from test_pairs import sets_of  # isort: skip
from test_rules_and_mix import measures  # isort: skip


def survivors(rows):
    """Rows that pass the base rules (no line is frequent enough in so few), then one of each group of near copies."""
    good = [r for r in rows if measures(r[1])[0] >= 10 and 100 * measures(r[1])[4] <= 20 * measures(r[1])[0]]
    sets = sets_of(good)
    root = list(range(len(good)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(good)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 90 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    best: dict = {}
    for i, r in enumerate(good):
        key = (r[0] is None, r[0] or 0)
        if find(i) not in best or key < best[find(i)][0]:
            best[find(i)] = (key, r)
    return [r for _, r in best.values()]


def test_run_equals_brute_force(spark, odd, odd_rows, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = survivors(odd_rows)
    tagger = pii.Tagger(pii.default_field())
    texts = [pii.masked(r[1], every) for r, (_, every) in zip(kept, pii.all_spans([r[1] for r in kept], tagger), strict=True)]
    clean = spark.createDataFrame([(r[0], t, r[3]) for r, t in zip(kept, texts, strict=True)], "doc_id long, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(clean).collect()}
    words = packing.WordIds(packing.tokenizer_path())
    want = Counter()
    for r, t in zip(kept, texts, strict=True):
        ids = [*words.tokenizer.encode(t, add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            want[r[0], s, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)), len(ids)] += copies[r[0]]
    assert Counter(tuple(r)[:5] for r in got) == +want
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for (s, offset, n), (t, after, _) in zip(places, places[1:], strict=False):
        assert (after == offset + n and after < 2048) if s == t else after == 0


def test_stages_keep_columns_and_take_empty_tables(spark, odd, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "PII", "mixing", "packing"]
    for docs in (empty, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns and out.count() == 0
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0
