from __future__ import annotations

import hashlib
import os
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import mixing, quality_rules

SF_DIR = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def measures(text):
    text = text or ""
    w = words(text)
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_base_measures_and_verdict(odd, odd_rows):
    got = quality_rules.judged(odd, max_docs=3).collect()
    assert len(got) == len(odd_rows)
    places = defaultdict(set)
    norm = lambda x: SPACE.sub(" ", re.sub("[0-9]+", "0", x)).strip(" ").lower()
    for r in odd_rows:
        for x in (r[1] or "").split("\n"):
            if words(x):
                places[r[3], norm(x)].add(r[1])
    want = []
    for r in odd_rows:
        m = measures(r[1])
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        gone = sum(len(words(x)) for x in (r[1] or "").split("\n") if words(x) and len(places[r[3], norm(x)]) > 3)
        left = m[0] - gone
        want.append((r[0], *m, failed, not failed and not (gone and (left < 10 or left < 0.2 * m[0]))))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(want, key=repr)


def test_frequent_lines_are_removed_and_copies_count_once(spark, rows):
    lines = [(i, f"Page {i} of this site\n" + " ".join(f"w{'abcdefghijkl'[i]}{j}" for j in range(4)), "h") for i in range(12)]
    copies = [(100 + i, "some text that many pages have in just this way\nand a second line of it here too", "h") for i in range(12)]
    rest = [(300, "Page 7 of this site\n" + " ".join(f"v{j}" for j in range(30)), "h"), (301, "Page 7 of this site\n" + " ".join(f"w{j}" for j in range(30)), "other")]
    docs = spark.createDataFrame([(i, t, s) for i, t, s in lines + copies + rest], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["removed_words"], r["kept"]) for r in quality_rules.judged(docs, max_docs=5).collect()}
    assert all(got[100 + i] == (0, True) for i in range(12))
    assert got[300] == (5, True) and got[301] == (0, True) and got[0][0] == 5
    kept = quality_rules.keep_good(docs, max_docs=5)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, v in got.items() if v[1])


def test_documents_are_counted_not_neighbours(spark):
    name = lambda *n: "".join(chr(97 + d) for x in n for d in (x // 26, x % 26))  # noqa: E731  digits are all alike in a line
    notice = "\n".join(" ".join(name(0, i, j) for j in range(8)) for i in range(6))
    held = [(i, f"{notice}\n" + " ".join(name(1, i, j) for j in range(11)), "h") for i in range(200)]
    # one document with a line sixty times, each time between other lines, and another document that has it once
    twice = [(500, "\n".join(f"between line {'x' * i} stands\nthe line that comes again" for i in range(60)), "g"), (501, "the line that comes again\n" + " ".join(f"v{j}" for j in range(12)), "g")]
    docs = spark.createDataFrame(held + twice, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["removed_words"], r["base_failed"], r["kept"]) for r in quality_rules.judged(docs).collect()}
    assert all(got[i] == (48, False, False) for i in range(200))
    assert got[501] == (0, False, True) and got[500][0] == 0


def test_lines_above_the_limit_leave_the_text(spark):
    texts = [f"Shared  line 7\n\n" + " ".join(chr(97 + i) + chr(97 + j) for j in range(20)) + "\nshared line 8\n tail" for i in range(6)]
    docs = spark.createDataFrame([(i, t, None, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in quality_rules.keep_good(docs, max_docs=5).collect()}
    # all have the last line too, in white space other than this
    want = {i: "\n" + t.split("\n")[2] for i, t in enumerate(texts)}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def brute_mix(rows):
    """(id, size, source size, target, taken) with targets by repeated resharing, thresholds by sorting."""
    size = [len(words(r[1])) for r in rows]
    code = [int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size, strict=True):
        total[r[3]] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, left = {}, set(), float(sum(size))
    while True:
        open_ = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] >= 3 * total[s]]
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 3.0 * total[s]
            capped.add(s)
            left -= target[s]
        if len(capped) == len(order):
            break
    return size, code, total, target


def test_targets_and_budgets(odd, odd_rows):
    size, code, total, target = brute_mix(odd_rows)
    got = mixing.mixed(odd).collect()
    assert len(got) == len(odd_rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted((r[0] is None, r[0] or 0, n) for r, n in zip(odd_rows, size, strict=True))
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == total[r["source"]]
        assert r["taken"] <= 3 * r["size"] and r["hash"] in code
        taken[r["source"]] += r["taken"]
    alike = Counter()  # rows of one id are taken together
    for r, n in zip(odd_rows, size, strict=True):
        alike[r[3], r[0]] += n
    largest = {s: max(n for (x, _), n in alike.items() if x == s) for s in total}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in total)
    again = mixing.mixed(odd.repartition(2)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_repeats_whole_rows(odd):
    want = {(r["doc_id"], r["size"]): r["copies"] for r in mixing.mixed(odd).collect()}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    n = Counter((r["doc_id"], len(words(r["text"]))) for r in mixed.collect())
    times = Counter((r["doc_id"], len(words(r["text"]))) for r in odd.collect())
    assert all(n[k] == want[k] * times[k] for k in times)


def test_the_mix_takes_what_was_planned(spark):
    """Ids that repeat with texts of other lengths: each size is taken as the plan says."""
    rows = [(i % 40, "w " * (1 + (i * 7) % 23), f"s{i % 3}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.mixed(docs).agg(F.sum("taken")).first()[0]
    assert sum(len(words(r["text"])) for r in mixing.mix(docs).collect()) == planned


def test_many_sources_against_sql(spark, rows):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', cast(1 + pmod(xxhash64(id), 40) as int))").alias("text"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("s"), (F.col("id") % 11).cast("string"))).alias("source"),
    )
    frame = docs.toPandas()
    connection = duckdb.connect()
    connection.register("documents", frame)
    want = sorted(connection.execute(mixing.SQL).fetchall())
    assert rows(mixing.mixed(docs), "doc_id", "size", "source_size", "target", "taken") == sorted(want, key=repr)


def test_empty(empty):
    assert quality_rules.judged(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0
    assert mixing.mixed(empty).count() == 0 and mixing.mix(empty).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")
@pytest.mark.parametrize("module", [quality_rules, mixing])
def test_queries_against_sql(spark, module):
    documents = f"{SF_DIR}/documents.parquet"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{documents}'")
    got, result = module.query(spark, SF_DIR), connection.execute(module.SQL)
    names = [c[0] for c in result.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(result.fetchall()) and got.columns == names
