"""Audit of how five document filters interact: what each removes, alone and in every order.

The filters fail a text with few words (A), few different words (B), many capitals (C) or a symbol (D), and a copy of a text
that a smaller document id has (E). A to D come from one pass of a table-driven byte transducer over whole texts, whose word
spans go into a verified hash table (`byte_words`). They are functions of the text, so copies share them; E then needs the
least id of each text only, which is reduced per task. The 120 orders are evaluated on the counts per part and set of failed
filters, at most 32 a part, never on documents.

Defined results: a null text is empty, it fails A and is a copy of other empty texts. A null source and an empty one are the
part ''. A repeated row counts as often as it stands there, and copies of one id are not copies of a smaller id. A null id is
neither smaller than another nor has it a label. Several labels of an id: one that says 1 is enough. Texts are compared by a
hash of 128 bits. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.byte_words import Texts, classes, distinct
from lakewarden.llm.common import pieces, stored, table

LETTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_SHARE = 65
CAPITAL_SHARE = 5
SYMBOLS = b"#$%&*|"
_CLASS, _BIT = classes(
    space=b"\x20\x09\x0a\x0b\x0c\x0d",
    capital=bytes(range(0x41, 0x5B)),
    symbol=SYMBOLS,
    continuation=bytes(range(0x80, 0xC0)),
)
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")


def measured(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of each text of an Arrow column, and the hash of its bytes."""
    texts = Texts(column)
    kind = _CLASS[texts.data[: texts.size]]
    starts, ends = texts.words((kind & _BIT["space"]) == 0)
    found = {name: texts.per_text(np.flatnonzero(kind & _BIT[name])) for name in ("capital", "continuation", "symbol")}
    bounds, raw = texts.bounds.tolist(), texts.data
    return {
        "n_words": texts.per_text(starts),
        "n_distinct": distinct(texts, starts, ends),
        "n_capitals": found["capital"],
        "n_chars": np.diff(texts.bounds) - found["continuation"],
        "n_symbols": found["symbol"],
        "text_key": [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(bounds, bounds[1:])],
    }


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, part and the counts of every whole text."""

    def run(batches):
        for batch in batches:
            for some in pieces([batch]):
                found = measured(some.column("text"))
                arrays = [some.column("doc_id"), some.column("part"), pa.array(found["text_key"], pa.binary())]
                arrays += [pa.array(found[c], pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "text_key", *COUNTS])

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    schema = "doc_id long, part string, text_key binary, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, F.col(text).alias("text")).mapInArrow(run, schema)


def failures(found: DataFrame) -> DataFrame:
    """The measures with `failed`, bits of the filters A to D that a document fails."""
    fails = [
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < DISTINCT_SHARE * F.col("n_words"),
        100 * F.col("n_capitals") > CAPITAL_SHARE * F.col("n_chars"),
        F.col("n_symbols") > 0,
    ]
    failed = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return found.select("doc_id", "part", "text_key", failed.cast("int").alias("failed"))


def labelled(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with whether a label calls them good or toxic. Null ids are spread by their text, since they have none."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).select(F.lit(False).alias("no_id"), "label_id", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    keyed = found.withColumn("no_id", F.col("doc_id").isNull()).withColumn("label_id", F.coalesce("doc_id", F.xxhash64("text_key")))
    return keyed.join(known, ["no_id", "label_id"], "left").select(*found.columns, F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def histogram(found: DataFrame) -> DataFrame:
    """Documents, good and toxic ones per part and set of failed filters, E included."""
    same = ["text_key", "failed", "part", "good", "toxic"]
    rows = found.groupBy(*same, "doc_id").agg(F.count("*").alias("rows"))  # repeated rows of an id together
    groups = rows.groupBy(*same).agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("no_id"),
        F.min("doc_id").alias("least"),
        F.min_by("rows", "doc_id").alias("at_least"),
    )
    # a text has one group per part and labels here, however many copies it has
    first = groups.withColumn("first", F.col("least") == F.min("least").over(Window.partitionBy("text_key")))
    kept = F.col("no_id") + F.when(F.col("first"), F.col("at_least")).otherwise(0)
    split = first.select("part", "good", "toxic", F.explode(F.array(F.struct("failed", kept.alias("n")), F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - kept).alias("n")))).alias("x"))
    return split.groupBy("part", F.col("x.failed").alias("failed")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")
    )


def orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from the counts per part and set of failed filters."""
    steps = []
    for order in permutations(range(5)):
        name, before = "".join(LETTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            steps.append((name, step, LETTERS[i], 1 << i, before))
            before |= 1 << i
    # 600 constants, joined to at most 32 rows of a part by exploding
    each = F.explode(F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(f).alias("f"), F.lit(b).alias("bit"), F.lit(m).alias("before")) for o, s, f, b, m in steps])).alias("s")
    rows = counts.select("*", each)
    hit, earlier = F.col("failed").bitwiseAND(F.col("s.bit")) != 0, F.col("failed").bitwiseAND(F.col("s.before")) != 0

    def total(column: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(column)).otherwise(0)).cast("long")

    out = rows.groupBy("part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"), F.col("s.f").alias("letter")).agg(
        total("n", ~hit & ~earlier).alias("kept"),
        total("n", hit & ~earlier).alias("removed"),
        total("n", hit & earlier).alias("redundant"),
        total("n", F.col("failed") == F.col("s.bit")).alias("unique_fails"),
        total("good", hit & ~earlier).alias("good_lost"),
        total("toxic", hit & ~earlier).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")
    return out.select("*", shapley).drop("letter")


def audit(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    found = stored(failures(measures(docs, text)), "failures")
    return orders(stored(histogram(labelled(found, labels)), "failed-sets"))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = """
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), first AS (
    SELECT t AS first_text, min(doc_id) AS least FROM words GROUP BY t
), label AS (
    SELECT doc_id AS label_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), flags AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           len(w) < 50 AS a,
           100 * len(list_distinct(w)) < 65 * len(w) AS b,
           100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS c,
           regexp_matches(t, '[#$%&*|]') AS d,
           coalesce(least < doc_id, false) AS e
    FROM words JOIN first ON t = first_text LEFT JOIN label ON doc_id = label_id
), sets AS (
    SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM flags GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), all_orders AS (
    SELECT [p.l, q.l, r.l, s.l, u.l] AS o
    FROM letters p, letters q, letters r, letters s, letters u
    WHERE len(list_distinct([p.l, q.l, r.l, s.l, u.l])) = 5
), steps AS (
    SELECT o, unnest([1, 2, 3, 4, 5])::INT AS step FROM all_orders
), marked AS (
    SELECT part, o, step, o[step] AS letter, n, good, toxic, f[o[step]] AS hit,
           len(list_filter(o[1:step - 1], lambda x: f[x])) > 0 AS earlier,
           len(list_filter(o, lambda x: f[x])) = 1 AS single
    FROM sets, steps
), summed AS (
    SELECT part, array_to_string(o, '') AS filter_order, step, letter,
           sum(CASE WHEN NOT hit AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN hit AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN hit AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN hit AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN hit AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN hit AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM marked GROUP BY part, o, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed
"""
