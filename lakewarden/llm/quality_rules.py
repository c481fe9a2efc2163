"""Document rules and cross-document line frequency, in DataFrame functions only.

Base rules look at one document: too few words, or too many words inside repeated five-word windows. Line frequency
looks across documents: lines are normalised and hashed, the documents that hold a line are counted per host, lines
above the limit are removed, and a document with too little left is rejected.

Documents are told apart by a hash of their whole text, so copies of a text count once and are not taken for boilerplate,
and a document counts once for a line, however often and wherever it holds it.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own; rows that repeat,
also with the same id, are judged each; ids may be null; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import SPACE, let, stored, words_of

#: A line is above the limit when more documents of its host than this hold it.
MAX_DOCS = 50
#: A document is depleted when fewer words than this, or less than this share of its words, are left.
MIN_WORDS = 10
MIN_SHARE = 0.2
WINDOW = 5


def repeat_words(words: Column) -> Column:
    """Number of words inside windows of five that occur twice or more in the array."""

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW)))), once)

    def once(h: Column) -> Column:
        again = let(F.sort_array(h), lambda s: F.exists(F.transform(s, lambda x, i: F.get(s, i + 1) == x), lambda x: F.coalesce(x, F.lit(False))))
        return F.when(again, let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), covered)).otherwise(F.lit(0))

    def covered(s: Column) -> Column:
        same = F.transform(
            s,
            lambda x, i: F.when((F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])), x["p"]),
        )
        return let(F.sort_array(F.array_compact(same)), lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b))

    return F.when(F.size(words) > WINDOW, let(words, of)).otherwise(F.lit(0)).cast("long")


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space as one blank."""
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(line, "[0-9]+", "0"), SPACE + "+", " ")))


def measured(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Row id, host and base measures of every document, with its lines as (hash, words)."""
    t = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        F.col(host).alias("host"),
        words_of(t).alias("words"),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.md5(t).alias("text_key"),
    )
    marks = F.transform(F.col("lines"), lambda x: F.struct(F.xxhash64(normalised(x)).alias("h"), F.size(words_of(x)).alias("w")))
    return split.select(
        "row",
        "doc_id",
        "host",
        "text_key",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        marks.alias("marks"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def frequent_lines(rows: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h) of lines that more than `max_docs` distinct documents of the host hold."""
    lines = rows.select("host", F.xxhash64("text_key").alias("document"), F.explode(F.array_distinct("marks.h")).alias("h"))
    return (
        lines.groupBy("host", "h", "document").agg(F.lit(1).alias("one")).groupBy("host", "h").agg(F.count("*").alias("docs"))
        .filter(F.col("docs") > max_docs).select("host", "h")
    )


def judged(docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per document: measures, `removed_words` and `removed` (lines above the limit, as hashes), `base_failed` and `kept`."""
    rows = stored(measured(docs, text, host), "quality-lines")
    lines = rows.select("row", "host", F.explode("marks").alias("m")).select("row", "host", "m.h", "m.w")
    limits = frequent_lines(rows, max_docs).withColumnRenamed("host", "of").withColumnRenamed("h", "of_h")
    removed = (
        lines.join(limits, lines["host"].eqNullSafe(limits["of"]) & (lines["h"] == limits["of_h"]))
        .groupBy(F.col("row").alias("of_row")).agg(F.sum("w").alias("removed_words"), F.collect_set("h").alias("removed"))
    )
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < MIN_WORDS) | (left < MIN_SHARE * F.col("n_words")))
    return (
        rows.drop("marks").join(removed, F.col("row") == F.col("of_row"), "left").drop("of_row")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = MAX_DOCS, chars: str = "n_chars") -> DataFrame:
    """The documents that no rule rejects, with all their columns, without the lines above the limit.

    Verdict and lines depend on host and text alone, so they are joined back by both. A text that loses lines has its
    characters counted anew, if there is a column for them.
    """
    found = judged(docs, text, host, max_docs)
    changed = found.filter(~F.col("kept") | (F.col("removed_words") > 0))
    changed = changed.groupBy(F.col("host").alias("__host"), F.col("text_key").alias("__key")).agg(
        F.first("kept").alias("__kept"), F.first("removed").alias("__gone")
    )
    key = F.md5(F.coalesce(docs[text], F.lit("")))
    joined = docs.join(changed, docs[host].eqNullSafe(changed["__host"]) & (key == changed["__key"]), "left").filter(F.coalesce("__kept", F.lit(True)))
    lines = F.filter(F.split(docs[text], "\n", -1), lambda x: ~F.array_contains("__gone", F.xxhash64(normalised(x))) | ~x.rlike(r"[^\x20\x09-\x0D]"))
    left = F.when(F.col("__gone").isNull(), docs[text]).otherwise(F.array_join(lines, "\n"))
    new = {text: left}
    if chars in docs.columns:
        new[chars] = F.when(F.col("__gone").isNull(), docs[chars]).otherwise(F.length(left).cast(docs.schema[chars].dataType))
    return joined.select(*[new[c].alias(c) if c in new else docs[f"`{c}`"] for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, source, text, list_filter(string_split_regex(text, '{SPACE}+'), lambda x: x <> '') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
win AS (SELECT r, unnest(range(1, len(words) - 3)) AS p, words FROM w WHERE len(words) >= 5),
keyed AS (SELECT r, p, array_to_string(words[p:p + 4], ' ') AS k FROM win),
again AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS n FROM keyed) WHERE n > 1),
covered AS (SELECT r, sum(least(5, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 5))) AS n FROM again GROUP BY ALL),
rep AS (SELECT r, sum(n) AS n FROM (SELECT r, least(5, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 5)) AS n FROM again) GROUP BY r),
line AS (SELECT r, source, i, lines[i] AS raw, trim(lower(regexp_replace(regexp_replace(lines[i], '[0-9]+', '0', 'g'), '{SPACE}+', ' ', 'g'))) AS line
         FROM (SELECT r, source, lines, unnest(range(1, len(lines) + 1)) AS i FROM w)),
often AS (SELECT source, line FROM (SELECT DISTINCT l.source, line, text FROM line l JOIN t USING (r)) GROUP BY source, line HAVING count(*) > {MAX_DOCS}),
removed AS (SELECT r, sum(len(list_filter(string_split_regex(raw, '{SPACE}+'), lambda x: x <> ''))) AS n FROM line p
            JOIN often o ON p.source IS NOT DISTINCT FROM o.source AND p.line = o.line GROUP BY r),
m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '{SPACE}+', '', 'g')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0) AS gone
      FROM w LEFT JOIN rep USING (r) LEFT JOIN removed USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (gone > 0 AND (n_words - gone < {MIN_WORDS} OR n_words - gone < {MIN_SHARE} * n_words)) AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
""".replace("covered AS (SELECT r, sum(least(5, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 5))) AS n FROM again GROUP BY ALL),\n", "")
