"""Mixing sources to target weights with hash-threshold histograms.

A document's size is its number of words. Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ...; together they
get as many words as there are, but none more than three times its own, the excess going to the others by weight.
A source takes each document as often as its target holds it whole; the rest is a budget met by those documents
whose hash is below the source's threshold. The threshold is found by histograms: words per source and hash bucket,
the bucket in which the budget ends, then that bucket alone by the next bits, until a bucket holds one hash. Nothing is
sorted by document.

Defined results: null and empty texts have size 0 and take nothing; a null source is a source of its own, last; documents of
equal id share a hash, and those of equal size too are taken alike; the very last hash is taken when that brings the source nearer to its budget (a
tie leaves it out); an empty table gives no rows; extra columns are kept out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import SPACE, stored, words_of

WEIGHTS = (5, 2, 1)
MOST = 3
#: Bits of the hash in all, and bits that one histogram resolves.
BITS, STEP = 60, 10
#: Nested budgets: what the first leaves over is filled from documents behind its threshold that fit, and so on.
ROUNDS = 3


def hash60(key: Column) -> Column:
    """First 15 hexadecimal digits of the key's MD5, as a number; a null key counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> with `target`, by water filling over the sources.

    With sources in rising order of limit per weight, a prefix of them stops at its limit and the others share what is left
    by weight. There is one row per source here, never per document.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(F.row_number().over(ranked) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = sizes.withColumn("weight", weight).withColumn("limit", F.lit(float(MOST)) * F.col("source_size"))
    s = s.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(filled), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
    s = s.withColumn("place", F.col("limit") / F.col("weight")).withColumn("level", F.col("left") / F.col("open"))
    # a level holds for the first source that stays under its limit; it is the level of all behind it
    under = F.col("level") * F.col("weight") < F.col("limit")
    s = s.withColumn("first", F.min(F.when(under, F.struct("place", F.col("source").isNull().alias("last"), "source", "level"))).over(everything))
    stops = F.col("first").isNull() | (F.struct("place", F.col("source").isNull(), "source") < F.struct("first.place", "first.last", "first.source"))
    return s.select("source", "source_size", F.when(stops, F.col("limit")).otherwise(F.col("first.level") * F.col("weight")).alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame, nearest: bool) -> DataFrame:
    """(source, size, hash) and (source, budget) -> (source, below, rest): documents with a hash under `below` meet the budget.

    Each level sums words by source and bucket of the hashes that share the source's prefix so far, and keeps the bucket in
    which the rest of the budget ends. The hash at the end is taken if it fits or, with `nearest`, if that comes nearer.
    """
    state = budgets.select(F.col("source").alias("s"), F.col("budget").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    for used in range(0, BITS, STEP):
        low = BITS - used - STEP
        inside = docs.join(state, docs["source"].eqNullSafe(state["s"]) & (F.shiftright(docs["hash"], low + STEP) == state["prefix"]))
        sums = inside.groupBy("s", "rest", F.shiftright("hash", low).alias("bucket")).agg(F.sum("size").alias("n"))
        before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("sofar", F.coalesce(F.sum("n").over(before), F.lit(0)))
        # the last bucket that begins within the budget: the rest of the budget ends in it, or beyond the last one
        state = (
            sums.filter(F.col("sofar") <= F.col("rest")).groupBy("s")
            .agg(F.max_by(F.struct((F.col("rest") - F.col("sofar")).alias("rest"), F.col("bucket"), F.col("n")), "bucket").alias("b"))
            .select("s", "b.rest", F.col("b.bucket").alias("prefix"), F.col("b.n").alias("last"))
        )
        if used + STEP < BITS:
            state = state.select("s", "rest", "prefix")
    takes = F.col("last") - F.col("rest") < F.col("rest") if nearest else F.col("last") <= F.col("rest")
    rest = F.col("rest") - F.when(takes, F.col("last")).otherwise(0)
    return state.select(F.col("s").alias("source"), F.when(takes, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("below"), rest.alias("rest"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """One row per document: (key, source, size, hash, source_size, target, copies, taken)."""
    sized = docs.select(F.col(key), F.col(source).alias("source"), F.size(words_of(F.col(text))).cast("long").alias("size"), hash60(F.col(key)).alias("hash"))
    sized = stored(sized, "mix-sizes")
    # one small row per source and step of the way from here on
    aims = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)) + F.lit(1e-12))
    aims = aims.withColumn("whole", whole).withColumn("budget", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    some = sized.filter("size > 0").select("source", "size", "hash")
    aims = aims.withColumn("below0", F.lit(0).cast("long")).withColumn("limit0", F.col("budget"))
    for n in range(1, ROUNDS + 1):
        now = aims.select(F.col("source").alias("of"), F.col(f"below{n - 1}").alias("from"), F.col(f"limit{n - 1}").alias("limit"))
        fits = some.join(now, some["source"].eqNullSafe(now["of"]) & (some["hash"] >= now["from"]) & (some["size"] <= now["limit"])) if n > 1 else some
        found = thresholds(fits.select("source", "size", "hash"), aims.select("source", F.col(f"limit{n - 1}").alias("budget")), n == ROUNDS)
        found = found.select(F.col("source").alias("of"), F.col("below").alias("b"), F.col("rest").alias("r"))
        aims = aims.join(found, aims["source"].eqNullSafe(found["of"]), "left").drop("of")
        aims = aims.withColumn(f"below{n}", F.coalesce("b", f"below{n - 1}")).withColumn(f"limit{n}", F.coalesce("r", f"limit{n - 1}")).drop("b", "r")
        aims = stored(aims, "mix-thresholds")
    aims = aims.withColumnRenamed("source", "s")
    # the first round takes any size, the others those that fit into what was left
    taken = F.col("hash") < F.col("below1")
    for n in range(2, ROUNDS + 1):
        taken |= (F.col("hash") >= F.col(f"below{n - 1}")) & (F.col("hash") < F.col(f"below{n}")) & (F.col("size") <= F.col(f"limit{n - 1}"))
    copies = F.least(F.col("whole") + F.when(taken, 1).otherwise(0), F.lit(MOST)).cast("long")
    return (
        sized.join(aims, sized["source"].eqNullSafe(aims["s"])).withColumn("copies", copies)
        .select(key, "source", "size", "hash", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mix itself: each document as many times as it is taken, with all its columns."""
    plan = mixed(docs, text, source, key)
    # rows of equal source, id and size are taken alike
    picks = plan.groupBy("source", "hash", "size").agg(F.max("copies").alias("__copies")).filter("__copies > 0")
    picks = picks.select(F.col("source").alias("__source"), F.col("hash").alias("__hash"), F.col("size").alias("__size"), "__copies")
    size = F.size(words_of(docs[text])).cast("long")
    same = docs[source].eqNullSafe(picks["__source"]) & (hash60(docs[key]) == picks["__hash"]) & (size == picks["__size"])
    joined = docs.join(picks, same)
    doc = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
    return joined.select(doc, F.explode(F.sequence(F.lit(1), picks["__copies"].cast("int")))).select("doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


ROUND_SQL = "\n".join(
    f"""c{n} AS (SELECT s.*, sum(n) OVER (PARTITION BY s.source ORDER BY hash) - n AS sofar, rest FROM
    (SELECT d.source, hash, sum(size) AS n, any_value(rest) AS rest FROM sized d JOIN x{n - 1} x ON d.source IS NOT DISTINCT FROM x.source
     WHERE size > 0 AND hash >= below AND (size <= rest OR {n} = 1) GROUP BY ALL) s),
e{n} AS (SELECT source, max_by(CASE WHEN {take} THEN hash + 1 ELSE hash END, hash) AS below,
     max_by(rest - sofar - CASE WHEN {take} THEN n ELSE 0 END, hash) AS rest FROM c{n} WHERE sofar <= rest GROUP BY source),
x{n} AS (SELECT x.source, coalesce(e.below, x.below) AS below, coalesce(e.rest, x.rest) AS rest
     FROM x{n - 1} x LEFT JOIN e{n} e ON x.source IS NOT DISTINCT FROM e.source),"""
    for n in range(1, ROUNDS + 1)
    for take in ("n - (rest - sofar) < rest - sofar" if n == ROUNDS else "n <= rest - sofar",)
)
TAKEN_SQL = "hash < x1.below" + "".join(f" OR (hash >= x{n - 1}.below AND hash < x{n}.below AND size <= x{n - 1}.rest)" for n in range(2, ROUNDS + 1))
JOIN_SQL = " ".join(f"JOIN x{n} ON d.source IS NOT DISTINCT FROM x{n}.source" for n in range(1, ROUNDS + 1))
SQL = f"""
WITH sized AS (SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '')) AS size,
               ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
r AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
      3.0::DOUBLE * source_size AS lim FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER f, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
      FROM r WINDOW f AS (ORDER BY lim / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
n AS (SELECT *, row_number() OVER (ORDER BY lim / weight, source ASC NULLS LAST) AS place FROM l),
f AS (SELECT min(place) AS first, min_by(level, place) AS level FROM n WHERE level * weight < lim),
a AS (SELECT source, source_size, CASE WHEN first IS NULL OR place < first THEN lim ELSE f.level * weight END AS target FROM n, f),
b AS (SELECT *, floor(target / greatest(source_size, 1) + 1e-12) AS whole FROM a),
h AS (SELECT source, hash, sum(size) AS n FROM sized WHERE size > 0 GROUP BY ALL),
x0 AS (SELECT source, 0::BIGINT AS below, greatest(target - whole * source_size, 0)::DOUBLE AS rest FROM b),
{ROUND_SQL}
p AS (SELECT d.*, {TAKEN_SQL} AS hit FROM sized d {JOIN_SQL})
SELECT doc_id, size, b.source_size, target, (least(whole + CASE WHEN hit THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
