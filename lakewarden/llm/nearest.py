"""Approximate nearest neighbours by cosine with an adaptive dimension scan.

Vectors are scaled to length one and turned by one random rotation, so that any block of columns is a fair sample of a
distance. They are dealt to lists by their nearest centre (k-means on a bounded sample). A query probes its nearest lists.
Within a list the scan goes through blocks of columns: after each, a hypothesis test drops candidates whose partial
distance is too large for their whole distance to be among the best so far. What remains is measured exactly on the
original vectors in double precision.

Lists are cut into chunks of candidates, and the queries that probe a list into chunks as well, so groups stay bounded
however large a list is. Centres and rotation are bounded by the number of lists and dimensions.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those of another
dimension than the most frequent one; ids may be null for candidates, such rows are never queries; equal scores go to the
smaller id (null last); a query's own row is the one with its id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import stored

#: Vectors that the centres are fitted on at most, lists, lists probed, and results per query.
SAMPLE, LISTS, PROBES, NEAREST = 20_000, 64, 40, 5
#: Columns per block, and the strictness of the test: larger drops less.
BLOCK, EPSILON = 16, 2.1
#: Candidates and queries in one group at most, about.
CANDIDATES, QUERIES = 1024, 2048


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): vectors that take part, as doubles."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    found = table.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(F.size("v") > 0)
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return found.filter(F.coalesce(fine, F.lit(False)))


def centres(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; empty centres keep their place."""
    r = np.random.default_rng(5)
    found = sample[r.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        near = (sample @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(size > 0, sums / np.maximum(size, 1e-12), found)
    return found


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def scan(query: np.ndarray, turned: np.ndarray, rows: np.ndarray, nearest: int, block: int = BLOCK, epsilon: float = EPSILON) -> np.ndarray:
    """Indexes of the candidates (of `rows`) that may be among the nearest to the turned query.

    Candidates come in batches; the bound is the `nearest`-th smallest whole distance so far.
    """
    dim = len(query)
    best = np.zeros(0)
    kept = []
    for start in range(0, len(rows), 128):
        alive = rows[start : start + 128]
        bound = np.partition(best, nearest - 1)[nearest - 1] if len(best) >= nearest else np.inf
        sofar = np.zeros(len(alive))
        for at in range(0, dim, block):
            gap = turned[alive, at : at + block] - query[at : at + block]
            sofar = sofar + np.einsum("ij,ij->i", gap, gap)
            seen = min(at + block, dim)
            if np.isfinite(bound) and seen < dim:
                near = sofar <= bound * (seen / dim) * (1 + epsilon / math.sqrt(seen)) ** 2 + 1e-12
                alive, sofar = alive[near], sofar[near]
        near = sofar <= bound + 1e-9
        kept.append(alive[near])
        best = np.concatenate([best, sofar[near]])
        if len(best) > 64 * nearest:
            best = np.partition(best, nearest - 1)[:nearest]
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def cosine(query: np.ndarray, found: np.ndarray) -> np.ndarray:
    return (found * query).sum(1) / (np.sqrt((found * found).sum(1)) * math.sqrt(float((query * query).sum())))


def _no_rows(spark) -> DataFrame:
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search(table: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, nearest: int = NEAREST, lists: int = LISTS, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows of every query, the rows whose id is divisible by `every`."""
    spark = table.sparkSession
    found = stored(usable(table, key, vector), "vectors")
    sizes = found.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return _no_rows(spark)
    dim = sizes[0]["dim"]
    found = found.filter(F.size("v") == dim)
    sample = np.array([r["v"] for r in found.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()])
    sample /= np.abs(sample).max(axis=1, keepdims=True)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    middle, turn = centres(sample, lists), rotation(dim)
    probes = min(probes, len(middle))

    def deal(batches):
        """Every vector with its list, and every query with each list that it probes."""
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), float).reshape(-1, dim)
            unit = v / np.abs(v).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            near = unit @ middle.T
            ids = batch.column("id")
            asks = np.array([i is not None and i % every == 0 for i in ids.to_pylist()], bool)
            probed = np.argsort(-near[asks], axis=1, kind="stable")[:, :probes]
            who = np.concatenate([np.arange(len(v)), np.repeat(np.flatnonzero(asks), probes)])
            where = np.concatenate([near.argmax(1), probed.ravel()]).astype(np.int32)
            asked = np.arange(len(who)) >= len(v)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(who)), batch.column("v").take(pa.array(who)), pa.array(where), pa.array(asked)], names=["id", "v", "list", "asks"])

    dealt = stored(found.mapInArrow(deal, "id long, v array<double>, list int, asks boolean"), "lists")
    counts = dealt.groupBy("list").agg(F.sum((~F.col("asks")).cast("long")).alias("c"), F.sum(F.col("asks").cast("long")).alias("q")).collect()  # one row per list
    plan = spark.createDataFrame([(r["list"], max(1, -(-r["c"] // CANDIDATES)), max(1, -(-r["q"] // QUERIES))) for r in counts], "list int, cs long, qs long")
    placed = dealt.join(F.broadcast(plan), "list")
    own_c, own_q = F.pmod(F.xxhash64("id", "v"), F.col("cs")), F.pmod(F.xxhash64("id"), F.col("qs"))
    # a query goes to every chunk of candidates of its list, a candidate to every chunk of queries
    placed = placed.withColumn("c", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("cs") - 1)).otherwise(F.array(own_c))))
    placed = placed.withColumn("q", F.explode(F.when(F.col("asks"), F.array(own_q)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("qs") - 1))))

    def nearest_in(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(group["v"].to_numpy())
        unit = v / np.abs(v).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        turned = unit @ turn
        asks = group["asks"].to_numpy()
        ids = group["id"].astype("Int64")
        missing = ids.isna().to_numpy()
        ids = ids.fillna(0).to_numpy(np.int64)
        rows = np.flatnonzero(~asks)
        out = []
        for q in np.flatnonzero(asks):
            picked = scan(turned[q], turned, rows[missing[rows] | (ids[rows] != ids[q])], nearest)
            score = cosine(v[q], v[picked])
            best = np.lexsort((ids[picked], missing[picked], -score))[:nearest]
            out += [(ids[q], None if missing[picked[b]] else ids[picked[b]], score[b]) for b in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "Int64", "score": "float64"})

    hits = placed.select("id", "v", "asks", "list", "c", "q").groupBy("list", "c", "q").applyInPandas(nearest_in, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
