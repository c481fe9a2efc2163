"""Deliveries that hold two keys and count only if both are free.

A delivery is taken if neither its event key nor its signature key was taken within the time to
live; if the second key is not free, the first is given back. So whether one key is free depends
on the other keys of earlier deliveries. In most data it does not come to that: if all deliveries
with a signature name the same event, a taken signature means a taken event, and the signature
decides nothing (and the other way round). Such keys are dropped by counts per key, and
what is left with one key follows its own time chain, which is safe for hot keys. Only deliveries
whose keys cross are walked together, one component of crossing keys at a time, in time order.

A key that a single delivery holds blocks nothing. Most keys are of that kind, so they are sorted out
first, by counts per hash, and deliveries without another key are accepted.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.fixed_values import EVENT_DEDUPE_SECONDS
from lakewarden.operators.components import connected_components
from lakewarden.operators.dedupe import accepted_in_time
from lakewarden.session import checkpoint, scratch_folder, shuffles_removed, stored


class KeysHeld:
    """Keys taken within the last `step` microseconds; older ones are forgotten."""

    def __init__(self, step: int):
        self.step = step
        self.until: dict[str, int] = {}
        self.order: deque[tuple[int, str]] = deque()

    def clear(self) -> None:
        self.until.clear()
        self.order.clear()

    def take(self, now: int, keys: list[str]) -> bool:
        """Takes all keys if all are free, else none."""
        while self.order and self.order[0][0] <= now:
            end, key = self.order.popleft()
            if self.until.get(key) == end:
                del self.until[key]
        if any(k in self.until for k in keys):
            return False
        for k in keys:
            self.until[k] = now + self.step
            self.order.append((now + self.step, k))
        return True


def shared_keys(rows: DataFrame, tie: str) -> DataFrame:
    """`rows` `(k1, k2, __at, tie)` with keys that only one of them holds set to null.

    Keys are counted by a hash of 64 bits; where hashes meet, a lone key is kept, which changes no result.
    A row without a time or `tie` keeps its keys, as it is not settled by being alone.
    """
    hashes = {k: F.when(F.col(k).isNotNull(), F.xxhash64(k)) for k in ("k1", "k2")}
    held = rows.select(F.explode(F.array(*hashes.values())).alias("h")).where("h is not null")
    often = held.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # rows without the key are dealt by their own values
    lone, unsettled = F.xxhash64(*rows.columns), F.col("__at").isNull() | F.col(tie).isNull()
    for key in ("k2", "k1"):
        named = often.select(F.col("h").alias("__often"))
        joined = rows.join(named, F.coalesce(hashes[key], lone) == F.col("__often"), "left")
        rows = joined.withColumn(key, F.when(F.col("__often").isNotNull() | unsettled, F.col(key))).drop("__often")
    return rows


def deciding_keys(rows: DataFrame) -> DataFrame:
    """Adds `key1` and `key2`, of the keys `k1` and `k2` (`1:…`, `2:…`, nulls allowed) those that decide.

    k2 is dropped where it always comes with the same k1, and k1 where it always comes with the
    same k2 that is not dropped itself. Rows without a key are dealt by their own values, as names
    that no key has; as nulls they would all meet in one task.
    """
    name = F.concat(F.lit("0:"), F.xxhash64(*rows.columns).cast("string"))
    lone1, lone2 = (name.cast(rows.schema[k].dataType) for k in ("k1", "k2"))
    one_first = (F.min("k1") == F.max("k1")) & (F.count("k1") == F.count(F.lit(1)))
    of_second = rows.where("k2 is not null").groupBy(F.col("k2").alias("__k2")).agg(one_first.alias("__same1"))
    marked = rows.join(of_second, F.coalesce("k2", lone2) == F.col("__k2"), "left").withColumn(
        "key2", F.when(~F.coalesce("__same1", F.lit(False)), F.col("k2"))
    )
    one_second = (F.min("key2") == F.max("key2")) & (F.count("key2") == F.count(F.lit(1)))
    of_first = marked.where("k1 is not null").groupBy(F.col("k1").alias("__k1")).agg(one_second.alias("__same2"))
    joined = marked.join(of_first, F.coalesce("k1", lone1) == F.col("__k1"), "left")
    return joined.withColumn("key1", F.when(~F.coalesce("__same2", F.lit(False)), F.col("k1"))).drop(
        "__k1", "__k2", "__same1", "__same2"
    )


def _walked(crossing: DataFrame, tie: str, ttl_us: int, step: int) -> DataFrame:
    """Accepted `tie`s among deliveries `(key1, key2, __at, tie)` whose keys cross.

    A key rests when a whole time to live passes without it; before and after a rest it counts as
    two nodes of the graph, so components end at rests and stay short in time.
    """
    digests = crossing.schema["key1"].dataType.typeName() == "binary"
    slot = F.floor(F.col("__at") / F.lit(ttl_us)).cast("bigint")
    crossing = crossing.withColumn("slot", slot)
    used = crossing.select(F.explode(F.array("key1", "key2")).alias("key"), "slot").where("key is not null").distinct()
    by_time = Window.partitionBy("key").orderBy("slot")
    wakes = F.when(F.col("slot") - F.lag("slot").over(by_time) <= 1, F.lit(None)).otherwise(F.col("slot"))
    nodes = checkpoint(
        used.withColumn("wake", wakes)
        .withColumn("wake", F.last("wake", ignorenulls=True).over(by_time))
        .select("key", "slot", F.concat_ws("@", "wake", F.base64("key") if digests else "key").alias("node"))
    )

    def node_of(rows: DataFrame, key: str, name: str) -> DataFrame:
        named = nodes.select(F.col("key").alias(key), "slot", F.col("node").alias(name))
        return rows.join(named, [key, "slot"], "left")

    placed = checkpoint(node_of(node_of(crossing, "key1", "n1"), "key2", "n2"))
    links = placed.select(F.coalesce("n1", "n2").alias("n1"), F.coalesce("n2", "n1").alias("n2")).distinct()
    parts = connected_components(links, "n1", "n2")
    located = placed.withColumn("node", F.coalesce("n1", "n2")).join(parts, "node")
    tie_type = crossing.schema[tie].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = None, KeysHeld(step)
        for pdf in batches:
            accepted = []
            for this, at, key1, key2, name in zip(*[pdf[c].tolist() for c in ("component", "__at", "key1", "key2", tie)]):
                if this != part:
                    part = this
                    held.clear()
                if held.take(at, [k for k in (key1, key2) if k is not None]):
                    accepted.append(name)
            if accepted:
                yield pd.DataFrame({"__ok": accepted})

    in_order = located.select("component", "__at", "key1", "key2", tie).repartition("component")
    return in_order.sortWithinPartitions("component", "__at", tie).mapInPandas(walk, f"__ok {tie_type}")


def mark_joint_replays(
    deliveries: DataFrame,
    first: str,
    second: str,
    at: str,
    tie: str,
    ttl_seconds: int = EVENT_DEDUPE_SECONDS,
    strict: bool = False,
) -> DataFrame:
    """Adds `is_duplicate` to deliveries with up to two keys, in the order of `(at, tie)`.

    `tie` is unique. The keys are both text or both digests (binary). A key is free again at least (`strict`: more than) the time to live after the
    delivery that took it. A delivery without keys is always accepted. Copies with equal keys of
    one instant are reduced per task before any shuffle, since only the first of them can count.
    """
    ttl_us = ttl_seconds * 1_000_000
    has_key = F.col(first).isNotNull() | F.col(second).isNotNull()
    keyed = deliveries.where(has_key).select(
        *[F.concat(F.lit(tag).cast(deliveries.schema[k].dataType), F.col(k)).alias(name) for tag, k, name in (("1:", first, "k1"), ("2:", second, "k2"))],
        F.unix_micros(F.col(at).cast("timestamp")).alias("__at"),
        tie,
    )
    spark = deliveries.sparkSession
    with shuffles_removed(spark), scratch_folder(spark) as folder:
        rows = stored(shared_keys(keyed, tie), "replay-keys", "zstd", folder)
        instants = rows.where("k1 is not null or k2 is not null").groupBy("k1", "k2", "__at").agg(F.min(tie).alias(tie))
        placed = stored(deciding_keys(instants).select("key1", "key2", "__at", tie), "replay-deciding", "zstd", folder)
        unshared = rows.where("k1 is null and k2 is null").select(F.col(tie).alias("__ok"))
        accepted = stored(_accepted(placed, tie, ttl_us, strict).unionByName(unshared), "replay-accepted", "zstd")
    # the join moves all deliveries: of the keys only whether there is one
    flagged = deliveries.withColumn("__has_key", has_key).join(accepted, F.col(tie) == F.col("__ok"), "left")
    duplicate = F.col("__has_key") & F.col("__ok").isNull()
    return flagged.select(*deliveries.columns, duplicate.alias("is_duplicate"))


def _accepted(placed: DataFrame, tie: str, ttl_us: int, strict: bool) -> DataFrame:
    """`__ok`, the accepted ties of deliveries `(key1, key2, __at, tie)` with keys that decide."""
    cross = placed.where("key1 is not null and key2 is not null")
    key = F.coalesce("key1", "key2").alias("__key")
    if cross.isEmpty():
        return accepted_in_time(placed.select(key, "__at", tie), "__key", tie, ttl_us, strict)
    crossed = cross.select(F.explode(F.array("key1", "key2")).alias("crossed")).distinct()
    marked = placed.join(crossed, F.coalesce("key1", "key2") == F.col("crossed"), "left")
    alone = marked.where("crossed is null").select(key, "__at", tie)
    together = marked.where("crossed is not null").drop("crossed")
    return accepted_in_time(alone, "__key", tie, ttl_us, strict).unionByName(
        _walked(together, tie, ttl_us, ttl_us + 1 if strict else ttl_us)
    )
