"""Token bucket per caller over a batch of calls, exact and safe for a hot caller."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.fixed_values import BUCKET_SECONDS, BUCKET_TOKENS
from lakewarden.operators.chains import chain_anchors


def refill(tokens: int, last_us: int, now_us: int, size: int, seconds: int) -> tuple[int, int]:
    """Tokens and refill clock at `now`; the clock only moves when a token is added."""
    added = (now_us - last_us) * size // (seconds * 1_000_000)
    if added > 0:
        return min(size, tokens + added), now_us
    return tokens, last_us


def limit_calls(
    calls: DataFrame,
    caller: str,
    at: str,
    call_id: str,
    size: int = BUCKET_TOKENS,
    seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Adds `is_limited`. `call_id` is unique and orders calls of the same instant.

    The refill clock depends on call times alone, so it is a greedy chain. Between two refills
    the first `tokens` calls pass. Calls are counted per refill period before the sequential
    walk, whose rows are therefore bounded by elapsed time over the refill interval, whatever
    the call rate. Ranking inside a period keeps at most `size` calls per task and period.
    """
    interval_us = -(-seconds * 1_000_000 // size)
    timed = calls.select(
        F.col(caller).alias("__caller"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("__at"),
        F.col(call_id).alias("__call"),
    )
    points = timed.groupBy("__caller", "__at").agg(F.count(F.lit(1)).alias("n"))
    sizes = points.groupBy("__caller").agg(F.count(F.lit(1)).alias("__n"))
    sized = points.join(sizes, "__caller")
    clock = chain_anchors(sized, ["__caller"], "__at", "__n", interval_us, strict=False)
    periods = clock.groupBy("__caller", "anchor").agg(F.sum("n").alias("n"))
    placed = timed.join(clock.select("__caller", "__at", "anchor"), ["__caller", "__at"])
    caller_type = calls.schema[caller].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who, tokens, last = None, size, 0
        for pdf in batches:
            granted = []
            for caller_id, start, asked in pdf.itertuples(index=False, name=None):
                if caller_id != who:
                    who, tokens, last = caller_id, size, start
                tokens, last = refill(tokens, last, start, size, seconds)
                granted.append(min(tokens, asked))
                tokens -= granted[-1]
            yield pdf[["__caller", "anchor"]].assign(granted=granted)

    grants = (
        periods.repartition("__caller")
        .sortWithinPartitions("__caller", "anchor")
        .mapInPandas(walk, f"__caller {caller_type}, anchor bigint, granted bigint")
    )
    in_order = Window.partitionBy("__caller", "anchor").orderBy("__at", "__call")
    leading = placed.withColumn("rank", F.row_number().over(in_order)).where(
        F.col("rank") <= size
    )
    passed = (
        leading.join(grants, ["__caller", "anchor"])
        .where(F.col("rank") <= F.col("granted"))
        .select(F.col("__call").alias("__passed"))
    )
    flagged = calls.join(passed, F.col(call_id) == F.col("__passed"), "left")
    return flagged.select(*calls.columns, F.col("__passed").isNull().alias("is_limited"))
