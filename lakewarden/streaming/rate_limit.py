"""Token bucket per caller over a stream, with constant-size state."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lakewarden.fixed_values import BUCKET_SECONDS, BUCKET_TOKENS
from lakewarden.operators.rate_limit import refill
from lakewarden.operators.triage import triage
from lakewarden.streaming.ordered import in_time_order


def limit_stream(
    calls: DataFrame,
    caller: str,
    at: str,
    size: int = BUCKET_TOKENS,
    seconds: int = BUCKET_SECONDS,
    late: str = "1 day",
    chunk_seconds: int = 60,
) -> DataFrame:
    """Adds `is_limited`. A caller's state is its tokens and refill clock.

    A caller's calls are taken in time order, one time chunk after the other, so a caller with
    very many calls takes no more memory. A call older than the refill clock finds the bucket as
    it is. A bucket that has filled up again is forgotten.
    """

    def step(held: tuple | None, pdf: pd.DataFrame) -> tuple[tuple, pd.DataFrame, int]:
        flags = []
        for now in pdf[at].astype("datetime64[us]").astype("int64").tolist():
            tokens, last = held if held else (size, now)
            tokens, last = refill(tokens, last, now, size, seconds)
            flags.append(tokens < 1)
            held = (max(tokens - 1, 0), last)
        return held, pdf.assign(is_limited=flags), held[1] + seconds * 1_000_000

    schema = StructType([*calls.schema.fields, StructField("is_limited", BooleanType())])
    return in_time_order(calls, caller, at, step, "tokens int, last bigint", schema, late=late, chunk_seconds=chunk_seconds)


def triage_stream(requests: DataFrame, caller: str, at: str, text: str, **options) -> DataFrame:
    """Triage of a stream of requests with the rate limit applied first."""
    limited = limit_stream(requests, caller, at)
    return triage(limited, text, limited="is_limited", **options).withColumn(
        "triaged", F.lit(True)
    )
