"""Greedy time chains: the events that count when each must be `gap` after the previous one.

Time-to-live de-duplication and refill clocks both follow such a chain. It is sequential per
key with a constant-size state, so ordinary keys are streamed in time order, many per task. One
key may hold a third of all rows. Such a hot key is cut into time chunks: each chunk is reduced
to the function "earliest allowed time on entry -> earliest allowed time on exit", a monotone
step function with few steps, the functions are walked in order, and every chunk is then
resolved on its own, knowing its entry.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_POINTS = 2_000_000
_NEVER = -(2**62)


def _leaving(ts: np.ndarray, heads: np.ndarray, step: int) -> np.ndarray:
    """Earliest allowed time after the chunk for a chain entering at each of the heads."""
    following = np.searchsorted(ts, ts + step, side="left")
    at = heads.copy()
    while (inside := following[at] < len(ts)).any():
        at = np.where(inside, following[at], at)
    return ts[at] + step


def _chunk_entries(points: DataFrame, keys: list[str], types: str, step: int, width: int):
    """`(keys, __chunk, __entry)` for the chunks of hot keys."""

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["__ts"].to_numpy(dtype=np.int64))
        start = int(pdf["__chunk"].iloc[0]) * width
        # an entry bound lies at most one step into the chunk, so only these can come first
        heads = np.arange(min(np.searchsorted(t, start + step, side="left") + 1, len(t)))
        leave = _leaving(t, heads, step)
        last = np.append(leave[1:] != leave[:-1], True)
        out = pd.DataFrame({"__head": t[heads][last], "__leave": leave[last]})
        for name in [*keys, "__chunk"]:
            out[name] = pdf[name].iloc[0]
        return out[[*keys, "__chunk", "__head", "__leave"]]

    steps = points.groupBy(*keys, "__chunk").applyInPandas(
        summarise, f"{types}, __chunk bigint, __head bigint, __leave bigint"
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, chunk, allowed, taken = None, None, _NEVER, False
        for pdf in batches:
            rows = []
            for *this, at, head, leave in pdf.itertuples(index=False, name=None):
                if this != key:
                    key, chunk, allowed = this, None, _NEVER
                if at != chunk:
                    chunk, taken = at, False
                    rows.append((*this, at, allowed))
                if not taken and head >= allowed:
                    allowed, taken = leave, True
            if rows:
                yield pd.DataFrame(rows, columns=[*keys, "__chunk", "__entry"])

    return (
        steps.repartition(*keys)
        .sortWithinPartitions(*keys, "__chunk", "__head")
        .mapInPandas(walk, f"{types}, __chunk bigint, __entry bigint")
    )


def chain_anchors(
    points: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    gap_us: int,
    strict: bool,
    hot_points: int = HOT_POINTS,
    chunk_gaps: int = 256,
) -> DataFrame:
    """Adds `anchor`, the last chain element at or before `ts`, to distinct `(keys, ts)`.

    The first event of a key starts its chain; the next element is the first event more than
    (`strict`) or at least `gap_us` microseconds later. Elements are the rows `ts = anchor`.
    `size` names the column with the number of points of the key; keys with more than
    `hot_points` are worked on in chunks of `chunk_gaps` gaps. Further columns pass through.
    """
    keys = list(keys)
    step = gap_us + 1 if strict else gap_us
    width = step * chunk_gaps
    types = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys)
    at = F.col(ts)
    chunk = ((at - F.pmod(at, F.lit(width))) / F.lit(width)).cast("bigint")
    is_hot = F.col(size) > hot_points
    chunked = points.withColumn(
        "__chunk", F.when(is_hot, chunk).otherwise(F.lit(0).cast("bigint"))
    )
    of_hot_keys = chunked.where(is_hot).select(*keys, at.alias("__ts"), "__chunk")
    entries = _chunk_entries(of_hot_keys, keys, types, step, width)
    placed = chunked.join(entries, [*keys, "__chunk"], "left").withColumn(
        "__entry", F.coalesce("__entry", F.lit(_NEVER))
    )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    kept = points.columns

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, allowed, anchor = None, _NEVER, _NEVER
        for pdf in batches:
            names = zip(*[pdf[k].tolist() for k in [*keys, "__chunk"]])
            anchors = []
            for this, t, entry in zip(names, pdf[ts].tolist(), pdf["__entry"].tolist()):
                if this != key:
                    key, allowed, anchor = this, entry, entry - step
                if t >= allowed:
                    anchor, allowed = t, t + step
                anchors.append(anchor)
            yield pdf[kept].assign(anchor=anchors)

    return (
        placed.repartition(*keys, "__chunk")
        .sortWithinPartitions(*keys, "__chunk", ts)
        .mapInPandas(follow, f"{columns}, anchor bigint")
    )
