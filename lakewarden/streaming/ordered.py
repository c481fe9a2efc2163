"""Keyed streams that are walked in time order, with a small carry per key and flat memory.

A key's rows of a micro-batch come in any order and may be a third of all rows. They are dealt to
time chunks; beyond one Arrow batch the chunks wait in the state store, which is on disk, and are
read back one after the other. So a task holds one Arrow batch or one chunk, never a key's rows.
What a key needs from its past is one small value, which a timer forgets once it can no longer
matter.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

#: A step takes the carry (None for a new key) and a chunk's rows in order, and gives the new carry, the rows to put out
#: and the time in microseconds from which the carry is as good as none.
Step = Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame, int]]


def _packed(pdf: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _micros(values: pd.Series):
    return values.astype("datetime64[us]").astype("int64")


class InTimeOrder(StatefulProcessor):
    """Hands a key's rows to `step` in the order of `(at, *ties)`.

    At once, or with `hold` only when the watermark has passed them; then the order of
    micro-batches makes no difference.
    """

    def __init__(self, step: Step, carry: str, columns: list[str], at: str, ties: list[str], chunk_seconds: int, hold: bool):
        self.step, self.carry_schema, self.columns, self.hold = step, carry, columns, hold
        self.at, self.order, self.chunk_us = at, [at, *ties], chunk_seconds * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.carry = handle.getValueState("carry", self.carry_schema)
        self.free = handle.getValueState("free", "at bigint")
        self.parts = handle.getMapState("parts", "chunk bigint, part int", "rows binary")
        self.chunks = handle.getMapState("chunks", "chunk bigint", "parts int")

    def _put(self, pdf: pd.DataFrame) -> None:
        for chunk, rows in pdf.groupby(_micros(pdf[self.at]) // self.chunk_us):
            key = (int(chunk),)
            n = self.chunks.getValue(key)[0] if self.chunks.containsKey(key) else 0
            self.parts.updateValue((int(chunk), n), (_packed(rows),))
            self.chunks.updateValue(key, (n + 1,))
            if self.hold and not n:
                # fires once the watermark is beyond the chunk
                self.handle.registerTimer((int(chunk) + 1) * self.chunk_us // 1000)

    def _take(self, chunk: int) -> pd.DataFrame:
        n = self.chunks.getValue((chunk,))[0]
        rows = [pa.ipc.open_stream(self.parts.getValue((chunk, i))[0]).read_all() for i in range(n)]
        for i in range(n):
            self.parts.removeKey((chunk, i))
        self.chunks.removeKey((chunk,))
        return pa.concat_tables(rows, promote_options="permissive").to_pandas()

    def _walk(self, pdf: pd.DataFrame) -> pd.DataFrame:
        held = self.carry.get() if self.carry.exists() else None
        carry, out, free = self.step(held, pdf.sort_values(self.order, kind="stable"))
        self.carry.update(carry)
        self.free.update((int(free),))
        self.handle.registerTimer(-(-int(free) // 1000) + 1)
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = (pdf.set_axis(self.columns, axis=1) for pdf in rows)  # some names do not survive the way here
        first = next(rows)
        second = None if self.hold else next(rows, None)
        if second is None and not self.hold:
            yield self._walk(first)
            return
        for pdf in (first, second):
            if pdf is not None:
                self._put(pdf)
        for pdf in rows:
            self._put(pdf)
        if not self.hold:
            for chunk in sorted(k[0] for k in self.chunks.keys()):
                yield self._walk(self._take(chunk))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if self.hold:
            for chunk in sorted(k[0] for k in self.chunks.keys()):
                if (chunk + 1) * self.chunk_us <= passed:
                    yield self._walk(self._take(chunk))
        if self.free.exists() and self.free.get()[0] <= passed:
            self.carry.clear()
            self.free.clear()


def in_time_order(
    rows: DataFrame,
    key: str,
    at: str,
    step: Step,
    carry: str,
    schema: StructType | str,
    ties: tuple[str, ...] = (),
    late: str | None = "1 day",
    chunk_seconds: int = 60,
    hold: bool = False,
) -> DataFrame:
    """`step` over the rows of every key; rows more than `late` behind the newest are left out by the watermark.

    Without `late` the rows have a watermark already. Needs the state store on disk, which `build_session` chooses.
    """
    processor = InTimeOrder(step, carry, rows.columns, at, list(ties), chunk_seconds, hold)
    timed = rows if late is None else rows.withWatermark(at, late)
    return timed.groupBy(key).transformWithStateInPandas(processor, schema, "append", "EventTime")


def first_in_time(ttl_us: int, at: str, strict: bool = True) -> Step:
    """Keeps the first row and each next one more than (`strict`), or at least, the time to live after the last kept."""
    gap = ttl_us + 1 if strict else ttl_us

    def step(held: tuple | None, pdf: pd.DataFrame) -> tuple[tuple, pd.DataFrame, int]:
        allowed, kept = held[0] if held else None, []
        for now in _micros(pdf[at]).tolist():
            kept.append(allowed is None or now >= allowed)
            if kept[-1]:
                allowed = now + gap
        return (allowed,), pdf[kept], allowed

    return step
