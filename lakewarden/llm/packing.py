"""Packing documents into token sequences by best-fit decreasing.

A document is tokenised and closed by one end id; overlong ones are cut into full windows, which leaves one shorter piece.
Best-fit decreasing places pieces from long to short, each into the open window with the tightest room, found in a segment
tree indexed by remaining capacity. Pieces of equal length are alike, so the placing works on the counts per length (at
most `CAPACITY` of them) and yields runs: the r-th piece of a length goes to this window at this offset. Every piece then
finds its place from its rank in its length, which comes from counts per bucket of pieces; no task sees all pieces.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; ids may be null; ties of equal
length are ordered by (document id, start, checksum); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import in_small_batches, pieces, stored
from lakewarden.llm.word_ids import WordIds

CAPACITY = 2048
END_ID = 1
#: Pieces per bucket when ranks are counted.
BUCKET = 20_000
_CACHES: dict[str, WordIds] = {}

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def cut(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: full windows first, then what is left."""

    def tokens(batches):
        words = _CACHES.get(path) or _CACHES.setdefault(path, WordIds(path))
        for batch in pieces(batches):
            ids, sizes = words.encode(batch.column("text"))
            own = np.insert(ids, np.cumsum(sizes), END_ID).astype("<u4")
            rows, at = [], 0
            for doc, n in zip(batch.column("doc_id").to_pylist(), (sizes + 1).tolist(), strict=True):
                rows += [(doc, s, min(capacity, n - s), zlib.crc32(own[at + s : at + min(n, s + capacity)]), n) for s in range(0, n, capacity)]
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=PIECE)

    return in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tokens, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


class Capacities:
    """Segment tree over remaining capacities: how many open windows have each, and the least capacity that will do."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: dict[int, list[list[int]]] = {}

    def add(self, room: int, first: int, n: int) -> None:
        """Windows first .. first + n - 1 have `room` left."""
        if n and room:
            self.windows.setdefault(room, []).append([first, n])
            self._change(room, n)

    def _change(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, need: int) -> int | None:
        """Least capacity of an open window that is at least `need`."""
        at = need + self.size
        if self.count[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at + (not self.count[2 * at])
                return at - self.size
            at //= 2
        return None

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to `most` windows of that room, as (first, how many); they are no longer open."""
        spans = self.windows[room]
        first, n = spans[0]
        got = min(n, most)
        if got == n:
            spans.pop(0)
        else:
            spans[0] = [first + got, n - got]
        self._change(room, -got)
        return first, got


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first window, pieces per window, offset) for the counts per length.

    A piece of a run with rank first + t is in window first + t // per, at offset + t % per * length. A window that takes one
    piece is then the tightest for the next of that length, so it takes as many as fit.
    """
    tree, windows, runs = Capacities(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            new = room is None
            room = capacity if new else room
            per = room // length
            wanted = -(-left // per)
            first, got = (windows, wanted) if new else tree.take(room, wanted)
            windows += wanted if new else 0
            placed = min(left, got * per)
            runs.append((length, rank, first, per, capacity - room))
            full, over = divmod(placed, per)
            tree.add(room - per * length, first, full)
            if over:
                tree.add(room - over * length, first + full, 1)
            rank, left = rank + placed, left - placed
    return runs


def packed(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and offset."""
    found = stored(cut(docs, path, text, capacity), "pieces")
    buckets = max(1, found.count() // BUCKET)
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).alias("bucket")
    found = found.select("*", bucket)
    counts = found.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one per length
    runs = np.array(best_fit(lengths, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    key = (runs[:, 0] << 48) + runs[:, 1]
    before = counts.select(
        F.col("length").alias("l"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = found.withColumn("inside", inside).join(before, (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("b")))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = runs[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            t = rank - run[:, 1]
            kept = [batch.column(c) for c in PIECE.names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(run[:, 2] + t // run[:, 3]), pa.array(run[:, 4] + t % run[:, 3] * length)], names=[*PIECE.names, "sequence_id", "offset"])

    ranked = ranked.select(*PIECE.names, (F.col("before") + F.col("inside")).cast("long").alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
