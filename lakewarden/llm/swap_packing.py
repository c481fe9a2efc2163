"""Packing documents into as few token sequences as possible by best fit and a swap-based local search.

A document is tokenised and closed by one end id; only longer ones are cut, into full windows and what is left. Best fit, from
long to short, gives a start. Then underfull bins exchange pieces: a move, one for one, or two for one, always so that the sum
of squared fills grows, which drains the emptiest bins into fuller ones until they vanish. The search ends when there are no
more bins than their tokens need, when no exchange helps, or after `EFFORT`; the packing is whole after every exchange.

Pieces of a length are alike, and so are bins that hold equal lengths. Start and search work on kinds of bins with their
numbers, from the counts per length (at most one per token of capacity), and an exchange is done for all bins of two kinds at
once. Every piece then finds its bin from its rank in its length, which comes from counts per bucket: no task sees all pieces.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; ids may be null; pieces of a length
take places in the order of the stored pieces; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import stored, table
from lakewarden.llm.packing import cut, tokenizer_path

CAPACITY = 4096
#: Pieces per bucket when ranks are counted.
BUCKET = 20_000
#: Bound of the search: 101 for a pair of kinds that is tried, 1 for one that is known not to help. About three seconds.
EFFORT = 2_000_000
#: Lengths in a bin, as ((length, how many), ..) from long to short.
Kind = tuple[tuple[int, int], ...]


@lru_cache(1 << 16)
def fill(kind: Kind) -> int:
    return sum(length * n for length, n in kind)


def changed(kind: Kind, out: tuple[int, ...], into: tuple[int, ...]) -> Kind:
    """The kind without the lengths `out` and with those of `into`."""
    held = Counter(dict(kind))
    held.subtract(out)
    held.update(into)
    return tuple(sorted(((length, n) for length, n in held.items() if n), reverse=True))


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Kind]:
    """Numbers of bins of each kind when lengths go from long to short into the open bin with the least room that will do."""
    rooms: list[int] = []  # sorted rooms of open bins
    open_bins: dict[int, Counter[Kind]] = defaultdict(Counter)
    done: Counter[Kind] = Counter()

    def put(kind: Kind, n: int) -> None:
        room = capacity - fill(kind)
        if not n:
            return
        if not room:
            done[kind] += n
            return
        if not open_bins[room]:
            insort(rooms, room)
        open_bins[room][kind] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            per = room // length  # after one piece the bin is the tightest for the next, so it takes as many as fit
            wanted = -(-left // per)
            if at < len(rooms):
                kind, n = next(iter(open_bins[room].items()))
                used = min(n, wanted)
                open_bins[room][kind] -= used
                if not open_bins[room][kind]:
                    del open_bins[room][kind]
                    if not open_bins[room]:
                        rooms.pop(at)
            else:
                kind, used = (), wanted
            full, over = divmod(min(left, used * per), per)
            put(changed(kind, (), (length,) * per), full)
            if over:
                put(changed(kind, (), (length,) * over), 1)
            left -= min(left, used * per)
    for kinds in open_bins.values():
        done.update(kinds)
    return done


def singles_and_pairs(kind: Kind) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """Ways to take one piece, and two, out of a bin; one for each different set of lengths."""
    ones = [(length,) for length, _ in kind]
    twos = [(a, b) for i, (a, n) in enumerate(kind) for b, _ in kind[i + (n < 2) :]]
    return ones, twos


def best_exchange(fuller: Kind, emptier: Kind, capacity: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """Lengths to take out of the fuller bin and out of the emptier one, so that the fuller gains most; None if it can't gain.

    The fuller bin with fill a gains d tokens from the one with fill b. The squared fills then grow by 2 d (a - b + d).
    """
    a, b = fill(fuller), fill(emptier)
    room, least = capacity - a, max(1, b - a + 1)
    ones, twos = singles_and_pairs(emptier)
    mine, my_pairs = singles_and_pairs(fuller)
    best, gain = None, least - 1
    for given, taken in ((ones, [()]), (ones, mine), (twos, mine), (ones, my_pairs)):
        if not given or not taken:
            continue
        sums = sorted((sum(g), g) for g in given)
        totals = np.array([s for s, _ in sums])
        back = np.array([sum(t) for t in taken])
        found = np.searchsorted(totals, back + room, side="right") - 1
        gains = np.where(found >= 0, totals[found] - back, 0)
        at = int(np.argmax(gains))
        if gains[at] > gain:
            gain, best = int(gains[at]), (taken[at], sums[found[at]][1])
        if gain == room:
            break
    return best


def improve(bins: Counter[Kind], capacity: int, effort: int = EFFORT) -> Counter[Kind]:
    """Exchange pieces between underfull bins while that makes the squared fills grow and a bin may still vanish."""
    bins = Counter(bins)
    total, need = bins.total(), -(-sum(fill(k) * n for k, n in bins.items()) // capacity)
    order = sorted((fill(k), k) for k in bins if fill(k) < capacity)  # from empty to full
    hopeless: dict[Kind, set[Kind]] = defaultdict(set)

    def change(kind: Kind, n: int) -> None:
        nonlocal total
        if not kind:
            total += n
            return
        new, bins[kind] = kind not in bins, bins[kind] + n
        entry = (fill(kind), kind)
        if not bins[kind]:
            del bins[kind]
            del order[bisect_left(order, entry)]
        elif new and entry[0] < capacity:
            insort(order, entry)

    moved = True
    while moved and total > need and effort > 0:
        moved = False
        for least, emptier in list(order):  # a pass drains the emptiest bins first, into the fullest
            while emptier in bins and total > need and effort > 0:
                step = None
                for most, fuller in reversed(order):
                    if most < least or effort <= 0:
                        break
                    many = bins[fuller] // 2 if fuller == emptier else min(bins[fuller], bins[emptier])
                    effort -= 1
                    if many and fuller not in hopeless[emptier]:
                        effort -= 100
                        step = best_exchange(fuller, emptier, capacity)
                        if step:
                            break
                        hopeless[emptier].add(fuller)
                if not step:
                    break
                out, into = step
                change(fuller, -many)
                change(emptier, -many)
                for kind in (changed(fuller, out, into), changed(emptier, into, out)):
                    change(kind, many if kind else -many)
                moved = True
    return bins


def runs(bins: Counter[Kind]) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces per bin, offset), sorted: where the r-th piece of a length is."""
    rows, rank, first = [], Counter(), 0
    for kind in sorted(bins):
        offset = 0
        for length, per in kind:
            rows.append((length, rank[length], first, per, offset))
            rank[length] += per * bins[kind]
            offset += per * length
        first += bins[kind]
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(found: DataFrame) -> DataFrame:
    """Stored pieces with their rank in their length; a hot length is ranked in many buckets, which counts put in order."""
    buckets = max(1, found.count() // BUCKET)
    found = found.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = (
        found.groupBy(F.col("length").alias("l"), F.col("bucket").alias("b"))
        .agg(F.count("*").alias("n"))
        .select("l", "b", (F.sum("n").over(Window.partitionBy("l").orderBy("b")) - F.col("n")).alias("before"))
    )
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    both = found.withColumn("inside", inside).join(before, (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("b")))
    return both.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).cast("long").alias("rank"))


def packed(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and their offset in it."""
    # rows of the stored pieces are numbered, so that repeated rows differ and reruns agree
    found = stored(cut(docs, path, text, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    found = found.withColumn("piece", F.expr(f"int(start div {capacity})"))
    lengths = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one per length
    place = runs(improve(best_fit(lengths, capacity), capacity))
    key = (place[:, 0] << 48) + place[:, 1]

    def seat(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = place[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            t = rank - run[:, 1]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(run[:, 2] + t // run[:, 3]), pa.array(run[:, 4] + t % run[:, 3] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked(found).mapInArrow(seat, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_path())
