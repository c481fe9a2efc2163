"""Removal of long repeated strings with suffix arrays.

A string of `LENGTH` bytes is repeated if it starts anywhere else, in the same or another text. Every byte that a repeated string
covers is removed.

1. Each window of `LENGTH` bytes has an anchor: the 64 bytes in it with the least hash. Neighbouring windows with one anchor are
   a segment. Equal windows have equal anchors, so an anchor that occurs once has no repeated windows; its segment is done.
2. The other segments, equal ones taken together, are dealt to shards by their anchor, so equal windows meet. A shard's suffix
   array is refined by rank doubling (Larsson and Sadakane: only groups that are still tied are sorted again), Kasai's
   scan gives the common prefixes of neighbours, and a window with a neighbour of `LENGTH` or more common bytes is repeated.
3. An anchor with more segments than a shard should hold is cut over several shards. Their windows are merged across
   shards by digest: a window that two of them hold is repeated. No shard has to see another, so this is a meeting, not a search.
   Digests travel as arrays, by ranges of their values; their number is at most that of the bytes in the segments.

Only spans travel back to the texts. Nothing depends on the order of texts, and no shard holds more than `SHARD` bytes or so.

Defined results: null and empty texts have no bytes; repeated rows are texts of their own, so each repeats the other; ids may be
null; texts shorter than `LENGTH` bytes are kept; overlapping occurrences in one text count; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import pieces, stored

LENGTH = 400
ANCHOR = 64
#: Bytes of segments in one shard, and segments of one anchor in one shard.
SHARD = 1 << 20
PER_ANCHOR = 1500
#: Bytes of a window's digest, and digests that meet in one group, about.
DIGEST = 16
PER_RANGE = 100_000
#: Texts are taken in stripes of so many window starts.
STRIPE = 4 << 20


def _mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    a = (a ^ (a >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return a ^ (a >> np.uint64(33))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = padded[: len(data)].copy()
    for j in range(1, 8):
        out = (out << np.uint64(8)) | padded[j : j + len(data)]
    return out


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row, from minima towards both ends of blocks of that width."""
    n = len(values)
    blocks = -(-n // width) * width
    padded = np.full(blocks, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    padded = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor's hash) of the segments of one text."""
    starts = len(data) - length + 1
    if starts < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    anchor = min(anchor, length)
    words = eights(data)
    grams = len(data) - anchor + 1
    h = np.zeros(grams, np.uint64)
    for j in range(0, anchor - 7, 8):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + grams]
    if anchor % 8:
        tail = words[anchor - 8 : anchor - 8 + grams] if anchor > 8 else words[:grams] >> np.uint64(64 - 8 * anchor)
        h = h * np.uint64(0x9E3779B97F4A7C15) + tail
    h = _mix(h)
    # among equal hashes the first one of the window is its anchor
    keyed = ((h >> np.uint64(24)) << np.uint64(24)) | np.arange(grams, dtype=np.uint64)
    place = (least_in_window(keyed, length - anchor + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, np.append(first[1:], starts) - 1, h[place[first]].view(np.int64)


def text_segments(text: bytes, length: int = LENGTH) -> list[tuple[int, bytes, int, int]]:
    """(anchor, digest, first byte, size) of all segments; long texts are taken in stripes that overlap."""
    out = []
    for at in range(0, max(len(text) - length + 1, 0), STRIPE):
        part = np.frombuffer(text, np.uint8, min(STRIPE + length - 1, len(text) - at), at)
        for a, b, h in zip(*(x.tolist() for x in segments(part, length)), strict=True):
            size = b - a + length
            out.append((h, xxhash.xxh3_128_digest(text[at + a : at + a + size]), at + a, size))
    return out


def suffix_ranks(data: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix, read up to `left` bytes and no more than `depth`; equal ranks only for equal suffixes.

    The first round ranks seven bytes, with nothing below every byte. A rank is the number of suffixes in smaller groups; each
    round doubles the bytes that count and sorts only positions that share their rank.
    """
    n = len(data)
    code = np.zeros(n, np.int64)
    for j in range(7):
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - j, 0)] = data[j:].astype(np.int64) + 1
        code = code * 257 + np.where(left > j, ahead, 0)
    order = np.argsort(code)
    fresh = np.concatenate([[True], code[order][1:] != code[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    size = np.bincount(np.cumsum(fresh) - 1)
    live = np.sort(order[np.repeat(size > 1, size)])
    have = 7
    while have < depth and len(live):
        nxt = np.where(left[live] > have, rank[np.minimum(live + have, n - 1)] + 1, 0)
        order = np.argsort(rank[live] * (n + 1) + nxt)
        r, x = rank[live][order], nxt[order]
        group = np.concatenate([[True], r[1:] != r[:-1]])
        fresh = group | np.concatenate([[True], x[1:] != x[:-1]])
        place = np.arange(len(live))
        rank[live[order]] = r + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        size = np.bincount(np.cumsum(fresh) - 1)
        live = np.sort(live[order][np.repeat(size > 1, size)])
        have *= 2
    return rank


def common_prefixes(data: np.ndarray, left: np.ndarray, order: np.ndarray, lanes: int = 64) -> np.ndarray:
    """Bytes that each position's suffix shares with the suffix before it in `order` (Kasai).

    A position shares at least one byte less than the position before it did, so each comparison goes on from there. The
    text is cut into lanes that advance together, eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = eights(data)
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, lanes)
    have = np.zeros(len(starts), np.int64)
    for t in range(lanes):
        at = starts + t
        on = at < n
        at, have = at[on], have[on]
        starts = starts[on]
        other = before[at]
        limit = np.where(other >= 0, np.minimum(left[at], left[np.maximum(other, 0)]), 0)
        have = np.minimum(np.maximum(have - 1, 0), limit)
        go = np.flatnonzero(have < limit)
        while len(go):
            x = words[np.minimum(at[go] + have[go], n - 1)] ^ words[np.minimum(other[go] + have[go], n - 1)]
            same = np.where(x == 0, 8, _leading_bytes(x))
            have[go] = np.minimum(have[go] + same, limit[go])
            go = go[(same == 8) & (have[go] < limit[go])]
        out[at] = have
    return out


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Equal bytes at the front, given the difference of two numbers of eight bytes."""
    out = np.zeros(len(x), np.int64)
    for j in range(1, 8):
        out += (x >> np.uint64(64 - 8 * j)) == 0
    return out


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Of the parts put one after the other: each part's start, and whether the window at a position is repeated."""
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts), np.uint8)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(data))
    rank = suffix_ranks(data, left, int(sizes.max()))
    order = np.argsort(rank, kind="stable")
    shared = common_prefixes(data, left, order)
    long = shared[order] >= length
    hit = np.zeros(len(data), bool)
    hit[order] = long | np.append(long[1:], False)
    return starts, hit


def spans_of(windows: np.ndarray, length: int = LENGTH) -> list[int]:
    """Start and end of the bytes that the windows at these (rising) positions cover, joined where they touch."""
    if not len(windows):
        return []
    cut = np.flatnonzero(np.diff(windows) > length)
    first, last = windows[np.append(0, cut + 1)], windows[np.append(cut, len(windows) - 1)] + length
    return np.stack([first, last], axis=1).ravel().tolist()


def removed(docs: DataFrame, text: str = "text", length: int = LENGTH, per_anchor: int = PER_ANCHOR, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document; `kept` is the rest of its bytes."""

    def read(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            found = [[{"anchor": h, "part": d, "at": a, "size": s} for h, d, a, s in text_segments(t, length)] for t in texts]
            kind = pa.list_(pa.struct([("anchor", pa.int64()), ("part", pa.binary()), ("at", pa.int64()), ("size", pa.int64())]))
            columns = [batch.column("row"), batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([press.compress(t) for t in texts], pa.binary()), pa.array(found, kind)], names=["row", "doc_id", "n_bytes", "sha", "packed", "segments"])

    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "row long, doc_id long, n_bytes long, sha string, packed binary, segments array<struct<anchor:long,part:binary,at:long,size:long>>"
    texts = stored(named.mapInArrow(read, schema), "texts")

    every = texts.select("row", F.explode("segments").alias("s")).select("row", "s.*")
    often = every.groupBy(F.col("anchor").alias("h")).agg(F.count("*").alias("n")).filter("n > 1").select("h")
    places = stored(every.join(often, F.col("anchor") == F.col("h")).drop("h"), "places")

    def extract(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            found: dict[bytes, list] = {}
            for packed, own in zip(batch.column("packed").to_pylist(), batch.column("own").to_pylist(), strict=True):
                whole = unpack.decompress(packed)
                for s in own:
                    one = found.setdefault(s["part"], [s["anchor"], whole[s["at"] : s["at"] + s["size"]], 0])
                    one[2] += 1
            rows = list(found.values())
            columns = [pa.array(list(found), pa.binary()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "anchor", "data", "n"])

    wanted = places.groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("anchor", "part", "at", "size")).alias("own"))
    taken = texts.select("row", "packed").join(wanted, F.col("row") == F.col("r")).select("packed", "own")
    parts = taken.mapInArrow(extract, "part binary, anchor long, data binary, n long")
    parts = stored(parts.groupBy("part").agg(F.min("anchor").alias("anchor"), F.min("data").alias("data"), F.sum("n").alias("n")), "parts")

    # an anchor with one segment only: all of its windows are those of the segment's other occurrences
    sizes = parts.groupBy(F.col("anchor").alias("h")).agg(F.count("*").alias("segments"), F.sum(F.length("data")).alias("bytes"))
    sizes = stored(sizes, "anchors")
    shards = max(1, (sizes.filter("segments > 1").agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]) // shard)
    met = parts.join(sizes, F.col("anchor") == F.col("h"))
    alone = met.filter("segments = 1").select("part", F.array(F.lit(0).cast("long"), F.length("data").cast("long")).alias("spans"))
    ways = F.ceil(F.col("segments") / per_anchor)
    dealt = met.filter("segments > 1").select("part", "data", "n", (ways > 1).alias("cut"), F.pmod(F.xxhash64("anchor", F.when(ways > 1, F.pmod(F.xxhash64("part"), ways))), F.lit(shards)).alias("shard"))

    def refine(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part", ignore_index=True)
        data = group["data"].tolist()
        starts, hit = repeated_windows(data, length)
        spans, windows = [], []
        for start, part, n, cut in zip(starts.tolist(), data, group["n"].tolist(), group["cut"].tolist(), strict=True):
            own = np.flatnonzero(hit[start : start + len(part) - length + 1])
            spans.append([0, len(part)] if n > 1 else spans_of(own, length))
            windows.append(b"".join(xxhash.xxh3_128_digest(part[i : i + length]) for i in range(len(part) - length + 1)) if cut else None)
        return pd.DataFrame({"part": group["part"], "spans": spans, "windows": windows})

    dealt = dealt.repartition(max(1, shards // 4), "shard")
    within = stored(dealt.groupBy("shard").applyInPandas(refine, "part binary, spans array<long>, windows binary"), "within")
    # windows of cut anchors meet by ranges of their digests, as arrays: one row for each batch of shards and range
    cut_parts = within.filter("windows is not null").select("part", "windows")
    ranges = 1 + (cut_parts.agg(F.coalesce(F.sum(F.length("windows")), F.lit(0))).first()[0]) // (DIGEST * PER_RANGE)

    def deal(batches):
        for batch in pieces(batches, "windows"):
            sizes = pc.binary_length(batch.column("windows")).to_numpy() // DIGEST
            held = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.uint64).reshape(-1, 2)
            owner, at = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(held)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            of = (held[:, 0] % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                if not len(some):
                    continue
                names, own = np.unique(owner[some], return_inverse=True)
                row = [[int(of[some[0]])], [held[some].tobytes()], [at[some].astype(np.int64).tobytes()], [own.astype(np.int64).tobytes()], [batch.column("part").take(pa.array(names)).to_pylist()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())), strict=True)], names=["range", "held", "at", "own", "parts"])

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        held, at, own = (np.frombuffer(b"".join(group[c]), t) for c, t in (("held", np.uint64), ("at", np.int64), ("own", np.int64)))
        held, names = held.reshape(-1, 2), [p for own_parts in group["parts"] for p in own_parts]
        sizes = group["parts"].map(len).to_numpy()
        own = own + np.repeat(np.cumsum(sizes) - sizes, group["own"].map(len).to_numpy() // 8)
        order = np.lexsort((held[:, 1], held[:, 0]))
        same = (held[order][1:] == held[order][:-1]).all(axis=1)
        hit = order[np.append(same, False) | np.append(False, same)] if len(order) else order
        hit = hit[np.lexsort((at[hit], own[hit]))]
        cuts = np.flatnonzero(np.diff(own[hit])) + 1
        found = [(names[own[some[0]]], spans_of(at[some], length)) for some in np.split(hit, cuts) if len(some)]
        return pd.DataFrame({"part": [p for p, _ in found], "spans": [x for _, x in found]})

    windows = cut_parts.mapInArrow(deal, "range long, held binary, at binary, own binary, parts array<binary>")
    across = windows.groupBy("range").applyInPandas(meet, "part binary, spans array<long>")
    found = within.select("part", "spans").union(alone).union(across).filter(F.size("spans") > 0)
    found = found.groupBy(F.col("part").alias("p")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = places.join(found, F.col("part") == F.col("p")).select("row", F.transform("spans", lambda x: x + F.col("at")).alias("spans"))
    spans = spans.groupBy(F.col("row").alias("r")).agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def cut_out(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for size, packed, own in zip(batch.column("n_bytes").to_pylist(), batch.column("packed").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                whole, rest, at, runs = unpack.decompress(packed), [], 0, 0
                for a, b in sorted(zip(own[::2], own[1::2], strict=True)):
                    if a > at or not runs:
                        rest.append(whole[at:a])
                        runs += 1
                    at = max(at, b)
                rest.append(whole[at:])
                kept = b"".join(rest)
                out.append((size - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["r", "n_removed", "n_spans", "kept_sha256", "kept"])

    less = texts.select("row", "n_bytes", "packed").join(spans, F.col("row") == F.col("r")).select("row", "n_bytes", "packed", "spans")
    less = less.mapInArrow(cut_out, "r long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    zero = F.lit(0).cast("long")
    return texts.select("row", "doc_id", "n_bytes", "sha").join(less, F.col("row") == F.col("r"), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
