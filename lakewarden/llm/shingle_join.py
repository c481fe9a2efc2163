"""Exact Jaccard join on word shingles by a grouped prefix join, and the components of its links.

A document is the set of its distinct three-word shingles, as 64-bit hashes. Two documents of at least 0.9 must share one of
the first tenth of their shingles, in any order that all documents agree on; here from rare to frequent, by counts per hash
slot, so common passages come last. Equal sets are one node. Nodes with equal prefix and size are one group:

1. Group pairs come from lists of the groups that have a shingle in their prefix. Lists of up to `SMALL` groups give all pairs;
   in longer lists each group meets the list's pivot of its size band. Pairs are dropped when the shingles they share in
   their prefixes and all that may follow are too few; for the others the sets themselves are compared. Members of a
   group meet the group's pivot.
2. The links make components. Where the nodes of a frequent shingle, or of a group, are still in several components, those
   outside of the largest one meet all that are in another component, by the same bound, unless they have met. Of the group
   pairs that shorter lists left over in 1., members in different components meet too. So no link is lost, and a large group
   of near copies costs pairs with its pivots, not all pairs.

Sets are made from whole texts wherever they are needed; only prefixes and sketches are stored. A sketch has the parity of the
set's hashes per slot, so two sketches differ in no more slots than their sets in shingles; pairs whose sketches differ in too
many cannot link and never meet their texts. Lists of frequent shingles are dealt to
several tasks. Pairs, links and components stay in tables.

Defined results: null and blank texts have an empty set and are linked with nothing; with fewer than three words the whole
sequence is one shingle; equal texts in repeated rows are linked, if not empty; null ids never name a component unless all of
it are null; an empty table gives no rows; other columns are carried along in `doc` whatever they are called.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.common import in_small_batches, pieces, stored

WORDS = 3
#: Similarity in hundredths, as 100 * intersection >= SHARE * union.
SHARE = 90
#: Groups of a shingle that meet each other outright.
SMALL = 24
#: Groups in one list of a frequent shingle, about.
LIST = 50_000
#: Hash slots that shingle counts are kept in; their number bounds what is shipped. Parts that they are added up in.
SLOTS = 1 << 22
PARTS = 256
#: Slots of the smallest sketch; larger sets have half as many slots as shingles, or up to as many.
SKETCH = 256
#: Numbers of 64 bits of the sketch of one length that all sets have, which joins compare.
FOLDED = 8
#: Pivots of a long list's size band, one for each class of shingles.
PIVOTS = 8


def _mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    a = (a ^ (a >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return a ^ (a >> np.uint64(33))


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own))
    size = min(words, len(own))
    out = np.full(len(own) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
    return np.unique(out)


def slots_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    return ((hashes & np.uint64((1 << 56) - 1)) % np.uint64(slots)).astype(np.int64)


def ordered(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Shingles as numbers that rise from rare to frequent: the slot's class of frequency above 56 bits of hash."""
    rate = classes[slots_of(hashes, len(classes))].astype(np.uint64)
    return np.sort((rate << np.uint64(56)) | (hashes & np.uint64((1 << 56) - 1)))


def prefix_length(size: int) -> int:
    """At least SHARE percent of a set is shared, so one of the first so many is."""
    return size - (SHARE * size + 99) // 100 + 1 if size else 0


def similar(a: int, b: int, common: int) -> bool:
    return 100 * common >= SHARE * (a + b - common)


def sketch(hashes: np.ndarray) -> bytes:
    """Parity of the number of hashes in each slot; the number of slots is a power of two."""
    slots = max(SKETCH, 1 << (len(hashes) // 2).bit_length())
    odd = np.bincount((hashes >> np.uint64(20) & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(hashes: np.ndarray) -> np.ndarray:
    """The same parity in `64 * FOLDED` slots, whatever the set's size."""
    odd = np.bincount((hashes >> np.uint64(20) & np.uint64(64 * FOLDED - 1)).astype(np.int64), minlength=64 * FOLDED) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def differing(x: bytes, y: bytes) -> int:
    """Slots in which two sketches differ, after folding the longer one: at most the shingles that only one of the sets has."""
    if len(x) < len(y):
        x, y = y, x
    a, n = int.from_bytes(x, "big"), 8 * len(x)
    while n > 8 * len(y):
        n //= 2
        a = (a >> n) ^ (a & ((1 << n) - 1))
    return (a ^ int.from_bytes(y, "big")).bit_count()


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def frequency_classes(docs: DataFrame) -> np.ndarray:
    """Class of frequency (twice the binary logarithm) of every hash slot, counting the shingles of all documents.

    A task counts into one array and hands on `PARTS` packed parts of it; the parts are added up in two steps.
    """

    def count(batches):
        sums = np.zeros(SLOTS, np.int32)
        for batch in pieces(batches):
            found = [shingles(t) for t in _texts(batch)]
            if found:
                np.add.at(sums, slots_of(np.concatenate(found), SLOTS), 1)
        press = zstandard.ZstdCompressor(level=1)
        made = [press.compress(part.astype(np.int64).tobytes()) for part in sums.reshape(PARTS, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(made, pa.binary())], names=["part", "sums"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        unpack, total = zstandard.ZstdDecompressor(), np.zeros(SLOTS // PARTS, np.int64)
        for packed in group["sums"]:
            total += np.frombuffer(unpack.decompress(packed), np.int64)
        return pd.DataFrame({"part": [key[0]], "sums": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})

    parts = docs.select("text").mapInArrow(count, "part int, sums binary")
    some = parts.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(256))).groupBy("part", "some").applyInPandas(add, "part int, sums binary")
    classes = np.zeros((PARTS, SLOTS // PARTS), np.uint8)
    unpack = zstandard.ZstdDecompressor()
    for r in some.groupBy("part").applyInPandas(add, "part int, sums binary").collect():  # PARTS rows, SLOTS numbers
        classes[r["part"]] = 2 * np.log2(np.frombuffer(unpack.decompress(r["sums"]), np.int64) + 1.0)
    return classes.ravel()


def nodes_of(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """Of (row, id, text, doc): the text packed, digests of its set (`node`) and of prefix and size (`group`), size, prefix and sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def read(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches):
            node, group, size, prefix, sketched, parity, packed = [], [], [], [], [], [], []
            for t in _texts(batch):
                own = shingles(t)
                size.append(len(own))
                node.append(hashlib.md5(own.tobytes()).digest())
                prefix.append(ordered(own, shared.value)[: prefix_length(len(own))].astype(np.int64))
                group.append(hashlib.md5(len(own).to_bytes(8, "little") + prefix[-1].tobytes()).digest())
                sketched.append(sketch(own))
                parity.append(folded(own))
                packed.append(press.compress(t))
            made = [pa.array(packed, pa.binary()), pa.array(node, pa.binary()), pa.array(group, pa.binary()), pa.array(size, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(sketched, pa.binary()), pa.array(parity, pa.list_(pa.int64()))]
            names = ["packed", "node", "group", "size", "prefix", "sketch", "folded"]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("no_text"), batch.column("doc"), *made], names=["row", "id", "no_text", "doc", *names])

    schema = T.StructType([docs.schema["row"], docs.schema["id"], docs.schema["no_text"], docs.schema["doc"]])
    for name, kind in (("packed", T.BinaryType()), ("node", T.BinaryType()), ("group", T.BinaryType()), ("size", T.LongType()), ("prefix", T.ArrayType(T.LongType())), ("sketch", T.BinaryType()), ("folded", T.ArrayType(T.LongType()))):
        schema = schema.add(name, kind)
    return docs.mapInArrow(read, schema)


def _enough(common, a: str, b: str):
    """Whether sets of sizes `a`, `b` may link if their prefixes share `common` shingles, or at most as many.

    A shingle of both sets that comes no later than the end of the prefix that ends first is in both prefixes; what comes
    after it can be shared at most as a whole, and never more than the smaller set holds.
    """
    beyond = [F.floor((SHARE * F.col(x) + 99) / 100) - 1 for x in (a, b)]
    upto = F.least(common + F.greatest(*beyond), a, b)
    return 100 * upto >= SHARE * (F.col(a) + F.col(b) - upto)


def _alike(a: str, b: str, size_a: str, size_b: str):
    """Whether the folded sketches do not rule a link out: of `d` shingles in one set only, at most `d` slots differ."""
    differ = sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(FOLDED)), F.lit(0))
    both = F.col(size_a) + F.col(size_b)
    return 100 * (both - differ) >= SHARE * (both + differ)


def near_enough(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches do not rule a link out."""

    def keep(batches):
        for batch in batches:
            sides = zip(*(batch.column(c).to_pylist() for c in ("size_a", "size_b", "sketch_a", "sketch_b")), strict=True)
            # sets of m and n shingles of which d are in one only share (m + n - d) / 2
            kept = batch.filter(pa.array([100 * (m + n - (d := differing(x, y))) >= SHARE * (m + n + d) for m, n, x, y in sides], pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    side = [rows.select(F.col("row").alias(f"row_{x}"), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab"]
    both = pairs.join(side[0].hint("merge"), F.col("a") == F.col("row_a")).join(side[1].hint("merge"), F.col("b") == F.col("row_b"))
    return both.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(keep, "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links among the pairs (a, b), by the sets of their whole texts."""

    def same(batches):
        unpack = zstandard.ZstdDecompressor()
        last: dict[int, np.ndarray] = {}
        for batch in pieces(batches, "text_a", 1 << 20):
            keep = []
            for sides in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if len(last) > 256:
                    last.clear()
                for node, text in zip(sides[:2], sides[2:], strict=True):
                    if node not in last:
                        last[node] = shingles(unpack.decompress(text))
                x, y = last[sides[0]], last[sides[1]]
                keep.append(similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    pairs = stored(near_enough(pairs, rows), "join-pairs")
    needed = pairs.select(F.col("a").alias("n")).union(pairs.select("b")).distinct()
    texts = stored(rows.select("row", "packed").join(needed.hint("merge"), F.col("row") == F.col("n"), "left_semi"), "join-texts")
    text = [texts.select(F.col("row").alias(f"row_{x}"), F.col("packed").alias(f"text_{x}")) for x in "ab"]
    both = pairs.join(text[0], F.col("a") == F.col("row_a")).join(text[1], F.col("b") == F.col("row_b")).select("a", "b", "text_a", "text_b")
    return stored(both.mapInArrow(same, "a long, b long"), "join-links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; the root is the component's smallest node.

    Large and small stars in turn: every node hands its larger, then its smaller neighbours on to the smallest one, until nothing
    changes, which takes a number of rounds that is logarithmic in practice.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "components")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "w"))
        # large star: a larger neighbour goes to the smallest of the neighbourhood
        large = both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        # small star: smaller neighbours, and the node itself, go to the smallest of them
        met = large.join(least, F.col("u") == F.col("w"))
        edges = stored(met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct(), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def shingle_lists(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, salt, pivot, size, shared, shared_many, many): groups by shingle of their prefix, without shingles of one group.

    A frequent shingle's groups are dealt to several lists (`salt`), by its class of frequency; these count as long (`many`).
    `shared` is the number of a group's shingles that have a list, `shared_many` of those that have a long one.
    """

    def runs(batches):
        """Rows come sorted by list; one that stands alone is dropped, unless it is one of several lists of its shingle."""
        held: list = []  # rows of the list at the end of the last batch
        many = False

        def out(rows, flag):
            return pa.RecordBatch.from_arrays([*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows], pa.array(flag, pa.bool_())], names=["token", "salt", "pivot", "size", "salts", "many"])

        for batch in batches:
            merged = pa.Table.from_batches([*held, batch.select(["token", "salt", "pivot", "size", "salts"])])
            keys = np.stack([merged.column(c).to_numpy() for c in ("token", "salt")])
            fresh = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])
            start = np.flatnonzero(fresh)
            size = np.diff(np.append(start, merged.num_rows))
            last = int(start[-1])
            # of a list that goes on beyond the batch, enough rows are held to know it when it ends, and no more
            long = size > SMALL
            long[0] |= many
            cut = merged.num_rows if long[-1] else last
            flag = np.repeat(long, size)[:cut]
            keep = ((np.repeat(size, size) > 1) | (merged.column("salts").to_numpy() > 1) | np.repeat(long, size))[:cut]
            # one row of an open long list stays behind as its mark
            rest = merged.slice(cut if cut < merged.num_rows else merged.num_rows - 1)
            if cut == merged.num_rows:
                flag, keep = flag[:-1], keep[:-1]
            done = merged.slice(0, len(flag)).filter(pa.array(keep))
            if done.num_rows:
                yield out(done.columns, flag[keep])
            held, many = rest.combine_chunks().to_batches(), bool(long[-1])
        if held:
            merged = pa.Table.from_batches(held)
            if merged.num_rows > 1 or many or merged.column("salts")[0].as_py() > 1:
                yield out(merged.columns, [many or merged.num_rows > SMALL] * merged.num_rows)

    own = rows.select("row", "prefix").join(groups.hint("merge"), F.col("row") == F.col("pivot")).select(F.explode("prefix").alias("token"), "pivot", "size")
    salts = F.ceil(F.pow(F.lit(2.0), F.shiftright("token", 56) / 2) / LIST).cast("int")
    lists = own.withColumn("salts", salts).withColumn("salt", F.pmod(F.xxhash64("pivot"), F.col("salts")).cast("int"))
    lists = lists.select("token", "salt", "pivot", "size", "salts").repartition("token", "salt").sortWithinPartitions("token", "salt")
    lists = stored(lists.mapInArrow(runs, "token long, salt int, pivot long, size long, salts int, many boolean"), "join-runs")
    lists = lists.withColumn("many", F.col("many") | (F.col("salts") > 1))
    of = lists.groupBy(F.col("pivot").alias("p")).agg(F.count("*").alias("shared"), F.count_if("many").alias("shared_many"))
    lists = lists.join(of.hint("merge"), F.col("pivot") == F.col("p"))
    return stored(lists.select("token", "salt", "pivot", "size", "shared", "shared_many", "many"), "join-lists")


def first_pairs(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs of pivots of groups with a shingle in common, and of every member with its group's pivot.

    `short` tells pairs of groups that share a shorter list, whose members may link as well.
    """
    own = nodes.filter("n <> pivot").select(F.col("pivot").alias("a"), F.col("n").alias("b"), F.lit(False).alias("short"))
    few = lists.filter(~F.col("many")).select("token", "salt", "pivot", "size", "shared")
    other = few.select(F.col("token").alias("t"), F.col("salt").alias("s"), F.col("pivot").alias("b"), F.col("size").alias("size_b"), F.col("shared").alias("shared_b"))
    met = (F.col("token") == F.col("t")) & (F.col("salt") == F.col("s"))
    small = few.join(other, met & (F.col("pivot") < F.col("b")) & _enough(F.least("shared", "shared_b"), "size", "size_b")).select(F.col("pivot").alias("a"), "b", "size", "size_b", F.lit(1).alias("one"))
    # sizes of a band are within the share of each other, or nearly
    many = lists.filter("many").withColumn("band", F.floor(F.log("size") / F.log(F.lit(100.0 / SHARE))))
    # near copies share most lists, so several pivots are tried for each, and the same few in all lists
    place = F.struct(F.xxhash64("pivot", F.pmod("token", F.lit(PIVOTS))), "pivot", "size", "shared")
    star = many.groupBy(F.col("token").alias("t"), F.col("salt").alias("s"), F.col("band").alias("in")).agg(F.min(place).alias("m"))
    star = star.select("t", "s", "in", F.col("m.pivot").alias("a"), F.col("m.size").alias("size_a"), F.col("m.shared").alias("shared_a"))
    large = many.join(star, met & (F.col("band") == F.col("in"))).filter((F.col("pivot") != F.col("a")) & _enough(F.least("shared", "shared_a"), "size", "size_a"))
    first = F.col("a") < F.col("pivot")
    large = large.select(
        F.least("a", "pivot").alias("a"), F.greatest("a", "pivot").alias("b"),
        F.when(first, F.col("size_a")).otherwise(F.col("size")).alias("size"), F.when(first, F.col("size")).otherwise(F.col("size_a")).alias("size_b"), F.lit(0).alias("one"),
    )
    counted = small.union(large).groupBy("a", "b").agg(F.min("size").alias("size"), F.min("size_b").alias("size_b"), F.sum("one").alias("common"))
    # in long lists a pair is not counted; a group's shingles with such lists bound what it shares there
    unseen = many.groupBy(F.col("pivot").alias("p")).agg(F.count("*").alias("unseen"))
    sides = [unseen.select(F.col("p").alias(f"p_{x}"), F.col("unseen").alias(f"unseen_{x}")) for x in "ab"]
    counted = counted.join(sides[0], F.col("a") == F.col("p_a"), "left").join(sides[1], F.col("b") == F.col("p_b"), "left")
    upto = F.col("common") + F.least(F.coalesce("unseen_a", F.lit(0)), F.coalesce("unseen_b", F.lit(0)))
    return own.union(counted.filter(_enough(upto, "size", "size_b")).select("a", "b", (F.col("common") > 0).alias("short"))).distinct()


def _across(labelled: DataFrame, key: str) -> DataFrame:
    """(a, b, sizes) for nodes of one key in different components, of which one is outside of the key's largest component.

    Pairs whose sketches rule a link out are not made.
    """
    per_root = labelled.groupBy(key, "root").agg(F.count("*").alias("n"))
    mixed = per_root.groupBy(F.col(key).alias("k")).agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1").drop("roots")
    found = stored(labelled.join(mixed, F.col(key) == F.col("k")).drop("k"), "join-mixed")
    aside = found.filter("root <> main").select(key, "node", "size", "most", "root", "folded")
    other = found.select(F.col(key).alias("k"), F.col("node").alias("o"), F.col("size").alias("size_o"), F.col("most").alias("most_o"), F.col("root").alias("root_o"), (F.col("root") == F.col("main")).alias("in_main"), F.col("folded").alias("folded_o"))
    apart = (F.col("root") != F.col("root_o")) & (F.col("in_main") | (F.col("node") < F.col("o")))
    pairs = aside.join(other, (F.col(key) == F.col("k")) & apart & _enough(F.least("most", "most_o"), "size", "size_o") & _alike("folded", "folded_o", "size", "size_o"))
    first = F.col("node") < F.col("o")
    return pairs.select(F.least("node", "o").alias("a"), F.greatest("node", "o").alias("b"), F.when(first, F.col("size")).otherwise(F.col("size_o")).alias("size"), F.when(first, F.col("size_o")).otherwise(F.col("size")).alias("size_b"))


def _members(labelled: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b) for members in different components of two groups that share a shorter list and may link.

    The bound on a pair of groups holds for all of their members, which have the same prefix and size. Components are told
    apart before members, so groups that are one component cost one row.
    """
    several = labelled.filter("node <> pivot").select(F.col("pivot").alias("p")).distinct()
    groups = met.filter("short").select("a", "b")
    groups = groups.join(several, F.col("a") == F.col("p"), "left_semi").union(groups.join(several, F.col("b") == F.col("p"), "left_semi")).distinct()
    held = labelled.select("pivot", "root").distinct()
    sides = [held.select(F.col("pivot").alias(f"p_{x}"), F.col("root").alias(f"root_{x}")) for x in "ab"]
    apart = groups.join(sides[0], F.col("a") == F.col("p_a")).join(sides[1], (F.col("b") == F.col("p_b")) & (F.col("root_a") != F.col("root_b"))).select("p_a", "root_a", "p_b", "root_b")
    left, right = (labelled.select(F.col("pivot").alias(f"of_{x}"), F.col("root").alias(f"in_{x}"), F.col("node").alias(f"node_{x}")) for x in "ab")
    pairs = apart.join(left, (F.col("p_a") == F.col("of_a")) & (F.col("root_a") == F.col("in_a"))).join(right, (F.col("p_b") == F.col("of_b")) & (F.col("root_b") == F.col("in_b")))
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def later_pairs(nodes: DataFrame, lists: DataFrame, roots: DataFrame, met: DataFrame) -> DataFrame:
    """Pairs of nodes in different components that may link and have not met.

    Groups that share a shorter list have met by their pivots, or cannot link, and their members are expanded; the others
    share shingles with long lists only.
    """
    labelled = stored(nodes.join(roots.withColumnRenamed("node", "r"), F.col("n") == F.col("r"), "left").select(F.col("n").alias("node"), "size", "pivot", "folded", F.coalesce("root", "n").alias("root")), "join-labelled")
    many = lists.filter("many").select("token", F.col("shared_many").alias("most"), F.col("pivot").alias("p"))
    by_token = many.join(labelled, F.col("p") == F.col("pivot")).select("token", "node", "size", "most", "root", "folded")
    counted = _across(by_token, "token").groupBy("a", "b").agg(F.min("size").alias("size"), F.min("size_b").alias("size_b"), F.count("*").alias("common"))
    pairs = counted.filter(_enough(F.col("common"), "size", "size_b")).select("a", "b").union(_across(labelled.withColumn("most", F.col("size")), "pivot").select("a", "b"))
    pairs = pairs.union(_members(labelled, met)).distinct()
    seen = met.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    return pairs.join(seen, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti")


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the component of their set, null if it is empty."""
    return rows.join(roots, (F.col("node") == F.col("of")) & (F.col("size") > 0), "left").drop("of")


def _rows_and_roots(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """All documents as `nodes_of` gives them, and (of, root): the component of every set that is not empty."""
    docs = in_small_batches(docs)
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.col(text).cast("string").alias("text"),
        F.col(text).isNull().alias("no_text"),
        F.struct(*([docs[f"`{c}`"] for c in docs.columns if c != text] or [F.lit(0)])).alias("doc"),
    )
    rows = stored(nodes_of(named, frequency_classes(docs.select(F.col(text).cast("string").alias("text")))), "join-documents")
    sets = rows.filter("size > 0").groupBy("node").agg(F.min("row").alias("n"), F.min("group").alias("group"), F.min("size").alias("size"), F.min("folded").alias("folded"))
    sets = stored(sets, "join-nodes")
    groups = stored(sets.groupBy("group").agg(F.min("n").alias("pivot"), F.min("size").alias("size")), "join-groups")
    nodes = stored(sets.join(groups.select(F.col("group").alias("g"), "pivot"), F.col("group") == F.col("g")).select("node", "n", "size", "pivot", "folded"), "join-members")
    lists = shingle_lists(rows, groups.select("pivot", "size"))
    pairs = stored(first_pairs(nodes, lists), "join-first")
    links = verified(pairs.select("a", "b"), rows)
    roots = stored(components(links), "join-roots")
    more = verified(later_pairs(nodes, lists, roots, pairs), rows)
    if not more.isEmpty():
        roots = stored(components(links.union(more)), "join-roots")
    named_roots = nodes.join(roots.withColumnRenamed("node", "r"), F.col("n") == F.col("r"), "left").select(F.col("node").alias("of"), F.coalesce("root", "n").alias("root"))
    return rows, named_roots


def joined(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, id, no_text, packed, doc, size, root): every document with its set's size and its component (null if empty)."""
    rows, roots = _rows_and_roots(docs, text, key)
    return _with_roots(rows, roots).select("row", "id", "no_text", "packed", "doc", "size", "root")


def with_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    rows = joined(docs, text, key)
    least = rows.filter("root is not null").groupBy(F.col("root").alias("r")).agg(F.min("id").alias("component_id"))
    return rows.join(least, F.col("root") == F.col("r"), "left").select("id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without those that another of their component stands for; the smallest id stays, of repeated rows one."""
    rows, roots = _rows_and_roots(docs, text, key)
    chosen = _with_roots(rows.select("row", "id", "node", "size"), roots).filter("root is not null").groupBy("root")
    chosen = chosen.agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "row")).alias("m")).select(F.col("m.row").alias("stays"))
    # texts are dealt once, by their row
    kept = rows.join(chosen, F.col("row") == F.col("stays"), "left").filter("size = 0 or stays is not null")

    def unpacked(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [None if none else unpack.decompress(t) for t, none in zip(batch.column("packed").to_pylist(), batch.column("no_text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc", "whole"])

    schema = T.StructType([rows.schema["doc"], T.StructField("whole", T.StringType())])
    made = kept.select("packed", "no_text", "doc").mapInArrow(unpacked, schema)
    return made.select(*[F.col("whole").cast(docs.schema[c].dataType).alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_components(docs).withColumnRenamed("id", "doc_id")
