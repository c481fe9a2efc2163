"""Scoring texts with prediction by partial matching, beside a smoothed word model.

The byte model is a trie of contexts of up to four bytes, counted over every training text. A byte is coded in its longest
known context; a byte new to the context costs an escape (as many escape counts as the context has distinct bytes) and is
then looked for in the shorter context, from which all bytes of the longer one are excluded; below the empty context all bytes
that are left are alike. A text ends with a byte that UTF-8 never has, which also stands before its start.

The trie grows with the corpus, so no task holds it. Texts are put into blocks of about `BLOCK` bytes; the distinct five-byte
strings of `GROUP` blocks are joined with the code length of each, and a task scores one block at a time with those. Code
lengths are worked out once per distinct string, in joins of edges and contexts by their bytes. Only contexts of up to two
bytes, at most 2^24 edges whatever the corpus, are shipped whole.

The word model's counts are a table as well; only the `HOT` most frequent words are shipped, the rest of a text's words meet
their counts in a join.

Training texts are those whose crc32(id as text) mod 10 is not 0. Defined results: null and empty texts have the end token
alone; null ids count as empty text; repeated rows are counted and scored each; without training texts the byte model is uniform
and the word model has N = V = 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import pieces, stored

#: Words whose counts are shipped to all tasks at most, the most frequent ones.
HOT = 300_000
#: Distinct words that a task holds before it hands them on.
HELD = 500_000
#: Bytes of text in a block, about.
BLOCK = 4 << 20
#: Blocks whose strings are looked up together.
GROUP = 8
#: Code lengths travel as whole numbers of this share of a decimal digit, below 64 digits.
FINE = 1 << 26
ORDER = 4
SMOOTH = 0.1


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the `order` bytes before it as one number, text by text with its end, and where each text begins."""
    edge = b"\xff" * order
    stream = np.frombuffer(b"".join(edge + t + b"\xff" for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + order * (np.repeat(np.arange(len(texts)), sizes) + 1)
    out = np.zeros(len(at), np.int64)
    for j in range(order, -1, -1):
        out = (out << 8) | stream[at - j]
    return out, starts


class Trie:
    """Log10 code lengths for contexts of up to two bytes, from counts of three-byte strings.

    `scores[row[context]]` are those of all bytes; `tails[row[context]]` those after an escape from the context.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        two, byte = codes >> 8, codes & 255
        contexts, where = np.unique(two, return_inverse=True)
        first = np.zeros((256, 256))
        np.add.at(first, (two & 255, byte), counts)
        zero = first.sum(0)
        n = len(contexts)
        # known contexts of two bytes, then all of one byte, then the empty one
        self.scores = np.zeros((n + 257, 256), np.float32)
        self.tails = np.zeros((n, 256), np.float32)
        self.scores[n + 256] = np.log10(self._row([zero]))
        for b in range(256):
            self.scores[n + b] = np.log10(self._row([first[b], zero])) if first[b].any() else self.scores[n + 256]
        order = np.argsort(where, kind="stable")
        ends = np.searchsorted(where[order], np.arange(n + 1))
        full = np.zeros(256)
        for c in range(n):
            own = order[ends[c] : ends[c + 1]]
            full[:] = 0
            full[byte[own]] = counts[own]
            chain = [full, first[contexts[c] & 255], zero]
            self.scores[c] = np.log10(self._row(chain))
            self.tails[c] = np.log10(np.maximum(self._row(chain, escaped=True), 1e-300))
        self.row = (n + (np.arange(65536) & 255)).astype(np.int32)
        self.row[contexts] = np.arange(n)

    @staticmethod
    def _row(chain: list[np.ndarray], escaped: bool = False) -> np.ndarray:
        """Probabilities of all bytes, given the counts in ever shorter contexts; with `escaped`, after leaving the first."""
        out, left, open_bytes = np.zeros(256), 1.0, np.ones(256, bool)
        for i, counts in enumerate(chain):
            seen = open_bytes & (counts > 0)
            if escaped and i == 0:
                open_bytes &= ~seen
                continue
            total, kinds = counts[seen].sum(), int(seen.sum())
            if not kinds:
                continue
            out[seen] = left * counts[seen] / (total + kinds)
            left *= kinds / (total + kinds)
            open_bytes &= ~seen
        if open_bytes.any():
            out[open_bytes] = left / open_bytes.sum()
        return out


def remainder(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % 10


FIELDS = {
    "block": pa.int64(), "part": pa.int64(), "ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int64()), "packed": pa.binary(),
    "codes": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()), "word": pa.binary(), "n": pa.int64(),
}
BLOCKS = "block long, part long, ids array<long>, held array<boolean>, sizes array<long>, packed binary, codes array<long>, counts array<long>, word binary, n long"


def blocks_of(docs: DataFrame) -> DataFrame:
    """Three kinds of rows: blocks of texts, distinct five-byte strings of a few blocks with training counts, training words."""
    schema = pa.schema(list(FIELDS.items()))

    def rows(size: int, /, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[f], t) if f in columns else pa.nulls(size, t) for f, t in FIELDS.items()], schema=schema)

    def collect(batches):
        press = zstandard.ZstdCompressor(level=3)
        words: Counter = Counter()
        part, held_codes, held_counts = None, [], []

        def strings():
            codes, where = np.unique(np.concatenate(held_codes), return_inverse=True)
            return rows(1, part=[part], codes=[codes], counts=[np.bincount(where, np.concatenate(held_counts)).astype(np.int64)])

        for batch in pieces(batches, limit=BLOCK):
            texts, held, block = _bytes(batch), batch.column("held_out").to_pylist(), batch.column("row")[0].as_py()
            words.update(w for t, h in zip(texts, held, strict=True) if not h for w in t.lower().split())
            if len(words) > HELD:
                yield rows(len(words), word=list(words), n=list(words.values()))
                words.clear()
            part = block if part is None else part
            for some, learnt in ((False, True), (True, False)):
                codes, n = np.unique(grams([t for t, h in zip(texts, held, strict=True) if h == some])[0], return_counts=True)
                held_codes.append(codes)
                held_counts.append(n * learnt)
            yield rows(1, block=[block], part=[part], ids=[batch.column("doc_id").to_pylist()], held=[held], sizes=[[len(t) for t in texts]], packed=[press.compress(b"".join(texts))])
            if len(held_codes) >= 2 * GROUP:
                yield strings()
                part, held_codes, held_counts = None, [], []
        if held_codes:
            yield strings()
        if words:
            yield rows(len(words), word=list(words), n=list(words.values()))

    return stored(docs.mapInArrow(collect, BLOCKS), "lm-blocks")


def code_lengths(codes: DataFrame, trie) -> DataFrame:
    """(code, value): log10 code length of every five-byte string, from (code, n) with training counts, 0 for unknown ones.

    Names: n5, n4, n3 count a byte after four, three and two others; t and d are a context's total and distinct bytes; x and
    e those of the shorter context without the bytes that the longer one knows.
    """
    seen = codes.filter("n > 0")
    low = lambda column, size: F.col(column).bitwiseAND((1 << 8 * size) - 1)
    g4 = stored(seen.groupBy(low("code", 4).alias("s4")).agg(F.sum("n").alias("n4")), "lm-g4")
    g3 = g4.groupBy(low("s4", 3).alias("s3")).agg(F.sum("n4").alias("n3"))
    c3_of = g4.withColumn("s3", low("s4", 3)).join(g3, "s3").groupBy(F.shiftright("s4", 8).alias("c3")).agg(F.sum("n4").alias("t3"), F.count("*").alias("d3"), F.sum("n3").alias("known2"))
    c2 = g3.groupBy(F.shiftright("s3", 8).alias("c2")).agg(F.sum("n3").alias("t2"), F.count("*").alias("d2"))
    c3 = c3_of.join(c2, low("c3", 2) == F.col("c2")).select("c3", "t3", "d3", (F.col("t2") - F.col("known2")).alias("x2"), (F.col("d2") - F.col("d3")).alias("e2"))
    c3 = stored(c3, "lm-c3")
    c4_of = seen.withColumn("s4", low("code", 4)).join(g4, "s4").groupBy(F.shiftright("code", 8).alias("c4")).agg(F.sum("n").alias("t4"), F.count("*").alias("d4"), F.sum("n4").alias("known3"))
    c4 = c4_of.join(c3.select(F.col("c3").alias("k3"), "t3", "d3"), low("c4", 3) == F.col("k3")).select("c4", "t4", "d4", (F.col("t3") - F.col("known3")).alias("x3"), (F.col("d3") - F.col("d4")).alias("e3"))
    keyed = codes.select("code", "n", F.shiftright("code", 8).alias("c4"), low("code", 4).alias("s4"), F.shiftright(low("code", 4), 8).alias("c3"))
    met = keyed.join(c4, "c4", "left").join(g4, "s4", "left").join(c3, "c3", "left").join(g3.select(F.col("s3"), "n3"), low("code", 3) == F.col("s3"), "left")
    numbers = ["n", "t4", "d4", "x3", "e3", "n4", "t3", "d3", "x2", "e2", "n3"]
    met = met.select("code", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in numbers])

    def value(batches):
        for batch in batches:
            code = batch.column("code").to_numpy()
            n, t4, d4, x3, e3, n4, t3, d3, x2, e2, n3 = (batch.column(c).to_numpy() for c in numbers)
            row = trie.value.row[(code >> 8) & 0xFFFF]
            known = row < len(trie.value.tails)
            whole = trie.value.scores[row, code & 255].astype(np.float64)
            tail = np.where(known, trie.value.tails[np.where(known, row, 0), code & 255], 0.0) if len(trie.value.tails) else whole
            with np.errstate(divide="ignore", invalid="ignore"):
                # after leaving three bytes: two bytes without what three know; nothing new there costs nothing
                two = np.where(n3 > 0, np.log10(n3 / (x2 + e2)), np.where(e2 > 0, np.log10(e2 / (x2 + e2)), 0.0) + tail)
                three = np.where(n4 > 0, np.log10(n4 / (t3 + d3)), np.log10(d3 / (t3 + d3)) + two)
                after = np.where(n4 > 0, np.log10(n4 / (x3 + e3)), np.where(e3 > 0, np.log10(e3 / (x3 + e3)), 0.0) + two)
                four = np.where(n > 0, np.log10(n / (t4 + d4)), np.log10(d4 / (t4 + d4)) + after)
            out = np.where(t4 > 0, four, np.where(t3 > 0, three, whole))
            yield pa.RecordBatch.from_arrays([batch.column("code"), pa.array(out)], names=["code", "value"])

    return stored(met.mapInArrow(value, "code long, value double"), "lm-values")


def scored(docs: DataFrame, text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id") == 0).alias("held_out"), F.col(text).cast("string").alias("text"))
    made = blocks_of(docs)
    blocks = made.filter("packed is not null").select("block", "part", "ids", "held", "sizes", "packed")
    strings = made.filter("codes is not null").select("part", "codes", "counts")
    words = stored(made.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    codes = stored(strings.select(F.explode(F.arrays_zip("codes", "counts")).alias("g")).groupBy(F.col("g.codes").alias("code")).agg(F.sum("g.counts").alias("n")), "lm-codes")
    three = codes.filter("n > 0").groupBy(F.col("code").bitwiseAND(0xFFFFFF).alias("s")).agg(F.sum("n").alias("n"))
    edges = np.array([(r["s"], r["n"]) for r in three.collect()], np.int64).reshape(-1, 2)  # 2^24 at most
    edges = edges[np.argsort(edges[:, 0])]
    train_docs = int(edges[(edges[:, 0] & 255) == 255, 1].sum())  # every text ends once
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, kinds = total + train_docs, kinds + (train_docs > 0)
    # whole classes of counts, from the top, as long as no more than `hot` words are in them
    of_class = F.floor(16 * F.log2("n")).cast("int")
    cut, held = None, 0
    for r in sorted(words.groupBy(of_class.alias("c")).agg(F.count("*").alias("words")).collect(), reverse=True):  # 1024 at most
        held += r["words"]
        if held > hot:
            break
        cut = r["c"]
    frequent = [] if cut is None else words.filter(of_class >= cut).collect()
    rank = {bytes(r["word"]): i for i, r in enumerate(frequent)}
    logs = np.log10(np.array([r["n"] for r in frequent], float) + SMOOTH)
    # one word's share of the probability is (count + SMOOTH) / 10^whole
    end_log, whole = math.log10(train_docs + SMOOTH), math.log10(tokens + SMOOTH * (kinds + 1))
    values = code_lengths(codes, spark.sparkContext.broadcast(Trie(edges[:, 0], edges[:, 1])))
    # a string's place among those of its blocks and its code length, as one number
    length = F.round(-F.col("value") * FINE).cast("long")
    placed = strings.select("part", F.posexplode("codes").alias("i", "code")).join(values, "code")
    needed = placed.select("part", (F.shiftleft(F.col("i").cast("long"), 32) + length).alias("known")).groupBy("part").agg(F.collect_list("known").alias("known"))
    needed = strings.select("part", "codes").join(needed, "part").withColumnRenamed("part", "of")
    table = spark.sparkContext.broadcast((rank, logs))

    def read(batches):
        unpack = zstandard.ZstdDecompressor()
        rank, logs = table.value
        get = rank.get
        for batch in batches:
            for b in range(batch.num_rows):
                known, code = (batch.column(c)[b].values.to_numpy() for c in ("known", "codes"))
                value = np.zeros(len(code))
                value[known >> 32] = (known & 0xFFFFFFFF) / -FINE
                sizes = batch.column("sizes")[b].as_py()
                ends = np.cumsum(sizes).tolist()
                data = unpack.decompress(batch.column("packed")[b].as_py())
                texts = [data[e - s : e] for s, e in zip(sizes, ends, strict=True)]
                own_codes, starts = grams(texts)
                score = np.add.reduceat(value[np.searchsorted(code, own_codes)], starts)
                n_tokens, n_known, base, rare = [], [], [], []
                for t in texts:
                    own = t.lower().split()
                    index = np.fromiter((get(w, -1) for w in own), np.int64, len(own))
                    found = index >= 0
                    n_tokens.append(len(own) + 1)
                    n_known.append(int(found.sum()) + (train_docs > 0))
                    base.append(float(logs[index[found]].sum()) + end_log)
                    rare.append([own[i] for i in np.flatnonzero(~found)])
                rows = np.arange(len(texts)) + batch.column("block")[b].as_py()
                columns = [pa.array(rows), batch.column("ids")[b].values, batch.column("held")[b].values, pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base), pa.array(score)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rare, pa.list_(pa.binary()))], names=["row", "doc_id", "held_out", "n_tokens", "hot_known", "hot_score", "score", "rare"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_score double, score double, rare array<binary>"
    ready = blocks.join(needed, F.col("part") == F.col("of")).select("block", "ids", "held", "sizes", "packed", "codes", "known")
    rows = stored(ready.mapInArrow(read, schema), "lm-rows")
    rare = rows.select("row", F.explode("rare").alias("w"))
    n = F.coalesce("n", F.lit(0))
    met = rare.join(words, rare["w"] == words["word"], "left").groupBy(F.col("row").alias("of")).agg(F.sum(F.log10(n + F.lit(SMOOTH))).alias("rare_score"), F.sum((n > 0).cast("long")).alias("rare_known"))
    base = F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)
    return rows.drop("rare").join(met, F.col("row") == F.col("of"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
