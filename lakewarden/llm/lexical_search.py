"""Ranked lexical search the other way round: documents stream past an inverted index over the terms of the items.

The items are a stated query set. Their terms make a vocabulary and posting lists (term -> items), which are broadcast; items
beyond a bound of bytes are searched in blocks, each with its own broadcast. One pass over the whole texts leaves each
document's length and its counts of vocabulary terms. From these come the statistics, and a second pass over them puts each
document's counts through the posting lists and keeps a heap of the best documents per item. Heaps are merged by a ranking.

Defined results: a null text has no terms, an item without terms or without a document above 0 has no rows. Every row of the
items and of the documents stands for itself, repeated ones too. Equal scores are ordered by document id, null ids last. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.byte_words import Texts, classes, equal, hashes
from lakewarden.llm.common import pieces, stored, table

BEST = 10
#: Bytes of item texts whose index is broadcast at a time.
BLOCK_BYTES = 4 << 20
#: Pairs of a document's term and an item that are added up at a time.
AT_ONCE = 1 << 22
_CLASS, _BIT = classes(term=bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(column: pa.Array) -> tuple[Texts, np.ndarray, np.ndarray]:
    """Texts with A-Z lower-cased, and the starts and ends of their terms."""
    texts = Texts(column)
    starts, ends = texts.words(_CLASS[texts.data[: texts.size]] != 0)
    texts.data = _LOWER[texts.data]
    return texts, starts, ends


class Vocabulary:
    """The different terms of some texts, found by hash with their bytes compared."""

    def __init__(self, column: pa.Array):
        texts, starts, ends = terms_of(column)
        words = [texts.data[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        self.words = sorted(set(words))
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(self.words) + bytes(8), np.uint8).copy()
        number = {w: i for i, w in enumerate(self.words)}
        owner = np.repeat(np.arange(len(column)), texts.per_text(starts))
        #: (term, item) with how often the item has the term, sorted
        pairs = np.array([number[w] for w in words], np.int64) * max(1, len(column)) + owner
        pairs, self.times = np.unique(pairs, return_counts=True)
        self.term_of, self.item_of = np.divmod(pairs, max(1, len(column)))
        self.first = np.searchsorted(self.term_of, np.arange(len(self.words) + 1))
        code = hashes(self.data, self.at, self.at + self.size)
        self.bits = max(8, int(8 * len(self.words)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        for i, place in enumerate((code >> np.uint64(64 - self.bits)).astype(np.int64).tolist()):
            while self.table[place] >= 0:
                place = (place + 1) & (len(self.table) - 1)
            self.table[place] = i
        self.code = code

    def find(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each term, -1 for those that no item has."""
        found, rest = np.full(len(starts), -1, np.int64), np.arange(len(starts))
        code, size = hashes(texts.data, starts, ends), ends - starts
        place = (code >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(rest):
            there = self.table[place[rest]]
            rest, there = rest[there >= 0], there[there >= 0]
            near = np.flatnonzero((self.code[there] == code[rest]) & (self.size[there] == size[rest]))
            who, held = rest[near], there[near]
            same = equal(texts.data, starts[who], size[who], self.data, self.at[held])
            found[who[same]] = held[same]
            rest = np.delete(rest, near[same])
            place[rest] = (place[rest] + 1) & (len(self.table) - 1)
        return found


def counted(docs: DataFrame, vocabulary, text: str = "text") -> DataFrame:
    """doc_id, its number of terms, and its terms of the vocabulary with their counts; documents without terms are left out."""

    def run(batches):
        known = vocabulary.value
        for batch in batches:
            for some in pieces([batch]):
                texts, starts, ends = terms_of(some.column("text"))
                per = texts.per_text(starts)
                owner, term = np.repeat(np.arange(len(per)), per), known.find(texts, starts, ends)
                hit, width = term >= 0, max(1, len(known.words))
                key, times = np.unique(owner[hit] * width + term[hit], return_counts=True)
                doc, term = np.divmod(key, width)
                bounds = np.searchsorted(doc, np.arange(len(per) + 1)).astype(np.int32)
                made = pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        pa.array(per, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(times, pa.int64())),
                    ],
                    names=["doc_id", "n", "terms", "times"],
                )
                yield made.filter(pa.array(per > 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, times array<long>")


class Heaps:
    """The best documents of every item, by (score from high, no id last, id)."""

    def __init__(self, items: int, best: int):
        self.items, self.best = items, best
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)  # scores below this cannot enter

    def update(self, scores: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        """`scores` has a row for each of these documents and a column for each item."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[row, item]])
        doc, no_id = np.concatenate([self.doc, doc[row]]), np.concatenate([self.no_id, no_id[row]])
        order = np.lexsort((doc, no_id, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.best]
        self.item, self.score, self.doc, self.no_id = item[rank < self.best], score[kept], doc[kept], no_id[kept]
        last = rank[rank < self.best] == self.best - 1
        self.least[self.item[last]] = self.score[last]


def searched(counts: DataFrame, vocabulary, weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """Each partition's heaps as rows: item, doc_id, score."""
    known = vocabulary.value
    n_items = int(known.item_of.max()) + 1 if len(known.item_of) else 0
    per_item = np.zeros(n_items)
    np.add.at(per_item, known.item_of, weights[known.term_of] * known.times * 1e6)
    in_doubles = not n_items or per_item.max() < 2**53  # sums of whole numbers below that are exact

    def run(batches):
        known = vocabulary.value
        heaps, per_term = Heaps(n_items, best), np.diff(known.first)
        for batch in batches:
            if not batch.num_rows:
                continue
            n, lists = batch.column("n").to_numpy(), batch.column("terms")
            term, times = (batch.column(c).flatten().to_numpy() for c in ("terms", "times"))
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            measure = 25 + (75 * n * n_docs) // n_terms
            value = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * measure[owner]))
            no_id = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            doc = batch.column("doc_id").fill_null(0).to_numpy()
            done = np.concatenate([[0], np.cumsum(np.bincount(owner, per_term[term], batch.num_rows))]).astype(np.int64) + np.arange(batch.num_rows + 1) * n_items
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(done, done[low] + AT_ONCE, side="right")) - 1)
                a, b = np.searchsorted(owner, [low, high])
                wide = per_term[term[a:b]]
                before = np.cumsum(wide) - wide
                posting = np.repeat(known.first[term[a:b]] - before, wide) + np.arange(int(wide.sum()))
                cell = np.repeat((owner[a:b] - low) * n_items, wide) + known.item_of[posting]
                add = np.repeat(value[a:b], wide) * known.times[posting]
                if in_doubles:
                    scores = np.bincount(cell, add, (high - low) * n_items).astype(np.int64)
                else:
                    scores = np.zeros((high - low) * n_items, np.int64)
                    np.add.at(scores, cell, add)
                heaps.update(scores.reshape(high - low, n_items), doc[low:high], no_id[low:high])
                low = high
        yield pa.RecordBatch.from_arrays(
            [pa.array(heaps.item), pa.array(heaps.doc, mask=heaps.no_id), pa.array(heaps.score)], names=["item", "doc_id", "score"]
        )

    return counts.mapInArrow(run, "item long, doc_id long, score long")


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items' rows in blocks, none with more than `limit` bytes of text unless it is one item."""
    sized = stored(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "items")
    size = F.sum(F.octet_length("text")).alias("bytes")
    n = 1 + (sized.agg(size).first()["bytes"] or 0) // limit
    while True:
        block = F.pmod(F.xxhash64("item"), F.lit(n))
        over = sized.groupBy(block.alias("block")).agg(size, F.count("*").alias("rows")).where((F.col("bytes") > limit) & (F.col("rows") > 1))
        if over.isEmpty():
            break
        n *= 2
    return [sized.where(block == i).orderBy("item") for i in range(n)]


def search(docs: DataFrame, items: DataFrame, best: int = BEST, text: str = "text") -> DataFrame:
    """The `best` highest-scoring documents of each item."""
    spark, out = docs.sparkSession, []
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    statistics = None
    for block in blocks(items):
        rows = block.collect()  # bounded by the block's bytes
        vocabulary = Vocabulary(pa.array([r["text"] for r in rows], pa.string()))
        if not vocabulary.words:
            continue
        shared = spark.sparkContext.broadcast(vocabulary)
        counts = stored(counted(docs, shared, text), "term-counts")
        statistics = statistics or counts.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(vocabulary.words), np.int64)
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # one per term
            df[r["term"]] = r["df"]
        weights = np.array([math.floor(1000 * math.log((2 * statistics["docs"] + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        found = searched(counts, shared, weights, statistics["docs"], statistics["terms"], best)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "number long, item_id long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        top = found.withColumn("rank", rank).where(F.col("rank") <= best)
        out.append(top.join(names, F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = """
WITH doc_terms AS (
    SELECT row_number() OVER () AS d, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), held AS (
    SELECT d, doc_id, w, len(w)::BIGINT AS n FROM doc_terms WHERE len(w) > 0
), total AS (
    SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM held
), item_terms AS (
    SELECT row_number() OVER () AS i, item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), wanted AS (
    SELECT i, item_id, term, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(w) AS term FROM item_terms) GROUP BY ALL
), tf AS (
    SELECT d, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT d, doc_id, n, unnest(w) AS term FROM held) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weight AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term
), scored AS (
    SELECT i, item_id, d, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM tf JOIN weight USING (term) JOIN wanted USING (term), total GROUP BY i, item_id, d, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
