"""Document quality from lines labelled good or bad by a linear-chain conditional random field.

Every line with a word is described by its mix of letters, capitals, digits and signs, its word lengths and repetition, each
cut into ranges. A line's score takes in its own ranges and those of the lines before and after; neighbouring labels have
scores too. The field is trained on documents labelled as a whole, each line carrying its document's label, on a bounded
sample of labelled rows (`SAMPLE`, by hash of the id, outside of the held-out third). A document's score is the marginal
probability of "good" from forward-backward over its lines, averaged with line lengths as weights. Statistics are per
document only, and neither labels nor language, source or id are inputs of a score.

Defined results: a text without words scores 0; null texts count as empty; null ids are never held out; repeated rows are scored
each; labels that are null or conflict are taken as they come; without any labelled rows every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import pieces, texts_of

#: Labelled rows that the field is fitted on at most.
SAMPLE = 4000
#: Ranges that each measure is cut into.
CUTS = {
    "upper": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "digit": (0.001, 0.01, 0.03, 0.08, 0.2, 0.5),
    "sign": (0.001, 0.01, 0.03, 0.06, 0.12, 0.25),
    "loud": (0.001, 0.01, 0.03, 0.06, 0.12, 0.25),
    "stop": (0.001, 0.005, 0.01, 0.02, 0.04, 0.1),
    "other": (0.001, 0.01, 0.03, 0.06, 0.12, 0.25),
    "space": (0.05, 0.1, 0.14, 0.18, 0.22, 0.3),
    "length": (8, 20, 60, 200, 600, 2000),
    "distinct": (0.15, 0.3, 0.45, 0.6, 0.75, 0.9),
    "again": (0.01, 0.03, 0.08, 0.2, 0.4, 0.7),
    "word": (2.5, 3.5, 4.5, 5.5, 6.5, 8.0),
}
RANGES = 7
WIDTH = len(CUTS) * RANGES
# character classes: 0 letter, 1 capital, 2 digit, 3 white space, 4 sign, 5 loud, 6 stop, 7 other
LETTER, UPPER, DIGIT, BLANK, SIGN, LOUD, STOP, OTHER = range(8)


def _classes() -> np.ndarray:
    """Class of every code point below U+3000; those above are letters."""
    table = np.zeros(0x3001, np.uint8)
    for cp in range(0x3000):
        c = chr(cp)
        if c.isalpha():
            table[cp] = UPPER if c.isupper() else LETTER
        elif c.isdigit():
            table[cp] = DIGIT
        elif c.isspace():
            table[cp] = BLANK
        else:
            table[cp] = SIGN if c in "#*$%&|<>~^_=+\\/@{}[]" else LOUD if c in "!?" else STOP if c in ".,;:" else OTHER
    return table


_TABLE = _classes()


def line_ranges(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all lines with a word: ranges (lines x measures), length in code points, and index of the text."""
    lines, owner = [], []
    for i, text in enumerate(texts):
        own = [x for x in text.split("\n") if x and not x.isspace()]
        lines += own
        owner += [i] * len(own)
    if not lines:
        return np.zeros((0, len(CUTS)), np.int64), np.zeros(0), np.zeros(0, np.int64)
    size = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _TABLE[np.minimum(codes, 0x3000)]
    starts = np.cumsum(size) - size
    counts = [np.add.reduceat(kind == k, starts, dtype=np.int64) for k in range(8)]
    words = [x.split() for x in lines]
    n_words = np.array([len(w) for w in words])
    distinct = np.array([len(set(w)) for w in words]) / np.maximum(n_words, 1)
    again = np.array([sum(map(eq, w, w[1:])) for w in words]) / np.maximum(n_words, 1)
    share = [c / size for c in counts]
    letters = np.maximum(counts[LETTER] + counts[UPPER], 1)
    values = {
        "upper": counts[UPPER] / letters, "digit": share[DIGIT], "sign": share[SIGN], "loud": share[LOUD], "stop": share[STOP], "other": share[OTHER], "space": share[BLANK],
        "length": size, "distinct": distinct, "again": again, "word": (size - counts[BLANK]) / np.maximum(n_words, 1),
    }
    return np.stack([np.searchsorted(CUTS[k], values[k], side="right") for k in CUTS], axis=1), size.astype(float), np.array(owner)


def logits(ranges: np.ndarray, owner: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of "good" over "bad" for every line, from its own ranges and its neighbours'."""
    columns = ranges + np.arange(len(CUTS)) * RANGES
    own, before, after = (weights[i * WIDTH : (i + 1) * WIDTH][columns].sum(1) for i in range(3))
    out = own + weights[3 * WIDTH]
    same = owner[1:] == owner[:-1]
    out[1:] += np.where(same, before[:-1], weights[3 * WIDTH + 1])
    out[:-1] += np.where(same, after[1:], weights[3 * WIDTH + 2])
    if len(out):
        out[0] += weights[3 * WIDTH + 1]
        out[-1] += weights[3 * WIDTH + 2]
    return out


def marginals(unary: np.ndarray, owner: np.ndarray, stay: float) -> tuple[np.ndarray, float, float]:
    """Probability of "good" per line; the log partition, and the expected number of neighbours with equal labels.

    Equal neighbouring labels score `stay`. All documents advance together, line by line.
    """
    n = len(unary)
    if not n:
        return np.zeros(0), 0.0, 0.0
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    sizes = np.diff(np.append(starts, n))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    both = np.stack([np.zeros(n), unary], axis=1)
    forward[starts] = both[starts]
    for t in range(1, sizes[0]):
        at = starts[: active[t]] + t
        p = forward[at - 1]
        forward[at, 0] = np.logaddexp(p[:, 0] + stay, p[:, 1])
        forward[at, 1] = np.logaddexp(p[:, 0], p[:, 1] + stay) + unary[at]
    total = np.logaddexp(forward[starts + sizes - 1, 0], forward[starts + sizes - 1, 1])
    equal = 0.0
    for t in range(sizes[0] - 1, 0, -1):
        at = starts[: active[t]] + t
        ahead = both[at] + backward[at]
        backward[at - 1, 0] = np.logaddexp(ahead[:, 0] + stay, ahead[:, 1])
        backward[at - 1, 1] = np.logaddexp(ahead[:, 0], ahead[:, 1] + stay)
        z = total[: active[t]]
        equal += float(np.exp(forward[at - 1, 0] + stay + ahead[:, 0] - z).sum() + np.exp(forward[at - 1, 1] + stay + ahead[:, 1] - z).sum())
    gap = forward + backward
    return 1.0 / (1.0 + np.exp(np.clip(gap[:, 0] - gap[:, 1], -700, 700))), float(total.sum()), equal


def train(ranges: np.ndarray, owner: np.ndarray, label: np.ndarray, steps: int = 60, rate: float = 0.3, decay: float = 1e-3) -> np.ndarray:
    """Weights fitted by AdaGrad on the likelihood of the line labels; the last weight is `stay`."""
    weights = np.zeros(3 * WIDTH + 4)
    if not len(label):
        return weights
    sums = np.full_like(weights, 1e-6)
    columns = ranges + np.arange(len(CUTS)) * RANGES
    same = owner[1:] == owner[:-1]
    first, last = np.concatenate([[True], ~same]), np.concatenate([~same, [True]])
    equal_seen = float((label[1:] == label[:-1])[same].sum())
    for _ in range(steps):
        good, _, equal = marginals(logits(ranges, owner, weights), owner, weights[-1])
        miss = label - good
        slope = np.zeros_like(weights)
        np.add.at(slope, columns, miss[:, None])
        np.add.at(slope, WIDTH + columns[:-1][same], miss[1:][same][:, None])
        np.add.at(slope, 2 * WIDTH + columns[1:][same], miss[:-1][same][:, None])
        slope[3 * WIDTH], slope[3 * WIDTH + 1], slope[3 * WIDTH + 2] = miss.sum(), miss[first].sum(), miss[last].sum()
        slope[-1] = equal_seen - equal
        slope -= decay * len(label) * weights
        sums += slope * slope
        weights += rate * slope / np.sqrt(sums)
    return weights


def scores(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Length-weighted probability of "good" per text."""
    ranges, size, owner = line_ranges(texts)
    good, _, _ = marginals(logits(ranges, owner, weights), owner, weights[-1])
    weight = np.bincount(owner, size, len(texts))
    found = np.bincount(owner, size * good, len(texts)) / np.maximum(weight, 1)
    return np.clip(found, 0.0, 1.0) if weights.any() else np.full(len(texts), 0.5)


def remainder(key) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from a sample of the labelled documents; ids, then lines as ranges, are bounded by `sample` documents."""
    known = labels.filter((remainder("doc_id") != 1) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    picked = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    pairs = dict(picked.collect())
    if not pairs:
        return np.zeros(3 * WIDTH + 4)

    def describe(batches):
        for batch in pieces(batches):
            ranges, _, owner = line_ranges(texts_of(batch))
            ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
            rows = np.split(ranges.astype(np.int8), np.searchsorted(owner, np.arange(1, len(ids))))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "lines"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    chosen = chosen.join(F.broadcast(docs.sparkSession.createDataFrame([(int(i),) for i in pairs], "doc_id long")), "doc_id", "left_semi")
    made = chosen.mapInArrow(describe, "doc_id long, lines binary").collect()
    made.sort(key=lambda r: (r["doc_id"], r["lines"]))
    ranges = [np.frombuffer(r["lines"], np.int8).reshape(-1, len(CUTS)).astype(np.int64) for r in made]
    owner = np.repeat(np.arange(len(made)), [len(r) for r in ranges])
    label = np.repeat([float(pairs[r["doc_id"]] > 0) for r in made], [len(r) for r in ranges])
    return train(np.concatenate([np.zeros((0, len(CUTS)), np.int64), *ranges]), owner, label)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def read(batches):
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores(texts_of(batch), weights))], names=["doc_id", "held_out", "score"])

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id") == 1).alias("held_out"), F.col("text").alias("text"))
    made = named.mapInArrow(read, "doc_id long, held_out boolean, score double")
    return made.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")))
