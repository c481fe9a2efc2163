"""Words of many texts at once, found on their UTF-8 bytes by table look-up.

A transducer with the states "in a word" and "between words" reads one byte a step. Every byte has a class, and a class leads
to the same state from both, so the state after a byte is a function of that byte alone and a whole batch of texts is one
table look-up. What the transducer puts out (starts and ends of words, and any other class of byte) are positions.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words longer than this are hashed and compared one by one, the others eight bytes a step.
LONG = 64
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def classes(**members: bytes) -> tuple[np.ndarray, dict[str, int]]:
    """Class table of all bytes, and the bit of each named class."""
    table, bits = np.zeros(256, np.uint8), {}
    for i, (name, values) in enumerate(members.items()):
        bits[name] = 1 << i
        table[list(values)] |= 1 << i
    return table, bits


class Texts:
    """Bytes of a column of texts (null: empty), one after the other, with eight spare bytes behind them."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "").cast(pa.large_string())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        held = column.buffers()[2]
        raw = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
        self.size = int(bounds[-1] - bounds[0]) if len(column) else 0
        self.bounds = bounds - bounds[0]
        self.data = np.zeros(self.size + 8, np.uint8)
        self.data[: self.size] = raw[bounds[0] : bounds[0] + self.size]

    def per_text(self, positions: np.ndarray) -> np.ndarray:
        """How many of the sorted positions each text has."""
        return np.diff(np.searchsorted(positions, self.bounds))

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes that are `inside`; none crosses the end of a text."""
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        starts, ends = edge[::2], edge[1::2]
        seam = np.unique(self.bounds[1:-1])
        seam = seam[(seam > 0) & (seam < self.size)]
        seam = seam[inside[seam] & inside[seam - 1]]
        if len(seam):
            starts, ends = np.sort(np.concatenate([starts, seam])), np.sort(np.concatenate([ends, seam]))
        return starts, ends


def eights(data: np.ndarray) -> np.ndarray:
    """For each position the eight bytes from there as one number."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    view, size = eights(data), ends - starts
    out = size.astype(np.uint64) * _PRIME
    rest, at = np.flatnonzero(size <= LONG), starts
    step = 0
    while len(rest):
        left = size[rest] - step
        out[rest] = _mixed(out[rest] ^ (view[at[rest] + step] & _MASK[np.minimum(left, 8)]))
        rest, step = rest[left > 8], step + 8
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = np.frombuffer(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
    return out


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value * _PRIME
    return value ^ (value >> np.uint64(29))


def equal(data: np.ndarray, starts: np.ndarray, size: np.ndarray, other: np.ndarray, other_starts: np.ndarray) -> np.ndarray:
    """Whether the words of `size` bytes at `starts` of `data` are the bytes at `other_starts` of `other`."""
    view, second = eights(data), eights(other)
    same = np.ones(len(starts), bool)
    rest, step = np.flatnonzero(size <= LONG), 0
    while len(rest):
        left = size[rest] - step
        differ = ((view[starts[rest] + step] ^ second[other_starts[rest] + step]) & _MASK[np.minimum(left, 8)]) != 0
        same[rest[differ]] = False
        rest, step = rest[~differ & (left > 8)], step + 8
    for i in np.flatnonzero(size > LONG).tolist():
        same[i] = bytes(data[starts[i] : starts[i] + size[i]]) == bytes(other[other_starts[i] : other_starts[i] + size[i]])
    return same


def distinct(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text its number of different words: every word goes into an open-addressing table, by text and hash.

    A word that finds its place taken is compared byte by byte with the word there: equal ones are counted once, others go on
    to the next place, so equal hashes do no harm. All words take a step at a time together.
    """
    per = texts.per_text(starts)
    owner, size = np.repeat(np.arange(len(per)), per), ends - starts
    code = _mixed(hashes(texts.data, starts, ends) ^ (owner.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    bits = max(4, int(2 * len(starts)).bit_length())
    mask = (1 << bits) - 1
    place = (code >> np.uint64(64 - bits)).astype(np.int64)
    table = np.full(mask + 1, -1, np.int64)
    first = np.zeros(len(starts), bool)
    rest = np.arange(len(starts))
    while len(rest):
        here = place[rest]
        free = table[here] < 0
        table[here[free]] = rest[free]  # of several words for a place one stays
        there = table[here]
        mine = there == rest
        first[rest[mine]] = True
        near = ~mine & (code[there] == code[rest]) & (owner[there] == owner[rest]) & (size[there] == size[rest])
        among, held = rest[near], there[near]
        settled = mine
        settled[np.flatnonzero(near)[equal(texts.data, starts[among], size[among], texts.data, starts[held])]] = True
        rest = rest[~settled]
        place[rest] = (place[rest] + 1) & mask
    return texts.per_text(starts[first])
