"""Token ids of whole texts for a tokenizer that splits at white space, with every word tokenised once per worker.

Words are found on the bytes of many texts at once (`byte_words`). ASCII letters, lower-cased as the tokenizer does, and the
signs behind them are tokens apart, so such a word is two units; any other word is one unit as it stands. Units are looked up
in an open-addressing table, bytes compared, and only unknown ones go to the tokenizer.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from lakewarden.llm.byte_words import Texts, classes, equal, hashes
from lakewarden.llm.common import pieces

#: Units that a worker remembers at a time, and their bytes.
REMEMBERED = 600_000
REMEMBERED_BYTES = 32 << 20
#: Bytes of text that are worked on at once; they take some fifty times that in positions, hashes and ids.
SLICE = 1 << 20
#: Signs that end words; the tokenizer makes one unit of a run of them.
SIGNS = b".,;:!?#$%&*+=|~^-"
_CLASS, _BIT = classes(
    space=b"\x20\x09\x0a\x0b\x0c\x0d",
    letter=bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)),
    sign=SIGNS,
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _grown(array: np.ndarray, need: int) -> np.ndarray:
    if need <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(need - len(array), len(array)), array.dtype)])


class WordIds:
    """Token ids of texts; the tokenizer drops white space, so a text's ids are those of its words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.n, self.bits = 0, 17
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.code = np.zeros(1 << 16, np.uint64)
        self.at = np.zeros((1 << 16) + 1, np.int64)  # bytes of unit i are at[i] .. at[i + 1]
        self.bytes = np.zeros(1 << 18, np.uint8)
        self.start = np.zeros((1 << 16) + 1, np.int64)  # and its ids start[i] .. start[i + 1]
        self.flat = np.zeros(1 << 17, np.uint32)

    def _find(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Number of each unit, -1 where it is unknown."""
        found, rest = np.full(len(starts), -1, np.int64), np.arange(len(starts))
        place = (code >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(rest):
            there = self.table[place[rest]]
            near = np.flatnonzero((there >= 0) & (self.code[there] == code[rest]) & (self.at[there + 1] - self.at[there] == size[rest]))
            who, held = rest[near], there[near]
            same = equal(data, starts[who], size[who], self.bytes, self.at[held])
            found[who[same]] = held[same]
            there[near[same]] = -1
            rest = rest[there >= 0]
            place[rest] = (place[rest] + 1) & (len(self.table) - 1)
        return found

    def _place(self, new: np.ndarray) -> None:
        """Put units of these numbers into the table."""
        rest, mask = new, len(self.table) - 1
        place = (self.code[new] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(rest):
            free = self.table[place] < 0
            self.table[place[free]] = rest[free]
            left = self.table[place] != rest
            rest, place = rest[left], (place[left] + 1) & mask

    def _keep(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, code: np.ndarray, ids: np.ndarray, per_unit: np.ndarray) -> None:
        n, m = self.n, self.n + len(starts)
        self.code, self.at, self.start = _grown(self.code, m), _grown(self.at, m + 1), _grown(self.start, m + 1)
        self.code[n:m] = code
        self.at[n + 1 : m + 1] = self.at[n] + np.cumsum(size)
        self.start[n + 1 : m + 1] = self.start[n] + np.cumsum(per_unit)
        self.bytes, self.flat = _grown(self.bytes, self.at[m] + 8), _grown(self.flat, self.start[m])
        self.bytes[self.at[n] : self.at[m]] = data[_spread(starts, size)]
        self.flat[self.start[n] : self.start[m]] = ids
        self.n = m
        if 2 * m > len(self.table):
            self.bits = int(2 * m).bit_length()
            self.table = np.full(1 << self.bits, -1, np.int32)
            n = 0
        self._place(np.arange(n, m))

    def _learn(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, code: np.ndarray, letters: np.ndarray) -> None:
        """Tokenise one unit per hash of these; another of equal hash stays unknown until the next call."""
        _, first = np.unique(code, return_index=True)
        alone = first[letters[first]]
        for at in range(0, len(alone), 5_000):
            self._learn_letters(data, starts, size, code, alone[at : at + 5_000])
        self._learn_each(data, starts, size, code, first[~letters[first]])

    def _learn_letters(self, data, starts, size, code, which) -> None:
        """Units of letters are tokenised as one text, since their last tokens say that they end one."""
        text = np.full(int(size[which].sum()) + len(which), 0x20, np.uint8)
        text[_spread(np.cumsum(size[which] + 1) - size[which] - 1, size[which])] = data[_spread(starts[which], size[which])]
        ids = np.array(self.tokenizer.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends_word[ids])
        if len(last) == len(which) and last[-1] == len(ids) - 1:
            self._keep(data, starts[which], size[which], code[which], ids, np.diff(last, prepend=-1))
        else:
            self._learn_each(data, starts, size, code, which)

    def _learn_each(self, data, starts, size, code, which) -> None:
        for at in range(0, len(which), 20_000):
            some = which[at : at + 20_000]
            words = [data[s : s + n].tobytes().decode("utf-8", "replace") for s, n in zip(starts[some].tolist(), size[some].tolist(), strict=True)]
            made = [m.ids for m in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            per_unit = np.fromiter(map(len, made), np.int64, len(made))
            self._keep(data, starts[some], size[some], code[some], np.fromiter(chain.from_iterable(made), np.uint32), per_unit)

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none), and each text's number of ids, without end ids."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        some = [self._encode(part.column("text")) for part in pieces([pa.RecordBatch.from_arrays([column], names=["text"])], limit=SLICE)]
        if len(some) == 1:
            return some[0]
        return np.concatenate([i for i, _ in some] or [self.flat[:0]]), np.concatenate([n for _, n in some] or [np.zeros(0, np.int64)])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = Texts(texts)
        kind = _CLASS[texts.data[: texts.size]]
        starts, ends = texts.words((kind & _BIT["space"]) == 0)
        per_text = texts.per_text(starts)
        # the core of a word ends at its last byte that is no sign
        solid = np.maximum.accumulate(np.where(kind & _BIT["sign"], 0, np.arange(1, texts.size + 1)))
        core = np.maximum(solid[ends - 1], starts)
        odd = np.concatenate([[0], np.cumsum((kind & _BIT["letter"]) == 0)])
        simple = (core > starts) & (odd[core] == odd[starts])
        core = np.where(simple, core, ends)
        data = _LOWER[texts.data]
        raw = np.flatnonzero(~simple)
        data[_spread(starts[raw], ends[raw] - starts[raw])] = texts.data[_spread(starts[raw], ends[raw] - starts[raw])]
        # units: the core, then the signs behind it, if any
        units = np.stack([np.stack([starts, core], 1), np.stack([core, ends], 1)], 1).reshape(-1, 2)
        letters = np.stack([simple, np.zeros(len(simple), bool)], 1).reshape(-1)
        real = units[:, 1] > units[:, 0]
        units, letters = units[real], letters[real]
        at, size = units[:, 0], units[:, 1] - units[:, 0]
        code = hashes(data, at, units[:, 1])
        if self.n > REMEMBERED or self.at[self.n] > REMEMBERED_BYTES:
            self.forget()
        index = self._find(data, at, size, code)
        while len(new := np.flatnonzero(index < 0)):
            self._learn(data, at[new], size[new], code[new], letters[new])
            index[new] = self._find(data, at[new], size[new], code[new])
        first, count = self.start[index], self.start[index + 1] - self.start[index]
        before = np.concatenate([[0], np.cumsum(count)])
        units_before = np.concatenate([[0], np.cumsum(real.reshape(-1, 2).sum(1))])[np.concatenate([[0], np.cumsum(per_text)])]
        return self.flat[_spread(first, count)], np.diff(before[units_before])


def _spread(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. for each of `size` places, then those of the next."""
    before = np.cumsum(size) - size
    return np.repeat(starts - before, size) + np.arange(int(size.sum()))
