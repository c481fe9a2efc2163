"""Personal data: fixed patterns, and a linear-chain conditional random field over word-shape features.

The patterns give the base spans. The field labels every word of every line as outside or as part of a kind; it is trained
from a small labelled table by gradient steps on the exact log likelihood (forward-backward), and decoded by Viterbi over
batches of lines in numpy, position by position. It adds what the patterns miss: national phone numbers, spelled-out email
addresses, and secrets such as keys, tokens and passwords. Spans that touch a base span are not added; base spans stay.

A line is decoded only if one of its words could leave "outside": where every word prefers "outside" by at least what the
best transition gains over outside-outside, the path that stays outside is the best one, so the shortcut is exact.

Defined results: null and empty texts have no spans; repeated rows are treated each; ids may be null; offsets are code points, end
exclusive; a span may overlap one of another kind; extra columns are ignored by `find` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.common import in_small_batches, pieces, texts_of

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("", *KINDS)
#: Kinds whose words in a row are one span.
JOINED = frozenset(["email", "phone"])
#: Kinds that the field may add; addresses and card numbers have checks of their own that a learnt label would undercut.
ADDED = frozenset(["email", "phone", "secret"])
#: Words whose scores a worker remembers at a time.
REMEMBERED = 100_000
#: Bytes of text that are tagged at once.
SLICE = 1 << 20

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile("[0-9]")
SPELLED = re.compile(r"@|[\[(]at[\])]", re.I)
EDGE = "\"'()[]{}<>.,;:!?"
SIGNS = EDGE + "#$%&*+-/=@\\^_`|~"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind index, end) of the fixed patterns, sorted; matches that fail their check are dropped, without retries."""
    found = []
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _digits(m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def shape(word: str) -> str:
    """X, x and d for letters and digits, runs of letters once, other signs as they are."""
    out = []
    for c in word[:40]:
        s = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        if s == "d" or not out or out[-1] != s:
            out.append(s)
    return "".join(out)


def features(word: str) -> list[str]:
    bare = word.strip(EDGE)
    digits = sum("0" <= c <= "9" for c in word)
    upper, lower = any(c.isupper() for c in bare), any(c.islower() for c in bare)
    value = bare.rsplit("=", 1)[-1].strip("\"'")
    out = ["bias", "w=" + bare.lower(), "s=" + shape(word), "b=" + shape(bare), f"d={min(digits, 6) if digits < 7 else 7 + (digits > 9) + (digits > 13) + (digits > 19)}"]
    out += [f"l={min(len(bare), 24) // 4}", f"mix={upper}{lower}{digits > 0}{len(value) >= 14}", f"plain={bare.isalpha()}"]
    if len(value) >= 14 and digits and value.isalnum():
        out.append("hex" if set(value) <= set("0123456789abcdef") else "caps" if value.isupper() else "alnum")
    if "=" in bare:
        out.append("key=" + bare.split("=")[0].lower())
    if "@" in bare:
        out.append("at")
    return out


def around(word: str) -> list[str]:
    bare = word.strip(EDGE)
    return ["w=" + bare.lower(), "s=" + shape(word)[:12]]


class Field:
    """Weights of the conditional random field: label scores by feature, and between neighbouring labels."""

    def __init__(self, own: dict[str, np.ndarray], left: dict[str, np.ndarray], right: dict[str, np.ndarray], move: np.ndarray):
        self.own, self.left, self.right, self.move = own, left, right, move

    def word_scores(self, word: str) -> np.ndarray:
        """Scores a word gives to itself, to the word after it, and to the word before it."""
        out = np.zeros((3, len(LABELS)))
        for row, (table, names) in enumerate(((self.own, features(word)), (self.left, around(word)), (self.right, around(word)))):
            for name in names:
                w = table.get(name)
                if w is not None:
                    out[row] += w
        return out


def train(examples: Iterable[tuple[list[str], list[int]]], steps: int = 60, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Fit by AdaGrad on the exact log likelihood of the labelled word sequences, all in one padded batch."""
    examples = [e for e in examples if e[0]]
    n, k, longest = len(examples), len(LABELS), max(len(w) for w, _ in examples)
    tables: list[dict[str, int]] = [{}, {}, {}]
    entries = []  # sequence, position, table, feature
    gold, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for s, (words, labels) in enumerate(examples):
        gold[s, : len(words)], mask[s, : len(words)] = labels, True
        for t, word in enumerate(words):
            for table, names in ((0, features(word)), (1, around(words[t - 1]) if t else []), (2, around(words[t + 1]) if t + 1 < len(words) else [])):
                entries += [(s, t, table, tables[table].setdefault(f, len(tables[table]))) for f in names]
    e = np.array(entries)
    base = np.cumsum([0, *[len(t) for t in tables]])
    where, feature = e[:, 0] * longest + e[:, 1], base[e[:, 2]] + e[:, 3]
    weights, move = np.zeros((base[-1], k)), np.zeros((k, k))
    sums, move_sums = np.full_like(weights, 1e-6), np.full_like(move, 1e-6)
    one_hot = np.eye(k)[gold] * mask[:, :, None]
    for _ in range(steps):
        unary = np.zeros((n * longest, k))
        np.add.at(unary, where, weights[feature])
        unary = unary.reshape(n, longest, k)
        alpha, beta = np.zeros_like(unary), np.zeros_like(unary)
        alpha[:, 0] = unary[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + unary[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        pairs = np.zeros((k, k))
        for t in range(longest - 2, -1, -1):
            ahead = unary[:, t + 1] + beta[:, t + 1]
            step = np.logaddexp.reduce(move + ahead[:, None, :], axis=2)
            both = alpha[:, t, :, None] + move + ahead[:, None, :] - total[:, None, None]
            pairs += (np.exp(both) * mask[:, t + 1, None, None]).sum(0)
            beta[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        marginal = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        miss = (one_hot - marginal).reshape(-1, k)
        slope = np.zeros_like(weights)
        np.add.at(slope, feature, miss[where])
        seen = np.zeros((k, k))
        np.add.at(seen, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1.0)
        for w, g, s in ((weights, slope - decay * n * weights, sums), (move, seen - pairs - decay * n * move, move_sums)):
            s += g * g
            w += rate * g / np.sqrt(s)
    made = [{f: weights[base[i] + j] for f, j in tables[i].items()} for i in range(3)]
    return Field(*made, move)


def viterbi(unary: np.ndarray, starts: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label of every word; sequences lie one after the other in `unary`, all are advanced together."""
    best = np.zeros(len(unary), np.int8)
    if not len(sizes):
        return best
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # sequences longer than t
    back = np.zeros(unary.shape, np.int8)
    score = unary[starts].astype(np.float64)
    final = score.copy()
    for t in range(1, sizes[0]):
        a = active[t]
        at = starts[:a] + t
        step = score[:a, :, None] + move
        back[at] = step.argmax(axis=1)
        score[:a] = step.max(axis=1) + unary[at]
        final[:a] = score[:a]
    label = final.argmax(axis=1)
    for t in range(sizes[0] - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        best[at] = label[:a]
        if t:
            label[:a] = back[at, label[:a]]
    return best


class Tagger:
    """Finds the field's spans in batches of texts."""

    def __init__(self, field: Field):
        self.field = field
        self.lexicon = {n[2:] for t in (field.own, field.left, field.right) for n in t if n.startswith("w=")}
        self.alike: dict[tuple, np.ndarray] = {}
        self.forget()
        self.gain = max(0.0, float(field.move.max() - field.move[0, 0]))

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1 << 12, 3, len(LABELS)), np.float32)

    def index(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if len(known) + len(new) > REMEMBERED and known:
            self.forget()
            return self.index(words)
        while len(known) + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        for word in new:
            self.scores[len(known)] = self._scores(word)
            known[word] = len(known)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _scores(self, word: str) -> np.ndarray:
        """Scores of a word; words of letters that training never saw differ only in form, length and the signs around them."""
        core = word.strip(SIGNS)
        if not core.isalpha() or "=" in word or "@" in word or word.strip(EDGE).lower() in self.lexicon:
            return self.field.word_scores(word)
        form = "x" if core.islower() else "X" if core.isupper() else "Xx" if core[0].isupper() and core[1:].islower() else ""
        if not form:
            return self.field.word_scores(word)
        at = word.index(core)
        key = (form, min(len(core), 28), word[:at], word[at + len(core) :])
        if key not in self.alike:
            if len(self.alike) > REMEMBERED:
                self.alike.clear()
            n = key[1]
            self.alike[key] = self.field.word_scores(key[2] + {"x": "q" * n, "X": "Q" * n, "Xx": "Q" + "q" * (n - 1)}[form] + key[3])
        return self.alike[key]

    def tag(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """(start, kind index, end) per text."""
        lines, sizes, owner = [], [], []
        words: list[str] = []
        for i, text in enumerate(texts):
            for start, line in _lines(text):
                own = WORD.findall(line)
                if own:
                    words += own
                    sizes.append(len(own))
                    lines.append((start, line))
                    owner.append(i)
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        if not words:
            return out
        index = self.index(words)
        sizes = np.array(sizes)
        starts = np.cumsum(sizes) - sizes
        unary = self.scores[index, 0]
        unary[1:] += self.scores[index[:-1], 1]
        unary[:-1] += self.scores[index[1:], 2]
        # no word looks across the ends of its line
        unary[starts[1:]] -= self.scores[index[starts[1:] - 1], 1]
        unary[starts[1:] - 1] -= self.scores[index[starts[1:]], 2]
        open_words = unary[:, 0] - unary[:, 1:].max(axis=1) < self.gain
        need = np.logical_or.reduceat(open_words, starts)
        chosen = np.flatnonzero(need)
        labels = viterbi(unary, starts[chosen], sizes[chosen], self.field.move)
        hit = np.logical_or.reduceat(labels > 0, starts)
        for n in np.flatnonzero(hit):
            start, line = lines[n]
            own = labels[starts[n] : starts[n] + sizes[n]]
            out[owner[n]] += [(start + a, k, start + b) for a, k, b in _spans(line, own)]
        return out


def _lines(text: str):
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


def _spans(line: str, labels: np.ndarray):
    """Words of one kind as spans without the signs around them."""
    places = [m.span() for m in WORD.finditer(line)]
    i = 0
    while i < len(labels):
        kind, j = int(labels[i]), i + 1
        if not kind:
            i += 1
            continue
        while KINDS[kind - 1] in JOINED and j < len(labels) and labels[j] == kind:
            j += 1
        start, end = places[i][0], places[j - 1][1]
        if KINDS[kind - 1] == "secret" and "=" in line[start:end].rstrip("=\"'"):
            start += line[start:end].rstrip("=\"'").rindex("=") + 1
        while start < end and line[start] in "\"'[{<,;:!?=" + ("" if KINDS[kind - 1] == "phone" else "("):
            start += 1
        while end > start and line[end - 1] in "\"')]}>.,;:!?=":
            end -= 1
        if end > start and _plausible(KINDS[kind - 1], line[start:end]):
            yield start, kind - 1, end
        i = j


def _plausible(kind: str, text: str) -> bool:
    """Checks that hold for any span of the kind, as the patterns have theirs."""
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    if kind == "email":
        return bool(SPELLED.search(text)) and bool(re.search(r"\.|dot", text, re.I))
    if kind == "secret":
        return len(text) >= 12 and any(c.isdigit() for c in text) and any(c.isalpha() for c in text)
    return True


def labelled_table(lines: int = 600, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The small labelled table: (line, spans) made by a fixed rule from filler words, harmless numbers and personal data."""
    r = random.Random(seed)
    syllables = "th er on an in re he ti es ou en ed is ñe ción é ç ü ge ver sch ung heit lich la de os ar en do mi que eau ment tion".split()

    def d(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def filler() -> str:
        word = "".join(r.choice(syllables) for _ in range(r.randint(1, 5)))
        word = r.choice([word] * 6 + [word.capitalize(), word.upper(), word.upper() + "!!"])
        return word + r.choice([""] * 8 + [",", ".", "###", "&&&", "***", "%%%", "$$$", "!"])

    def harmless() -> list[str]:
        return r.choice([
            [f"{r.randint(1900, 2030)}"], [f"{r.randint(1, 99)}.{r.randint(0, 9)}."], ["version", f"{r.randint(1, 9)}."], [f"{d(2)},{d(3)}"], [f"${d(2)}.{d(2)}"],
            [f"{d(4)}-{d(2)}-{d(2)}"], [f"{d(2)}:{d(2)}"], ["|"], ["|", filler(), "|"], [f"{d(1)}-{d(2)}"], [f"({r.randint(1900, 2030)})"], ["at", filler()], ["dot", filler()],
            [f"({d(1)})"], [f"{d(6)}"], ["token", filler()], ["password", filler()], ["=", filler()], [f"{filler()}={filler()}"], ["A" + d(2)], [f"p.", d(3)], [f"{d(3)}-{d(3)}"], ["phone", filler()],
            ["https://" + "".join(r.choice(syllables) for _ in range(3)) + ".example/" + d(3)], [d(12)], ["No.", d(5)], ["COVID-19"], [f"{d(2)}%"], ["call", filler()], ["+", filler()],
        ])

    def name() -> str:
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8)))

    def secret() -> tuple[list[str], int]:
        hexa = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([16, 18, 20, 32, 40, 64])))
        caps = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(14)) + d(2)
        both = "".join(r.choice("abcdefghijkABCDEFGHIJK0123456789") for _ in range(22)) + d(2)
        return r.choice([
            (["AKIA" + caps], 0), (["token", "=", f'"{hexa}"'], 2), (["password=" + hexa], 0), (["password:", hexa], 1), (["api_key=" + both], 0), (["secret", "=", hexa], 2),
            (["key", "=", f"'{both}'"], 2), (["ghp_" + both], 0), (["sk-" + both], 0), (["Bearer", both], 1), (["token", hexa + "."], 1), (["AKIA" + caps + "."], 0), (["token:", both], 1), (["passwd=" + both + ","], 0),
        ])

    def personal() -> tuple[list[str], str, int]:
        kind = r.choice(KINDS)
        if kind == "email":
            host = f"{name()}.{r.choice(['com', 'org', 'net', 'example.com'])}"
            return r.choice([
                ([f"{name()}.{d(2)}@{host}"], kind, 0), ([f"{name()}@{host},"], kind, 0), ([name(), "[at]", name(), "[dot]", "com"], kind, 0), ([name(), "(at)", name(), "(dot)", "org"], kind, 0),
                ([f"{name()}[at]{host}"], kind, 0), ([f"{name()}(at){host}"], kind, 0), (["email:", f"<{name()}@{host}>"], kind, 1),
            ])
        if kind == "ip":
            return [".".join(str(r.randint(1, 255)) for _ in range(4)) + r.choice(["", "", "."])], kind, 0
        if kind == "card":
            return r.choice([([d(16)], kind, 0), ([d(4), d(4), d(4), d(4)], kind, 0), (["-".join(d(4) for _ in range(4))], kind, 0), ([d(15)], kind, 0)])
        if kind == "phone":
            a, b, c = d(3), d(3), d(4)
            return r.choice([
                ([f"+{d(1)}", f"({a})", f"{b}-{c}"], kind, 0), ([f"({a})", f"{b}-{c}"], kind, 0), ([f"{a}-{b}-{c}"], kind, 0), ([f"{a}.{b}.{c}"], kind, 0), ([f"({a}){b}-{c}"], kind, 0),
                ([f"+{d(2)}", d(3), d(7)], kind, 0), ([f"+{d(11)}"], kind, 0), (["tel:", f"{a}-{b}-{c}"], kind, 1), (["call", f"1-{a}-{b}-{c}"], kind, 1), ([f"+{d(2)}-{a}-{b}-{c}."], kind, 0),
            ])
        words, first = secret()
        return words, kind, first

    out = []
    for _ in range(lines):
        words, marks = [], []
        for _ in range(r.randint(1, 4)):
            words += [filler() for _ in range(r.randint(0, 4))]
            what = r.random()
            if what < 0.35:
                words += harmless()
            elif what < 0.75:
                new, kind, first = personal()
                marks += [(len(words) + i, kind) for i in range(first, len(new))]
                words += new
            words += [filler() for _ in range(r.randint(0, 3))]
        places, at = [], 0
        for w in words:
            places.append((at, at + len(w)))
            at += len(w) + 1
        out.append((" ".join(words), [(*places[i], kind) for i, kind in marks]))
    return out


def examples(table: Iterable[tuple[str, list[tuple[int, int, str]]]]) -> list[tuple[list[str], list[int]]]:
    """Word sequences with labels: a word has the kind of the span that it touches."""
    made = []
    for text, spans in table:
        places = [m.span() for m in WORD.finditer(text)]
        labels = [next((LABELS.index(k) for s, e, k in spans if s < b and a < e), 0) for a, b in places]
        made.append(([text[a:b] for a, b in places], labels))
    return made


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(examples(labelled_table()))


_TAGGERS: dict[int, Tagger] = {}


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]]:
    """(base spans, all spans) per text; the field adds spans that touch no base span."""
    out = []
    for text, learnt in zip(texts, tagger.tag(texts), strict=True):
        base = base_spans(text)
        more = [x for x in learnt if KINDS[x[1]] in ADDED and not any(x[0] < e and s < x[2] for s, _, e in base)]
        out.append((base, sorted(base + more)))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _tagger(shared) -> Tagger:
    """One tagger per worker and model, kept between tasks."""
    if shared.id not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[shared.id] = Tagger(shared.value)
    return _TAGGERS[shared.id]


class _Shared:
    """A broadcast model and its number, which names it in the workers."""

    def __init__(self, spark, field: Field):
        self.held = spark.sparkContext.broadcast(field)
        self.id = self.held._jbroadcast.id()

    def __getstate__(self):
        return {"held": self.held, "id": self.id}

    @property
    def value(self) -> Field:
        return self.held.value


def find(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """(doc_id, counts of base spans, base_sha256, spans) of every document."""
    shared = _Shared(docs.sparkSession, field or default_field())

    def read(batches):
        for batch in pieces(batches, limit=SLICE):
            found = all_spans(texts_of(batch), _tagger(shared))
            columns = [batch.column("doc_id")]
            columns += [pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in range(4)]
            columns += [pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()), pa.array([joined(every) for _, every in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(read, schema)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first names the place."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars", field: Field | None = None) -> DataFrame:
    """The documents with personal data masked, all other columns as they were; `length`, if there, is counted anew."""
    shared = _Shared(docs.sparkSession, field or default_field())
    place = docs.columns.index(text)
    nth = docs.columns.index(length) if length in docs.columns else None
    kind = docs.schema[nth].dataType if nth is not None else None

    def read(batches):
        for batch in pieces(batches, text, SLICE):
            raw = batch.column(place).to_pylist()
            found = all_spans([t or "" for t in raw], _tagger(shared))
            clean = [None if t is None else masked(t, every) for t, (_, every) in zip(raw, found, strict=True)]
            batch = batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))
            if isinstance(kind, T.IntegralType):
                sizes = [None if t is None else len(t) for t in clean]
                batch = batch.set_column(nth, batch.schema.field(nth), pa.array(sizes, batch.schema.field(nth).type))
            yield batch

    return in_small_batches(docs).mapInArrow(read, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
