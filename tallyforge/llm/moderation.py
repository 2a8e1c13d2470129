"""Scores for abusive, hateful or sexually explicit language.

A logistic regression over hashed word n-grams and skip-grams, trained by
FTRL-proximal: each coordinate has its own rate, and L1 leaves few weights, which
are broadcast as two small arrays. The unit is a segment (a sentence or line); a
document scores as its worst segment. Labels are of documents, so training
alternates: it fits segments, then takes of each positive document only the
segments that look worst, and fits again.

Nothing but the labels says what is abusive: there is no list of words. Disguises
are undone towards words the labelled documents contain: zero-width characters,
look-alike letters of other scripts, digits and signs for letters, letters set
apart by dots or spaces, stretched letters, words run together, and letters hidden
behind `*` or `#`, which are resolved to the word of that shape that is most
telling of the positive documents.

Readers err: a document counts as positive by the share of its labels that are 1,
null labels do not count, and evenly split documents are left out. Null, empty and
space-only texts score 0. At most `SAMPLE` labelled documents are used to fit, taken
by a hash of the id; all documents are scored, whole. Without labels of both kinds
nothing is known and every document scores 0.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents a model is fitted on at most: the bound of what is collected.
SAMPLE = 20_000
BITS = 20
MASK = (1 << BITS) - 1

#: Letters of other scripts that look like Latin ones, and signs for letters.
_LIKE, _LATIN = "аеорсухіѕԁкмтнвјҺοαειρτυκν", "aeopcyxisdkmthbjhoaeiptukv"
_LOOKALIKES = str.maketrans({**dict(zip(_LIKE.upper(), _LATIN.upper())), **dict(zip(_LIKE, _LATIN))})
_LEET = str.maketrans("013457@$!|8", "oieastasilb")
_HIDDEN = re.compile("[​-‏‪-‮⁠-⁤﻿­]")
_STRETCHED = re.compile(r"(.)\1{2,}")
#: Letters set apart: by spaces, and by other signs.
_SPACED = re.compile(r" [^\W\d_](?: [^\W\d_]){2,}(?=[ ,.!?;:])")
_APART = re.compile(r"(?<![^\W_])(?:[^\W\d_][.\-_*]){2,}[^\W\d_](?![^\W_])")
#: The words and numbers of a text without white space, and its exclamation and question marks.
_PART = re.compile(r"[@$]?[^\W\d_](?:[\w@$!|*#'’]*[\w*#])?|\d+(?:[.,:/-]\d+)*(?![^\W\d_])|\d[\w@$!|*#'’]*[\w*#]|[!?](?!$)")

WORD, SEGMENT, DOCUMENT = 0, 1, 2
NUMBER, NAME = "0", "Name"


_ODD = re.compile(f"[{_LIKE}{_LIKE.upper()}]")


def clean(text: str | None) -> str:
    """A text without hidden characters and look-alikes, its line ends standing apart."""
    if not text:
        return ""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
        if _ODD.search(text):
            text = text.translate(_LOOKALIKES)
    return text


@dataclass
class Vocabulary:
    """What the labelled documents' words are used for: `telling` words with how much
    more often they occur in positive documents, those seen in `lower` case, and both."""

    telling: dict[str, float] = field(default_factory=dict)
    known: frozenset[str] = frozenset()
    lower: frozenset[str] = frozenset()
    by_length: dict[int, list[str]] = field(default_factory=dict)

    @classmethod
    def of(cls, inside: dict[str, int], outside: dict[str, int], lower: Iterable[str], rate: float) -> Vocabulary:
        """inside, outside: positive and other documents a word is in; rate: positive
        documents for each other one."""
        share = {w: n / (n + outside.get(w, 0) * rate) for w, n in inside.items() if w.isalpha() and len(w) > 2}
        telling = {w: v * inside[w] for w, v in share.items() if v >= TELLING and inside[w] >= 2}
        ranked: dict[int, list[str]] = defaultdict(list)
        for w in sorted(share, key=lambda w: (-telling.get(w, 0.0), -share[w], w)):
            ranked[len(w)].append(w)
        seen = frozenset(lower)
        return cls(telling, seen | frozenset(telling), seen, dict(ranked))

    def unmask(self, token: str) -> str:
        pattern = re.compile("".join("[a-z]" if c in "*#" else re.escape(c) for c in token))
        return next((w for w in self.by_length.get(len(token), ()) if pattern.fullmatch(w)), token)

    def run_together(self, word: str) -> list[str] | None:
        """Known words, one of them telling, that a word consists of without their
        spaces, as in `afilthymoron`; the fewest, with the longest telling ones."""
        best: dict[int, tuple[int, int, list[str]]] = {0: (0, 0, [])}
        for to in range(1, len(word) + 1):
            for since in range(max(0, to - 14), to):
                part = word[since:to]
                if since not in best or part not in self.known or len(part) == 1 and part not in "ai":
                    continue
                n, told, parts = best[since]
                now = (n - 1, told + len(part) ** 2 * (part in self.telling and len(part) > 3), [*parts, part])
                if to not in best or (now[1], now[0]) > (best[to][1], best[to][0]):
                    best[to] = now
        found = best.get(len(word))
        return found[2] if found and found[1] and len(found[2]) > 1 else None


#: Share of a word's documents, positive and others weighed alike, that must be
#: positive for it to be telling.
TELLING = 0.75


def undisguised(token: str, words: Vocabulary) -> list[str]:
    """The words of a token in lower case."""
    if not any(map(str.isalpha, token)):
        return [NUMBER] if token not in "!?" else [token]
    low = token.lower().replace("’", "'")
    if low in words.known or low.isalpha() and low.isascii() and len(low) < 7 and not _STRETCHED.search(low):
        return [low]
    plain = "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c)) if not low.isascii() else low
    if not plain.isalpha():
        bare = plain.rstrip("!")
        for undone in (bare.translate(_LEET), bare.replace("1", "l").translate(_LEET)):
            if undone in words.known:
                return [undone]
        if "*" in plain or "#" in plain:
            plain = words.unmask(bare.translate(_LEET))
        elif any(c in "@$!|" for c in bare[1:]):
            plain = words.unmask(re.sub(r"[@$!|]", "*", bare))
    if _STRETCHED.search(plain):
        double, single = _STRETCHED.sub(r"\1\1", plain), _STRETCHED.sub(r"\1", plain)
        plain = double if double in words.known else single
    if len(plain) > 6 and plain not in words.known and plain.isalpha():
        return words.run_together(plain) or [plain]
    return [plain]


#: Different tokens whose plain words a worker keeps.
CACHE = 300_000


class Reader:
    """Texts as arrays of word hashes with their segments. Each different token, as
    it stands between white space, is taken apart, undisguised and hashed once; all
    else is array work over many documents. An item is a word or an end: of a
    segment (`.`, `!`, `?`, `;` before white space, a line end, two spaces) or of a
    document."""

    def __init__(self, words: Vocabulary) -> None:
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.many: list[int] = []  # items of each token
        self.items: list[tuple[int, bool, int, int]] = []  # kind, capitalised, name wherever it stands (2: but at a start), hash
        self.plain: list[str] = []  # the word of each item
        self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 4), np.int64)

    def _item(self, kind: int, word: str = "", capital: bool = False) -> None:
        never = (2 if word in self.words.telling else 1) if capital and self.words.known and word not in self.words.lower else 0
        self.items.append((kind, capital, never, zlib.crc32(word.encode("utf-8", "replace"))))
        self.plain.append(word)

    def _learn(self, token: str) -> None:
        self.codes[token] = len(self.many)
        before = len(self.items)
        if token == "\x00":
            self._item(DOCUMENT)
        elif token == "" or token == "\n":
            self._item(SEGMENT)
        else:
            for part in _PART.findall(_APART.sub(self._apart, token)):
                found = undisguised(part, self.words)
                titled = part[0].isupper() and (part[1:].islower() or len(part) == 1) and part != "I"
                for w in found:
                    self._item(WORD, w, titled and not (w in self.words.telling and w in self.words.lower))
            if token[-1] in ".!?;":
                self._item(SEGMENT)
        self.many.append(len(self.items) - before)

    def _apart(self, match: re.Match) -> str:
        text = match.group(0)
        letters = re.sub(r"[ .\-_*]", "", text).lower()
        if letters in self.words.known or "*" not in text and " " not in text:
            return letters
        # `a m o r o n`: an article before the word set apart. Stars may hide letters, not set them apart.
        return f"{letters[0]} {letters[1:]}" if letters[1:] in self.words.known else text

    def items_of(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item of each word, its segment, document of each segment)."""
        if len(self.codes) > CACHE:
            self.clear()
        text = " \x00 ".join([clean(t).replace("\x00", "") for t in texts]).replace("\n", " \n ").replace("\r", " \n ").replace("\t", " ")
        raw = _SPACED.sub(lambda m: " " + self._apart(m).strip(), f" {text} ").split(" ")[1:-1]
        new = set(raw) - self.codes.keys()
        if new:
            for t in sorted(new):
                self._learn(t)
            many = np.array(self.many, dtype=np.int64)
            self.flat = many, np.cumsum(many) - many, np.array(self.items, dtype=np.int64).reshape(-1, 4)
        many, since, items = self.flat
        codes = np.fromiter(map(self.codes.__getitem__, raw), np.int64, len(raw))
        n = many[codes]
        at = np.repeat(since[codes] - np.cumsum(n) + n, n) + np.arange(n.sum())
        kind = items[at, 0]
        document = np.concatenate([[0], np.cumsum(kind[kind != WORD] == DOCUMENT)])
        segment = np.cumsum(kind != WORD)
        words = kind == WORD
        return at[words], segment[words], document

    def read(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, its segment, document of each segment with words). Capitalised
        words that do not merely begin a segment, and those never seen in lower case
        in a labelled document, are all NAME; telling ones only if they are never seen in
        lower case and begin no segment."""
        at, segment, document = self.items_of(texts)
        items = self.flat[2][at]
        capital = items[:, 1] == 1
        same = segment[1:] == segment[:-1]
        behind, before = np.append(False, same)[: len(at)], np.append(same & capital[1:], False)[: len(at)]
        after = np.append(False, capital[:-1] & same)[: len(at)]
        # A capitalised word between others in lower case, seen in lower case too, starts a sentence.
        never = items[:, 2]
        fresh = behind & capital & (never == 0) & ~before & ~after
        name = (never == 1) | (never == 2) & behind | (capital & (behind | before) & ~fresh & (never != 2))
        start = np.append(True, ~same)[: len(at)] | fresh
        return np.where(name, _NAME, items[:, 3]), np.cumsum(start) - 1, document[segment[start]]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])[: len(x)]]


_NAME = zlib.crc32(NAME.encode())
#: Odd multipliers and offsets that tell the kinds of features apart.
_MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
#: Kinds of features: which following words are taken together. Words, bigrams,
#: trigrams, and bigrams that skip one and two words.
GRAMS = ((0,), (0, 1), (0, 1, 2), (0, 2), (0, 3))


def slots(h: np.ndarray, segment: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the first word, slot) of all features of a kind, kind by kind."""
    for kind, gram in enumerate(GRAMS):
        n = len(h) - gram[-1]
        if n <= 0:
            continue
        x = np.full(n, 0x1000193 * kind, dtype=np.int64)
        for i, m in zip(gram, _MIX):
            x += h[i : i + n] * m
        x = (x ^ (x >> 17) ^ (x >> 31)) & MASK
        inside = segment[:n] == segment[gram[-1] :]
        yield np.flatnonzero(inside), x[inside]


@dataclass
class Model:
    """Sparse weights, the bias, and the words that disguises are undone to."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    words: Vocabulary


#: Words of the stretches a longer segment is scored by as well as whole: text that
#: runs on without the signs a segment ends with does not hide what is in it.
WINDOW = 12
#: Characters of texts that are taken together, about.
CHUNK = 2_000_000


class Scorer:
    """A model ready for use in a worker."""

    def __init__(self, model: Model) -> None:
        self.bias, self.reader = model.bias, Reader(model.words)
        self.dense = np.zeros(MASK + 1, dtype=np.float32)
        self.dense[model.index] = model.weight

    def _some(self, texts: Sequence[str | None]) -> np.ndarray:
        h, segment, document = self.reader.read(texts)
        sums = np.zeros(len(h) + 1)
        for place, slot in slots(h, segment):
            sums[1:] += np.bincount(place, self.dense[slot], len(h))
        np.cumsum(sums, out=sums)
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])[: len(h)])
        until = np.append(first[1:], len(h))
        inner = np.flatnonzero(np.arange(len(h)) + WINDOW < until[segment])
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, document, sums[until] - sums[first] + self.bias)
        np.maximum.at(out, document[segment[inner]], sums[inner + WINDOW] - sums[inner] + self.bias)
        return out

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Log-odds of the worst segment of each text; -inf without words."""
        out, since, size = [np.zeros(0)], 0, 0
        for i, t in enumerate(texts):
            size += len(t or "") + 1
            if size > CHUNK or i == len(texts) - 1:
                out.append(self._some(texts[since : i + 1]))
                since, size = i + 1, 0
        return np.concatenate(out)


#: Labelled documents that a feature must occur in to count.
LEAST_DOCUMENTS = 2
#: A positive segment weighs as the square root of clean ones to each, by this.
BALANCE = 6.0
#: Log-odds of a document's worst segment from which a clean label, and below
#: which (turn by turn) a positive one, is taken for a reader's error; and from which
#: segments of a positive document other than the worst are positive too.
DOUBT, ERROR, ALSO = 3.0, (-math.inf, -2.5, -1.0), 3.0
#: Segments whose gradients are added up before the weights change.
BATCH = 256


class Ftrl:
    """FTRL-proximal for logistic loss, with a rate of its own for each weight."""

    def __init__(self, size: int, alpha: float = 0.15, beta: float = 1.0, l1: float = 1.0, l2: float = 1.0) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, row: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """One step for a batch of examples: features `at`, each of example `row`."""
        used, place = np.unique(at, return_inverse=True)
        w = self.weights(used)
        p = 1.0 / (1.0 + np.exp(-np.clip(np.bincount(row, w[place], len(label)), -35.0, 35.0)))
        g = np.bincount(place, ((p - label) * weight)[row], len(used))
        n = self.n[used]
        grown = n + g * g
        self.z[used] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[used] = grown


class Examples:
    """Segments as rows of features; the last feature is the bias of each."""

    def __init__(self, segment: np.ndarray, feature: np.ndarray, count: int, size: int) -> None:
        order = np.argsort(segment, kind="stable")
        self.feature, self.size, self.count = feature[order], size, count
        self.until = np.cumsum(np.bincount(segment, minlength=count))

    def rows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, place in `chosen`) of the chosen segments in their order."""
        n = np.diff(self.until, prepend=0)[chosen]
        since = self.until[chosen] - n
        at = np.repeat(since - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.feature[at], np.repeat(np.arange(len(chosen)), n)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        n = np.diff(self.until, prepend=0)
        return np.bincount(np.repeat(np.arange(self.count), n), weights[self.feature], self.count)

    def train(self, chosen: np.ndarray, label: np.ndarray, weight: np.ndarray, epochs: int, rng: np.random.Generator, **params: float) -> np.ndarray:
        model = Ftrl(self.size, **params)
        for _ in range(epochs):
            turn = rng.permutation(len(chosen))
            feature, row = self.rows(chosen[turn])
            cuts = np.searchsorted(row, np.arange(0, len(chosen) + BATCH, BATCH))
            y, v = label[turn], weight[turn]
            for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
                at = slice(b * BATCH, (b + 1) * BATCH)
                model.update(feature[i:j], row[i:j] - b * BATCH, y[at], v[at])
        return model.weights(slice(None))


def vocabulary(texts: Sequence[str], labels: np.ndarray) -> Vocabulary:
    """The words of labelled documents, plainly read."""
    reader = Reader(Vocabulary())
    at, segment, document = reader.items_of(texts)
    size = len(reader.items)
    pairs = _distinct(document[segment] * size + at)
    inside: dict[str, int] = defaultdict(int)
    outside: dict[str, int] = defaultdict(int)
    lower: dict[str, int] = defaultdict(int)
    counts = [np.bincount((pairs % size)[labels[pairs // size] == y], minlength=size) for y in (1, 0)]
    for item, word, ones, zeros in zip(reader.items, reader.plain, *counts):
        inside[word] += int(ones)
        outside[word] += int(zeros)
        if not item[1] and word.isalpha():
            lower[word] += int(ones + zeros)
    positives = int(labels.sum())
    return Vocabulary.of(inside, outside, [w for w, n in lower.items() if n >= 2], max(positives, 1) / max(len(labels) - positives, 1))


def fit(labelled: Iterable[tuple[str | None, float]], epochs: int = 3, seed: int = 7, **params: float) -> Model | None:
    """A model from (text, share of labels that are 1) of documents; None without
    labels of both kinds."""
    docs = [(t, int(share > 0.5)) for t, share in labelled if share != 0.5 and t and not t.isspace()]
    texts, y = [t for t, _ in docs], np.array([v for _, v in docs], dtype=np.int64)
    if not len(y) or y.min() == y.max():
        return None
    words = vocabulary(texts, y)
    h, segment, document = Reader(words).read(texts)
    if not len(h):
        return None
    at, slot = (np.concatenate(x) for x in zip(*((segment[place], slot) for place, slot in slots(h, segment))))
    # Features that enough documents have, as numbers without gaps; the bias is the last.
    seen = np.bincount(_distinct(document[at] << BITS | slot) & MASK, minlength=MASK + 1)
    usual = np.flatnonzero(seen >= LEAST_DOCUMENTS)
    number = np.full(MASK + 1, -1)
    number[usual] = np.arange(len(usual))
    kept = number[slot] >= 0
    every = np.arange(len(document))
    x = Examples(np.concatenate([at[kept], every]), np.concatenate([number[slot[kept]], np.full(len(every), len(usual))]), len(every), len(usual) + 1)
    rng = np.random.default_rng(seed)

    def train(chosen: np.ndarray) -> np.ndarray:
        """Weights fitted on segments that are all of their document's label."""
        label = y[document[chosen]]
        ones = int(label.sum())
        balance = max(1.0, math.sqrt((len(label) - ones) / ones) / BALANCE) if ones else 1.0
        return x.train(chosen, label.astype(float), np.where(label == 1, balance, 1.0), epochs, rng, **params)

    first = np.flatnonzero(np.diff(document, prepend=-1))
    worst = lambda scores: np.repeat(np.maximum.reduceat(scores, first), np.diff(np.append(first, len(document))))
    positive, half = y[document] == 1, document % 2
    weights = np.zeros(x.size)
    folds = [weights, weights]
    keep = np.ones(len(document), dtype=bool)
    for turn, error in enumerate(ERROR):
        if turn:
            # Clean labels are judged by the weights fitted without the document; which segments of a positive one count, with it.
            own, held_out = x.scores(weights), np.where(half == 0, x.scores(folds[0]), x.scores(folds[1]))
            top = worst(own)
            keep = np.where(positive, (top >= error) & ((own == top) | (own > ALSO)), worst(held_out) <= DOUBT)
        weights = train(every[keep])
        if turn < len(ERROR) - 1:
            folds = [train(every[keep & (half == 1)]), train(every[keep & (half == 0)])]
    held = np.flatnonzero(weights[:-1])
    return Model(usual[held], weights[held].astype(np.float32), float(weights[-1]), words)


def labelled_sample(documents: DataFrame, labels: DataFrame, row: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(text, share): the labelled documents a model is fitted on."""
    votes = labels.filter("label IN (0, 1)").groupBy(F.col(row).alias("__row")).agg(F.avg(F.col("label").cast("double")).alias("share"))
    chosen = votes.orderBy(F.xxhash64("__row"), "__row").limit(sample)
    return documents.select(F.col(row).alias("__row"), F.col(text).alias("text")).join(F.broadcast(chosen), "__row").orderBy("__row").select("text", "share")


def scored(documents: DataFrame, model: Model | None, row: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, keep..., score): a score from 0 to 1 for every document."""
    import pyarrow as pa
    from pyspark.sql import types as T

    source = documents.select(row, *keep, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("score", T.DoubleType(), False)])
    if model is None:
        return source.select(row, *keep, F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # sparse weights and the words of at most SAMPLE documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            odds = scorer.scores(b.column(b.num_columns - 1).to_pylist())
            score = np.where(np.isneginf(odds), 0.0, 1.0 / (1.0 + np.exp(-np.clip(odds, -35.0, 35.0))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64())], names=[*b.schema.names[:-1], "score"])

    return source.mapInArrow(run, schema)


#: Documents of at least this score have such language.
THRESHOLD = 0.5
#: The model fitted last, with the fingerprint of what it was fitted on: queries over
#: the same labels share it.
_last: dict[str, Model | None] = {}


def fitted(sample: Sequence[tuple[str | None, float]]) -> Model | None:
    """fit, once for the same documents and labels in a row."""
    digest = hashlib.sha256()
    for text, share in sample:
        digest.update(f"{share}|{len(text or '')}|".encode() + (text or "").encode("utf-8", "replace"))
    key = digest.hexdigest()
    if key not in _last:
        model = fit(sample)
        _last.clear()
        _last[key] = model
    return _last[key]


def moderated(documents: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fit on the labels and score every document."""
    sample = [(r["text"], r["share"]) for r in labelled_sample(documents, labels).toLocalIterator()]  # at most SAMPLE documents
    return scored(documents, fitted(sample), keep=keep)
