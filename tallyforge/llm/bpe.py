"""Byte-pair encoding of a whole corpus with a public vocabulary.

The encoder finds, at each byte, the longest vocabulary entry with an Aho-Corasick
automaton and keeps it only if it may follow the token before it: two tokens are
compatible when merging their joined bytes gives exactly those two, which is read
off the tokens' own merge halves. Where no length fits, it steps back. No byte is
tried at more than once with the same length, so a text of any length takes linear
time, and the ids are exactly those of the merge procedure. Decoding reads byte
ranges of one buffer through an offset table.

Text is taken as it is, without normalisation and without special tokens: their
strings are ordinary text. Null and empty texts give an empty list. Rows are
encoded in Arrow batches on the executors; a bounded cache keeps common pieces.
"""

from __future__ import annotations

import base64
import importlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_50k.tiktoken"
#: How many distinct pieces of text a worker keeps the ids of.
CACHE = 200_000
#: Longer pieces are not kept.
CACHED_BYTES = 64


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The place of an installed public vocabulary; it is not copied."""
    return importlib.import_module("public_tokenizers").path(name)


def split_pattern() -> str:
    return importlib.import_module("public_tokenizers").PATTERN


class Encoder:
    """Encoder and decoder of a rank file: one `base64 rank` pair a line."""

    def __init__(self, path: str, pattern: str) -> None:
        import ahocorasick
        import regex

        self.pieces = regex.compile(pattern).findall
        ranks: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # The automaton works on text: one character stands for one byte.
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        # Decoding: all tokens in one buffer, token t from offsets[t] to offsets[t + 1].
        self.buffer = b"".join(self.tokens)
        self.offsets = array("q", [0])
        for token in self.tokens:
            self.offsets.append(self.offsets[-1] + len(token))
        self.halves = self._halves()
        self.compatible = lru_cache(1 << 18)(self._compatible)
        self.cache: dict[str, list[int]] = {}

    def _halves(self) -> list[tuple[int, int]]:
        """The two tokens that merge into each one; a byte, which none do, has
        itself. Tokens are taken by rank: a token's halves are the two that the
        merges of lower rank leave of its bytes."""
        halves = [(t, t) for t in range(len(self.tokens))]
        ranks = self.ranks
        for rank, token in enumerate(self.tokens):
            if len(token) < 2:
                continue
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                best, at = rank, -1
                for i in range(len(parts) - 1):
                    r = ranks.get(parts[i] + parts[i + 1], rank)
                    if r < best:
                        best, at = r, i
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2 and parts[0] in ranks and parts[1] in ranks:
                halves[rank] = (ranks[parts[0]], ranks[parts[1]])
        return halves

    def _compatible(self, left: int, right: int) -> bool:
        """Whether `left` then `right` is how their joined bytes are encoded: no
        merge across the border comes before one inside either of them. Both are
        taken apart from the outermost merge inwards, the later one first."""
        ranks, tokens, halves = self.ranks, self.tokens, self.halves
        bound = len(tokens)
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < bound:
                return False
            tail, head = halves[left][1], halves[right][0]
            if (left > right and tail != left) or head == right:
                if tail == left:
                    return True
                bound, left = left, tail
            else:  # of equal ranks the merge further left comes first
                bound, right = right + 1, head

    def encode_bytes(self, piece: bytes) -> list[int]:
        """The ids of bytes that no split divides."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        # Vocabulary entries that start at each byte, shortest first.
        starts: list[list[int]] = [[] for _ in range(n)]
        tokens = self.tokens
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            starts[end + 1 - len(tokens[rank])].append(rank)
        compatible = self.compatible
        # left[at]: how many of its entries are still untried; dead ends stay dead.
        left = [len(s) for s in starts]
        out: list[int] = []
        at = 0
        while at < n:
            options, k = starts[at], left[at]
            placed = False
            while k:
                k -= 1
                rank = options[k]
                to = at + len(tokens[rank])
                if (to == n or left[to]) and (not out or compatible(out[-1], rank)):
                    left[at] = k
                    out.append(rank)
                    at = to
                    placed = True
                    break
            if not placed:
                left[at] = 0
                if not out:
                    raise ValueError("bytes outside the vocabulary")
                at -= len(tokens[out.pop()])
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        cache = self.cache
        for piece in self.pieces(text):
            ids = cache.get(piece)
            if ids is None:
                ids = self.encode_bytes(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= CACHED_BYTES:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        buffer, offsets = self.buffer, self.offsets
        return b"".join(buffer[offsets[t] : offsets[t + 1]] for t in ids).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder a worker process, which Spark keeps between tasks."""
    return Encoder(path, pattern)


def encoded(df: DataFrame, text: str = "text", out: str = "ids", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(keep..., out): one row per row of df with the ids of its text."""
    import pyarrow as pa

    path, pattern = path or vocabulary_path(), pattern or split_pattern()
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        for b in batches:
            texts = b.column(b.num_columns - 1)
            values, offsets = array("i"), array("i", [0])
            for t in texts:
                values.extend(encode(t.as_py()))
                offsets.append(len(values))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], names=[*b.schema.names[:-1], out])

    return source.mapInArrow(run, schema)


def counted(df: DataFrame, text: str = "text", out: str = "tokens", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(keep..., out): the number of tokens of each text, without its ids."""
    import pyarrow as pa

    path, pattern = path or vocabulary_path(), pattern or split_pattern()
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        for b in batches:
            sizes = pa.array([len(encode(t.as_py())) for t in b.column(b.num_columns - 1)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], sizes], names=[*b.schema.names[:-1], out])

    return source.mapInArrow(run, schema)
