"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece has exactly one last token in its encoding. An automaton over the vocabulary gives all tokens that
end at a position; the one that is compatible with the last token of the prefix before it is the last token here. Ids are
read off along back-pointers, without merging anything.
"""

from __future__ import annotations

from array import array

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts, per_process
from .vocabulary import byte_alphabet, read_vocabulary

# Ids of pieces up to this length are remembered, up to so many per task process: the newer half, and what was the newer half
# before. The answers for so many pairs of tokens are remembered as well.
REMEMBERED_CHARS, REMEMBERED_PIECES, REMEMBERED_PAIRS = 48, 400_000, 250_000

NEVER = 1 << 60


def token_bytes(vocabulary: dict) -> dict[int, bytes]:
    """The bytes of every id; all that decoding needs."""
    value = {c: b for b, c in enumerate(byte_alphabet())}
    data = {i: bytes(value[c] for c in s) for s, i in vocabulary["ids"].items()}
    return data | {i: s.encode() for s, i in vocabulary["special"].items()}


def decode_packed(packed: bytes, data: dict[int, bytes]) -> str:
    return b"".join(map(data.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


class Encoder(dict):
    """Packed ids (unsigned 32 bits, little-endian) by piece; unknown pieces are encoded on first sight."""

    def __init__(self, vocabulary: dict):
        ids = vocabulary["ids"]
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.answers = 0
        self.data = token_bytes(vocabulary)
        self.special = vocabulary["special"]
        self.find = regex.compile(vocabulary["split"]).findall
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = marks
        self.cut = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")").split if marks else None

        # Rank of joining two tokens, by left and then right token; the parts and rank of each joined token.
        self.joins: dict[int, dict[int, int]] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(vocabulary["merges"]):
            left, right = ids[a], ids[b]
            self.joins.setdefault(left, {})[right] = rank
            parts.setdefault(ids[a + b], (left, right, rank))
        # Tokens at a token's right (left) edge while it is built, each with the rank at which it is joined further.
        self.right_edge = {t: self._edge(t, parts, 1) for t in ids.values()}
        self.left_edge = {t: self._edge(t, parts, 0) for t in ids.values()}

        self.automaton = ahocorasick.Automaton()
        whole: dict[int, bool] = {}
        for symbol, token in sorted(ids.items(), key=lambda x: len(x[0])):
            if token in parts:
                left, right, _ = parts[token]
                whole[token] = whole.get(left, False) and whole.get(right, False) and not self._joined_early(left, right)
            else:
                whole[token] = len(symbol) == 1
            if whole[token]:
                raw = self.data[token]
                self.automaton.add_word(raw.decode("latin-1"), (token, len(raw)))
        self.automaton.make_automaton()

    @staticmethod
    def _edge(token: int, parts: dict, side: int) -> list[tuple[int, int]]:
        chain, until = [(token, NEVER)], None
        while token in parts:
            until = parts[token][2]
            token = parts[token][side]
            chain.append((token, until))
        return chain

    def _joined_early(self, left: int, right: int) -> bool:
        """Whether smaller parts across the seam are joined before both tokens are complete."""
        for x, x_until in self.right_edge[left]:
            row = self.joins.get(x)
            if row:
                for y, y_until in self.left_edge[right]:
                    rank = row.get(y)
                    if rank is not None and rank < x_until and rank <= y_until and (x, y) != (left, right):
                        return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        """Whether encoding the joined bytes of two tokens gives just these two.

        Parts x | y at the seam are joined if their rank comes while both stand there: before x is joined to its left and
        not after y is joined to its right (of equal ranks the leftmost goes first).
        """
        edge = self.left_edge[right]
        for x, x_until in self.right_edge[left]:
            row = self.joins.get(x)
            if row:
                for y, y_until in edge:
                    rank = row.get(y)
                    if rank is not None and rank < x_until and rank <= y_until:
                        return False
        return True

    def _answer(self, left: int, token: int) -> bool:
        if self.answers >= REMEMBERED_PAIRS:
            self.pairs.clear()
            self.answers = 0
        self.answers += 1
        found = self.pairs.setdefault(left, {})[token] = self.compatible(left, token)
        return found

    def piece(self, raw: bytes) -> list[int]:
        none: dict[int, bool] = {}
        last: list[int] = [-1] * (len(raw) + 1)
        size: list[int] = [0] * (len(raw) + 1)
        for end, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            end += 1
            if last[end] < 0:
                if length < end:
                    left = last[end - length]
                    fits = self.pairs.get(left, none).get(token)
                    if not (self._answer(left, token) if fits is None else fits):
                        continue
                last[end], size[end] = token, length
        ids, at = [], len(raw)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            packed = array("I", self.piece(piece.encode())).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if 2 * len(self) >= REMEMBERED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if any(mark in text for mark in self.marks):
            return b"".join(
                np.array([self.special[part]], "<u4").tobytes() if i % 2 else b"".join(map(self.__getitem__, self.find(part)))
                for i, part in enumerate(self.cut(text))
            )
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, packed: bytes) -> str:
        return decode_packed(packed, self.data)


def _work(docs: DataFrame, tokenizer_path: str, name: str, build):
    """What `build` makes of the vocabulary, once per process; encoding and decoding run in processes of their own."""
    vocabulary = read_vocabulary(tokenizer_path)
    shared, digest = docs.sparkSession.sparkContext.broadcast(vocabulary), vocabulary["digest"]
    return lambda: per_process((name, digest), lambda: build(shared.value))


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) with `ids`, packed as unsigned 32-bit little-endian integers, and `n_tokens`.

    Texts are encoded whole, special strings in them as their special ids. A null or empty text has no ids; repeated rows
    each give a row; input columns named `ids` or `n_tokens` are replaced. The vocabulary is broadcast (the file bounds it).
    """
    encoder = _work(docs, tokenizer_path, "bpe", Encoder)

    def make():
        own = encoder()

        def work(texts):
            packed = [own.encode(t) for t in texts]
            return [packed, [len(p) // 4 for p in packed]]

        return work

    return map_texts(docs, text, docs.columns if keep is None else keep, [("ids", T.BinaryType()), ("n_tokens", T.LongType())], make)


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) with `decoded`, the text of the packed ids, special tokens included.

    Null or empty ids give an empty text; bytes that are no UTF-8 become the replacement character; a clashing input
    column `decoded` is replaced.
    """
    pieces = _work(encoded, tokenizer_path, "bpe-pieces", token_bytes)

    def make():
        data = pieces()
        return lambda packed: [[decode_packed(p, data) for p in packed]]

    columns = encoded.columns if keep is None else keep
    return map_texts(encoded, ids, columns, [("decoded", T.StringType())], make, empty=b"")
