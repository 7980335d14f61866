"""Token counts by byte-pair merging with a heap over a linked list; no identifiers are made."""

from __future__ import annotations

import heapq
import unicodedata

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, per_process
from .vocabulary import byte_alphabet, read_vocabulary

# Counts of words up to this length are remembered, up to so many per task process.
REMEMBERED_CHARS, REMEMBERED_WORDS = 48, 400_000


def merge_count(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges byte-pair encoding makes: the lowest-ranked adjacent pair, leftmost first, until none is left.

    `pairs` gives (rank, merged symbol). Neighbours are a doubly linked list over positions; a heap entry is stale when
    the symbols at its position have changed since.
    """
    n = len(symbols)
    if n < 2:
        return 0
    symbol = list(symbols)
    after = [*range(1, n), -1]
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = pairs.get((symbol[i], symbol[i + 1]))
        if found:
            heap.append((found[0], i, found[1]))
    heapq.heapify(heap)
    done = 0
    while heap:
        rank, i, merged = heapq.heappop(heap)
        j = after[i]
        if symbol[i] < 0 or j < 0:
            continue
        found = pairs.get((symbol[i], symbol[j]))
        if found is None or found[0] != rank:
            continue
        done += 1
        symbol[i], symbol[j] = merged, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            found = pairs.get((merged, symbol[k]))
            if found:
                heapq.heappush(heap, (found[0], i, found[1]))
        h = before[i]
        if h >= 0:
            found = pairs.get((symbol[h], merged))
            if found:
                heapq.heappush(heap, (found[0], h, found[1]))
    return done


class WordCounts(dict):
    """Tokens by word; a word that is not there yet is merged."""

    def __init__(self, vocabulary: dict):
        alphabet, end, ids = byte_alphabet(), vocabulary["word_end"], vocabulary["ids"]
        self.inner = [ids[c] for c in alphabet]
        self.last = [ids[c + end] for c in alphabet]
        self.pairs = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(vocabulary["merges"])}

    def __missing__(self, word: str) -> int:
        data = word.encode()
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        count = len(symbols) - merge_count(symbols, self.pairs)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = count
        return count


# Capital letters that are newer than Python's tables, with their small ones.
NEWER_CAPITALS = {0xA7CB: 0x0264, 0xA7DC: 0x019B}


def normalised(text: str) -> str:
    """Composed form in lower case, each character by itself (so a final sigma is not special)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(NEWER_CAPITALS).lower()


class TextCounter:
    def __init__(self, vocabulary: dict):
        self.words = WordCounts(vocabulary)
        self.find = regex.compile(vocabulary["split"]).findall
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.marks = special

    def count(self, text: str) -> int:
        parts = [text]
        if any(mark in text for mark in self.marks):
            parts = self.special.split(text)
        tokens = len(parts) - 1
        for part in parts:
            tokens += sum(map(self.words.__getitem__, self.find(normalised(part))))
        return tokens


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", limit: int = 2048) -> DataFrame:
    """Per document `key`, n_bytes, n_tokens and over_limit (n_tokens > limit).

    Texts are used whole. A null or empty text has 0 bytes and 0 tokens; a null key stays null; repeated rows each give
    a row; other columns are not read. The vocabulary file is read on the driver and broadcast (its size bounds it).
    """
    vocabulary = read_vocabulary(tokenizer_path)
    shared, digest = docs.sparkSession.sparkContext.broadcast(vocabulary), vocabulary["digest"]

    def make():
        counter = per_process(("token_counts", digest), lambda: TextCounter(shared.value))
        return lambda texts: [[len(t.encode()) for t in texts], [counter.count(t) for t in texts]]

    counted = map_texts(docs, text, [key], [("n_bytes", T.LongType()), ("n_tokens", T.LongType())], make)
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
