"""Suffix order with common-prefix values by induced sorting over queues that spill to disk.

Suffixes whose first character is followed by a smaller suffix are of type L, others of type S. The leftmost S suffixes are
the sample. Pieces between sample positions are named in sorted order, the string of names is sorted by the same procedure
one level down, and that gives the order of the sample. All L suffixes are then induced in ascending order, and all S
suffixes in descending order: whatever leaves the queue sends the suffix one place to the left into the queue of its first
character. A queue is a priority queue over (character, rank) whose entries arrive in order of rank, so that it is a file to
which is appended and which is read from the front. Entries carry their common prefix with the entry before them; when an
entry moves on, it takes the least value of those passed since the last entry for the same character, and one more.

Order and common prefixes are exact up to `depth` characters. Names cover at least two characters of the level above, so the
depth halves from level to level and the recursion ends after log2(depth) levels.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

# Entries of a queue kept in memory; what exceeds it is on disk. Entries read at a time. Items of a block of names.
MEMORY_ENTRIES, READ_ENTRIES, BLOCK_ITEMS = 8 << 20, 1 << 20, 1 << 16
SMALL = 512


class Queues:
    """A queue per character: arrays are appended at the end and read from the front, on disk beyond the memory limit."""

    def __init__(self, dtype: np.dtype):
        self.dtype, self.held, self.files, self.count = np.dtype(dtype), {}, {}, 0

    def push(self, name: int, entries: np.ndarray) -> None:
        self.held.setdefault(name, []).append(entries)
        self.count += len(entries)
        if self.count > MEMORY_ENTRIES:
            for key, parts in self.held.items():
                if key not in self.files:
                    self.files[key] = tempfile.TemporaryFile()
                self.files[key].seek(0, os.SEEK_END)
                for part in parts:
                    self.files[key].write(part.tobytes())
            self.held, self.count = {}, 0

    def pop(self, name: int):
        """Yields arrays from the front until nothing is left; what is pushed meanwhile comes last."""
        file = self.files.get(name)
        at = 0
        while file is not None or name in self.held:
            if file is not None:
                file.seek(at)
                raw = file.read(READ_ENTRIES * self.dtype.itemsize)
                at += len(raw)
                if raw:
                    yield np.frombuffer(raw, self.dtype)
                    continue
                file.close()
                del self.files[name]
            parts = self.held.pop(name, [])
            self.count -= sum(map(len, parts))
            if parts:
                yield np.concatenate(parts)
            file, at = self.files.get(name), 0


def types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last character is smaller than all others and S."""
    change = np.flatnonzero(text[:-1] != text[1:])
    small = text[change] < text[change + 1]
    return np.append(np.repeat(small, np.diff(change, prepend=-1)), True)


def sample_positions(s_type: np.ndarray) -> np.ndarray:
    return np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1


def names(text: np.ndarray, s_type: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, int]:
    """Places of the pieces between sample positions among the sorted distinct pieces, from 1, and their number.

    A piece reaches up to and with the next sample position; at equal characters L comes before S.
    """
    symbols = text.astype(np.uint64) * np.uint64(2) + s_type
    bits = int(symbols.max()).bit_length()
    per_word = 63 // bits
    end = np.append(sample[1:], sample[-1])

    def word(rows: np.ndarray, first: int) -> np.ndarray:
        key = np.zeros(len(rows), np.uint64)
        start, last = sample[rows], end[rows]
        for j in range(first, first + per_word):
            at = start + j
            key = (key << np.uint64(bits)) | np.where(at <= last, symbols[np.minimum(at, last)], np.uint64(0))
        return key

    # The symbols of longer pieces beyond the first word, from the last word to the second, as one rank.
    length = end - sample
    tail = np.zeros(len(sample), np.int64)
    for first in range(int(length.max()) // per_word * per_word, 0, -per_word):
        rows = np.flatnonzero(length >= first)
        tail[rows] = _dense(word(rows, first), tail[rows]) + 1
    place = _dense(word(np.arange(len(sample)), 0), tail)
    return (place + 1).astype(_positions(len(text))), int(place.max()) + 1


def _positions(n: int) -> type:
    """The smaller integer type that holds positions of a text of `n` characters."""
    return np.int32 if n < 1 << 31 else np.int64


def _dense(key: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Places of (key, minor) among the distinct ones in order."""
    order = np.lexsort((minor, key)) if minor.any() else np.argsort(key)
    key, minor = key[order], minor[order]
    fresh = np.append(False, (key[1:] != key[:-1]) | (minor[1:] != minor[:-1]))
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(fresh)
    return place


def order_of_names(text: np.ndarray, count: int, depth: int) -> np.ndarray:
    """Positions in order of their suffixes, exact up to `depth` names; the last name is the smallest and unique."""
    n = len(text)
    if depth <= 1 or count == n:
        return np.argsort(text, kind="stable")
    if n <= SMALL:
        rank, known = text.astype(np.int64), 1
        while known < depth:
            pair = rank * (int(rank.max()) + 2) + np.append(rank[known:] + 1, np.zeros(min(known, n), np.int64))[:n]
            rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            known *= 2
        return np.argsort(rank, kind="stable")
    s_type = types(text)
    sample = sample_positions(s_type).astype(_positions(n))
    place, below = names(text, s_type, sample)
    seeds = sample[order_of_names(place, below, (depth + 1) // 2)]
    large = induce_names(text, ~s_type, seeds)
    small = induce_names(text.max() - text, s_type, large[::-1])[::-1]
    # By name, and within a name L suffixes before S suffixes; the last position is the smallest.
    first = np.cumsum(np.bincount(text)) - np.bincount(text)
    order = np.empty(n, _positions(n))
    own = text[large]
    order[first[own] + _within(own)] = large
    end = np.cumsum(np.bincount(text))
    own = text[small]
    order[end[own] - 1 - _within(own[::-1])[::-1]] = small
    order[0] = n - 1
    return order


def _within(groups: np.ndarray) -> np.ndarray:
    """Places of the elements of runs of equal values."""
    first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else np.empty(0, np.int64)
    return np.arange(len(groups)) - np.repeat(first, np.diff(np.append(first, len(groups))))


def induce_names(text: np.ndarray, wanted: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The `wanted` suffixes in order, induced from `seeds` in order, over an alphabet of any size.

    Neighbouring names share a queue. When it is opened, its entries have arrived in order of rank and are put in order of
    name. Entries that come in meanwhile for the same block follow those of their name that were there, in the order of
    the ones that sent them; seeds follow last.
    """
    counts = np.bincount(text[wanted], minlength=int(text.max()) + 1) + np.bincount(text[seeds], minlength=int(text.max()) + 1)
    block_of_name = (np.cumsum(counts) - counts) // BLOCK_ITEMS
    low = np.searchsorted(block_of_name, np.arange(int(block_of_name[-1]) + 1))
    block = block_of_name[text].astype(np.int32)
    ends = np.searchsorted(block[seeds], np.arange(len(low)), side="right")
    kind = _positions(len(text))
    queues = Queues(kind)
    where, state = np.empty(len(text), np.int32), np.empty(len(text), np.int8)
    none = np.empty(0, kind)
    done, begin = [], 0

    def sent(entries: np.ndarray) -> np.ndarray:
        left = entries[entries > 0] - 1
        return left[wanted[left]]

    def by_name(entries: np.ndarray, base: int, top: int) -> np.ndarray:
        name = text[entries] - base
        return np.argsort(name.astype(np.uint16) if top - base < 1 << 16 else name, kind="stable")

    for b, stop in enumerate(ends.tolist()):
        own = seeds[begin:stop]
        begin = stop
        arrived = np.concatenate([none, *queues.pop(b)])
        base, top = int(low[b]), int(low[b + 1]) if b + 1 < len(low) else len(block_of_name)
        entries = np.concatenate([arrived, own])
        if not len(entries):
            continue
        now = sent(entries)
        now = now[block[now] == b]
        inside = []
        while len(now):
            inside.append(now)
            now = sent(now)
            now = now[block[now] == b]
        induced = len(arrived)
        if inside:
            late = np.concatenate(inside)
            late = late[_behind(text, where, state, arrived, late, own, base, len(inside))]
            entries = np.concatenate([arrived, late, own])
            induced += len(late)
        order = by_name(entries, base, top)
        done.append(entries[order[order < induced]])
        left = sent(entries[order])
        to = block[left]
        left, to = left[to > b], to[to > b]
        if len(left):
            by = np.argsort(to.astype(np.uint16) if len(low) < 1 << 16 else to, kind="stable")
            left, to = left[by], to[by]
            cut = np.flatnonzero(np.diff(to)) + 1
            for part, name in zip(np.split(left, cut), to[np.append(0, cut)].tolist()):
                queues.push(name, part)
    return np.concatenate([none, *done])


def _behind(text, where, state, arrived, late, own, base: int, depth: int) -> np.ndarray:
    """The order of entries that came in late, by the place of the ones that sent them.

    A place is (name; arrived, late or seed; number). Numbers of the late ones follow from their own senders, so they are
    right after as many rounds as the longest chain of them has links.
    """
    for number, entries in enumerate((arrived, late, own)):
        where[entries] = np.arange(len(entries), dtype=np.int32)
        state[entries] = number
    sender = late + 1
    fixed = (text[sender].astype(np.int64) - base) << 34 | state[sender].astype(np.int64) << 32
    of = where[sender].astype(np.int64)
    chained = np.flatnonzero(state[sender] == 1)
    number = of.copy()
    number[chained] = 0
    for _ in range(depth):
        order = np.argsort(fixed | number, kind="stable")
        if not len(chained):
            break
        place = np.empty(len(late), np.int64)
        place[order] = np.arange(len(late))
        number[chained] = place[of[chained]]
    return order


def packed(text: np.ndarray) -> np.ndarray:
    """Four characters from each position on, the first in the lowest bits."""
    padded = np.append(text, np.zeros(4, text.dtype)).astype(np.uint64)
    return padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)


def common_prefix(words: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of pairs of suffixes of a packed text, at most `depth`, compared four characters at a time."""
    result = np.full(len(left), depth, np.int64)
    rows, last = np.arange(len(left)), len(words) - 1
    for at in range(0, depth, 4):
        differ = words[np.minimum(left[rows] + at, last)] ^ words[np.minimum(right[rows] + at, last)]
        unequal = differ != 0
        found = differ[unequal]
        equal_bits = np.bitwise_count((found & (~found + np.uint64(1))) - np.uint64(1))
        result[rows[unequal]] = at + equal_bits // 16
        rows = rows[~unequal]
        if not len(rows):
            break
    return np.minimum(result, depth).astype(np.uint8)


def _entries(at: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Position and common prefix in one integer."""
    return at << 8 | lcp


class Passed:
    """What moves on from a stream of entries: its common prefix is the least passed since the last for that character."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queues: Queues, depth: int):
        self.text, self.wanted, self.queues, self.depth = text, wanted, queues, depth
        # Least value since the last entry sent to a character; 0 before the first.
        self.since = np.zeros(int(text.max()) + 1, np.uint8)

    def send(self, at: np.ndarray, lcp: np.ndarray) -> None:
        if not len(at):
            return
        index = np.flatnonzero(at > 0)
        index = index[self.wanted[at[index] - 1]]
        if len(index):
            left = at[index] - 1
            to = self.text[left]
            by = np.argsort(to, kind="stable")
            index, left, to = index[by], left[by], to[by]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            begin = np.append(0, index[:-1] + 1)
            begin[first] = 0
            table = self._minima(lcp)
            least = self._least(table, begin, index)
            names = to[first]
            least[first] = np.minimum(least[first], self.since[names])
            self.since = np.minimum(self.since, lcp.min())
            ends = np.append(first[1:], len(index)) - 1
            tail = index[ends] + 1
            rest = np.full(len(names), 255, np.uint8)
            some = tail < len(lcp)
            rest[some] = self._least(table, tail[some], np.full(int(some.sum()), len(lcp) - 1))
            self.since[names] = rest
            sent = _entries(left, np.minimum(least, self.depth - 1) + 1)
            for name, begin_at, end_at in zip(names.tolist(), first.tolist(), (ends + 1).tolist()):
                self.queues.push(name, sent[begin_at:end_at])
        else:
            self.since = np.minimum(self.since, lcp.min())

    @staticmethod
    def _minima(lcp: np.ndarray) -> np.ndarray:
        levels = max(1, len(lcp).bit_length())
        table = np.empty((levels, len(lcp)), np.uint8)
        table[0] = lcp
        for k in range(1, levels):
            half = 1 << (k - 1)
            table[k] = table[k - 1]
            np.minimum(table[k - 1, : len(lcp) - half], table[k - 1, half:], out=table[k, : len(lcp) - half])
        return table

    @staticmethod
    def _least(table: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = np.frexp((end - begin + 1).astype(np.float64))[1] - 1
        return np.minimum(table[level, begin], table[level, end - (1 << level) + 1])


def induce(text: np.ndarray, words: np.ndarray, wanted: np.ndarray, seeds: dict[int, tuple[np.ndarray, np.ndarray]], chars: list[int], depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The `wanted` suffixes by first character, in the order of `chars`, with their common prefixes with the one before.

    In a character's stream the induced entries come first, then its seeds.
    """
    queues = Queues(np.int64)
    passed = Passed(text, wanted, queues, depth)
    found = {}
    for c in chars:
        parts = []
        for part in queues.pop(c):
            at, lcp = part >> 8, (part & 255).astype(np.uint8)
            if not parts:
                lcp[0] = 0
            parts.append((at, lcp))
            passed.send(at, lcp)
        if parts:
            found[c] = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if c in seeds:
            at, lcp = seeds[c][0], seeds[c][1].copy()
            lcp[0] = common_prefix(words, found[c][0][-1:], at[:1], depth)[0] if c in found else 0
            passed.send(at, lcp)
    return found


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in order of their suffixes, and the common prefix of each with the one before; both exact up to `depth`.

    `text` (uint16) ends with a character that is smaller than all others and appears nowhere else.
    """
    s_type = types(text)
    sample = sample_positions(s_type)
    if not len(sample):
        return np.zeros(1, np.int64), np.zeros(1, np.uint8)
    place, count = names(text, s_type, sample)
    seeds = sample[order_of_names(place, count, (depth + 1) // 2)]
    words = packed(text)
    lcp = np.zeros(len(seeds), np.uint8)
    lcp[1:] = common_prefix(words, seeds[:-1], seeds[1:], depth)
    first = text[seeds]
    chars = np.flatnonzero(np.bincount(text)).tolist()
    cut = dict(zip(*[x.tolist() for x in np.unique(first, return_index=True)]))
    bounds = [*cut.values(), len(seeds)]
    grouped = {c: (seeds[b:e], lcp[b:e]) for c, b, e in zip(cut, bounds, bounds[1:])}
    large = induce(text, words, ~s_type, grouped, chars, depth)
    turned = {c: (at[::-1], np.append(np.uint8(0), lcp[:0:-1])) for c, (at, lcp) in large.items()}
    small = induce(text, words, s_type, turned, chars[::-1], depth)
    order, prefix = [], []
    last = len(text) - 1
    order.append(np.array([last]))
    prefix.append(np.zeros(1, np.uint8))
    for c in chars:
        before = None
        if c in large:
            order.append(large[c][0])
            prefix.append(large[c][1])
            before = large[c][0][-1:]
        if c in small:
            at, values = small[c][0][::-1], np.append(np.uint8(0), small[c][1][:0:-1])
            if before is not None:
                values[0] = common_prefix(words, before, at[:1], depth)[0]
            order.append(at)
            prefix.append(values)
    return np.concatenate(order), np.concatenate(prefix)
