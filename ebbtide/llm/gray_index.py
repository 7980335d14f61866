"""A hierarchical index of 64-bit fingerprints in Gray order, and the search for all that differ in few bits.

Fingerprints of a group are sorted by their rank in the Gray code, so that neighbours share most bits. Runs of neighbours
form nodes; a node keeps the bits that all below it share (mask and pattern). A search goes down from the root, adds up the
differences on bits that a node fixes beyond its parent, and drops whole nodes when the sum exceeds the limit. Many groups
are searched side by side, one level at a time.
"""

from __future__ import annotations

import numpy as np

FAN = 8
# Pairs of query and node that are looked at together: bounds the memory of a search.
FRONT = 1 << 20


def gray_rank(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _level(starts: np.ndarray, groups: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of up to FAN neighbours that lie in the same group: first child of each, and its group."""
    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    position = np.arange(total) - np.repeat(first, np.diff(np.r_[first, total]))
    at = np.flatnonzero(position % FAN == 0)
    return at, groups[at]


def build(codes: np.ndarray, groups: np.ndarray) -> list[dict]:
    """Levels from the fingerprints up to one root per group; rows are sorted by (group, Gray rank)."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    n = len(codes)
    levels = [{"mask": np.full(n, full), "pattern": codes, "last": np.arange(n), "groups": groups}]
    while len(levels[-1]["groups"]) > len(np.unique(groups)):
        below = levels[-1]
        total = len(below["groups"])
        at, own = _level(None, below["groups"], total)
        same = np.bitwise_and.reduceat(below["mask"], at)
        ones = np.bitwise_and.reduceat(below["pattern"], at)
        some = np.bitwise_or.reduceat(below["pattern"], at)
        mask = same & ~(ones ^ some)
        end = np.r_[at[1:], total]
        levels.append({"mask": mask, "pattern": ones & mask, "last": below["last"][end - 1], "groups": own, "first": at, "end": end})
    return levels


def near_pairs(codes: np.ndarray, groups: np.ndarray, limit: int):
    """Yields arrays (i, j), i < j: rows of one group whose codes differ in at most `limit` bits; input as for `build`."""
    levels = build(codes, groups)
    top = levels[-1]
    roots = np.searchsorted(top["groups"], groups)
    for begin in range(0, len(codes), FRONT // 16):
        rows = np.arange(begin, min(begin + FRONT // 16, len(codes)))
        nodes = roots[rows]
        sums = np.bitwise_count((codes[rows] ^ top["pattern"][nodes]) & top["mask"][nodes]).astype(np.int64)
        yield from _descend(codes, levels, len(levels) - 1, rows, nodes, sums, limit)


def _descend(codes, levels, depth, rows, nodes, sums, limit):
    if not len(rows):
        return
    if depth == 0:
        keep = nodes > rows
        if keep.any():
            yield rows[keep], nodes[keep]
        return
    node, child = levels[depth], levels[depth - 1]
    if len(rows) > FRONT // FAN:
        half = len(rows) // 2
        yield from _descend(codes, levels, depth, rows[:half], nodes[:half], sums[:half], limit)
        yield from _descend(codes, levels, depth, rows[half:], nodes[half:], sums[half:], limit)
        return
    width = node["end"][nodes] - node["first"][nodes]
    again = np.repeat(np.arange(len(rows)), width)
    offset = np.arange(len(again)) - np.repeat(np.cumsum(width) - width, width)
    below = node["first"][nodes][again] + offset
    row, parent = rows[again], nodes[again]
    fresh = child["mask"][below] & ~node["mask"][parent]
    total = sums[again] + np.bitwise_count((codes[row] ^ child["pattern"][below]) & fresh)
    keep = (total <= limit) & (child["last"][below] > row)
    yield from _descend(codes, levels, depth - 1, row[keep], below[keep], total[keep], limit)


class Forest:
    """Union-find over rows; keeps only links that join two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
