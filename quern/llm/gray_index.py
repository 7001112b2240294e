"""All links between 64-bit fingerprints, found in a hierarchical index in Gray order.

Fingerprints stand in the order of their Gray rank, so neighbours differ in few bits. Runs of
eight make a node that keeps only what its members share: a mask of the bits that are
equal and their pattern; eight nodes make a node above. A query starts at the top. Its
differences from a node's pattern, counted under the node's mask, can only grow on
the way down, so a node beyond the limit drops its whole group; if even all
unshared bits cannot push the count over the limit, the whole group links at once.
"""

from __future__ import annotations

import numpy as np

FAN = 8


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The position of each code in the Gray sequence (unsigned 64 bits)."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class Forest:
    """Disjoint sets over 0..n-1, smallest member as root."""

    def __init__(self, n: int):
        self.up = np.arange(n, dtype=np.int64)

    def flat(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the pairs. Those already joined are dropped first, all at once."""
        flat = self.flat()
        ra, rb = flat[a], flat[b]
        new = ra != rb
        if not new.any():
            return
        pairs = np.unique(np.minimum(ra, rb)[new] * len(flat) + np.maximum(ra, rb)[new])
        for x, y in zip((pairs // len(flat)).tolist(), (pairs % len(flat)).tolist(), strict=True):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def _levels(c: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Nodes over codes in Gray order, leaves first: starts, ends, mask and pattern of each level, up to one root."""
    levels, width = [], FAN
    while True:
        starts = np.arange(0, len(c), width)
        ones, any_ = np.bitwise_and.reduceat(c, starts), np.bitwise_or.reduceat(c, starts)
        mask = ~(ones ^ any_)
        levels.append((starts, np.r_[starts[1:], len(c)], mask, ones & mask))
        if len(starts) == 1:
            return levels
        width *= FAN


def spanning_links(codes: np.ndarray, limit: int, most: int = 2_000_000) -> np.ndarray:
    """For each code the index of a code it is linked with, directly or over others (itself if none).

    ``most`` bounds the pairs of query and node that are at work at a time.
    """
    return _linked(codes, None, limit, most)


def crossing_links(codes: np.ndarray, others: np.ndarray, limit: int, most: int = 2_000_000) -> np.ndarray:
    """As spanning_links() over codes and then others, of links between the two only."""
    return _linked(codes, others, limit, most)


def _linked(codes: np.ndarray, others: np.ndarray | None, limit: int, most: int) -> np.ndarray:
    n = len(codes)
    if not n or (others is not None and not len(others)):
        return np.arange(n + (len(others) if others is not None else 0))
    order = np.argsort(gray_rank(codes), kind="stable")
    c = codes[order]
    levels = _levels(c)
    asked = c if others is None else others
    shift = 0 if others is None else n
    forest = Forest(n + (0 if others is None else len(others)))
    step, lo = max(64, most // 1024), 0
    while lo < len(asked):
        hi = min(len(asked), lo + step)
        q = np.arange(lo, hi)
        found = _search(c, levels, asked, q, q if others is None else np.full(len(q), -1), limit, most)
        if found is None:
            step = max(1, step // 4)
            continue
        forest.union(*(np.where(x >= 0, x, shift + ~x) for x in found))
        lo = hi
    flat = forest.flat()
    place = np.r_[order, np.arange(n, len(flat))]
    out = np.empty(len(flat), np.int64)
    out[place] = place[flat]
    return out


def _search(c, levels, asked, queries, after, limit, most):
    """Index pairs that link each query with all members beyond ``after`` within the limit; None if more than ``most`` pairs are at work at once.

    A query is given by its number in ``asked``: as it is where it is a member itself, as its complement where it is not.
    """
    own = queries if after.size and after[0] >= 0 else ~queries
    at, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
    pairs_q, pairs_e = [], []
    for k in range(len(levels) - 1, -1, -1):
        starts, ends, mask, pattern = levels[k]
        keep = ends[node] - 1 > after[at]
        at, node = at[keep], node[keep]
        least = np.bitwise_count((asked[queries[at]] ^ pattern[node]) & mask[node])
        keep = least <= limit
        at, node, least = at[keep], node[keep], least[keep]
        whole = least + np.bitwise_count(~mask[node]) <= limit
        if whole.any():  # each such node is tied together once, and its queries to its first member
            pairs_q.append(own[at[whole]])
            pairs_e.append(starts[node[whole]])
            for x in np.unique(node[whole]):
                members = np.arange(starts[x], ends[x])
                pairs_q.append(members)
                pairs_e.append(np.full(len(members), starts[x]))
            at, node = at[~whole], node[~whole]
        if k:
            below = levels[k - 1][0]
            lo, hi = np.searchsorted(below, starts[node]), np.searchsorted(below, ends[node])
        else:
            lo, hi = np.maximum(starts[node], after[at] + 1), ends[node]
        many = hi - lo
        total = int(many.sum())
        if total > most and len(queries) > 1:
            return None
        base = np.repeat(lo - (np.cumsum(many) - many), many)
        at, node = np.repeat(at, many), base + np.arange(total)
    ok = np.bitwise_count(asked[queries[at]] ^ c[node]) <= limit
    return np.concatenate([*pairs_q, own[at[ok]]]), np.concatenate([*pairs_e, node[ok]])
