"""Exact top-k by dot product over an inverted index with block maxima.

Example ids are cut into blocks of BLOCK neighbours. Each term keeps its postings
by id, and per block the largest weight in it. A query's bound for a block is the
sum of its weights times those maxima. The blocks with the highest bounds are opened first; every
block whose bound reaches the k-th best score found there is opened too, and all others are skipped:
none of their examples can be among the k best.

The postings of the DENSE most frequent terms are kept as full rows, zeros included: their part of all scores is one
matrix product for many queries, and its largest value in a block, an exact one, enters the block's bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 64
#: Blocks that are opened first.
FIRST = 4
#: Full rows; only terms that more than one example of SPARSE has get one.
DENSE, SPARSE = 400, 32
#: Queries that are worked through at a time.
TOGETHER = 16


def spread(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (many[0] numbers), then start[1], ..."""
    return np.repeat(start - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))


class BlockMaxIndex:
    """Postings of unit vectors: rows of (example, term, weight), one per example and term, none below zero."""

    def __init__(self, n: int, terms: int, example: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.n, self.blocks = n, -(-n // BLOCK)
        df = np.bincount(term, minlength=terms)
        full = np.argsort(-df, kind="stable")[:DENSE]
        full = full[df[full] * SPARSE > n]
        self.row = np.full(terms, -1)
        self.row[full] = np.arange(len(full))
        self.full = np.zeros((len(full), self.blocks * BLOCK))
        dense = self.row[term] >= 0
        self.full[self.row[term[dense]], example[dense]] = weight[dense]
        example, term, weight = example[~dense], term[~dense], weight[~dense]
        order = np.lexsort((example, term))
        self.example, self.weight = example[order].astype(np.int32), weight[order].astype(float)
        # per term: the blocks it has postings in, where each begins, and its largest weight there
        key = term[order].astype(np.int64) * max(1, self.blocks) + self.example // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        self.at = np.r_[first, len(key)]
        self.block = key[first] % max(1, self.blocks)
        self.most = np.maximum.reduceat(self.weight, first) if len(key) else np.empty(0)
        self.start = np.searchsorted(key[first], np.arange(terms + 1) * max(1, self.blocks))
        self.opened = self.skipped = 0

    def top(self, query: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of n queries, given as sorted rows of (query, term, weight), the (example ids, dot products) of the k largest above zero; ties to the smaller id."""
        ends = np.searchsorted(query, np.arange(0, n + TOGETHER, TOGETHER))
        for i, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)):
            yield from self._some(query[lo:hi] - i * TOGETHER, terms[lo:hi], weights[lo:hi], min(TOGETHER, n - i * TOGETHER), k)

    def _some(self, query: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        row = self.row[terms]
        dense = row >= 0
        q = np.zeros((n, len(self.full)))
        q[query[dense], row[dense]] = weights[dense]
        part = (q @ self.full).reshape(n, self.blocks, BLOCK)
        # the rest by term, so that postings are met again while they are near
        rare = np.flatnonzero(~dense)
        rare = rare[np.argsort(terms[rare], kind="stable")]
        begin = self.start[terms[rare]]
        many = self.start[terms[rare] + 1] - begin
        runs = spread(begin, many)
        share, cell = np.repeat(weights[rare], many), np.repeat(query[rare] * self.blocks, many) + self.block[runs]
        bound = np.bincount(cell, self.most[runs] * share, n * self.blocks).astype(float).reshape(n, self.blocks)
        if self.blocks:
            bound += part.max(axis=2)
        open_ = np.zeros(bound.shape, bool)
        first = np.argpartition(-bound, FIRST, axis=1)[:, :FIRST] if self.blocks > FIRST else np.tile(np.arange(self.blocks), (n, 1))
        np.put_along_axis(open_, first, True, axis=1)
        open_ &= bound > 0
        score = np.zeros(part.shape)
        self._add(score, part, runs, cell, share, open_)
        least = self._kth(score, k)
        more = (bound > 0) & (bound >= least[:, None] - 1e-9) & ~open_
        self._add(score, part, runs, cell, share, more)
        opened = int(open_.sum() + more.sum())
        self.opened, self.skipped = self.opened + opened, self.skipped + open_.size - opened
        least = np.maximum(self._kth(score, k) - 1e-9, 1e-13)
        flat = score.reshape(n, -1)
        for i in range(n):
            at = np.flatnonzero(flat[i] >= least[i])
            found = np.round(flat[i][at], 12)
            at, found = at[found > 0], found[found > 0]
            best = np.lexsort((at, -found))[:k]
            yield at[best], found[best]

    @staticmethod
    def _kth(score: np.ndarray, k: int) -> np.ndarray:
        flat = score.reshape(len(score), -1)
        return np.partition(flat, -k, axis=1)[:, -k] if flat.shape[1] > k else np.zeros(len(flat))

    def _add(self, score: np.ndarray, part: np.ndarray, runs: np.ndarray, cell: np.ndarray, share: np.ndarray, chosen: np.ndarray) -> None:
        """Add the dot products of all examples in the chosen blocks; cell: query * blocks + block of each run."""
        keep = chosen.ravel()[cell]
        runs, share, own = runs[keep], share[keep], cell[keep] // max(1, self.blocks) * (self.blocks * BLOCK)
        begin = self.at[runs]
        many = self.at[runs + 1] - begin
        postings = spread(begin, many)
        score += np.bincount(self.example[postings] + np.repeat(own, many), self.weight[postings] * np.repeat(share, many), score.size).reshape(score.shape)
        score[chosen] += part[chosen]
