"""A hierarchical k-means tree with best-bin-first traversal."""

from __future__ import annotations

import heapq

import numpy as np

BRANCH = 8
ROUNDS = 8


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, rows of x to rows of c; good enough for routing, not for scores."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def _split(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """k-means++ and Lloyd: (centres, label of each row); centres without rows are dropped."""
    c = x[[rng.integers(len(x))]]
    near = _distances(x, c)[:, 0].clip(0)
    while len(c) < k and near.sum() > 0:
        c = np.vstack([c, x[rng.choice(len(x), p=near / near.sum())]])
        near = np.minimum(near, _distances(x, c[-1:])[:, 0].clip(0))
    for _ in range(ROUNDS):
        label = _distances(x, c).argmin(axis=1)
        used, label = np.unique(label, return_inverse=True)
        new = np.zeros((len(used), x.shape[1]))
        np.add.at(new, label, x)
        new /= np.bincount(label)[:, None]
        if new.shape == c.shape and np.allclose(new, c):
            break
        c = new
    return c, _distances(x, c).argmin(axis=1)


class Tree:
    """Nodes by number; node 0 is the root. A node has a run of children, or is the leaf of that number."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        centres = [sample.mean(axis=0)] if len(sample) else [np.zeros(sample.shape[1])]
        self.children: list[tuple[int, int] | None] = [None]
        rows = {0: np.arange(len(sample))}
        heap = [(-len(sample), 0)]
        count = 1
        while heap and count < leaves:  # the fullest leaf is split next
            size, node = heapq.heappop(heap)
            if -size < 2 * BRANCH:
                break
            c, label = _split(sample[rows[node]], BRANCH, rng)
            if len(c) < 2:
                continue
            first = len(centres)
            centres += list(c)
            self.children[node] = (first, first + len(c))
            self.children += [None] * len(c)
            own = rows.pop(node)
            for j in range(len(c)):
                rows[first + j] = own[label == j]
                heapq.heappush(heap, (-len(rows[first + j]), first + j))
            count += len(c) - 1
        self.centres = np.array(centres)
        self.leaf_of = np.full(len(centres), -1)
        at = [i for i, k in enumerate(self.children) if k is None]
        self.leaf_of[at] = np.arange(len(at))
        self.leaves = len(at)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row reaches by its nearest centre at every level."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.children[node] is None:
                out[rows] = self.leaf_of[node]
                continue
            lo, hi = self.children[node]
            label = _distances(x[rows], self.centres[lo:hi]).argmin(axis=1)
            todo += [(lo + j, rows[label == j]) for j in range(hi - lo)]
        return out

    def visits(self, q: np.ndarray):
        """Leaves in best-bin-first order: the open branch with the nearest centre goes on, down to a leaf."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node] is not None:
                lo, hi = self.children[node]
                d = ((self.centres[lo:hi] - q) ** 2).sum(axis=1)
                best = int(d.argmin())
                for j, x in enumerate(d.tolist()):
                    if j != best:
                        heapq.heappush(queue, (x, lo + j))
                node = lo + best
            yield int(self.leaf_of[node])
