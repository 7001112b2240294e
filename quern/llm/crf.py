"""A linear-chain conditional random field with two states, over many chains at once.

Chains stand end to end in one feature matrix. Chains of like length are stepped
through together, so a pass costs as many vector operations as the longest has lines.
"""

from __future__ import annotations

import numpy as np


def _padded(lengths: np.ndarray, most: int = 200_000):
    """Groups of chains of like length: (chains, index matrix (steps, chains) into the lines, mask)."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and lengths[order[hi]] * (hi + 1 - lo) <= max(most, lengths[order[lo]]) and lengths[order[hi]] <= 2 * lengths[order[lo]] + 8:
            hi += 1
        chains = order[lo:hi]
        steps = np.arange(int(lengths[chains].max()))[:, None]
        mask = steps < lengths[chains]
        yield chains, np.where(mask, starts[chains] + steps, 0), mask
        lo = hi


class Crf:
    """Scores: weights . features for state 1 (0 for state 0), moves[i, j] between neighbours."""

    def __init__(self, n: int):
        self.weights, self.moves = np.zeros(n), np.zeros((2, 2))

    def _passes(self, s: np.ndarray, index: np.ndarray, mask: np.ndarray):
        """Log forward and backward messages (steps, chains, 2) for one group."""
        steps, k = index.shape
        e = np.zeros((steps, k, 2))
        e[:, :, 1] = s[index]
        fwd, bwd = np.empty_like(e), np.zeros_like(e)
        fwd[0] = e[0]
        for t in range(1, steps):
            move = np.logaddexp(fwd[t - 1, :, :1] + self.moves[0], fwd[t - 1, :, 1:] + self.moves[1])
            fwd[t] = np.where(mask[t][:, None], move + e[t], fwd[t - 1])
        for t in range(steps - 2, -1, -1):
            x = bwd[t + 1] + e[t + 1]
            move = np.logaddexp(x[:, :1] + self.moves[:, 0], x[:, 1:] + self.moves[:, 1])
            bwd[t] = np.where(mask[t + 1][:, None], move, 0.0)
        return e, fwd, bwd, np.logaddexp(fwd[-1, :, 0], fwd[-1, :, 1])

    def marginals(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """P(state 1) of every line."""
        out = np.empty(len(x))
        s = x @ self.weights
        for _, index, mask in _padded(lengths):
            _, fwd, bwd, z = self._passes(s, index, mask)
            p = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z)
            out[index[mask]] = p[mask]
        return np.clip(out, 0, 1)

    def fit(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 120, rate: float = 0.1, l2: float = 1e-3) -> None:
        """Chains whose lines all have the chain's state y; weight by chain. Full-batch Adam."""
        w = weight / max(weight.sum(), 1e-9) / 1.0
        per_line = np.repeat(w / lengths, lengths)
        theta = np.zeros(x.shape[1] + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        groups = list(_padded(lengths))
        gold = (np.repeat(y, lengths) * per_line) @ x
        for i in range(1, rounds + 1):
            self.weights, self.moves = theta[:-4], theta[-4:].reshape(2, 2)
            s = x @ self.weights
            p = np.empty(len(x))
            moved = np.zeros((2, 2))
            for chains, index, mask in groups:
                e, fwd, bwd, z = self._passes(s, index, mask)
                one = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z)
                p[index[mask]] = one[mask]
                scale = w[chains] / lengths[chains]
                if len(index) > 1:
                    inner = mask[1:] * scale
                    for a in (0, 1):
                        for b in (0, 1):
                            joint = np.exp(fwd[:-1, :, a] + self.moves[a, b] + e[1:, :, b] + bwd[1:, :, b] - z)
                            moved[a, b] += (joint * inner).sum()
                    stay = (mask[1:].sum(axis=0) * scale)
                    moved[0, 0] -= (stay * (y[chains] == 0)).sum()
                    moved[1, 1] -= (stay * (y[chains] == 1)).sum()
            grad = np.r_[(np.clip(p, 0, 1) * per_line) @ x - gold, moved.ravel()] + l2 * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            theta = theta - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        self.weights, self.moves = theta[:-4].copy(), theta[-4:].reshape(2, 2).copy()
