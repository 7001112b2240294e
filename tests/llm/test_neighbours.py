import math
import random

import numpy as np
import pytest

from quern.llm import neighbours
from quern.llm.kmeans_tree import Tree

SCHEMA = "vec_id long, embedding array<float>, label int, leaf string"


def brute(rows, every, k):
    rows = {(i, tuple(v)): None for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in rows:
        if i % every == 0:
            best = sorted((math.dist(v, w), j) for j, w in rows if (j, w) != (i, v))
            out[i] = [(j, d) for d, j in best[:k]]
    return out


def table(n, dims=8, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 3) for _ in range(dims)] for _ in range(6)]
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(rng.gauss(c, 1)) for c in rng.choice(centres)], 1, "x") for i in range(n)]
    return [(i, rows[5][1], 1, "x") if i % 3 == 1 else r for i, r in enumerate(rows)]  # a third of all rows share a vector


def test_tree_reaches_every_leaf():
    x = np.random.default_rng(1).normal(size=(2000, 6))
    t = Tree(x, 50)
    assert t.leaves >= 50 and set(t.assign(x).tolist()) == set(range(t.leaves))
    assert sorted(t.visits(x[0])) == list(range(t.leaves))
    assert np.mean([next(t.visits(q)) == leaf for q, leaf in zip(x[:200], t.assign(x[:200]), strict=True)]) == 1
    assert Tree(np.ones((100, 4)), 9).leaves == 1


@pytest.mark.parametrize("part", [neighbours.QUERIES, 20])
def test_recall_and_scores(spark, monkeypatch, part):
    monkeypatch.setattr(neighbours, "QUERIES", part)
    rows = table(3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got: dict = {}
    for r in sorted(neighbours.neighbours(df, every=20).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute(rows, 20, 10)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    by = {i: v for i, v, *_ in rows}
    for q, found in got.items():
        assert [d for _, d in found] == pytest.approx([math.dist(by[q], by[j]) for j, _ in found])
        assert found == sorted(found, key=lambda x: (x[1], x[0]))
        assert q not in {j for j, _ in found}
    shared = next(q for q in want if q % 3 == 1)
    assert got[shared] == [(j, 0.0) for j in [i for i in range(3000) if (i % 3 == 1 or i == 5) and i != shared][:10]]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, "a"), (100, [1.0, 0.0], 1, "a"), (100, [1.0, 0.0], 1, "a"), (3, [0.0, 1.0], None, None), (None, [1.0, 1.0], 1, "a"), (4, None, 1, "a"), (5, [0.0, 0.0], 1, "a"), (6, [nan, 1.0], 1, "a"), (7, [inf, 1.0], 1, "a"), (8, [None, 1.0], 1, "a"), (200, [1.0], 1, "a"), (9, [], 1, "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, neighbours.neighbours(df).collect()))
    assert got == [(0, 1, 100, 0.0), (0, 2, 3, pytest.approx(2**0.5)), (100, 1, 0, 0.0), (100, 2, 3, pytest.approx(2**0.5))]
    assert neighbours.neighbours(df.limit(0)).collect() == []
