import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quern.llm import components, gray_index, simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, codes, limit=4):
    n, up = len(codes), list(range(len(codes)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= limit:
                up[root(i)] = root(j)
    best = {}
    for i in range(n):
        if ids[i] is not None:
            best[root(i)] = min(best.get(root(i), ids[i]), ids[i])
    return [best.get(root(i)) for i in range(n)]


def test_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 50, 300):
        t = " ".join(rng.choice(["The", "É", "ab", "x", "of it", "Zz"]) for _ in range(n)).replace(" x", "\t\n x")
        assert simhash.fingerprint(t) == brute_fingerprint(t)
    assert simhash.fingerprint(None) == 0


def test_gray_rank_is_inverse():
    i = np.arange(5000, dtype=np.uint64)
    assert (gray_index.gray_rank(i ^ (i >> np.uint64(1))) == i).all()


def families(rng, n, spread):
    out = set()
    while len(out) < n:
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 40])):
            x = c
            for _ in range(rng.randrange(spread)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def test_index_links_like_brute_force():
    rng = random.Random(2)
    for trial in range(4):
        codes = families(rng, 500, 6)
        rng.shuffle(codes)
        most = 2_000_000 if trial % 2 else 3000
        got = gray_index.spanning_links(np.array(codes, np.uint64), 4, most=most).tolist()
        want = brute_components(list(range(len(codes))), codes)
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
        n = rng.randrange(100, 400)  # links between two parts and those inside each, put together, are all links
        x, y = np.array(codes[:n], np.uint64), np.array(codes[n:], np.uint64)
        pairs = [*enumerate(gray_index.spanning_links(x, 4, most=most).tolist()), *((n + i, n + k) for i, k in enumerate(gray_index.spanning_links(y, 4, most=most).tolist())), *enumerate(gray_index.crossing_links(x, y, 4, most=most).tolist())]
        up = list(range(len(codes)))

        def root(i):
            while up[i] != i:
                i = up[i]
            return i

        for i, k in pairs:
            up[root(i)] = root(k)
        got = [root(i) for i in range(len(codes))]
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
    dense = np.array(sorted({1 << i | 1 << j for i in range(64) for j in range(64)}), np.uint64)
    assert len(set(gray_index.spanning_links(dense, 4).tolist())) == 1
    assert gray_index.crossing_links(dense, dense[:0], 4).tolist() == list(range(len(dense))) and len(gray_index.spanning_links(dense[:0], 4)) == 0


def test_pairs_of_chunks_lose_no_link(spark):
    rng = random.Random(7)
    codes = families(rng, 3000, 6)
    signed = [(c - 2**64 if c >= 2**63 else c,) for c in codes]
    df = spark.createDataFrame(signed, "code long").repartition(5)
    ranks = gray_index.gray_rank(np.array(codes, np.uint64))
    assert [r["code"] for r in df.orderBy(simhash.gray_rank(F.col("code"))).collect()] == [signed[i][0] for i in np.argsort(ranks).tolist()]
    place = {c: i for i, (c,) in enumerate(signed)}
    up = list(range(len(codes)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for r in simhash.links(df, chunk=50).collect():
        up[root(place[r.a])] = root(place[r.b])
    want = brute_components(list(range(len(codes))), codes)
    mine = [root(i) for i in range(len(codes))]
    assert len(set(zip(want, mine))) == len(set(want)) == len(set(mine))


def test_components(spark):
    rng = random.Random(3)
    path = list(range(60))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1000, 1000 + i) for i in range(50)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = {r.node: r.rep for r in components.representatives(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[x] for x in path}) == 1 and len({got[x] for x in range(1000, 1050)}) == 1 and got[2000] == got[2001]
    assert len(set(got.values())) == 3
    assert components.representatives(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clustered_equals_brute_force(spark):
    rng = random.Random(4)
    base = [[rng.choice("abcdefghijklmnop") * rng.randrange(1, 5) for _ in range(rng.choice([2, 9, 120, 400]))] for _ in range(40)]
    rows = []
    for w in base:
        for _ in range(rng.choice([1, 2, 6])):
            v = list(w)
            if rng.random() < 0.7:
                v[rng.randrange(len(v))] = "zz"
            rows.append((rng.choice([None, len(rows), len(rows)]), " ".join(v), "c"))
    rows += [(900, None, "c"), (901, "", "c"), (902, " \n", "c"), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, code string")
    codes = [brute_fingerprint(t) for _, t, _ in rows]
    want = sorted(((i, f"{c:016x}", k) for (i, _, _), c, k in zip(rows, codes, brute_components([r[0] for r in rows], codes))), key=str)
    assert sorted(map(tuple, simhash.clustered(docs).collect()), key=str) == want
    assert sorted(map(tuple, simhash.clustered(docs, chunk=8).collect()), key=str) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    up = brute_components(list(range(len(rows))), codes)
    best = {}
    for (i, t, c), k in zip(rows, up):
        best[k] = min(best.get(k, (True, 0, "￿")), (i is None, i or 0, t or ""))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(best.values())
    assert simhash.clustered(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0
