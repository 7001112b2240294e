import random

import pytest

from quern.llm import near_copies, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def brute_sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_links_are_exact_five_word_jaccard(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abdehilnorstu") for _ in range(rng.randrange(3, 9)))
    texts = [None, "", "a b", "A  b", "a b c"]
    for _ in range(60):
        base = [word() for _ in range(rng.randrange(60, 200))]
        texts.append(" ".join(base))
        for _ in range(3):  # edits around the limit
            v = list(base)
            for _ in range(rng.randrange(1, max(2, len(v) // 20))):
                v[rng.randrange(len(v))] = word()
            texts.append(" ".join(v))
        v = list(base)
        rng.shuffle(v)  # the same words, no common shingle
        texts.append(" ".join(v))
        texts.append(" ".join(base[: rng.randrange(len(base) * 3 // 4, len(base))]) + " " + " ".join(word() for _ in range(rng.randrange(20))))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    sets, up = [brute_sets(t) for t in texts], list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    not_by_bits = 0
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
                bits = (simhash.word_fingerprint(texts[i]) ^ simhash.word_fingerprint(texts[j])).bit_count()
                not_by_bits += bits > corpus_pipeline.NEAR_BITS
    assert not_by_bits
    best = {}
    for i, d in enumerate(ids):
        best[root(i)] = min(best.get(root(i), d), d)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(best.values())


def test_bands():
    marks = near_copies.shingles(near_copies.word_digests(" ".join(f"w{i}" for i in range(5000))))
    assert len(marks) == 4996 and len(set(near_copies.bands(marks).tolist())) == near_copies.BANDS
    assert len(near_copies.bands(marks[:0])) == 0
