import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import substring


def brute(texts, length):
    """(n_words, n_removed, kept digest) of each text, by counting every window."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    word = lambda: rng.choice([f"w{rng.randrange(vocabulary)}", "é", "a b", "x"])
    passages = [[word() for _ in range(rng.randrange(8, 60))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            parts += rng.choice(passages)[rng.randrange(4) :] if rng.random() < 0.5 else [word() for _ in range(rng.randrange(30))]
        texts.append("".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in parts))
    return texts + [texts[3], texts[4], "", None, " \n", "x " * 300, "x " * 300 + "y", " ".join(f"u{i}" for i in range(20_000))]


@pytest.mark.parametrize("seed,length,gram", [(1, 35, 8), (2, 10, 3), (3, 12, 12)])
def test_equals_brute_force(spark, seed, length, gram):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in substring.digests(df, length=length, gram=gram).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_edges(spark):
    schema = "doc_id long, text string, g1 string, copies int, runs string"
    long = " ".join(f"u{i}" for i in range(40))
    rows = [(None, long, "a", 1, "r"), (None, long, "b", 2, None), (7, None, None, None, None), (7, "short", "c", 3, "s"), (7, "short", "c", 3, "s")]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r["doc_id"] is None, r["n_words"], r["n_removed"]) for r in substring.digests(df).collect())
    assert got == [(False, 0, 0), (False, 1, 0), (False, 1, 0), (True, 40, 40), (True, 40, 40)]
    assert substring.digests(df.limit(0)).collect() == []
    kept = substring.without_repeats(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.withColumn("text", F.when(F.col("doc_id").isNull(), "").otherwise(F.col("text"))).collect()))


def test_kept_text_keeps_its_white_space(spark):
    p = " ".join(f"p{i}" for i in range(35))
    df = spark.createDataFrame([(1, f"a  b\n{p}\tc  d"), (2, f"e {p}")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in substring.without_repeats(df).collect()) == [(1, "a  b\nc  d"), (2, "e")]


def test_no_join_of_pairs(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = substring.texts_and_repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
