import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from quern.llm import mixing, near_copies, quality_rules, sharding, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, class string, g1 long, shard string"


def rows(n=400, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(["the", "of", "w%%", "x!", "é b", f"u{rng.randrange(500)}"]) for _ in range(rng.choice([0, 1, 3, 49, 50, 60, 200]))]
        if i % 6 == 0:
            words = words[:5] * 30
        text = "".join(w + rng.choice([" ", "\n", "\t", "\x0b"]) for w in words)
        out.append((i, text, "en", rng.choice(["a", "b", "é", "Z", None]), len(text), 1, "r", "c", 2, "s"))
    hot = "hot copy of a text " * 20
    out = [(r[0], hot, *r[2:]) if r[0] % 3 == 1 else r for r in out]  # a third of the rows are copies
    return out + [out[5], out[5], (None, out[5][1], *out[5][2:]), (None, None, None, None, None, None, None, None, None, None), (900, "", "en", "a", 0, 1, "r", "c", 2, "s")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def repeat_brute(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    return len({i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)})


def test_rules_against_brute_force(table):
    want = []
    for i, text, *_ in rows():
        t = text or ""
        words = t.encode().split()
        lines = [x for x in t.split("\n") if x.encode().split()]
        n, chars, symbols = len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t)
        dup, rep = len(lines) - len(set(lines)), repeat_brute(words)
        failed = n < 50 or 100 * rep > 50 * n
        kept = not (failed or 100 * symbols > 5 * chars or 100 * dup > 60 * len(lines) or chars < 2 * n or chars > 20 * n or 5 * t.count("!") > n)
        want.append((i, n, chars, symbols, dup, rep, failed, kept))
    got = quality_rules.judged(table).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    kept = quality_rules.filtered(table)
    assert kept.columns == table.columns and kept.count() == sum(w[-1] for w in want)
    assert quality_rules.judged(table.limit(0)).collect() == [] and quality_rules.filtered(table.limit(0)).collect() == []


def test_rule_order():
    assert quality_rules.ordered([("slow", 1.0, 0.5), ("fast", 0.1, 0.2), ("never", 0.1, 0.0)]) == ["fast", "slow", "never"]
    asked = []
    rules = [("a", lambda t: asked.append("a") or True), ("b", lambda t: asked.append("b") or True)]
    assert quality_rules.first_rejection(quality_rules.Text("x"), rules) == "a" and asked == ["a"]


def test_shards(table):
    got = sharding.sharded(table).collect()
    given = rows()
    assert len(got) == len(given)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in given)
    size, places = Counter(), {}
    for r in got:
        size[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert set(size) == set(range(8))
    assert max(size.values()) - min(size.values()) <= 0.05 * max(size.values()) + max(len((t or "").encode()) for _, t, *_ in given)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    where = {}
    for r in got:
        where.setdefault(r["text_crc32"], set()).add(r["shard"])
    small = [k for k, n in Counter(r["text_crc32"] for r in got).items() if n < 10]
    assert all(len(where[k]) == 1 for k in small)  # groups of copies stay together unless one shard can't hold them
    again = sorted((str(r["doc_id"]), r["text_crc32"], r["shard"]) for r in sharding.sharded(table.repartition(3)).collect())
    assert again == sorted((str(r["doc_id"]), r["text_crc32"], r["shard"]) for r in got)
    assert sharding.sharded(table.limit(0)).collect() == []


def naive_shards(groups, shards=8):
    """Vector bin packing by plain loops. groups: [(g1, g2, bytes, words, rows)], all above 1/4096. Gives rows of each group in each shard."""
    total = [max(1, sum(g[k] for g in groups)) for k in (2, 3, 4)]
    units = []
    for g in sorted(groups):
        left, cut = g[4], max(g[2] / total[0], g[4] / total[2]) > 1 / shards
        while left:
            n = math.ceil(left / (2 * shards)) if cut else left
            units.append((g[:2], n, [g[k] / g[4] * n * (shards / t) for k, t in zip((2, 3, 4), total)]))
            left -= n
    room = [[1.0, 1.02, 1.02] for _ in range(shards)]
    placed = {}
    for key, n, v in sorted(units, key=lambda u: -max(u[2])):
        product = [sum(w * a * b for w, a, b in zip((4, 1, 1), r, v)) for r in room]
        fits = [k for k in range(shards) if all(a >= b for a, b in zip(room[k], v))] or [k for k in range(shards) if room[k][0] >= v[0]]
        k = max(fits, key=lambda k: (product[k], -k)) if fits else max(range(shards), key=lambda k: (room[k][0], -k))
        placed.setdefault(key, [0] * shards)[k] += n
        room[k] = [a - b for a, b in zip(room[k], v)]
    return placed


def test_shards_equal_naive_packing(spark):
    rng = random.Random(9)
    texts = [" ".join("x" * rng.randrange(1, 9) for _ in range(rng.choice([1, 5, 40, 200]))) for _ in range(150)]
    data = [(i, rng.choice(texts)) for i in range(500)] + [(1000 + i, texts[0]) for i in range(120)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    digests = {r["text"]: (r["g1"], r["g2"]) for r in df.selectExpr("text", "xxhash64(text, 1) AS g1", "xxhash64(text, 2) AS g2").distinct().collect()}
    many = Counter(t for _, t in data)
    want = naive_shards([(*digests[t], n * (len(t) + 1), n * len(t.split()), n) for t, n in many.items()])
    by_id = dict(data)
    got = {}
    for r in sharding.sharded(df).collect():
        got.setdefault(digests[by_id[r["doc_id"]]], [0] * 8)[r["shard"]] += 1
    assert got == want


@pytest.mark.parametrize("ids", [None, 7])
def test_rows_alike_in_everything_spread_to_within_one_row(spark, ids):
    text = "fifteen letters"
    data = [(ids, text)] * 800 + [(i, "x" * (i % 9)) for i in range(100)]
    got = sharding.sharded(spark.createDataFrame(data, "doc_id long, text string")).collect()
    size, slots = Counter(), {}
    for r in got:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(size) == 8 and max(size.values()) - min(size.values()) <= len(text) + 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


ODD = "doc_id long, text string, source string, `a.b` string, row string, copies int, copy int, q_code long, q_head long, q_row string, node long, c0 string, c1 int, code long, at long, start long, m long, shard int, TEXTS string"


def test_clashing_names_and_long_texts(spark):
    long = " ".join(f"word{i}" for i in range(100_000))  # 1 MB
    rest = ("ab", "r", 1, 2, 3, 4, "q", 5, "c", 6, 7, 8, 9, 10, 11, "t")
    data = [(1, long, "s", *rest), (2, long + " end", "s", *rest), (3, " ".join(f"v{i}" for i in range(60)), "é", *rest), (4, None, None, *rest)]
    df = spark.createDataFrame(data, ODD)
    given = sorted(map(tuple, df.collect()))
    kept = quality_rules.filtered(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == given[:3]
    assert sorted(r["n_words"] for r in quality_rules.judged(df).collect()) == [0, 60, 100_000, 100_001]
    took = mixing.mixed(df)
    assert took.columns == df.columns and set(map(tuple, took.collect())) <= set(given)
    assert sum(r["copies"] for r in mixing.copies(df).collect()) == took.count()
    assert sorted(r["words"] for r in sharding.sharded(df).collect()) == [0, 60, 100_000, 100_001]
    for one in (simhash.one_of_each(df), near_copies.one_of_each(df, 6)):
        assert one.columns == df.columns and sorted(map(tuple, one.collect())) == [given[0], *given[2:]]


def test_rows_alike_in_everything_mix(spark):
    data = [(None, "a b c", "s")] * 900 + [(i, "d e", "t") for i in range(50)]
    got = mixing.copies(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    took = Counter()
    for r in got:
        took[r["source"]] += r["copies"] * r["size"]
        target = {r["source"]: r["target"]}
        assert r["copies"] <= 2
    assert abs(took["s"] - next(r["target"] for r in got if r["source"] == "s")) <= 3 and target


def test_rule_order_ties_and_estimates(spark, table):
    assert quality_rules.ordered([("b", 0.0, 0.0), ("a", 0.0, 0.0)]) == ["b", "a"]
    found = quality_rules.estimate(table, quality_rules.RULES)
    assert [n for n, *_ in found] == list(quality_rules.RULES) and all(0 <= r <= 1 and s >= 0 for _, s, r in found)


def test_pack_fills_evenly():
    rng = np.random.default_rng(1)
    v = np.c_[rng.lognormal(3, 1, 3000), rng.lognormal(2, 1, 3000), np.ones(3000)]
    where = sharding.pack(v, 8)
    sums = np.array([v[where == k].sum(axis=0) for k in range(8)])
    assert (sums.max(axis=0) / sums.mean(axis=0) < 1.03).all()


def brute_targets(sizes):
    """Water filling by repetition."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2 * sizes[s]
            open_.discard(s)
        left = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


def test_mix(table):
    given = rows()
    count = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _, t, _, s, *_ in given:
        sizes[s] += count(t)
    got = mixing.copies(table).collect()
    assert len(got) == len(given)
    want = brute_targets(sizes)
    took = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]])
        assert 0 <= r["copies"] <= 2
        took[r["source"]] += r["copies"] * r["size"]
    longest = max(count(t) for _, t, *_ in given)
    assert all(abs(took[s] - want[s]) <= 2 * longest for s in sizes)
    assert sum(r["copies"] for r in got) == mixing.mixed(table).count()
    assert mixing.mixed(table).columns == table.columns
    key = lambda rs: Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in rs)
    assert key(got) == key(mixing.copies(table.repartition(9)).collect())
    assert mixing.copies(table.limit(0)).collect() == [] and mixing.mixed(table.limit(0)).collect() == []


def test_mix_equals_sql(spark, table):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    distinct = list({(r[0], r[1], r[3]): None for r in rows() if r[0] is not None})
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", distinct)
    df = spark.createDataFrame(distinct, "doc_id long, text string, source string")
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall())
    got = sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["copies"] * r["size"]) for r in mixing.copies(df).collect())
    tidy = lambda rs: [(*r[:3], round(r[3], 6), r[4]) for r in rs]
    assert tidy(got) == tidy(want)
