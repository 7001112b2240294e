import random
from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
import tiktoken

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from quern.llm import byte_bpe, mixing, quality_rules, substring  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abdehilnorstu") for _ in range(rng.randrange(2, 9)))
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(90):
        words = [word() for _ in range(rng.randrange(10, 260))]
        if i % 5 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage
        if i % 7 == 0 and rows:
            words = rows[i // 2][1].split()
            words[rng.randrange(len(words))] = word()
        if i % 9 == 0:
            words = [w + "###" for w in words]
        text = "".join(w + rng.choice("  \n") for w in words)
        rows.append((i, text, "en", rng.choice(["a", "b", None]), len(text)))
    rows += [rows[3], (None, rows[4][1], None, "c", None), (200, None, None, None, None), (201, "", "en", "a", 0)]
    return rows


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_against_brute_force(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    # quality rules
    kept = [r for r in docs if not any(rule(quality_rules.Text(r[1])) for rule in quality_rules.RULES.values())]
    out = corpus_pipeline.rules(spark, df, "")
    assert as_rows(out) == sorted(kept, key=str)
    # near copies: components of all pairs whose five-word shingles have a Jaccard of 0.8
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (r[1].lower().split() for r in kept)]
    up = list(range(len(kept)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(kept)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(kept):
        groups.setdefault(root(i), []).append(r)
    single = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert len(single) < len(kept)
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(kept, SCHEMA), "")
    assert as_rows(out) == sorted(single, key=str)
    # repeated passages
    n = substring.LENGTH
    words = [r[1].split() for r in single]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    want = {}
    for r, w in zip(single, words, strict=True):
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        want[r[0]] = [x for j, x in enumerate(w) if j not in gone]
    out = corpus_pipeline.substring_dedup(spark, spark.createDataFrame(single, SCHEMA), "")
    got = out.collect()
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"].split() for r in got} == want
    assert any(len(want[r[0]]) < len(w) for r, w in zip(single, words, strict=True))
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    # mixing: as often as the SQL statement says
    left = [tuple(r) for r in got]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", left)
    times = {r[0]: r[4] // r[1] for r in con.execute(mixing.SQL).fetchall() if r[1]}
    out = corpus_pipeline.mix(spark, spark.createDataFrame(left, SCHEMA), "")
    assert as_rows(out) == sorted((r for r in left for _ in range(times.get(r[0], 0))), key=str)
    # encoding
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = corpus_pipeline.encode(spark, spark.createDataFrame(left, SCHEMA), "").collect()
    assert {r["doc_id"]: r["ids"] for r in out} == {r[0]: theirs.encode_ordinary(r[1]) for r in left}
    assert all(r["n_tokens"] == len(r["ids"]) for r in out)


def test_run_equals_its_stages(spark, docs, tmp_path):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        d = spark.read.parquet(f"{tmp_path}/{k}")
    assert as_rows(corpus_pipeline.run(spark, str(tmp_path))) == as_rows(d)


def test_empty_and_extra_columns(spark):
    odd = spark.createDataFrame([], SCHEMA + ", code long, row string, g1 int, copies string, `a.b` string, q_code int, q_head int, q_row int, copy int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns and out.collect() == []
    assert corpus_pipeline.encode(spark, odd, "").collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    one = spark.createDataFrame([(1, text, "en", "s", 9, 5, "r", 2, "c", "d", 1, 2, 3, 4)], odd.schema)
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, one, "")
        assert [(r["doc_id"], r["text"], r["code"], r["row"], r["g1"], r["copies"]) for r in out.collect()] == [(1, text, 5, "r", 2, "c")]
    assert {tuple(r) for r in corpus_pipeline.mix(spark, one, "").collect()} <= {(1, text, "en", "s", 9, 5, "r", 2, "c", "d", 1, 2, 3, 4)}
