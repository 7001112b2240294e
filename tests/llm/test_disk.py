"""What operators leave in the folder for intermediate tables, what they shuffle and what they keep in memory."""

import glob
import random
import re
import tracemalloc

import pyarrow.parquet as pq
import pytest

from quern.llm import byte_bpe, html_text, mixing, near_copies, substring
from quern.operators.explore import with_index
from quern.plans.scratch import shared_dir


@pytest.fixture()
def made(spark):
    """Gives the names of the intermediate tables that are there and were not at the test's start; columns(): those of their columns."""
    here = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/*"))
    before = here()

    def names():
        return sorted(re.split("[-_][0-9a-f]{32}", p.rsplit("/", 1)[-1])[0] for p in here() - before)

    names.columns = lambda: {c for p in here() - before for f in glob.glob(f"{p}/*.parquet") for c in pq.read_schema(f).names}
    return names


def corpus(n=40, words=120, seed=5):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(words))) for i in range(n)]


def test_a_mix_does_not_shuffle_its_rows_by_source(spark):
    df = spark.createDataFrame([(*r, "ab"[r[0] % 2]) for r in corpus()], "doc_id long, text string, source string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        took = mixing.mixed(df)
        plan = took._jdf.queryExecution().executedPlan().toString()
        assert took.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_texts_of_a_finished_search_for_repeats_go(spark, made):
    rows = corpus()
    passage = " ".join(f"p{i}" for i in range(40))
    df = spark.createDataFrame([*rows, (90, f"a {passage}"), (91, f"b {passage}")], "doc_id long, text string")
    out = substring.without_repeats(df)
    assert made() == ["kept"]
    assert sorted(map(tuple, out.collect())) == [*rows, (90, "a"), (91, "b")]


def test_sets_of_a_finished_search_for_near_copies_go(spark, made):
    rows = corpus()
    df = spark.createDataFrame([*rows, *((50 + i, t + " more") for i, t in rows[:10])], "doc_id long, text string")
    out = near_copies.one_of_each(df, 4)
    left = made()
    assert "heads" in left and not {"cells", "sets", "bands", "live"} & set(left)
    assert sorted(map(tuple, out.collect())) == rows


def test_texts_of_pages_are_not_stored(spark, made):
    words = dict(corpus(n=60, words=400))
    pages = [(i, f"http://h.org/{i // 10}/{i}", f"<article><p>{t}</p></article>") for i, t in words.items()]
    out = html_text.extracted(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert "lines" in made.columns() and not {"text", "texts"} & made.columns()
    assert {r["page_id"]: r["text"] for r in out.collect()} == words


def test_numbering_needs_no_python_worker(spark):
    plan = with_index(spark.range(50), "id")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
    assert [r["index"] for r in with_index(spark.range(50), "id").orderBy("id").collect()] == list(range(50))
    assert with_index(spark.range(0), "id").collect() == []


def test_an_encoder_keeps_no_decoded_words():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b" ab": 257}
    texts = [f"ab {t}  x" for _, t in corpus(n=5)] + ["", "ab", " ab"]
    both, ids = (byte_bpe.Written(byte_bpe.Codec(ranks, r" ?[^\s]+|\s+"), lambda i: b" %d" % i, decode=d) for d in (True, False))
    want = [list(x) for x in both.block(texts)]
    got = [list(x) for x in ids.block(texts)]
    assert ["".join(b.decode() for _, b in x) for x in want] == texts
    assert [[i for i, _ in x] for x in got] == [[i for i, _ in x] for x in want]
    assert len(ids.ids) == len(both.ids) > 100 and not ids.raw


def test_an_encoder_keeps_the_words_of_recent_blocks_only(monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 4_000)
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b" ab": 257, b" a": 258}
    codec, replayed, held = byte_bpe.Codec(ranks, r" ?[^\s,]+|,|\s+"), [], []
    blocks = [[" ".join(["ab", *(f"abba{n:02}x{k}x{i}, abba" for i in range(90))]) for k in range(4)] for n in range(12)]
    want = [[(b"".join(b" %d" % i for i in codec.encode(t)), t.encode()) for t in texts] for texts in blocks]
    codec.forget()
    replay = codec.replay
    monkeypatch.setattr(codec, "replay", lambda words: replayed.append(b" abba" in words) or replay(words))
    written = byte_bpe.Written(codec, lambda i: b" %d" % i)
    tracemalloc.start()
    try:
        for texts, those in zip(blocks, want, strict=True):
            got = [tuple(map(b"".join, zip(*parts, strict=True))) for parts in written.block(texts)]
            assert got == those
            del got
            held.append(tracemalloc.get_traced_memory()[0])
    finally:
        tracemalloc.stop()
    assert replayed.count(True) == 1  # what is frequent is not made again
    assert held[-1] < 1.3 * held[2]  # though all other words are new


def test_an_encoder_keeps_a_bounded_part_of_a_long_text(monkeypatch):
    monkeypatch.setattr(byte_bpe, "STRETCH", 500)
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 50)
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b" ab": 257}
    written = byte_bpe.Written(byte_bpe.Codec(ranks, r" ?[^\s]+|\s+"), lambda i: b" %d" % i)
    text = " ".join(f"ab{i}" for i in range(3_000))
    (parts,) = written.block([text])
    assert b"".join(b for _, b in parts).decode() == text
    assert max(map(len, (written.codec.cache.young, written.codec.cache.old))) < 300
