import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = byte_bpe.Codec(RANKS, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=300) | st.text("abtheinr 'sS\n\t0é#", max_size=400))
def test_codec_equals_tiktoken(text):
    ids = OURS.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\u3000", "\x1c", "a", "bc", "it's", "#", "7", ", "]), max_size=40), st.integers(1, 9))
def test_white_space_and_stretches(parts, stretch):
    text, before = "".join(parts), byte_bpe.STRETCH
    byte_bpe.STRETCH = stretch
    try:
        assert OURS.encode(text) == THEIRS.encode_ordinary(text)
    finally:
        byte_bpe.STRETCH = before


def test_replay_defers_to_lower_ranks():
    # merging (a, b) makes a pair of lower rank while more (a, b) wait in the same word
    ranks = {bytes([i]): 1000 + i for i in range(256)} | {b"ab": 50, b"abc": 10, b"abab": 60, b"cab": 20}
    ours = byte_bpe.Codec(ranks, r"(?s).+")
    theirs = tiktoken.Encoding("x", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcab", "ababcab", "cabab", "abababcabc", "ccabab", "abcabcab"):
        assert ours.encode(text) == theirs.encode_ordinary(text)


def test_operators(spark):
    rows = [(1, "The quick  brown\n\nfox's #1", "x"), (2, None, "x"), (None, "", "y"), (1, "The quick  brown\n\nfox's #1", "x"), (5, "é　漢字 " * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, byte_bpe.digests(docs, PATH, P.PATTERN).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = THEIRS.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    enc = byte_bpe.encoded(docs, PATH, P.PATTERN)
    assert {r.doc_id: r.ids for r in enc.collect()}[5] == THEIRS.encode_ordinary(rows[4][1])
    dec = byte_bpe.decoded(enc, PATH, P.PATTERN)
    assert sorted(bytes(r.raw) for r in dec.collect()) == sorted((t or "").encode() for _, t, _ in rows)
    assert byte_bpe.digests(docs.limit(0), PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("n", [4_100_000])
def test_very_long_text(spark, n):
    text = ("lorem 12 " * (n // 9 + 1))[:n]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = byte_bpe.digests(docs, PATH, P.PATTERN).first()
    ids = THEIRS.encode_ordinary(text)
    assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
