import re
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.functions import geometry, text, vectors


def frame(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_every_code_point_counts_as_python_does(spark):
    points = [chr(i) for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF]
    texts = [f"a{c}b" for c in points if c.isspace()] + ["".join(points[k : k + 4096]) for k in range(0, len(points), 4096)]
    df = frame(spark, texts)
    assert column(df, text.word_count(F.col("c"))) == [len(t.split()) for t in texts]
    assert column(df, text.py_strip(F.col("c"))) == [t.strip() for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=60))
def test_random_texts(spark, texts):
    df = frame(spark, texts)
    c = F.col("c")
    assert column(df, text.word_count(c)) == [len(t.split()) for t in texts]
    assert column(df, F.length(text.py_strip(c))) == [len(t.strip()) for t in texts]
    assert column(df, text.strip_end(c)) == [t.rstrip(" .") for t in texts]

    def clean(t):
        t = re.sub(r"[^\w\s]", "", t.lower()).encode("ascii", "ignore").decode()
        return re.sub(r"\s+", " ", re.sub(r"\d+", "", t)).strip()

    assert column(df, text.clean_text(c)) == [clean(t) for t in texts]


def test_nulls_stay_null(spark):
    df = frame(spark, [None])
    for e in (text.word_count, text.py_strip, text.clean_text, text.strip_end, text.one_line):
        assert column(df, e(F.col("c"))) == [None]


def test_tags(spark):
    df = spark.createDataFrame([(0, ["NOUN", "ADJ", "NOUN"]), (1, [])], "i int, c array<string>")
    c = F.col("c")
    assert column(df, text.tag_string(c)) == ["NOUN_ADJ_NOUN_", ""]
    assert column(df, text.tags_of(text.tag_string(c))) == [["NOUN", "ADJ", "NOUN"], []]
    assert column(df, text.signature(c)) == ["ADJ_NOUN", ""]
    assert column(df, text.n_kinds(c)) == [2, 1]
    counts = df.select("i", *text.tag_counts(c).values()).orderBy("i").collect()
    assert (counts[0]["NOUN"], counts[0]["ADJ"], counts[0]["VERB"], counts[1]["NOUN"]) == (2, 1, 0, 0)


def test_uid_halves(spark):
    uids = ["f" * 32, "0" * 31 + "1", "8000000000000000ABCDEFabcdef0123"]
    a, b = text.uid_halves(F.col("c"))
    df = frame(spark, uids)
    assert [int(x) for x in column(df, a)] == [int(u[:16], 16) for u in uids]
    assert [int(x) for x in column(df, b)] == [int(u[16:], 16) for u in uids]
    with pytest.raises(Exception, match="not a 32-digit uid: unknown"):
        column(frame(spark, ["unknown"]), a)


def test_label(spark):
    assert column(frame(spark, ["__label__en", "x", ""]), text.label_of(F.col("c"))) == ["en", "", ""]


def test_resize(spark):
    df = spark.createDataFrame([(0, 1000, 500)], "i int, w int, h int")
    size = lambda mode: tuple(column(df, geometry.resized(F.col("w"), F.col("h"), mode, 100))[0])
    assert {m: size(m) for m in geometry.RESIZE_MODES} == {"no": (1000, 500), "border": (100, 100), "keep_ratio": (200, 100), "keep_ratio_largest": (100, 50), "center_crop": (100, 100)}
    with pytest.raises(ValueError):
        geometry.resized(F.col("w"), F.col("h"), "other")


def test_vectors(spark):
    rng = np.random.default_rng(1)
    x, refs = rng.normal(size=(30, 5)), rng.normal(size=(4, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(30, None), (31, [0.0] * 5)], "i int, c array<double>")
    r = spark.createDataFrame([(v.tolist(),) for v in refs], "v array<double>")

    def lift(v, c):
        t = max(np.sqrt(c) * np.linalg.norm(v), 1e-8)
        s = np.sinh(min(t, np.arcsinh(2**15))) * v / t
        return s, np.sqrt(1 / c + s @ s)

    def residual(a, b, c):
        (xs, xt), (ys, yt) = lift(a, c), lift(b, c)
        n = np.linalg.norm(xs)
        clamp = lambda z: min(max(z, -1 + 1e-8), 1 - 1e-8)
        inner = xs @ ys - xt * yt
        outer = np.arccos(clamp((yt + xt * c * inner) / (n * np.sqrt(max((c * inner) ** 2 - 1, 1e-8)) + 1e-8)))
        return outer - np.arcsin(clamp(0.2 / (np.sqrt(c) * n + 1e-8)))

    for c in (1.0, 0.5):
        got = column(vectors.specificity(df, "c", r, "v", c), "specificity")
        assert got[:30] == pytest.approx([np.mean([residual(t, v, c) for t in refs]) for v in x])
        assert got[30] is None and got[31] is not None
        got = column(vectors.specificity(df, "c", r, "v", c, as_text=True), "specificity")
        assert got[:30] == pytest.approx([np.mean([residual(v, t, c) for t in refs]) for v in x])
        e = df.orderBy("i").select(vectors.expm(F.col("c"), c).alias("e")).collect()
        assert e[3]["e"]["space"] == pytest.approx(lift(x[3], c)[0].tolist()) and e[3]["e"]["time"] == pytest.approx(lift(x[3], c)[1])
    cos = column(df, vectors.cosine(F.col("c"), F.lit(x[0].tolist())))
    assert cos[0] == pytest.approx(1) and cos[30] is None and cos[31] is None
    with pytest.raises(ValueError, match="empty"):
        vectors.specificity(df, "c", r.limit(0), "v")
