"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. Its features are its own form (symbols, capitals,
repeats, word lengths) and that of the lines before and after it; the field adds what a
neighbour's state says. Forward-backward marginals, weighted by line length, are the
document's quality, and a logistic curve maps that to the chance of label 1.

The field is fitted on a bounded sample: at most SAMPLE_ROWS labelled rows of each class that have at most
TEXT_LINES lines, the first of them whose lines add up to SAMPLE_LINES; a document's label holds for all its lines. The curve is fitted
on raw scores from FIT_FOLDS fields, none of which has seen the text or a copy of it. Every
document is scored over its whole text.

Defined cases: a null text and one without words have no line and score the share of label
1 among all labelled rows that may be learned from (0.5 if there are none); a null id is
not held out; repeated rows are scored one by one; an empty table gives an empty result;
columns that are not asked for are ignored; of rows with one id and several texts the smallest text is learned from.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, column, mapped, slices
from quern.llm.crf import Crf
from quern.llm.labelled import Platt, class_weights, remainder, sample
from quern.plans.scratch import release, stored

SAMPLE_ROWS = 3000
TEXT_LINES, SAMPLE_LINES = 2000, 300_000
FIT_FOLDS = 3
FOLDS = 5
THRESHOLD = 0.3

_SYMBOLS = "#*$%&|<>{}[]=_~^@\\/+"
_N = 16
MADE = "doc_id string, y int, n int, own binary, size binary"
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_lines long"


def line_features(lines: list[str]) -> np.ndarray:
    """(lines, _N) numbers of about 0 to 1."""
    times = Counter(lines)
    out = np.empty((len(lines), _N))
    for i, x in enumerate(lines):
        words = x.split()
        n, size = len(words) or 1, len(x)
        symbols = sum(map(x.count, _SYMBOLS)) / n
        bangs = x.count("!") / n
        upper = sum(map(str.isupper, words)) / n
        near = sum(map(operator.eq, words, words[1:])) / n
        kinds = len(set(words)) / n
        digits = sum(map(x.count, "0123456789")) / size
        out[i] = (
            1.0, min(n, 200) / 200, min(1.0, symbols), symbols > 0.3, min(1.0, bangs), bangs > 0.3, upper, upper > 0.4,
            near, near > 0.2, (1 - kinds) * min(1, n / 20), n >= 20 and kinds < 0.25, digits, times[x] > 1, min(1.0, size / n / 20), x[-1] in ".!?:;\"'",
        )
    return out


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line that has a word, with its neighbours' beside its own, and the lines' lengths."""
    lines = [y for x in text.split("\n") if (y := x.strip())]
    if not lines:
        return np.empty((0, 3 * _N)), np.empty(0)
    own = line_features(lines)
    none = np.zeros((1, _N))
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none])]), np.array([len(x) for x in lines], float)


class Model:
    """A fitted field, its calibration and the score of texts without lines."""

    def __init__(self, crf: Crf, curve: Platt, prior: float):
        self.crf, self.curve, self.prior = crf, curve, prior

    def raw(self, x: np.ndarray, weight: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals; lengths: lines of each text, all above 0."""
        at = np.cumsum(lengths) - lengths
        return np.add.reduceat(self.crf.marginals(x, lengths) * weight, at) / np.add.reduceat(weight, at)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(score, lines) of each text."""
        found = [features(t or "") for t in texts]
        lengths = np.array([len(w) for _, w in found], np.int64)
        out = np.full(len(texts), self.prior)
        full = lengths > 0
        if full.any():
            out[full] = self.curve(self.raw(np.vstack([x for x, _ in found]), np.concatenate([w for _, w in found]), lengths[full]))
        return out, lengths


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS, lines: int = SAMPLE_LINES) -> Model:
    """Fit on labelled rows outside the held-out fold. The executors make the features; the driver gets lines * (_N + 1) numbers at most."""
    chosen, counts = sample(docs, labels, label, remainder("doc_id", FOLDS) != 0, {0: rows, 1: rows}, id_col, text)
    schema = arrow_schema(MADE)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 1, 2_000_000):
                out = []
                for i, x, y in zip(*(column(b, k) for k in range(3)), strict=True):
                    f, w = features(x)
                    if 0 < len(w) <= TEXT_LINES:
                        out.append((i, y, len(w), f[:, :_N].astype(np.float32).tobytes(), w.astype(np.float32).tobytes()))
                cols = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    made = stored(mapped(chosen.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y"), run, MADE), "features")
    sizes = sorted((r["h"], r["doc_id"], r["n"]) for r in made.select(F.xxhash64("doc_id").alias("h"), "doc_id", "n").collect())  # at most 2 * rows
    within = {i for (_, i, _), n in zip(sizes, np.cumsum([n for *_, n in sizes]), strict=True) if n <= lines}
    keep = made if len(within) == len(sizes) else made.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in sorted(within)], "doc_id string")), "doc_id", "left_semi")
    got = keep.select("y", "own", "size").collect()
    release(made)
    got.sort(key=lambda r: (r["y"], bytes(r["own"]), bytes(r["size"])))  # whatever order the rows come in, the same model
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    none = Platt(np.array([]), np.array([]), np.array([]))
    if len({r["y"] for r in got}) < 2:
        return Model(Crf(3 * _N), none, prior)
    own = [np.frombuffer(r["own"], np.float32).reshape(-1, _N).astype(float) for r in got]
    size = [np.frombuffer(r["size"], np.float32).astype(float) for r in got]
    y = np.array([r["y"] for r in got])
    fold = np.array([zlib.crc32(r["own"]) % FIT_FOLDS for r in got])
    raw = np.full(len(y), np.nan)
    for f in range(FIT_FOLDS):
        held = np.flatnonzero(fold == f)
        if len(held) and len(set(y[fold != f].tolist())) == 2:
            raw[held] = Model(_field(own, y, np.flatnonzero(fold != f)), none, prior).raw(*_stacked(own, size, held))
    seen = ~np.isnan(raw)
    return Model(_field(own, y, np.arange(len(y))), Platt(raw[seen], y[seen], class_weights(y, counts)[seen]), prior)


def _stacked(own: list[np.ndarray], size: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features with those of the neighbouring lines beside them, line sizes and numbers of lines of some texts, end to end."""
    x = np.empty((sum(len(own[i]) for i in rows), 3 * _N))
    at = 0
    for i in rows:
        o = own[i]
        part = x[at : at + len(o)]
        part[:, :_N], part[0, _N : 2 * _N], part[-1, 2 * _N :] = o, 0, 0
        part[1:, _N : 2 * _N], part[:-1, 2 * _N :] = o[:-1], o[1:]
        at += len(o)
    return x, np.concatenate([size[i] for i in rows]), np.array([len(own[i]) for i in rows])


def _field(own: list[np.ndarray], y: np.ndarray, rows: np.ndarray) -> Crf:
    crf, y = Crf(3 * _N), y[rows]
    x, _, lengths = _stacked(own, own, rows)
    crf.fit(x, lengths, y, np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())))
    return crf


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_lines."""
    schema = arrow_schema(SCHEMA)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 2, 4_000_000):
                score, lines = model.scores(column(b, 2))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(lines)], schema=schema)

    held = F.coalesce(remainder(id_col, FOLDS) == 0, F.lit(False))
    return mapped(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held.alias("held_out"), F.col(f"`{text}`").cast("string").alias("text")), run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    docs = table(spark, sf_dir, "documents")
    return scored(docs, trained(docs, table(spark, sf_dir, "labels")))
