"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are the first STEM letters of a text's words, lower-cased and bare of outer punctuation: they carry a stem
through its inflections. A letter alone is no term. Every term of every example is in
the vectors; its weight is log frequency times idf times GROUND plus its evidence, the likelihood ratio of
a term that leans to the toxic class, cut off at FULL. Background words so weigh little beside telling ones, and
none is removed. Texts are compared by the cosine of these vectors with every example of both
classes through a block-max inverted index, the K nearest vote with weights
1 / (distance + NEAR), and a logistic curve gives the score. The nearest toxic examples are returned as evidence.

The curve is fitted out of sample: examples are cut into FIT_FOLDS folds by their smallest shingle digest, so that
copies share one, and each fold is scored by weights, idf and an index that come from the others.

Examples are a bounded sample: at most SAMPLE_TOXIC labelled rows of class 1 and
SAMPLE_OTHER of class 0, the first of them whose terms add up to SAMPLE_TERMS. In a term's evidence, examples that
share their smallest shingle digest count as one, so that a copied text does not turn its words into
evidence; all stay in the index. What is collected and broadcast so has a fixed bound.

Defined cases: a null or empty text, or one without any term of the examples, has no neighbour
and scores the share of toxic ones among examples without terms; a null id is
not held out; repeated rows are scored one by one; of rows with one id and several texts the smallest text is learned
from; an empty table gives an empty result; columns that are not asked for are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, column, mapped, slices
from quern.llm.block_max import BlockMaxIndex
from quern.llm.labelled import Platt, class_weights, remainder, sample
from quern.plans.scratch import release, stored

SAMPLE_TOXIC = 1000
SAMPLE_OTHER = 2000
SAMPLE_TERMS = 4_000_000
FOLDS, HELD_OUT = 4, 2
FIT_FOLDS = 5
THRESHOLD = 0.3
GROUND, FULL = 0.02, 20.0
K, NEAR = 16, 0.05
STEM = 4

_OUTER = string.punctuation + "¡¿«»„“”‘’…–—"
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, evidence array<long>"
VECTORS = "doc_id long, y int, copy long, terms array<string>, counts array<int>"


def stems(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of the text, term) of every word of at least two letters or digits, in order."""
    words = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    many = pc.list_value_length(words).to_numpy()
    terms = pc.utf8_slice_codeunits(pc.utf8_trim(words.flatten(), _OUTER), 0, STEM)
    long = pc.greater(pc.utf8_length(terms), 1)
    return np.repeat(np.arange(len(texts)), many)[long.to_numpy(zero_copy_only=False)], terms.filter(long)


def _copy(text: str) -> int:
    """The smallest digest of a text's three-word runs: near copies share it."""
    import xxhash

    words = text.lower().encode().split()
    runs = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [words]
    return min(map(xxhash.xxh64_intdigest, map(b" ".join, runs))) - 2**63


class Examples:
    """Rows of (example, number of a term, count), sorted by example, with labels: what vectors are made from."""

    def __init__(self, ids: np.ndarray, y: np.ndarray, copy: np.ndarray, row: np.ndarray, names: list[str], term: np.ndarray, count: np.ndarray):
        self.ids, self.y, self.copy, self.row, self.names, self.term, self.count = ids, y, copy, row, names, term, count

    def term_weights(self, chosen: np.ndarray) -> np.ndarray:
        """Weight of each term, from the chosen examples (mask): idf times ground and evidence."""
        n, terms = int(chosen.sum()), len(self.names)
        keep = chosen[self.row]
        row, term = self.row[keep], self.term[keep]
        idf = np.log((n + 1) / (np.bincount(term, minlength=terms) + 0.5)).clip(0)
        _, alike, many = np.unique(self.copy[chosen] * 2 + self.y[chosen], return_inverse=True, return_counts=True)
        part = np.zeros(len(chosen))
        part[chosen] = 1 / many[alike]
        p, q = (np.bincount(term, part[row] * (self.y[row] == c), terms) for c in (1, 0))
        n1, n0 = (max(1e-9, float(part[self.y == c].sum())) for c in (1, 0))
        share = (p + q) / (n1 + n0)
        g = 2 * (_excess(p, share * n1) + _excess(q, share * n0) + _excess(n1 - p, (1 - share) * n1) + _excess(n0 - q, (1 - share) * n0))
        leans = (p + 0.5) / (n1 + 1) > (q + 0.5) / (n0 + 1)
        return idf * (GROUND + np.clip(np.where(leans, g, 0), 0, FULL) / FULL)

    def index(self, weights: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, BlockMaxIndex]:
        """(numbers of the chosen examples in the index's order, the index)."""
        keep = chosen[self.row]
        row, term = self.row[keep], self.term[keep]
        w = (1 + np.log(self.count[keep])) * weights[term]
        norm = np.sqrt(np.bincount(row, w * w, len(chosen)))
        w = w / np.where(norm > 0, norm, 1)[row]
        # Blocks are of examples whose weight stands on the same common term; such bounds are narrow.
        df = np.bincount(term, minlength=len(self.names))
        best = np.lexsort((term, -w * df[term], row))
        lead = np.full(len(chosen), -1)
        first = best[np.r_[True, row[best][1:] != row[best][:-1]]] if len(best) else best
        lead[row[first]] = term[first]
        numbers = np.flatnonzero(chosen)
        numbers = numbers[np.lexsort((self.ids[numbers], lead[numbers]))]
        place = np.full(len(chosen), -1)
        place[numbers] = np.arange(len(numbers))
        return numbers, BlockMaxIndex(len(numbers), len(self.names), place[row], term, w)


def _excess(k: np.ndarray, expected: np.ndarray) -> np.ndarray:
    return np.where(k > 1e-12, k * np.log(np.where(k > 1e-12, k, 1) / np.where(expected > 0, expected, 1)), 0)


class Model:
    """Vocabulary, index, labels and calibration."""

    def __init__(self, examples: Examples, chosen: np.ndarray, class_weight: np.ndarray):
        self.names, self.term_weight = examples.names, examples.term_weights(chosen)
        order, self.index = examples.index(self.term_weight, chosen)
        self.ids, self.y, self.weight = examples.ids[order], examples.y[order], class_weight[order]
        total = self.weight.sum()
        self.base = float((self.weight * self.y).sum() / total) if total else 0.5
        bare = ~np.isin(order, examples.row)
        self.alone = float(((self.weight * self.y)[bare].sum() + self.base) / (self.weight[bare].sum() + 1))
        self.curve = Platt(np.array([]), np.array([]), np.array([]))
        self.vocabulary: pa.Array | None = None

    def vectors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, weight): the unit vectors of the texts over the examples' terms, sorted by text."""
        if self.vocabulary is None:
            self.vocabulary = pa.array(self.names, pa.string())
        row, found = stems(texts)
        at = pc.index_in(found, value_set=self.vocabulary)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        keys, counts = np.unique(row[known] * max(1, len(self.names)) + at.drop_null().to_numpy(), return_counts=True)
        return self.unit(keys // max(1, len(self.names)), keys % max(1, len(self.names)), counts, len(texts))

    def unit(self, row: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = (1 + np.log(counts)) * self.term_weight[terms]
        keep = w > 0
        row, terms, w = row[keep], terms[keep], w[keep]
        return row, terms, w / np.sqrt(np.bincount(row, w * w, n))[row]

    def votes(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(raw score, NaN without a neighbour; neighbours nearest first) of each of n vectors."""
        raw, nearest = np.full(n, np.nan), []
        for i, (near, cosine) in enumerate(self.index.top(row, terms, weights, n, K)):
            w = self.weight[near] / (np.clip(1 - cosine, 0, 1) + NEAR)
            if len(near):
                raw[i] = ((w * self.y[near]).sum() + self.base) / (w.sum() + 1)
            nearest.append(near)
        return raw, nearest

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, list[list[int]]]:
        raw, nearest = self.votes(*self.vectors(texts), len(texts))
        evidence = [self.ids[near[self.y[near] == 1][:3]].tolist() for near in nearest]
        return np.where(np.isnan(raw), self.alone, self.curve(np.nan_to_num(raw, nan=0.5))), evidence


def fitted(examples: Examples, counts: dict[int, int]) -> Model:
    """The model of all examples, its curve fitted on votes of models that have not seen the example's fold."""
    everything = np.ones(len(examples.y), bool)
    weight = class_weights(examples.y, counts)
    model = Model(examples, everything, weight)
    raw = np.full(len(examples.y), np.nan)
    fold = examples.copy % FIT_FOLDS
    for f in np.unique(fold).tolist():
        part, held = Model(examples, fold != f, weight), np.flatnonzero(fold == f)
        if part.index.n:
            keep = (fold == f)[examples.row]
            raw[held] = part.votes(*part.unit(np.searchsorted(held, examples.row[keep]), examples.term[keep], examples.count[keep], len(held)), len(held))[0]
    seen = ~np.isnan(raw)
    model.curve = Platt(raw[seen], examples.y[seen], weight[seen])
    model.index.opened = model.index.skipped = 0
    return model


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text") -> Model:
    """Fit on labelled rows outside the held-out fold; the driver holds at most SAMPLE_TERMS numbers of the sample."""
    chosen, counts = sample(docs, labels, label, remainder("doc_id", FOLDS) != HELD_OUT, {0: SAMPLE_OTHER, 1: SAMPLE_TOXIC}, id_col, text)
    schema = arrow_schema(VECTORS)

    def vectors(batches):
        for whole in batches:
            for b in slices(whole, 1, 2_000_000):
                row, terms = stems(b.column(1))
                terms = terms.dictionary_encode()
                size = max(1, len(terms.dictionary))
                keys, times = np.unique(row * size + terms.indices.to_numpy(), return_counts=True)
                ends = pa.array(np.searchsorted(keys, np.arange(b.num_rows + 1) * size), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x) for x in (terms.dictionary.take(pa.array(keys % size)), pa.array(times, pa.int32()))]
                copies = [_copy(x) for x in column(b, 1)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(copies, pa.int64()), *(x.cast(f.type) for x, f in zip(lists, list(schema)[3:], strict=True))], schema=schema)

    made = stored(mapped(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y"), vectors, VECTORS), "vectors")
    sizes = sorted((r["h"], r["doc_id"], r["n"]) for r in made.select(F.xxhash64("doc_id").alias("h"), "doc_id", F.size("terms").alias("n")).collect())  # at most the sample's rows
    within = int((np.cumsum([n for *_, n in sizes]) <= SAMPLE_TERMS).sum()) if sizes else 0
    last = sizes[min(within, len(sizes) - 1)][:2] if sizes else (0, 0)
    take = made if within == len(sizes) else made.where((F.xxhash64("doc_id") < last[0]) | ((F.xxhash64("doc_id") == last[0]) & (F.col("doc_id") < last[1])))
    got = take.toArrow().combine_chunks().sort_by("doc_id")
    release(made)
    y, ids, copy = (got[c].to_numpy() for c in ("y", "doc_id", "copy"))
    many = got["terms"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False) if len(got) else np.empty(0, np.int64)
    names = pa.chunked_array([x.flatten() for x in got["terms"].chunks], pa.string()).combine_chunks().dictionary_encode()
    count = np.concatenate([x.flatten().to_numpy() for x in got["counts"].chunks] or [np.empty(0, np.int32)])
    row = np.repeat(np.arange(len(y)), many)
    return fitted(Examples(ids, y.astype(np.int64), copy, row, names.dictionary.to_pylist(), names.indices.to_numpy().astype(np.int64), count), counts)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (ids of its nearest toxic examples)."""
    schema = arrow_schema(SCHEMA)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # built from the bounded sample

    def run(batches):
        m = shared.value
        for whole in batches:
            for b in slices(whole, 2):
                score, evidence = m.scores(b.column(2))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(evidence, schema.field(4).type)], schema=schema)

    held = F.coalesce(remainder(id_col, FOLDS) == HELD_OUT, F.lit(False))
    return mapped(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held.alias("held_out"), F.col(f"`{text}`").cast("string").alias("text")), run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    docs = table(spark, sf_dir, "documents")
    return scored(docs, trained(docs, table(spark, sf_dir, "labels")))
