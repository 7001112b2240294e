"""Substring dedup by seed and extend: winnowed anchors, extension both ways, maximal repeats.

A window of ``length`` words is a repeat if its word sequence starts anywhere else, in
the same document or another. Every word that a repeated window covers goes.

Seeds. In each window the rightmost smallest digest of its GRAM-word runs is the
window's anchor, so equal windows have the same anchor at the same place. The windows
that share an anchor occurrence are consecutive: one row stands for all of them.
Only anchors whose digest occurs twice go on; this join drops almost all rows.

Extension. An anchor's block is all the text that its windows cover, to both sides. Where
blocks agree, all their windows are repeats, and a block is counted, never paired:
a passage in a third of all documents is one row with a large count. Where an anchor has
several blocks (the edges of repeats) one copy of each block is extended window by
window, again by counting. Overlapping repeats then merge into maximal ones. The work is
linear in the text, and no step holds a group in one task: counts are partial sums, and
the joins back are plain equi-joins that adaptive execution splits where keys are hot.

Texts are stored once, without copies, bucketed by digest, so that the two joins of
positions to texts move positions only.

Defined cases: a null text has no words; null and repeated ids are allowed, every row
gets its result; texts shorter than a window stay whole, even if repeated; an empty table gives an empty
result; columns that are not asked for are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, mapped, slices
from quern.plans.scratch import bucketed, release, stored

LENGTH = 35
GRAM = 8
#: Bytes whose words are digested at a time.
BYTES = 1_000_000

ANCHORS = "anchor long, block long, g1 long, x long, y int"
WINDOWS = "anchor long, w long, g1 long, x long, single boolean"
DIGESTS = "g1 long, lo int, n_words long, n_removed long, kept_sha256 string"

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = tuple(_U(int.from_bytes(hashlib.sha256(b"substring %d" % i).digest()[:8], "big") | 1) for i in range(8))
_BYTE = np.array([int.from_bytes(hashlib.sha256(b"byte %d" % i).digest()[:8], "big") for i in range(256)], _U)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _ODD[0]
    h = (h ^ (h >> _U(29))) * _ODD[1]
    return h ^ (h >> _U(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    p = np.full(n + 1, base, _U)
    p[0] = 1
    return np.cumprod(p, dtype=_U)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that stand end to end in data."""
    space = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[offsets] = True
    start = ~space & (head[:-1] | np.r_[True, space[:-1]])
    end = ~space & (head[1:] | np.r_[space[1:], True])
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each word, in slices of about BYTES."""
    out = np.empty(len(starts), _U)
    if not len(starts):
        return out
    cuts = np.unique(np.r_[np.searchsorted(starts, np.arange(0, int(ends[-1]), BYTES)), len(starts)])
    for lo, hi in zip(np.r_[0, cuts], cuts, strict=False):
        if lo == hi:
            continue
        sizes = ends[lo:hi] - starts[lo:hi]
        first = np.cumsum(sizes) - sizes
        inner = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        values = _BYTE[data[np.repeat(starts[lo:hi], sizes) + inner]] * _powers(_ODD[2], int(sizes.max()))[inner]
        out[lo:hi] = np.add.reduceat(values, first) + sizes.astype(_U) * _ODD[3]
    return _mixed(out)


class Sequence:
    """Digests of word runs of any length, by prefix sums of a polynomial."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        low = _powers(_ODD[4], n)
        self.sums = np.r_[_U(0), np.cumsum(_mixed(words ^ _ODD[7]) * low[:n], dtype=_U)]
        inverse = _U(pow(int(_ODD[4]), -1, 1 << 64))
        self.back = _powers(inverse, n)

    def run(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        size = np.asarray(size)
        return _mixed((self.sums[start + size] - self.sums[start]) * self.back[start] + size.astype(_U) * _ODD[5])


def _anchors(words: np.ndarray, doc: np.ndarray, length: int, gram: int):
    """(anchor position, first window, last window) of every run of windows that share an anchor; the anchors' digests."""
    n = len(words)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, np.empty(0, _U)
    powers = _powers(_ODD[6], gram)
    grams = sum((words[j : n - gram + 1 + j] * powers[j] for j in range(1, gram)), words[: n - gram + 1] * powers[0])
    value = _mixed(grams)
    best, at, width, most = value, np.arange(len(value)), 1, length - gram + 1
    while width < most:
        step = min(width, most - width)
        right = best[step:] <= best[:-step]
        best, at = np.where(right, best[step:], best[:-step]), np.where(right, at[step:], at[:-step])
        width += step
    starts = np.flatnonzero(doc[length - 1 :] == doc[: n - length + 1])
    if not len(starts):
        return none, none, none, np.empty(0, _U)
    chosen = at[starts]
    new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    return chosen[new], starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]], value[chosen[new]]


def _laid_out(texts: pa.Array):
    """The bytes of a string array, text offsets, word starts and ends, each word's text and each text's first word."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    starts, ends = word_spans(data, offsets)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return data, offsets, starts, ends, doc, np.searchsorted(starts, offsets[:-1])


def _covered(n: int, starts, spans, length: int) -> np.ndarray:
    """Which of n words a window from one of the runs of window starts covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + spans + length, n), -1)
    return np.cumsum(edge)[:n] > 0


def _keys(text: str):
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return body, F.xxhash64(body), F.shiftright(F.xxhash64(F.lit("lo"), body), 32).cast("int")


def texts_and_runs(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Two tables as stored: (g1, lo, text, copies) of each distinct text; (g1, lo, runs) of those with repeated windows."""
    body, g1, lo = _keys(text)
    once = docs.select(g1.alias("g1"), lo.alias("lo"), body.alias("text")).groupBy("g1", "lo").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = bucketed(once, "texts", ["g1", "lo"])
    schema = arrow_schema(ANCHORS)

    def seeds(batches):
        for whole in batches:
            for b in slices(whole, 2, 2_000_000):
                data, offsets, starts, ends, doc, first = _laid_out(b.column(2))
                words = word_digests(data, starts, ends)
                at, s, e, digest = _anchors(words, doc, length, gram)
                if not len(at):
                    continue
                block = Sequence(words).run(s, e - s + length) + (at - s).astype(_U) * _ODD[1]
                d = doc[s]
                high = b.column(1).to_numpy().astype(np.int64)[d] << 32
                yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), pa.array(block.view(np.int64)), pa.array(b.column(0).to_numpy()[d]), pa.array(high | (s - first[d])), pa.array((e - s).astype(np.int32))], schema=schema)

    anchors = stored(mapped(texts.select("g1", "lo", "text"), seeds, ANCHORS), "anchors")
    # Each side of the joins below is a table as it stands, so that adaptive execution can split hot keys.
    twice = stored(anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "twice")
    seeds_ = stored(anchors.join(twice, "anchor", "left_semi"), "seeds")
    release(anchors, twice)
    blocks = stored(seeds_.groupBy("anchor", "block").agg(F.count("*").alias("n"), F.min(F.struct("g1", "x", "y")).alias("rep")), "blocks")
    kinds = stored(blocks.groupBy("anchor").count().where("count > 1").select("anchor"), "kinds")
    edges = blocks.join(kinds, "anchor", "left_semi").select("rep.g1", F.shiftright("rep.x", 32).cast("int").alias("lo"), F.struct((F.col("rep.x").bitwiseAND(0xFFFFFFFF)).cast("int").alias("s"), F.col("rep.y").alias("y"), (F.col("n") == 1).alias("single"), "anchor").alias("edge"))
    wanted = edges.groupBy("g1", "lo").agg(F.collect_list("edge").alias("edges"))  # at most a text's own anchors
    w_schema = arrow_schema(WINDOWS)

    def extend(batches):
        for whole in batches:
            for b in slices(whole, 2, 2_000_000):
                data, offsets, starts, ends, doc, first = _laid_out(b.column(2))
                sequence = Sequence(word_digests(data, starts, ends))
                lists = b.column(3)
                many = np.diff(lists.offsets.to_numpy())
                e = lists.flatten()
                d = np.repeat(np.arange(b.num_rows), many)
                s, y, single, anchor = (e.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                n = y + 1
                row = np.repeat(np.arange(len(s)), n)
                at = s[row] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                w = sequence.run(first[d[row]] + at, length)
                high = b.column(1).to_numpy().astype(np.int64)[d[row]] << 32
                yield pa.RecordBatch.from_arrays([pa.array(anchor[row]), pa.array(w.view(np.int64)), pa.array(b.column(0).to_numpy()[d[row]]), pa.array(high | at), pa.array(single[row])], schema=w_schema)

    windows = stored(mapped(texts.join(wanted, ["g1", "lo"]).select("g1", "lo", "text", "edges"), extend, WINDOWS), "windows")
    again = stored(windows.groupBy("anchor", "w").count().where("count > 1").select("anchor", "w"), "again")
    whole_blocks = seeds_.join(blocks.where("n > 1").select("anchor", "block"), ["anchor", "block"], "left_semi").select("g1", "x", "y")
    lone = windows.where("single").join(again, ["anchor", "w"], "left_semi").select("g1", "x", F.lit(0).alias("y"))
    found = whole_blocks.union(lone).select("g1", F.shiftright("x", 32).cast("int").alias("lo"), F.struct(F.col("x").bitwiseAND(0xFFFFFFFF).cast("int").alias("s"), "y").alias("run"))
    runs = stored(found.groupBy("g1", "lo").agg(F.collect_list("run").alias("runs")), "runs")
    release(seeds_, blocks, kinds, windows, again)
    return texts, runs


def _joined(texts: DataFrame, runs: DataFrame) -> DataFrame:
    return texts.join(runs, ["g1", "lo"], "left").select("g1", "lo", "text", "copies", "runs")


def texts_and_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(g1, lo, text, copies, runs): each distinct text with the runs (first window start, more starts) of its repeated windows."""
    return _joined(*texts_and_runs(docs, text, length, gram))


def _removed(n: int, copies: int, runs, length: int) -> np.ndarray | None:
    """Which of a text's n words go; None if none does."""
    if n >= length and copies > 1:
        return np.ones(n, bool)
    if not runs:
        return None
    return _covered(n, np.array([r["s"] for r in runs]), np.array([r["y"] for r in runs]), length)


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    schema = arrow_schema(DIGESTS)

    def run(batches):
        for b in (part for whole in batches for part in slices(whole, 2, 4_000_000)):
            rows = []
            for x, copies, runs in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                words = x.encode().split()
                gone = _removed(len(words), copies, runs, length)
                kept = words if gone is None else list(compress(words, (~gone).tolist()))
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[2:], strict=True))], schema=schema)

    _, g1, lo = _keys(text)
    judged = stored(mapped(texts_and_repeats(docs, text, length, gram), run, DIGESTS), "judged")
    rows = docs.select(F.col(id_col).alias("doc_id"), g1.alias("g1"), lo.alias("lo"))
    return rows.join(judged, ["g1", "lo"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All rows and columns of docs; the text without the words of repeated windows, what stays keeps its own white space."""
    schema = arrow_schema("g1 long, lo int, kept string")

    def run(batches):
        for b in (part for whole in batches for part in slices(whole, 2, 4_000_000)):
            out = []
            for x, copies, runs in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if not runs and copies == 1:
                    out.append(x)
                    continue
                raw = x.encode()
                starts, ends = word_spans(np.frombuffer(raw, np.uint8), np.array([0]))
                gone = _removed(len(starts), copies, runs, length)
                if gone is None:
                    out.append(x)
                    continue
                turn = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8)))  # kept stretches from turn[0::2] to turn[1::2]
                parts = [raw[starts[a] : ends[z - 1]] for a, z in zip(turn[0::2], turn[1::2], strict=True)]
                out.append(b"\n".join(parts).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, schema.field(2).type)], schema=schema)

    _, g1, lo = _keys(text)
    texts, runs = texts_and_runs(docs, text, length, gram)
    kept = stored(mapped(_joined(texts, runs), run, "g1 long, lo int, kept string"), "kept")
    release(texts, runs)
    others = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(F.lit(0).alias("q_0"), *(F.col(f"`{c}`") for c in others)).alias("q_row"), F.col(f"`{text}`").isNull().alias("q_null"), g1.alias("g1"), lo.alias("lo"))
    joined = rows.join(kept, ["g1", "lo"])
    return joined.select(*((F.when(~F.col("q_null"), F.col("kept")).alias(c) if c == text else F.col(f"q_row.`{c}`").alias(c)) for c in docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    return digests(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), p AS (
  SELECT k, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM d
), win AS (
  SELECT k, i, md5(array_to_string(ws[i : i + {LENGTH - 1}], ' ')) AS h
  FROM (SELECT k, ws, unnest(range(1, len(ws) - {LENGTH - 2})) AS i FROM d WHERE len(ws) >= {LENGTH})
), rep AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1
), gone AS (
  SELECT DISTINCT k, i + j AS i FROM rep, range({LENGTH}) t(j)
), kept AS (
  SELECT k, string_agg(w, ' ' ORDER BY i) AS body, count(*) AS n FROM p ANTI JOIN gone USING (k, i) GROUP BY k
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (k)
"""
