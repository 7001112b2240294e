"""One document of each group of near copies: five-word shingles with a Jaccard of 0.8 or more.

Texts with the same set of shingles are one node from the start. Candidates are the links of a SimHash
index over distinct words and all pairs of nodes that agree in one of BANDS bands of ROWS
minimum digests; a pair of similarity s shares no band with probability (1 - s ** ROWS) ** BANDS,
1.3e-7 at 0.8 and less above. Every candidate is then held against the exact Jaccard of its
shingle sets, and only confirmed pairs link to components.

Candidates are confirmed in two rounds. The first pairs each node with the smallest of its band;
what that links is contracted. The second takes the bands whose nodes are still apart: nodes that such bands connect
make a cell, cells are cut into blocks, and every two blocks of a cell meet in one task, where the pairs of a common
band that are still apart are held against each other. Sets so travel once per block, never once per pair.

Defined cases: words are cut at ASCII white space and compared in ASCII lower case; a text of fewer than five
words is one shingle; null and blank texts have none and are alike; repeated rows are one;
an empty table gives an empty result; columns that are not asked for are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import simhash
from quern.llm.batches import arrow_schema, column, mapped, positional, slices
from quern.llm.components import representatives
from quern.plans.scratch import release, stored
from quern.plans.shipping import ship

SHINGLE = 5
#: Least similarity of a link, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, ROWS = 40, 5
#: Shingles whose digests under all functions are worked out at a time.
CHUNK = 2048
#: Nodes of a cell that make a block.
BLOCK = 128

_RNG = np.random.default_rng(simhash.SEED)
_ODD = _RNG.integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**64, BANDS * ROWS, np.uint64)
_PLACE = _RNG.integers(0, 2**64, SHINGLE, np.uint64) | np.uint64(1)
_ROW = _RNG.integers(0, 2**64, ROWS, np.uint64) | np.uint64(1)
_BAND = _RNG.integers(0, 2**64, BANDS, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_digests(text: str | None) -> np.ndarray:
    import xxhash

    words = (text or "").encode().lower().split()
    return np.fromiter((xxhash.xxh64_intdigest(w, simhash.SEED) for w in words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """The distinct shingles' 64-bit digests in order, from the words' digests."""
    n = min(len(words), SHINGLE)
    if not n:
        return words
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out += words[k : len(words) - n + 1 + k] * _PLACE[k]
    return np.unique(_mix(out))


def node_of(marks: np.ndarray) -> int:
    """A signed digest of a set of shingles."""
    import xxhash

    return xxhash.xxh64_intdigest(marks.tobytes(), simhash.SEED) - 2**63


def bands(marks: np.ndarray) -> np.ndarray:
    """A key for each band of minimum digests."""
    if not len(marks):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for lo in range(0, len(marks), CHUNK):
        h = np.multiply.outer(_ODD, marks[lo : lo + CHUNK])
        h += _ADD[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    return _mix((least.reshape(BANDS, ROWS) * _ROW).sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles reach the least similarity; exact."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def nodes_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(node, first, t, code, n, keys): each set of shingles, its smallest id, a digest of one of its texts, its fingerprint, size and band keys."""
    spec = "doc_id long, t long, node long, code long, n long, keys array<long>"
    schema = arrow_schema(spec)

    def run(batches):
        for b in batches:
            out = []
            for x in column(b, 2):
                words = word_digests(x)
                marks = shingles(words)
                out.append((node_of(marks), simhash.majority(np.unique(words)), len(marks), bands(marks)))
            node, code, n, keys = zip(*out, strict=True) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.int64()), pa.array(np.array(code, np.uint64).view(np.int64)), pa.array(n, pa.int64()), pa.array(keys, schema.field(5).type)], schema=schema)

    col = F.col(f"`{text}`").cast("string")
    marked = mapped(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(col).alias("t"), col.alias("text")), run, spec)
    return marked.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("t").alias("t"), *(F.first(c).alias(c) for c in ("code", "n", "keys")))


def sets_of(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(node, n, marks): the shingles of the texts whose digests are in wanted (t)."""
    spec = "node long, n long, marks array<long>"
    schema = arrow_schema(spec)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 0, 2_000_000):
                sets = [shingles(word_digests(x)) for x in column(b, 0)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in sets], pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array([x.view(np.int64) for x in sets], schema.field(2).type)], schema=schema)

    col = F.col(f"`{text}`").cast("string")
    texts = docs.select(col.alias("text"), F.xxhash64(col).alias("t")).join(wanted, "t", "left_semi").groupBy("t").agg(F.min("text").alias("text"))
    return mapped(texts.select("text"), run, spec)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) of nodes whose sets are alike."""
    schema = arrow_schema("a long, b long")

    def run(batches):
        for r in batches:
            x, y = ((c.values.to_numpy().view(np.uint64), c.offsets.to_numpy()) for c in (r.column(2), r.column(3)))
            ok = [alike(x[0][x[1][i] : x[1][i + 1]], y[0][y[1][i] : y[1][i + 1]]) for i in range(r.num_rows)]
            yield pa.RecordBatch.from_arrays([r.column(0), r.column(1)], schema=schema).filter(pa.array(ok, pa.bool_()))

    sizes = sets.select("node", "n")
    # Sizes first: they rule pairs out, and cost less to join than the sets.
    sized = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").where(_near_in_size("na", "nb")).select("a", "b")
    one = sets.select(F.col("node").alias("a"), F.col("marks").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("marks").alias("y"))
    return mapped(stored(sized, "sized").join(one, "a").join(other, "b").select("a", "b", "x", "y"), run, "a long, b long")


def _near_in_size(a: str, b: str):
    return DENOMINATOR * F.least(a, b) >= NUMERATOR * F.greatest(a, b)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def edges(docs: DataFrame, nodes: DataFrame, text: str, limit: int) -> DataFrame:
    """nodes: stored. Gives (a, b): links between nodes that span every component."""
    codes = stored(nodes.groupBy("code").agg(F.min("node").alias("head")), "codes")
    linked = simhash.links(codes.select("code"), limit)
    heads = lambda c, k: codes.select(F.col("code").alias(c), F.col("head").alias(k))
    by_code = nodes.select("node", "code").join(codes, "code").select(F.col("head").alias("a"), F.col("node").alias("b"))
    by_bits = linked.toDF("ca", "cb").join(heads("ca", "a"), "ca").join(heads("cb", "b"), "cb").select("a", "b")
    keyed = stored(nodes.select("node", "n", F.explode("keys").alias("key")), "bands")
    shared = keyed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("many")).where("many > 1").select("key", "head")
    live = stored(keyed.join(shared, "key"), "live")
    first = stored(_ordered(by_code.union(by_bits).union(live.select(F.col("head").alias("a"), F.col("node").alias("b")))), "candidates")
    in_pairs = first.select(F.explode(F.array("a", "b")).alias("node")).union(live.select("node")).distinct()
    sets = stored(sets_of(docs, stored(nodes.join(in_pairs, "node", "left_semi").select("t"), "wanted"), text), "sets")
    links = stored(confirmed(first, sets), "links")
    reps = stored(representatives(links), "reps").toDF("node", "rep")
    apart = stored(live.join(reps, "node", "left").select("key", "node", "n", F.coalesce("rep", "node").alias("rep")), "apart")
    mixed = apart.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key")
    more = across(stored(apart.join(mixed, "key", "left_semi"), "apart"), sets)
    release(sets, keyed, live, apart)
    return links.union(more)


def across(apart: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """apart: stored (key, node, n, rep). Gives (a, b), stored: links that join all alike nodes of a band with different reps."""
    heads = apart.groupBy("key").agg(F.min("node").alias("head"))
    cells = representatives(apart.select("key", "node").join(heads, "key").select(F.col("head").alias("a"), F.col("node").alias("b"))).toDF("node", "cell")
    banded = apart.groupBy("node").agg(F.first("rep").alias("rep"), F.collect_set("key").alias("keys"))  # BANDS keys at most
    rows = stored(banded.join(cells, "node").join(sets.select("node", "marks"), "node"), "cells")
    large = rows.groupBy("cell").count().where(F.col("count") > block).select("cell", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    meets = F.transform(F.sequence(F.lit(0), parts - 1), lambda y: F.struct(F.least(y, F.col("own")).alias("i"), F.greatest(y, F.col("own")).alias("j")))
    dealt = rows.join(large, "cell", "left").withColumn("own", own).select("cell", "node", "rep", "keys", "marks", F.inline(meets))
    schema = arrow_schema("a long, b long")

    def meet(t: pa.Table) -> pa.Table:
        node, rep = t["node"].to_numpy(), t["rep"].to_numpy()
        keys, marks = t["keys"].combine_chunks(), t["marks"].combine_chunks()
        pairs = alike_pairs(node, rep, *((c.flatten().to_numpy(), c.value_lengths().to_numpy()) for c in (keys, marks)))
        return pa.table([pa.array(node[x]) for x in pairs], schema=schema)

    ship(apart.sparkSession)
    links = stored(dealt.groupBy("cell", "i", "j").applyInArrow(meet, "a long, b long"), "links")
    release(rows)
    return links


def alike_pairs(node: np.ndarray, rep: np.ndarray, keys: tuple[np.ndarray, np.ndarray], marks: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that link: of a common key, with different reps and alike sets. keys, marks: (values of all rows, how many each row has).

    What a row links to is taken as joined from then on, so the links span, not list, all alike rows.
    """
    n, at = len(node), np.repeat(np.arange(len(node)), keys[1])
    order = np.argsort(keys[0], kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(keys[0][order]) != 0, True]) + 1 if len(order) else []
    together = np.zeros((n, n), bool)
    for lo, hi in zip([0, *ends], ends, strict=False):
        if hi - lo > 1:
            together[np.ix_(at[order[lo:hi]], at[order[lo:hi]])] = True
    group = np.unique(rep, return_inverse=True)[1]
    size, start = marks[1], np.r_[0, np.cumsum(marks[1])]
    near = DENOMINATOR * np.minimum.outer(size, size) >= NUMERATOR * np.maximum.outer(size, size)
    together &= near
    found: list[tuple[int, int]] = []
    for i in range(n):
        others = np.flatnonzero(together[i, :i] & (group[:i] != group[i]))
        if not len(others):
            continue
        mine = marks[0][start[i] : start[i + 1]].view(np.uint64)
        theirs = np.concatenate([marks[0][start[j] : start[j + 1]] for j in others.tolist()]).view(np.uint64)
        hit = np.searchsorted(mine, theirs)
        same = mine[np.minimum(hit, len(mine) - 1)] == theirs if len(mine) else np.zeros(len(theirs), bool)
        both = np.bincount(np.repeat(np.arange(len(others)), size[others]), same, len(others)).astype(np.int64)
        ok = DENOMINATOR * both >= NUMERATOR * (size[i] + size[others] - both)
        for j in others[ok].tolist():
            if group[j] != group[i]:
                found.append((i, j))
                group[group == group[j]] = group[i]
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return a, b


def one_of_each(docs: DataFrame, limit: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns whatever their names, of which each component keeps one: smallest id (null last), then smallest text."""
    at, id_at = docs.columns.index(text), docs.columns.index(id_col)
    rows = positional(docs)
    spec = rows.select("*", F.lit(0).cast("long").alias("node")).schema
    schema = arrow_schema(spec)

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([node_of(shingles(word_digests(x))) for x in b.column(at).to_pylist()], pa.int64())], schema=schema)

    nodes = stored(nodes_of(rows, f"c{id_at}", f"c{at}"), "nodes")
    reps = stored(representatives(edges(rows, nodes, f"c{at}", limit)), "reps").toDF("node", "rep")
    order = F.struct(F.col("first").isNull(), "first", "node")
    whole = nodes.select("node", "first").join(reps, "node", "left").withColumn("rep", F.coalesce("rep", "node"))
    heads = stored(whole.groupBy("rep").agg(F.min_by("node", order).alias("node")).select("node"), "heads")
    release(nodes)
    order = F.struct(F.col(f"c{id_at}").isNull(), f"c{id_at}", f"c{at}")
    kept = mapped(rows, run, spec).join(heads, "node", "left_semi")
    return kept.groupBy("node").agg(F.min_by(F.struct(*rows.columns), order).alias("row")).select("row.*").toDF(*docs.columns)
