"""SimHash near-duplicates through a Gray-order hierarchical index.

A text's fingerprint has a bit where over half of its shingles' XXH64 digests have it.
Fingerprints link at LIMIT or fewer differing bits; a component is what links reach.

Equal fingerprints are one code from the start. All codes stand in one order, that of their Gray rank, by a range sort;
CHUNK neighbours make a chunk, FAN chunks a node above, and so on to one root. A node keeps what its members share: a mask
of equal bits and their pattern. Pairs of nodes are followed from the root down by joins with their children, and
a pair whose patterns differ in more than LIMIT bits that both masks have is dropped with all below it. Pairs of
chunks that are left are searched in tasks, where the index of ``gray_index`` goes on from chunks to codes. A task gives
back spanning links, never all pairs, and the links are contracted to components by joins.

Defined cases: a null text counts as an empty one (fingerprint 0, linked like any
other); null ids are never the smallest unless a component has no other; repeated rows
share a fingerprint; an empty table gives an empty result; columns that are not asked
for are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, column, mapped, positional, slices
from quern.llm.components import representatives
from quern.llm.gray_index import crossing_links, spanning_links
from quern.operators.explore import with_index
from quern.plans.scratch import stored

SHINGLE = 4
LIMIT = 4
SEED = 42
#: Neighbours in Gray order that make a chunk, and nodes that make a node above.
CHUNK, FAN = 8192, 64
#: Digests that are counted at a time.
TOGETHER = 500_000


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - k + 1)
    last = ends[k - 1 :] if len(words) >= k else ends[-1:]
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for lo in range(0, n, TOGETHER):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[lo : min(n, lo + TOGETHER)], last[lo : lo + TOGETHER], strict=True)], np.uint64)
        bits += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def word_fingerprint(text: str | None) -> int:
    """The fingerprint over a text's distinct words, for texts that share most words but few long shingles."""
    import xxhash

    words = set((text or "").encode().lower().split())
    if not words:
        return 0
    return majority(np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words)))


def majority(h: np.ndarray) -> int:
    """The bits that over half of the digests have."""
    bits = np.zeros(64, np.int64)
    for lo in range(0, len(h), TOGETHER):
        bits += np.unpackbits(h[lo : lo + TOGETHER].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest: Callable[[str | None], int] = fingerprint) -> DataFrame:
    """(doc_id, code): the fingerprint as a signed 64-bit number."""
    schema = arrow_schema("doc_id long, code long")

    def run(batches):
        for whole in batches:
            for b in slices(whole, 1):
                codes = np.array([digest(x) for x in column(b, 1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes)], schema=schema)

    return mapped(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")), run, "doc_id long, code long")


def gray_rank(code: Column) -> Column:
    """The position of a code in the Gray sequence, as a signed number in the order of the unsigned one."""
    for k in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, k))
    return code.bitwiseXOR(F.lit(-(2**63)))


def met_chunks(ordered: DataFrame, limit: int, fan: int = FAN) -> DataFrame:
    """ordered: stored (code, chunk). (i, j), i <= j: the pairs of chunks that may hold links, from the root down."""
    bits = lambda a, o: F.bitwise_not(a.bitwiseXOR(o)).alias("mask")
    node = ordered.groupBy(F.col("chunk").alias("node")).agg(F.bit_and("code").alias("ones"), F.bit_or("code").alias("any"))
    levels = [stored(node, "nodes")]
    while levels[-1].limit(2).count() > 1:
        above = levels[-1].groupBy(F.floor(F.col("node") / fan).alias("node")).agg(F.bit_and("ones").alias("ones"), F.bit_or("any").alias("any"))
        levels.append(stored(above, "nodes"))
    pairs = levels.pop().select(F.col("node").alias("i"), F.col("node").alias("j"))
    while levels:
        children = levels.pop().select("node", F.floor(F.col("node") / fan).alias("up"), bits(F.col("ones"), F.col("any")), "ones")
        one, other = (children.toDF(*(f"{s}_{c}" for c in children.columns)) for s in "ab")
        apart = F.bit_count(F.col("a_ones").bitwiseXOR(F.col("b_ones")).bitwiseAND(F.col("a_mask")).bitwiseAND(F.col("b_mask")))
        down = pairs.join(one, F.col("i") == F.col("a_up")).join(other, F.col("j") == F.col("b_up")).where((F.col("a_node") <= F.col("b_node")) & (apart <= limit))
        pairs = stored(down.select(F.col("a_node").alias("i"), F.col("b_node").alias("j")), "met")
    return pairs


def links(codes: DataFrame, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """codes: distinct (code). Gives (a, b): links that span every component of codes within limit of each other."""
    placed = with_index(codes.select("code", gray_rank(F.col("code")).alias("rank")), "rank", name="at")
    ordered = stored(placed.select("code", F.floor(F.col("at") / chunk).alias("chunk")), "gray")
    schema = arrow_schema("a long, b long")
    whole = stored(ordered.groupBy("chunk").agg(F.collect_list("code").alias("codes")), "chunks")  # at most ``chunk`` codes a row
    one, other = whole.toDF("i", "x"), whole.toDF("j", "y")
    met = met_chunks(ordered, limit).join(one, "i").join(other, "j").select("i", "j", "x", F.when(F.col("i") < F.col("j"), F.col("y")).alias("y"))

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                x = b.column(2)[k].values.to_numpy().view(np.uint64)
                y = b.column(3)[k].values
                both = x if y is None else np.concatenate([x, y.to_numpy().view(np.uint64)])
                at = spanning_links(x, limit) if y is None else crossing_links(x, both[len(x) :], limit)
                linked = at != np.arange(len(at))
                yield pa.RecordBatch.from_arrays([pa.array(both[linked].view(np.int64)), pa.array(both[at[linked]].view(np.int64))], schema=schema)

    return mapped(met.repartition("i", "j"), run, "a long, b long")


def labelled(codes: DataFrame, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """codes: stored (code, first) with the smallest id of each code. Adds component (its smallest id) and head (the code that has it)."""
    reps = stored(representatives(links(codes.select("code"), limit, chunk)), "reps")
    order = F.struct(F.col("first").isNull(), "first", "code")
    linked = stored(reps.join(codes, reps["node"] == codes["code"]).select("code", "first", "rep"), "linked")
    best = stored(linked.groupBy("rep").agg(F.min("first").alias("component"), F.min_by("code", order).alias("head")), "best")
    found = linked.select("code", "rep").join(best, "rep").select("code", "component", "head")
    return codes.join(found, "code", "left").select("code", F.coalesce("component", "first").alias("component"), F.coalesce("head", "code").alias("head"))


def clustered(docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs, id_col, text), "fingerprints")
    codes = stored(rows.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    labels = stored(labelled(codes, limit, chunk), "labels")
    out = rows.join(labels, "code")
    return out.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT, chunk: int = CHUNK, digest: Callable[[str | None], int] = fingerprint) -> DataFrame:
    """The documents, all columns whatever their names, of which each component keeps one: smallest id (null last), then smallest text."""
    at, id_at = docs.columns.index(text), docs.columns.index(id_col)
    rows = positional(docs)
    spec = rows.select("*", F.lit(0).cast("long").alias("code")).schema
    schema = arrow_schema(spec)

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                codes = np.array([digest(x) for x in b.column(at).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes)], schema=schema)

    codes = stored(fingerprints(rows, f"c{id_at}", f"c{at}", digest).groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    heads = stored(labelled(codes, limit, chunk).where("code = head").select("code"), "heads")
    order = F.struct(F.col(f"c{id_at}").isNull(), f"c{id_at}", f"c{at}")
    best = mapped(rows, run, spec).join(heads, "code", "left_semi").groupBy("code").agg(F.min_by(F.struct(*rows.columns), order).alias("row"))
    return best.select("row.*").toDF(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    return clustered(table(spark, sf_dir, "documents"))
