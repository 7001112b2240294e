"""Sharding by vector bin packing over bytes, words and rows.

Groups of equal texts go to one shard together. Each group has a vector (bytes,
words, rows); the next group, largest first, goes to the shard where the dot
product of its vector with what the shard has left is highest, both in units of a
shard's even share, among the shards that can still hold it in all measures, or else in bytes.

Bytes fill a shard exactly to its even share; words and rows may exceed theirs by SLACK
and count WEIGHTS times in the product.

At scale: only groups above 1/4096 of all bytes or rows are packed as such (at most 8192
exist); the smaller ones are first gathered by digest into 4096 parcels, whose totals
are packed like groups. A group larger than a shard's even share, which no shard can
hold, is packed in runs of its rows, each one part in 2 * shards of the rows left, down to
single rows, so it spreads to within one row. At most 2 * shards such groups exist, and the driver sees at most 16,384
vectors and a few hundred runs a group, whatever the input.

Texts are read once; sizes and digests are stored with a row number. Rows are numbered by sorting in
ranges with that number last, so rows that are alike in everything are spread over tasks too.

Defined cases: a null text counts as an empty one; null ids are allowed; repeated
rows stay apart as rows, together as a group; ties in a shard's order are between
rows alike in id and text; an empty table gives an empty result; columns that are
not asked for are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.mixing import word_count
from quern.operators.explore import with_index
from quern.plans.scratch import stored

SHARDS = 8
PARCELS = 4096
#: Of bytes, words and rows.
WEIGHTS = (4.0, 1.0, 1.0)
SLACK = (0.0, 0.02, 0.02)


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each vector (n, 3). Largest first by the vector's greatest share of the total; ties by position."""
    total = np.maximum(vectors.sum(axis=0), 1)
    v = vectors * (shards / total)  # in units of a shard's even share
    left = np.ones((shards, v.shape[1])) + SLACK
    out = np.empty(len(v), dtype=np.int32)
    for i in np.argsort(-v.max(axis=1), kind="stable"):
        score = left @ (v[i] * WEIGHTS)
        for fits in ((left >= v[i]).all(axis=1), left[:, 0] >= v[i, 0]):  # in all measures; else in bytes, the law's measure
            if fits.any():
                score = np.where(fits, score, -np.inf)
                break
        else:
            score = left[:, 0]  # every shard would overflow: the one with the most bytes left
        k = int(score.argmax())
        out[i] = k
        left[k] -= v[i]
    return out


def runs_of(rows: int, shards: int) -> list[int]:
    """Lengths of the runs that a group is packed in: a part of what is left each, down to single rows."""
    out = []
    while rows:
        out.append(-(-rows // (2 * shards)))
        rows -= out[-1]
    return out


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, words, text_crc32, shard, slot (0, 1, ... in each shard)."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    read = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        word_count(body).alias("words"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body, F.lit(1)).alias("g1"),
        F.xxhash64(body, F.lit(2)).alias("g2"),
    )
    rows = stored(read.select("*", F.xxhash64("doc_id", "g1", "g2").alias("row_hash"), F.monotonically_increasing_id().alias("m")), "sizes")
    plan = parcels_of(rows, shards)
    spark = docs.sparkSession
    large = spark.createDataFrame(plan["large"], "g1 long, g2 long, big_shard int")
    small = spark.createDataFrame(plan["small"], "parcel int, small_shard int")
    # Both tables have at most 16,384 rows by construction.
    placed = (
        rows.withColumn("parcel", F.pmod("g1", F.lit(PARCELS)).cast("int"))
        .join(F.broadcast(large), ["g1", "g2"], "left")
        .join(F.broadcast(small), "parcel", "left")
        .select(*rows.columns, F.coalesce("big_shard", "small_shard").alias("shard"))
    )
    if plan["cut"]:
        cut = F.broadcast(spark.createDataFrame(plan["cut"], "g1 long, g2 long, ends array<struct<end: long, shard: int>>"))  # at most 2 * shards rows
        hot = with_index(rows.join(cut, ["g1", "g2"]), "g1", "g2", "row_hash", "doc_id", "m", name="at")
        first = hot.groupBy(F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(F.min("at").alias("first"))
        own = hot.join(F.broadcast(first), (F.col("g1") == F.col("f1")) & (F.col("g2") == F.col("f2")))
        shard = F.filter("ends", lambda x: x["end"] > F.col("at") - F.col("first"))[0]["shard"]
        placed = placed.join(cut, ["g1", "g2"], "left_anti").unionByName(own.select(*rows.columns, shard.alias("shard")))
    numbered = with_index(placed, "shard", "row_hash", "doc_id", "m", name="at")
    starts = numbered.groupBy(F.col("shard").alias("s")).agg(F.min("at").alias("start"))  # a row a shard
    slot = (F.col("at") - F.col("start")).cast("long").alias("slot")
    return numbered.join(F.broadcast(starts), F.col("shard") == F.col("s")).select("doc_id", "size", "words", "text_crc32", "shard", slot)


def parcels_of(rows: DataFrame, shards: int) -> dict[str, list[tuple]]:
    """Where each large group and each parcel of small groups goes; of groups above an even share, how many rows go where."""
    groups = stored(rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("rows")), "groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    if not total["rows"]:
        return {"large": [], "cut": [], "small": []}
    is_large = (F.col("bytes") * PARCELS > total["bytes"]) | (F.col("rows") * PARCELS > total["rows"])
    key = F.when(is_large, F.struct("g1", "g2"))
    packed = groups.groupBy(key.alias("large"), F.when(~is_large, F.pmod("g1", F.lit(PARCELS)).cast("int")).alias("parcel")).agg(F.sum("bytes"), F.sum("words"), F.sum("rows"))
    units, vectors = [], []
    for key, parcel, size, words, n in sorted(packed.collect(), key=lambda r: (r[0] is None, tuple(r[0] or ()), r[1] or 0)):
        group = tuple(key) if key is not None else None
        cut = group is not None and max(size / total["bytes"], n / total["rows"]) > 1 / shards
        for run in runs_of(n, shards) if cut else [n]:
            units.append((group, parcel, run, cut))
            vectors.append((size / n * run, words / n * run, run))
    where = pack(np.array(vectors, dtype=float).reshape(-1, 3), shards).tolist()
    ends: dict[tuple, list[int]] = {}
    for (group, _, run, cut), k in zip(units, where, strict=True):
        if cut:
            ends.setdefault(group, [0] * shards)[k] += run
    both = list(zip(units, where, strict=True))
    return {
        "large": [(*g, k) for (g, _, _, cut), k in both if g is not None and not cut],
        "cut": [(*g, [(end, k) for k, end in enumerate(accumulate(counts))]) for g, counts in ends.items()],
        "small": [(p, k) for (g, p, _, _), k in both if g is None],
    }


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    out = sharded(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "words")
