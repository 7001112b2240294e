"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first, calibrated visits.

The tree is fitted on a bounded sample (PER_LEAF vectors a leaf, at most MAX_LEAVES leaves) and
every vector is put into the leaf it reaches. A query opens leaves in the order of a
priority queue of branches. How many it opens is calibrated: CALIBRATION vectors that are no queries (queries, if there are no others) are
answered by brute force over all vectors, the places of their true neighbours' leaves in their
own traversals are looked up, and visits widen until TARGET of those neighbours are
reached (``calibrated`` returns that number and recall). A query opens further leaves until
they hold as many vectors as it must return.

Equal vectors are one entry with its K + 1 smallest ids (found by a ranked window, which keeps
no more than that per key before the shuffle), so a vector that a third of the rows share
costs no more than any other. Leaves above CHUNK entries are cut into chunks and queries into parts of QUERIES;
the part's queries that open a leaf meet a chunk of it in one task, so no task has more than QUERIES vectors on the
one side and about CHUNK on the other. A query's nearest leaves are searched first; the K-th distance found
there bounds what the later ones give back, so results grow with the queries, not with visits.

Distances are Euclidean, from the original vectors in double precision.

Defined cases: vectors that are null, zero, of another than the table's most common length or
that hold a null, NaN or infinite component take no part, nor do rows without an id;
rows equal in id and vector count once; ties go to the smaller id; with fewer than K
candidates all are returned; an empty table gives an empty result; columns that are
not asked for are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, mapped
from quern.llm.kmeans_tree import Tree
from quern.plans.scratch import stored
from quern.plans.shipping import ship

K = 10
EVERY = 100
LEAF, MAX_LEAVES, PER_LEAF = 128, 4096, 16
CHUNK = 256
#: Queries of a part, on average.
QUERIES = 1024
CALIBRATION = 128
TARGET = 0.95
#: Numbers of a sample on the driver, whatever the vectors' length.
SAMPLE_NUMBERS = 8_000_000

ENTRY = "g1 long, g2 long, vec array<double>, ids array<long>"
SENT = "vec_id long, g1 long, g2 long, vec array<double>, bound double, part int, leaf long, chunk int"
FOUND = "query_id long, g1 long, g2 long, vec_id long, score double"


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, g1, g2) of the rows that take part."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL")
    finite = rows.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    length = finite.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return finite.where(F.size("vec") == (length["n"] if length else 0)).select("vec_id", "vec", F.xxhash64("vec").alias("g1"), F.xxhash64(F.lit("v"), "vec").alias("g2"))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 1)


def nearest(q: np.ndarray, q_id: int | None, q_key, x: np.ndarray, ids: list, keys, k: int, bound: float = float("inf")) -> list[tuple[float, int, int]]:
    """(distance, id, row) of the k nearest entries' ids within the bound, without the query's own row."""
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    if len(d) > k + 1:
        bound = min(bound, np.partition(d, k)[k])
    rows = np.flatnonzero(d <= bound)
    out = [(float(d[r]), i, r) for r in rows.tolist() for i in ids[r] if not (i == q_id and keys[r] == q_key)]
    out.sort()
    return out[:k]


class Index:
    """The stored entries with their leaves, the tree, and how many leaves a query opens."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K):
        self.k, spark = k, vectors.sparkSession
        rows = valid(vectors, id_col, vec_col)
        self.rows = rows
        by = Window.partitionBy("g1", "g2").orderBy("vec_id")
        # rank, not row_number: rows equal in id and vector must not push others out; they meet in collect_set
        few = rows.withColumn("r", F.dense_rank().over(by)).where(F.col("r") <= k + 1)
        once = few.groupBy("g1", "g2").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_set("vec_id")).alias("ids"))
        self.entries = stored(once, "entries")
        n = self.entries.count()
        leaves = max(1, min(MAX_LEAVES, n // LEAF))
        dims = len((self.entries.select("vec").first() or [[]])[0])
        size = min(leaves * PER_LEAF, max(leaves, SAMPLE_NUMBERS // max(1, dims)))
        sample = self.entries.orderBy("g1", "g2").limit(size).select("vec").toArrow()["vec"].combine_chunks() if n else None  # at most SAMPLE_NUMBERS numbers
        self.tree = Tree(_matrix(sample if isinstance(sample, pa.Array) else sample.combine_chunks()), leaves) if n else None
        self.visits, self.recall, self.asked = 1, 1.0, 0
        if n:
            self.shared = spark.sparkContext.broadcast(self.tree)
            shared = self.shared

            def put(batches):
                for b in batches:
                    if b.num_rows:
                        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.assign(_matrix(b.column(2))))], names=[*b.schema.names, "leaf"])

            self.placed = stored(mapped(self.entries.select("g1", "g2", "vec", "ids"), put, f"{ENTRY}, leaf long"), "leaves")
            self.sizes = {r["leaf"]: r["count"] for r in self.placed.groupBy("leaf").count().collect()}  # at most MAX_LEAVES rows

    def calibrated(self, queries: DataFrame, most: int = CALIBRATION, target: float = TARGET) -> Index:
        """Widen the visits until ``target`` of the true neighbours of at most ``most`` queries are reached."""
        asked = [(r["vec_id"], r["g1"], r["g2"], np.array(r["vec"])) for r in queries.orderBy(F.xxhash64("vec_id"), "vec_id", "g1").limit(most).select("vec_id", "g1", "g2", "vec").collect()]
        if not asked:
            return self
        k, schema = self.k, arrow_schema("i int, score double, vec_id long, leaf long")

        def brute(batches):
            for b in batches:
                x, ids, leaf = _matrix(b.column(2)), b.column(3).to_pylist(), b.column(4).to_numpy()
                keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
                out = [(i, d, v, int(leaf[r])) for i, (q_id, g1, g2, q) in enumerate(asked) for d, v, r in nearest(q, q_id, (g1, g2), x, ids, keys, k)]
                cols = list(zip(*out, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        true = mapped(self.placed, brute, "i int, score double, vec_id long, leaf long")
        best = true.withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy("score", "vec_id"))).where(F.col("r") <= k).select("i", "leaf").collect()
        places = [{leaf: n for n, leaf in enumerate(self.tree.visits(q), 1)} for *_, q in asked]
        reached = np.sort([places[r["i"]][r["leaf"]] for r in best])
        if len(reached):
            self.visits = int(reached[min(len(reached) - 1, int(np.ceil(target * len(reached))) - 1)])
            self.recall = float((reached <= self.visits).mean())
        return self

    def _met(self, queries: DataFrame, later: bool) -> DataFrame:
        """queries: (vec_id, g1, g2, vec, bound). (query_id, g1, g2, vec_id, score) of up to k entries within the bound from every chunk opened.

        The first leaves, until they hold more than k entries, or all later ones.
        """
        k, least, sizes, shared = self.k, self.visits, self.sizes, self.shared
        chunks = {leaf: -(-n // CHUNK) for leaf, n in sizes.items()}
        schema, found = arrow_schema(SENT), arrow_schema(FOUND)

        def route(batches):
            for b in batches:
                for i, q in enumerate(_matrix(b.column(3))):  # a query's row is repeated per chunk it opens
                    opened, held = [], 0
                    for n, leaf in enumerate(shared.value.visits(q), 1):
                        if later == (held > k):
                            opened += [(leaf, c) for c in range(chunks.get(leaf, 0))]
                        held += sizes.get(leaf, 0)
                        if held > k and (n >= least or not later):
                            break
                    one = b.slice(i, 1).take(pa.array([0] * len(opened), pa.int64()))
                    yield pa.RecordBatch.from_arrays([*one.columns, pa.array([x for x, _ in opened], pa.int64()), pa.array([c for _, c in opened], pa.int32())], schema=schema)

        def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if left.num_rows and right.num_rows:
                x, ids = _matrix(right["vec"].combine_chunks()), right["ids"].to_pylist()
                keys = list(zip(right["g1"].to_pylist(), right["g2"].to_pylist(), strict=True))
                q = _matrix(left["vec"].combine_chunks())
                for i, (q_id, g1, g2, bound) in enumerate(zip(*(left[c].to_pylist() for c in ("vec_id", "g1", "g2", "bound")), strict=True)):
                    out += [(q_id, g1, g2, v, d) for d, v, _ in nearest(q[i], q_id, (g1, g2), x, ids, keys, k, bound)]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            return pa.table([pa.array(c, f.type) for c, f in zip(cols, found, strict=True)], schema=found)

        spark = queries.sparkSession
        ship(spark)
        parts = max(1, -(-self.asked // QUERIES))
        part = F.pmod(F.xxhash64("vec_id", "g1"), F.lit(parts)).cast("int").alias("part")
        sent = mapped(queries.select("vec_id", "g1", "g2", "vec", "bound", part), route, SENT)
        counts = spark.createDataFrame(sorted(chunks.items()), "leaf long, chunks int")  # at most MAX_LEAVES rows
        cut = self.placed.join(F.broadcast(counts), "leaf").withColumn("chunk", F.pmod(F.xxhash64("g1", "g2"), F.col("chunks")).cast("int")).drop("chunks")
        if parts > 1:  # each part gets the leaves that it opens, no others
            sent = stored(sent, "sent")
            cut = cut.join(sent.select("leaf", "part").distinct().toDF("leaf", "part"), "leaf")
        else:
            cut = cut.withColumn("part", F.lit(0))
        key = ["part", "leaf", "chunk"]
        return sent.groupBy(*key).cogroup(cut.groupBy(*key)).applyInArrow(meet, FOUND)

    def search(self, queries: DataFrame) -> DataFrame:
        """queries: (vec_id, vec, g1, g2). Gives (query_id, rank, vec_id, score).

        The nearest leaves come first; the k-th distance found there bounds what later leaves send.
        """
        self.asked = queries.count()
        rank = F.row_number().over(Window.partitionBy("query_id", "g1", "g2").orderBy("score", "vec_id"))
        best = lambda met: met.withColumn("rank", rank).where(F.col("rank") <= self.k)
        first = stored(best(self._met(queries.withColumn("bound", F.lit(float("inf"))), False)), "first")
        bounds = first.where(F.col("rank") == self.k).select(F.col("query_id").alias("vec_id"), "g1", "g2", F.col("score").alias("bound"))
        bounded = queries.join(bounds, ["vec_id", "g1", "g2"], "left").fillna(float("inf"), ["bound"])
        return best(first.drop("rank").union(self._met(bounded, True))).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = EVERY, k: int = K) -> DataFrame:
    """The k nearest rows of every row whose id is divisible by ``every``."""
    index = Index(vectors, id_col, vec_col, k)
    if index.tree is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "g1", "g2"])
    others = index.rows.where(F.col("vec_id") % every != 0)
    return index.calibrated(queries if others.isEmpty() else others).search(queries)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    return neighbours(table(spark, sf_dir, "embeddings"))
