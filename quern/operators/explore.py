"""Relational operators for exploring a table: duplicates, counts, histograms, sets, numbering."""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.plans.scratch import stored

MERGES = ("intersection", "union")


def keep_first(df: DataFrame, by: str, order: str) -> DataFrame:
    """One row for each value of ``by``: the first in ``order``. Spark keeps one row a key before it shuffles."""
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("q_i", F.row_number().over(w)).where("q_i = 1").drop("q_i")


def _counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(F.col(by).alias("q_by")).agg(F.count("*").alias("q_n"))


def drop_all_copies(df: DataFrame, by: str) -> DataFrame:
    """Rows whose value occurs once. Counting by partial sums and joining back keeps hot values out of one task."""
    return df.join(_counts(df, by).where("q_n = 1"), F.col(by).eqNullSafe(F.col("q_by")), "left_semi")


def duplicated(df: DataFrame, by: str) -> DataFrame:
    """Rows whose value occurs more than once."""
    return df.join(_counts(df, by).where("q_n > 1"), F.col(by).eqNullSafe(F.col("q_by")), "left_semi")


def unique_test(df: DataFrame, *columns: str) -> DataFrame:
    """(column, is_unique) for each column; nulls are left out of both counts."""
    got = df.agg(*(F.count_distinct(c).alias(f"d_{c}") for c in columns), *(F.count(c).alias(f"n_{c}") for c in columns))
    return got.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), (F.col(f"d_{c}") == F.col(f"n_{c}")).alias("is_unique")) for c in columns))))


def value_counts(df: DataFrame, *columns: str, normalize: bool = False) -> DataFrame:
    """(columns, count), or with ``normalize`` (columns, proportion)."""
    n = df.groupBy(*columns).agg(F.count("*").alias("count"))
    if not normalize:
        return n
    total = df.agg(F.count("*").alias("q_total"))
    return n.join(F.broadcast(total)).select(*columns, (F.col("count") / F.col("q_total")).alias("proportion"))  # total is one row


def column_value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) of several columns in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("count"))


def histogram(df: DataFrame, column: str, bins: int, percent: bool = False) -> DataFrame:
    """(bin, low, high, count[, percent]) with equal widths; the last bin has its right edge. Empty bins are there too."""
    x = F.col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"))  # one row
    lo, hi = F.col("lo"), F.col("hi")
    width = (hi - lo) / bins
    at = F.when(hi == lo, F.lit(bins // 2 + 1)).otherwise(F.least(F.floor((x - lo) / width).cast("int") + 1, F.lit(bins)))
    counts = df.where(x.isNotNull()).join(F.broadcast(ends)).groupBy(at.alias("q_bin")).agg(F.count("*").alias("q_count"))
    frame = ends.where("n > 0").select("lo", "hi", "n", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = frame.join(counts, F.col("bin") == F.col("q_bin"), "left").withColumn("count", F.coalesce("q_count", F.lit(0)))
    cols = ["bin", (lo + width * (F.col("bin") - 1)).alias("low"), (lo + width * F.col("bin")).alias("high"), "count"]
    return out.select(*cols, *([(F.col("count") * 100.0 / F.col("n")).alias("percent")] if percent else []))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max); quartiles exact, interpolated between the values at their ranks.

    Values are numbered by a range sort, and the driver gets the at most six that the quartiles of a column stand on.
    """
    kind = "column string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    rows = []
    for c in columns:
        x = F.col(f"`{c}`").cast("double").alias("x")
        one = df.select(x).agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")).first()
        at = [(one["count"] - 1) * p for p in (0.25, 0.5, 0.75)] if one["count"] else []
        wanted = sorted({f(p) for p in at for f in (math.floor, math.ceil)})
        value = {r["at"]: r["x"] for r in with_index(df.select(x).where("x IS NOT NULL"), "x", name="at").where(F.col("at").isin(wanted)).collect()} if at else {}
        between = [value[math.floor(p)] + (value[math.ceil(p)] - value[math.floor(p)]) * (p - math.floor(p)) for p in at] or [None] * 3
        rows.append((c, one["count"], one["mean"], one["std"], one["min"], *between, one["max"]))
    return df.sparkSession.createDataFrame(rows, kind)


def info(df: DataFrame) -> DataFrame:
    """(column, type, non_null) of every column."""
    n = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)))
    return n.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n{i}").alias("non_null")) for i, (c, t) in enumerate(df.dtypes)))))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, count)."""
    return value_counts(df, a, b)


def with_index(df: DataFrame, *order: str, name: str = "index") -> DataFrame:
    """df with a gapless index from 0 in a total order, without sorting in one task.

    Rows are sorted by ranges and stored with their place in the partition; partition sizes, one
    number a partition, are then summed up.
    """
    spark = df.sparkSession
    held = stored(df.orderBy(*order).withColumn("q_at", F.monotonically_increasing_id()), "indexed")
    part = F.shiftright("q_at", 33)
    sizes = sorted((r[0], r[1]) for r in held.groupBy(part.alias("p")).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    # A row a partition. From Arrow the driver makes it; rows of Python would start a Python worker a task, which then waits beside the next stages'.
    table = F.broadcast(spark.createDataFrame(pa.table({"q_p": pa.array([p for p, _ in starts], pa.int64()), "q_start": pa.array([n for _, n in starts], pa.int64())})))
    place = F.col("q_start") + F.col("q_at").bitwiseAND((1 << 33) - 1)
    return held.withColumn("q_p", part).join(table, "q_p").withColumn(name, place).drop("q_at", "q_p", "q_start")


def numbered_batches(df: DataFrame, size: int, worker: str, *order: str) -> DataFrame:
    """df with batch_id: rows of each worker in order, ``size`` a batch, from 1. A worker's rows may fill many tasks."""
    numbered = with_index(df, worker, *order, name="q_place")
    starts = numbered.groupBy(F.col(worker).alias("q_worker")).agg(F.min("q_place").alias("q_first"))  # a row a worker
    same = F.col(worker).eqNullSafe(F.col("q_worker"))
    batch = F.floor((F.col("q_place") - F.col("q_first")) / size).cast("int") + 1
    return numbered.join(starts, same).withColumn("batch_id", batch).drop("q_place", "q_worker", "q_first")


def round_robin(index: Column, n: int) -> Column:
    """The worker that list[i::n] would give an item of this index."""
    return F.pmod(index, F.lit(n)).cast("int")


def equal_split(df: DataFrame, n: int, *order: str, name: str = "split") -> DataFrame:
    """df with a split number from 0: n runs of consecutive rows whose sizes differ by one at most."""
    indexed = with_index(df, *order, name="q_index")
    total = indexed.agg(F.count("*").alias("q_total"))  # one row
    return indexed.join(F.broadcast(total)).withColumn(name, F.floor(F.col("q_index") * n / F.col("q_total")).cast("int")).drop("q_index", "q_total")


def merged(parts: list[DataFrame], how: str = "intersection") -> DataFrame:
    """Distinct uids that all (``intersection``) or any (``union``) of the frames have."""
    if how not in MERGES:
        raise ValueError(f"unknown merge strategy {how!r}; one of {MERGES}")
    if not parts:
        raise ValueError("nothing to merge")
    return reduce(DataFrame.intersect if how == "intersection" else DataFrame.union, parts).distinct()


def with_missing(df: DataFrame, columns: list[str], kind: str = "int") -> DataFrame:
    """df with those of the columns that it lacks, as nulls."""
    return df.withColumns({c: F.lit(None).cast(kind) for c in columns if c not in df.columns})


def mined_patterns(*frames: DataFrame, column: str = "signature") -> DataFrame:
    """Distinct values that all frames have."""
    return merged([f.select(F.col(column).alias("pattern")).distinct() for f in frames])


def value_sides(df: DataFrame, column: str, **sides: str) -> DataFrame:
    """(column, a boolean a side): on which sides, given as conditions, each distinct value occurs. One pass serves all set operations."""
    return df.groupBy(column).agg(*(F.bool_or(F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in sides.items()))


def random_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """n rows by a seeded draw."""
    return df.orderBy(F.rand(seed)).limit(n)

