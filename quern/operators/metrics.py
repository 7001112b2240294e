"""Counts of what filters let through, by batch and over all batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_batch(flagged: DataFrame, verdicts: dict[str, str], batch: str = "batch_id", cascade: bool = True) -> DataFrame:
    """(filter, batch_id, input_count, output_count, filtered_count, filter_rate), all filters in one pass.

    verdicts: filter name to its boolean column, in the order of application. With ``cascade`` a filter sees
    what the earlier ones kept, otherwise every filter sees all rows.
    """
    seen: Column = F.lit(True)
    aggregates, structs = [], []
    for i, (name, column) in enumerate(verdicts.items()):
        ok = F.coalesce(F.col(column), F.lit(False))
        aggregates += [F.count_if(seen).alias(f"i{i}"), F.count_if(seen & ok).alias(f"o{i}")]
        structs.append(F.struct(F.lit(name).alias("filter"), F.col(f"i{i}").alias("input_count"), F.col(f"o{i}").alias("output_count")))
        if cascade:
            seen = seen & ok
    rows = flagged.groupBy(batch).agg(*aggregates).select(F.col(batch).alias("batch_id"), F.inline(F.array(*structs)))
    gone = F.col("input_count") - F.col("output_count")
    rate = F.round(F.coalesce(F.try_divide(gone.cast("double"), F.col("input_count").cast("double")), F.lit(0.0)), 5)
    return rows.select("filter", "batch_id", "input_count", "output_count", gone.alias("filtered_count"), rate.alias("filter_rate"))


def summary(batches: DataFrame, time: str | None = None) -> DataFrame:
    """One row a filter: totals, batches, and mean, sample deviation, least and greatest of the batches' rates (and times)."""
    r5 = lambda c: F.round(c, 5)
    stats = lambda c, name: [r5(F.avg(c)).alias(f"avg_{name}"), r5(F.coalesce(F.stddev_samp(c), F.lit(0.0))).alias(f"stddev_{name}"), r5(F.min(c)).alias(f"min_{name}"), r5(F.max(c)).alias(f"max_{name}")]
    return batches.groupBy("filter").agg(
        F.sum("input_count").alias("total_input"),
        F.sum("output_count").alias("total_output"),
        F.count("*").alias("batches_processed"),
        F.sum("filtered_count").alias("total_filtered"),
        *stats("filter_rate", "filter_rate"),
        *(stats(time, "elapsed_time_seconds") if time else []),
        F.count("*").alias("calls"),
    )


def bench_summary(results: DataFrame) -> DataFrame:
    """(workers, mean_time, std_dev) of rows (workers, execution, seconds); the population deviation."""
    return results.groupBy("workers").agg(F.avg("seconds").alias("mean_time"), F.stddev_pop("seconds").alias("std_dev"))


def bench_rows(json: DataFrame, column: str = "value") -> DataFrame:
    """(workers, execution, seconds) from JSON objects of workers to {"execution_times": [...]}."""
    parsed = F.from_json(F.col(column), "map<string, struct<execution_times: array<double>, mean_time: double, std_dev: double>>")
    each = json.select(F.explode(parsed).alias("workers", "r"))
    return each.select("workers", F.posexplode("r.execution_times").alias("i", "seconds")).select("workers", (F.col("i") + 1).alias("execution"), "seconds")
