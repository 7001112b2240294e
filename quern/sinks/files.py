"""Metrics, patterns, field dumps and tar shards."""

from __future__ import annotations

import io
import json
import os
import tarfile
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_metrics(batches: DataFrame, summary: DataFrame, folder: str, worker: str = "0", parameters: dict[str, dict] | None = None, apply_filters: str = "True", elapsed: dict[str, float] | None = None) -> tuple[str, str]:
    """Write metrics_summary_<worker>_<time>.json and metrics_details_<worker>_<time>.json.

    The summary has a row a filter. Details are written as they come, one row a filter and batch, and never held together.
    elapsed: seconds that a filter's job took; all its batches were measured by that one job.
    """
    os.makedirs(folder, exist_ok=True)
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S")
    seconds = elapsed or {}

    def row(r, **times) -> dict:
        name = r["filter"]
        fixed = {"parameters": str((parameters or {}).get(name, {})), "apply_filters": apply_filters}
        return {**{k: v for k, v in r.asDict().items() if k != "filter"}, **(times if name in seconds else {}), **fixed}

    at = [os.path.join(folder, f"metrics_{kind}_{worker.replace(':', '_')}_{stamp}.json") for kind in ("summary", "details")]
    with open(at[0], "w", encoding="utf-8") as f:
        spread = lambda s: {"avg_elapsed_time_seconds": s, "stddev_elapsed_time_seconds": 0.0, "min_elapsed_time_seconds": s, "max_elapsed_time_seconds": s}
        total = {r["filter"]: row(r, **spread(round(seconds.get(r["filter"], 0.0) / max(1, r["batches_processed"]), 5))) for r in summary.collect()}
        json.dump({"worker_id": worker, "filter_metrics": total}, f, indent=2)
    with open(at[1], "w", encoding="utf-8") as f:
        f.write(f'{{"worker_id": {json.dumps(worker)}, "filter_metrics": {{')
        last = None
        for r in batches.orderBy("filter", "batch_id").toLocalIterator():
            name = r["filter"]
            f.write(", " if name == last else f'{"" if last is None else "], "}{json.dumps(name)}: [')
            json.dump({**row(r, elapsed_time=round(seconds.get(name, 0.0), 5)), "timestamp": datetime.now().isoformat()}, f)
            last = name
        f.write("]}}" if last is not None else "}}")
    return at[0], at[1]


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """The rows as Parquet files, in a folder a value of ``partition_by`` if given."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_patterns(patterns: DataFrame, path: str, column: str = "pattern") -> None:
    """Distinct patterns, sorted, one a line, in one text file below path."""
    patterns.select(F.col(column).alias("value")).distinct().orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def save_field(df: DataFrame, column: str, path: str) -> None:
    """One field, a row a line; line feeds inside become spaces."""
    df.select(F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)


def add_sample(tar: tarfile.TarFile, r: dict) -> None:
    """The members of one sample (key, meta, txt, jpg)."""
    for ending, data in (("jpg", r.get("jpg")), ("json", r.get("meta")), ("txt", r.get("txt"))):
        if data is not None:
            raw = data.encode() if isinstance(data, str) else bytes(data)
            member = tarfile.TarInfo(f"{r['key']}.{ending}")
            member.size = len(raw)
            tar.addfile(member, io.BytesIO(raw))


def tar_bytes(rows: Iterator[dict]) -> bytes:
    """A tar file of samples (key, meta, txt, jpg)."""
    body = io.BytesIO()
    with tarfile.open(fileobj=body, mode="w") as tar:
        for r in rows:
            add_sample(tar, r)
    return body.getvalue()


def _place(shard: str | None, key: str | None) -> tuple:
    """Sorts as (shard, key) does in Spark: nulls first, then code points."""
    return (shard is not None, shard or "", key is not None, key or "")


def _shard_number(starts: list[tuple]):
    """(shard, key) columns to the number of the new shard, given the place of the first sample of each."""

    @F.arrow_udf("long")
    def number(shards: pa.Array, keys: pa.Array) -> pa.Array:
        return pa.array([bisect_right(starts, _place(*x)) - 1 for x in zip(shards.to_pylist(), keys.to_pylist(), strict=True)], pa.int64())

    return number.asNondeterministic()


def write_shards(samples: DataFrame, folder: str, per_shard: int = 10_000) -> DataFrame:
    """Samples in (shard, key) order as new tar files of ``per_shard`` samples; gives (shard, samples).

    ``folder`` must be shared by the executors: each shard is written by the task that has it, a batch of samples in memory
    at a time, under a name of its own first, so that a repeated attempt replaces it whole.
    """
    from quern.operators.explore import with_index
    from quern.plans.shipping import ship

    ship(samples.sparkSession)
    keys = with_index(samples.select("shard", "key"), "shard", "key", name="q_index")
    within = F.pmod("q_index", F.lit(per_shard))
    ends = keys.where((within == 0) | (within == per_shard - 1)).select("q_index", "shard", "key").orderBy("q_index").collect()  # two rows a new shard
    starts = [_place(r["shard"], r["key"]) for r in ends if r["q_index"] % per_shard == 0]
    last = {r["q_index"] + 1: _place(r["shard"], r["key"]) for r in ends}
    if all(last.get(i * per_shard) != at for i, at in enumerate(starts)):
        # A sample finds its shard by its key alone, so captions and images move once.
        numbered, order = samples.withColumn("q_shard", _shard_number(starts)(F.col("shard"), F.col("key"))), ("q_shard", "shard", "key")
    else:  # one key on both sides of an edge: only a sort of the samples tells how many go to which side
        numbered, order = with_index(samples, "shard", "key", name="q_index").withColumn("q_shard", F.floor(F.col("q_index") / per_shard)), ("q_shard", "q_index")
    os.makedirs(folder, exist_ok=True)
    columns = [c for c in ("key", "meta", "txt", "jpg") if c in samples.columns]

    def write(batches):
        now = None  # (number, temporary path, tar, samples)

        def closed() -> pa.RecordBatch:
            number, at, tar, n = now
            tar.close()
            os.replace(at, os.path.join(folder, f"{number:08d}.tar"))
            return pa.RecordBatch.from_arrays([pa.array([f"{number:08d}.tar"]), pa.array([n], pa.int64())], names=["shard", "samples"])

        for b in batches:
            for r in (row for i in range(0, b.num_rows, 64) for row in b.slice(i, 64).to_pylist()):
                if now is None or now[0] != r["q_shard"]:
                    if now is not None:
                        yield closed()
                    at = os.path.join(folder, f".{r['q_shard']:08d}.{os.getpid()}")
                    now = (r["q_shard"], at, tarfile.open(at, "w"), 0)
                add_sample(now[2], r)
                now = (*now[:3], now[3] + 1)
        if now is not None:
            yield closed()

    dealt = numbered.select(*dict.fromkeys((*order, *columns))).repartition("q_shard").sortWithinPartitions(*order)
    return dealt.mapInArrow(write, "shard string, samples long")


def first_samples(samples: DataFrame, n: int) -> DataFrame:
    """The first n samples in (shard, key) order."""
    return samples.orderBy("shard", "key").limit(n)


def resharded(samples: DataFrame, uids: DataFrame, folder: str, per_shard: int = 10_000) -> DataFrame:
    """Write the shards of a uid subset."""
    return write_shards(samples.join(uids.select("uid").distinct(), "uid", "left_semi"), folder, per_shard)
