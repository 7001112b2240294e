"""Plan and run the download of images into shards; the fetcher is given, nothing here opens a connection."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.explore import with_index

SAMPLES_PER_SHARD = 10_000
RETRIES = 5
FETCHED = "shard_id long, key string, uid string, url string, caption string, jpg binary, status string, error_message string, sha256 string"


def planned(metadata: DataFrame, order: str = "uid", per_shard: int = SAMPLES_PER_SHARD) -> DataFrame:
    """metadata with shard_id and key: ``per_shard`` consecutive rows in order to a shard, keys zero-padded."""
    out = with_index(metadata, order, name="q_index")
    at = F.col("q_index")
    return out.withColumn("shard_id", F.floor(at / per_shard).cast("long")).withColumn("key", F.lpad(at.cast("string"), 12, "0")).drop("q_index")


def blurred_boxes(boxes: list, width: int, height: int) -> list[tuple[int, int, int, int]]:
    """Face boxes in shares of the image as pixel boxes inside it."""
    out = []
    for left, top, right, bottom in boxes or []:
        x0, y0 = max(0, int(left * width)), max(0, int(top * height))
        x1, y1 = min(width, int(right * width + 0.5)), min(height, int(bottom * height + 0.5))
        if x1 > x0 and y1 > y0:
            out.append((x0, y0, x1, y1))
    return out


def fetched(plan: DataFrame, fetch: Callable[[str], bytes], retries: int = RETRIES, change: Callable[[bytes, dict], bytes] | None = None) -> DataFrame:
    """plan: (shard_id, key, uid, url, text). One row a sample with its image or the error of its last attempt.

    change: an image step (resize, blur, re-encode) on the bytes and the row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                body, error = None, None
                for _ in range(retries + 1):
                    try:
                        body, error = fetch(r["url"]), None
                        break
                    except Exception as e:  # any failure of a fetch is a row's status
                        error = f"{type(e).__name__}: {e}"
                if body is not None and change is not None:
                    body = change(body, r)
                status = "failed_to_download" if error else "success"
                rows.append((r["shard_id"], r["key"], r["uid"], r["url"], r["text"], body, status, error, hashlib.sha256(body).hexdigest() if body is not None else None))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in FETCHED.split(", ")])

    return plan.select("shard_id", "key", "uid", "url", "text").repartition("shard_id").mapInPandas(run, FETCHED)


def companion_files(metadata_files: DataFrame, column: str = "file") -> DataFrame:
    """metadata_files with the name of the feature file that stands beside each Parquet file."""
    return metadata_files.withColumn("features", F.regexp_replace(column, r"\.parquet$", ".npz"))
