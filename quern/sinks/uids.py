"""Surviving uids as a sorted array of 128-bit numbers."""

from __future__ import annotations

import os
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import is_uid

DTYPE = np.dtype("u8,u8")


def checked(uids: DataFrame, column: str = "uid") -> DataFrame:
    """uids in lower case; a row that is not a 32-digit uid raises."""
    c = F.col(column)
    return uids.select(F.when(is_uid(c), F.lower(c)).otherwise(F.raise_error(F.concat(F.lit("not a 32-digit uid: "), F.coalesce(c, F.lit("null")))).cast("string")).alias("uid"))


def packed(uids: DataFrame, column: str = "uid") -> DataFrame:
    """(body): rows of up to a batch of sorted uids as packed pairs of unsigned numbers, in order."""
    ordered = checked(uids, column).orderBy("uid")  # digits of one case sort as the number pairs do

    def run(batches):
        for b in batches:
            if b.num_rows:
                raw = bytes.fromhex("".join(b.column(0).to_pylist()))
                pairs = np.frombuffer(raw, ">u8").astype("<u8")
                yield pa.RecordBatch.from_arrays([pa.array([pairs.tobytes()], pa.binary())], names=["body"])

    return ordered.mapInArrow(run, "body binary")


def save_uids(uids: DataFrame, folder: str, column: str = "uid", name: str = "ok_uids.npy") -> str:
    """Write folder/ok_uids.npy, a sorted array of (f0, f1). The driver holds one partition at a time, never all uids."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    n = 0
    with open(path + ".part", "wb") as f:
        for r in packed(uids, column).toLocalIterator(prefetchPartitions=True):
            f.write(r["body"])
            n += len(r["body"]) // DTYPE.itemsize
    with open(path, "wb") as out, open(path + ".part", "rb") as body:
        np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(DTYPE.newbyteorder("<")), "fortran_order": False, "shape": (n,)})
        while part := body.read(1 << 24):
            out.write(part)
    os.remove(path + ".part")
    return path


def read_uids(path: str) -> list[str]:
    """The uids of a saved array, as 32 digits each."""
    return [f"{int(a):016x}{int(b):016x}" for a, b in np.load(path)]


def uid_table(spark: SparkSession, path: str) -> DataFrame:
    """(place, uid) of a saved array; the driver maps the file and hands on slices of it."""
    pairs = np.load(path, mmap_mode="r")
    step = 1 << 20
    parts = []
    for lo in range(0, max(1, len(pairs)), step):
        some = pairs[lo : lo + step]
        digits = [f"{int(a):016x}{int(b):016x}" for a, b in some]
        parts.append(spark.createDataFrame(pa.table({"place": pa.array(range(lo, lo + len(some)), pa.int64()), "uid": pa.array(digits, pa.string())})))
    return reduce(DataFrame.union, parts)
