"""Arrow-batch helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from quern.plans.shipping import ship


#: Bytes of an Arrow batch on its way to Python, where the session has Spark's default.
BATCH_BYTES = "16m"


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """df.mapInArrow with the package's sources sent along, smaller batches, and memory given back at a task's end."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m") in ("67108864b", "64m", "64MB"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, and other stages share its machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def positional(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1, ...: plans then hold whatever the names are, dots and clashes included."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def arrow_schema(df_or_ddl: str | StructType) -> pa.Schema:
    """The Arrow schema that Spark expects for a DDL string or struct type."""
    kind = _parse_datatype_string(df_or_ddl) if isinstance(df_or_ddl, str) else df_or_ddl
    return to_arrow_schema(kind)


def column(batch: pa.RecordBatch, i: int) -> list:
    return batch.column(i).to_pylist()


def slices(batch: pa.RecordBatch, at: int, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that column ``at`` has about ``most`` bytes at most in each part (one long text may exceed it)."""
    n, lo = batch.num_rows, 0
    if batch.nbytes <= most:
        yield batch
        return
    texts = batch.column(at)
    if pa.types.is_list(texts.type):  # of strings
        ends = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(texts.values), 0).to_numpy(zero_copy_only=False))]
        at_row = texts.offsets.to_numpy()
        sizes = (ends[at_row[1:]] - ends[at_row[:-1]]).tolist()
    else:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    total = 0
    for i in range(n):
        if total and total + sizes[i] > most:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += sizes[i]
    if lo < n:
        yield batch.slice(lo)
