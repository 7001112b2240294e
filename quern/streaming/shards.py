"""The same filters over shards as they arrive in a folder. An extension: finite inputs need only the batch reader."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from quern.plans.steps import FilterStep
from quern.sources.shards import KINDS, from_binary

FILES = "path string, modificationTime timestamp, length long, content binary"


def shard_stream(spark: SparkSession, folder: str, columns: Iterable[str] = KINDS, files_per_trigger: int | None = None, bytes_per_trigger: int = 1 << 28) -> DataFrame:
    """Samples of tar files as they appear in a folder. A run takes about so many bytes, or so many files if their number is given: each run has a fixed cost, however small its files are."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.tar")
    reader = reader.option("maxBytesPerTrigger", bytes_per_trigger) if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)
    return from_binary(reader.load(folder), columns)


def filtered_to(samples: DataFrame, step: FilterStep, folder: str, checkpoint: str, once: bool = True):
    """Start writing the uids that a step keeps to Parquet. ``once``: stop when all files there now are done."""
    writer = step.plan(samples).writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
