"""Delimited and Parquet tables of captions and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPTION_URL = "caption string, url string"
URL_CAPTION = "url string, caption string"


def read_tsv(spark: SparkSession, path: str | list[str], schema: str = CAPTION_URL, header: bool = True) -> DataFrame:
    """Tab-separated rows under a declared schema; quotes are ordinary characters."""
    return spark.read.csv(path, sep="\t", schema=schema, header=header, quote="", enforceSchema=True)


def read_metadata(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """One frame of Parquet files; only ``columns`` are read, files that lack one give nulls."""
    df = spark.read.option("mergeSchema", "true").parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select(*columns) if columns else df


def concatenated(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames whose columns may differ; what is missing is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def described(spark: SparkSession, path: str) -> DataFrame:
    """(column, type) of a Parquet file or folder."""
    return spark.createDataFrame(spark.read.parquet(path).dtypes, "column string, type string")


def read_lines(spark: SparkSession, path: str, name: str = "pattern") -> DataFrame:
    """Distinct non-empty lines of a text file."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()
