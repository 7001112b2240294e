"""Image sizes from file headers, without decoding pixels."""

from __future__ import annotations

import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def size_of(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) of a JPEG, PNG, GIF or WebP image; None if it is none of these or broken."""
    try:
        if not data:
            return None
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", data[6:10])
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp(data)
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
    except (struct.error, IndexError):
        pass
    return None


def _webp(data: bytes) -> tuple[int, int] | None:
    kind = data[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
    if kind == b"VP8 ":
        w, h = struct.unpack("<HH", data[26:30])
        return w & 0x3FFF, h & 0x3FFF
    if kind == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    return None


def _jpeg(data: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:  # fill
            at += 1
            continue
        if 0xD0 <= marker <= 0xD9 or marker == 0x01:  # without a length
            at += 2
            continue
        size = struct.unpack(">H", data[at + 2 : at + 4])[0]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", data[at + 5 : at + 9])
            return w, h
        at += 2 + size
    return None


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height) of the image files below a path; null sizes for files that are no images."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.withColumn("size", size_column(F.col("content"))).select("path", "size.width", "size.height")


def size_column(image: Column) -> Column:
    """struct(width, height) of image bytes; null fields where there is no size."""
    from quern.plans.shipping import ship

    ship(SparkSession.active())

    @F.pandas_udf("width int, height int")
    def run(images: pd.Series) -> pd.DataFrame:
        found = [size_of(x) for x in images]
        return pd.DataFrame({"width": pd.array([f and f[0] for f in found], "Int32"), "height": pd.array([f and f[1] for f in found], "Int32")})

    return run(image)


def checked_column(place: Column, fetch: Callable[[str], bytes], test: Callable[[int, int], bool]) -> Column:
    """Whether the image at a URL or path passes a test of its width and height; any error is false.

    fetch: a URL or path to bytes; given by the caller, nothing here opens a connection.
    """
    from quern.plans.shipping import ship

    ship(SparkSession.active())

    def passes(x: str | None) -> bool:
        try:
            return bool(test(*size_of(fetch(x))))
        except Exception:  # whatever is wrong with one image, it is not a good one
            return False

    @F.pandas_udf("boolean")
    def run(places: pd.Series) -> pd.Series:
        return pd.Series([passes(x) for x in places], dtype="boolean")

    return run(place)


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
