"""Training settings by dataset scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Name, batch_size, learning_rate, train_num_samples, warmup, model, beta2.
SCALES = (
    ("debug", 1024, 1e-4, 128_000, 500, "ViT-B-32", None),
    ("small", 4096, 5e-4, 12_800_000, 500, "ViT-B-32", None),
    ("medium", 4096, 5e-4, 128_000_000, 500, "ViT-B-32", None),
    ("large", 8192, 5e-4, 1_280_000_000, 500, "ViT-B-16", None),
    ("xlarge", 90112, 1e-3, 12_800_000_000, 10000, "ViT-L-14", 0.95),
)
SCHEMA = "name string, batch_size int, learning_rate double, train_num_samples long, warmup int, model string, beta2 double"
_COLUMNS = tuple(x.split()[0] for x in SCHEMA.split(", "))


def names() -> list[str]:
    """Scale names, smallest scale first."""
    return [s[0] for s in SCALES]


def scale(name: str) -> dict:
    """The settings of one scale."""
    for s in SCALES:
        if s[0] == name:
            return dict(zip(_COLUMNS[1:], s[1:], strict=True))
    raise ValueError(f"unknown scale {name!r}; one of {names()}")


def table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCALES, SCHEMA)
