"""Vector arithmetic over array columns: cosine, hyperbolic maps and specificity."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-8
#: Numbers of a reference set that may be sent to every executor.
MOST_REFERENCES = 8_000_000
K = 0.1


def _double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if either is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def logit(a: Column, b: Column, scale: float = 100.0) -> Column:
    """Scaled similarity, as a contrastive model's logits per pair."""
    return cosine(a, b) * F.lit(scale)


def expm(v: Column, curvature: float = 1.0) -> Column:
    """struct(space, time): exponential map of v at the origin of the Lorentz model."""
    root = math.sqrt(curvature)
    t = F.lit(root) * norm(v)
    shift = F.least(F.greatest(t, F.lit(EPS)), F.lit(math.asinh(2.0**15)))
    factor = F.sinh(shift) / F.greatest(t, F.lit(EPS))
    space = F.transform(_double(v), lambda x: x * factor)
    return F.struct(space.alias("space"), F.sqrt(F.lit(1 / curvature) + factor * factor * dot(v, v)).alias("time"))


def lorentz(v: np.ndarray, c: float) -> tuple[np.ndarray, np.ndarray]:
    """expm() of the rows of a matrix."""
    t = math.sqrt(c) * np.sqrt((v * v).sum(axis=1))
    factor = np.sinh(np.clip(t, EPS, math.asinh(2.0**15))) / np.maximum(t, EPS)
    space = v * factor[:, None]
    return space, np.sqrt(1 / c + (space * space).sum(axis=1))


def entailment(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], c: float = 1.0) -> np.ndarray:
    """(rows of x, rows of y): exterior angle less aperture; x and y as lorentz() gives them."""
    (xs, xt), (ys, yt) = x, y
    size = np.sqrt((xs * xs).sum(axis=1))
    aperture = np.arcsin(np.clip(2 * K / (math.sqrt(c) * size + EPS), -1 + EPS, 1 - EPS))
    inner = c * (xs @ ys.T - np.outer(xt, yt))
    below = size[:, None] * np.sqrt(np.maximum(inner * inner - 1, EPS)) + EPS
    return np.arccos(np.clip((yt + xt[:, None] * inner) / below, -1 + EPS, 1 - EPS)) - aperture[:, None]


def specificity(df: DataFrame, vector: str, references: DataFrame, ref_vector: str, curvature: float = 1.0, as_text: bool = False, name: str = "specificity") -> DataFrame:
    """df with the mean entailment residual between each vector and a reference set.

    An image is entailed by reference texts (the references are the general side); with ``as_text`` the roles turn.
    The set goes to every executor, so its size is checked first.
    """
    from quern.plans.shipping import ship

    width = references.select(F.max(F.size(ref_vector)).alias("d"), F.count(ref_vector).alias("n")).first()
    if not width["n"]:
        raise ValueError("the reference set is empty")
    if width["d"] * width["n"] > MOST_REFERENCES:
        raise ValueError(f"{width['n']} references of {width['d']} numbers are more than {MOST_REFERENCES} numbers")
    rows = np.array([r[0] for r in references.where(F.col(ref_vector).isNotNull()).select(_double(F.col(ref_vector))).collect()])
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(lorentz(rows, curvature))

    @F.pandas_udf("double")
    def mean(vectors):
        import pandas as pd

        out = np.full(len(vectors), np.nan)
        good = np.flatnonzero(vectors.notna())
        for lo in range(0, len(good), 1024):
            part = good[lo : lo + 1024]
            own = lorentz(np.vstack(vectors.iloc[part].to_numpy()).astype(float), curvature)
            out[part] = entailment(own, shared.value, curvature).mean(axis=1) if as_text else entailment(shared.value, own, curvature).mean(axis=0)
        return pd.Series(out)

    return df.withColumn(name, F.nullif(mean(_double(F.col(vector))), F.lit(float("nan"))))
