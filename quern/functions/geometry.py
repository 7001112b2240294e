"""Image dimensions: ratio tests and resize arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESIZE_MODES = ("no", "border", "keep_ratio", "keep_ratio_largest", "center_crop")


def ratio(w: Column, h: Column) -> Column:
    """w / h; null if h is 0."""
    return F.try_divide(w.cast("double"), h.cast("double"))


def worst_ratio(w: Column, h: Column) -> Column:
    return F.greatest(ratio(w, h), ratio(h, w))


def resized(w: Column, h: Column, mode: str = "keep_ratio_largest", size: int = 512) -> Column:
    """struct(width, height) after a resize.

    ``no`` leaves the image; ``border`` and ``center_crop`` give a square of ``size``; ``keep_ratio``
    brings the smaller side to ``size`` and ``keep_ratio_largest`` the larger one.
    """
    if mode not in RESIZE_MODES:
        raise ValueError(f"unknown resize mode {mode!r}; one of {RESIZE_MODES}")
    if mode == "no":
        out = w, h
    elif mode in ("border", "center_crop"):
        out = F.lit(size), F.lit(size)
    else:
        side = F.least(w, h) if mode == "keep_ratio" else F.greatest(w, h)
        scale = F.try_divide(F.lit(float(size)), side.cast("double"))
        out = F.greatest(F.round(w * scale), F.lit(1)), F.greatest(F.round(h * scale), F.lit(1))
    return F.struct(out[0].cast("int").alias("width"), out[1].cast("int").alias("height"))
