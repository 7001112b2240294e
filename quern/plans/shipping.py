"""Make this package importable in Python workers wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _DONE:
        return
    root = Path(__file__).resolve().parents[1]
    if root.parent.suffix != ".zip":
        target = os.path.join(tempfile.mkdtemp(prefix="quern-src-"), f"{root.name}-src.zip")
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(target)
    _DONE.add(app)
