"""Intermediate tables in the folder that the driver and all executors share.

A job that needs a cut in its lineage writes a Parquet table below
``spark.checkpoint.dir`` and reads it back: the files outlive lost executors,
and the reader knows their size, so joins on them are planned on facts. Only
where that setting is absent (tests on one machine) is a temporary folder used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_TABLES: list[str] = []
_SWEPT = 0.0
#: Seconds between two sweeps of finished plans.
SWEEP = 5.0


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables; raises on a cluster without one."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if set_dir:
        return f"{set_dir.rstrip('/')}/quern-{app}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="quern-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return f"file://{_OWN[app]}/quern-{app}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to a new table in the shared folder and return a reader of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _swept(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_path = path
    return out


def bucketed(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Like stored(), but bucketed by keys into spark.sql.shuffle.partitions buckets: joins on keys leave its rows where they are."""
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{unique}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).format("parquet").option("path", path).saveAsTable(unique)
    _swept(spark)
    _TABLES.append(unique)
    out = spark.table(unique)
    out._quern_path, out._quern_table = path, unique
    return out


def _swept(spark: SparkSession) -> None:
    """Let the driver drop plans that are done, so that executors delete their shuffle files soon, not at some later collection; every SWEEP seconds at most."""
    global _SWEPT
    if time.monotonic() - _SWEPT > SWEEP:
        _SWEPT = time.monotonic()
        spark.sparkContext._jvm.System.gc()


def release(*tables: DataFrame) -> None:
    """Delete tables made by stored(). Nothing may still be going to read them."""
    for t in tables:
        spark, path = t.sparkSession, t._quern_path
        if name := getattr(t, "_quern_table", None):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            _TABLES.remove(name)
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release_all(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; call it once results are written."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
