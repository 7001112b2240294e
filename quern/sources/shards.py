"""Tar shards of (image, caption, JSON) samples as a data source, one partition a shard.

    spark.read.format("shards").option("columns", "json,txt").load("/data/shards")

A sample is a run of members with one key. Rows: key, uid, txt, jpg, meta, shard. Members are read as a stream, so a
shard is never in memory as a whole. ``columns`` names the member kinds to read (Python sources get no column pruning).
Filters on uid (equality or a list) are applied before images and captions are kept, if
spark.sql.python.filterPushdown.enabled is on; read_shards() turns it on.
"""

from __future__ import annotations

import json
import tarfile
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "key string, uid string, txt string, jpg binary, meta string, shard string"
KINDS = ("json", "txt", "jpg")
UNKNOWN = "unknown"
_IMAGES = frozenset("jpg jpeg png webp gif".split())


def listed(paths: str | Iterable[str]) -> list[str]:
    """Tar files: those given, and those in given folders, in path order. Raises if there are none."""
    found: list[str] = []
    for p in [paths] if isinstance(paths, str) else paths:
        q = Path(p)
        found += map(str, q.glob("*.tar")) if q.is_dir() else [str(q)]
    if not found:
        raise ValueError("The tar files list is empty")
    return sorted(found)


def uid_in(meta: str | None) -> str | None:
    """The uid in a sample's JSON; 'unknown' without one, null for a JSON null."""
    try:
        given = json.loads(meta) if meta else {}
    except ValueError:
        return UNKNOWN
    return given.get("uid", UNKNOWN) if isinstance(given, dict) else UNKNOWN


def samples(members: Iterable[tuple[str, bytes]], kinds: frozenset[str], uids: frozenset[str] | None, shard: str) -> Iterator[tuple]:
    """Rows from (member name, bytes) in archive order."""

    def row() -> tuple | None:
        meta = held.get("json")
        uid = uid_in(meta.decode() if meta is not None else None)
        if uids is not None and uid not in uids:
            return None
        txt = held.get("txt")
        return (key, uid, txt.decode("utf-8", "replace").strip() if txt is not None else None, held.get("jpg"), meta.decode() if meta is not None and "json" in kinds else None, shard)

    key, held = None, {}
    for name, body in members:
        stem, _, ending = name.rpartition("/")[2].partition(".")
        ending = ending.lower()
        kind = "jpg" if ending in _IMAGES else ending
        if stem != key:
            if key is not None and (r := row()):
                yield r
            key, held = stem, {}
        if kind == "json" or kind in kinds:
            held[kind] = body
    if key is not None and (r := row()):
        yield r


def members(path: str, kinds: frozenset[str], keys: frozenset[str] | None = None) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the members, of the given keys only; bytes are read for wanted kinds."""
    with tarfile.open(path, mode="r|*") as tar:
        for m in tar:
            if m.isfile() and (keys is None or m.name.rpartition("/")[2].partition(".")[0] in keys):
                ending = m.name.rpartition("/")[2].partition(".")[2].lower()
                wanted = ending == "json" or ("jpg" if ending in _IMAGES else ending) in kinds
                yield m.name, tar.extractfile(m).read() if wanted else b""


class Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ShardReader(DataSourceReader):
    def __init__(self, options: dict):
        given = options.get("paths")
        self.paths = listed(json.loads(given) if given else options["path"])
        self.kinds = frozenset(x.strip() for x in options.get("columns", ",".join(KINDS)).split(","))
        if not self.kinds <= set(KINDS):
            raise ValueError(f"columns are some of {KINDS}")
        self.uids: frozenset[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {EqualTo: lambda f: (f.value,), In: lambda f: f.value}.get(type(f))
            if values and f.attribute == ("uid",):
                new = frozenset(values(f))
                self.uids = new if self.uids is None else self.uids & new
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Shard(p) for p in self.paths]

    def read(self, partition: Shard) -> Iterator[tuple]:
        yield from samples(members(partition.path, self.kinds), self.kinds, self.uids, partition.path.rpartition("/")[2])


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShardReader(self.options)


def read_shards(spark: SparkSession, paths: str | list[str], columns: Iterable[str] = KINDS, uids: list[str] | DataFrame | None = None) -> DataFrame:
    """Samples of tar shards. uids: only these; a short list goes into the scan, of a frame only the keys are joined before captions and images are read."""
    from quern.plans.shipping import ship

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ShardSource)
    df = spark.read.format("shards").option("paths", json.dumps(listed(paths))).option("columns", ",".join(columns)).load()
    if isinstance(uids, DataFrame):
        return _only(spark, df, listed(paths), frozenset(columns), uids)
    return df if uids is None else df.where(F.col("uid").isin(uids))


def _only(spark: SparkSession, samples_: DataFrame, paths: list[str], kinds: frozenset[str], uids: DataFrame) -> DataFrame:
    """The samples of a frame of uids. A first pass reads the JSON members only; the second keeps, of each shard, the members of wanted keys.

    A row a shard carries its wanted keys and uids, so the join moves these, never captions or images.
    """
    import pyarrow as pa

    columns = samples_.columns
    light = spark.read.format("shards").option("paths", json.dumps(paths)).option("columns", "json").load().select("uid", "key", "shard")
    wanted = light.join(uids.select("uid").distinct(), "uid", "left_semi").groupBy("shard").agg(F.collect_list(F.struct("key", "uid")).alias("keys"))
    files = spark.createDataFrame([(p, p.rpartition("/")[2]) for p in paths], "path string, shard string")
    schema = pa.schema([(c, pa.binary() if c == "jpg" else pa.string()) for c in columns])

    def run(batches):
        for b in batches:
            for path, keys in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keep, rows = frozenset(k["key"] for k in keys), []
                for r in samples(members(path, kinds, keep), kinds, frozenset(k["uid"] for k in keys), path.rpartition("/")[2]):
                    rows.append(r)
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    chosen = files.join(wanted, "shard").select("path", "keys").repartition("path")
    return chosen.mapInArrow(run, SCHEMA).select(columns)


def leading(spark: SparkSession, paths: str | list[str], n: int) -> list[str]:
    """The fewest first shards, by name, that hold n samples; of the samples only their number a shard is moved."""
    found = sorted(listed(paths), key=lambda p: (p.rpartition("/")[2], p))
    counts = dict(read_shards(spark, found, columns=("json",)).groupBy("shard").count().collect())  # a row a shard
    names, have = set(), 0
    for name in sorted({p.rpartition("/")[2] for p in found}):
        names.add(name)
        have += counts.get(name, 0)
        if have >= n:
            break
    return [p for p in found if p.rpartition("/")[2] in names]


def read_binary_shards(spark: SparkSession, path: str, columns: Iterable[str] = KINDS) -> DataFrame:
    """The same rows through Spark's own file reader, for stores that only Spark reaches (a shard must fit into a row, 2 GB)."""
    return from_binary(spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(path), columns)


def from_binary(files: DataFrame, columns: Iterable[str] = KINDS) -> DataFrame:
    """Samples of tar files given as (path, content), in a batch or a stream."""
    import pyarrow as pa

    from quern.plans.shipping import ship

    ship(files.sparkSession)
    kinds = frozenset(columns)
    schema = pa.schema([("key", pa.string()), ("uid", pa.string()), ("txt", pa.string()), ("jpg", pa.binary()), ("meta", pa.string()), ("shard", pa.string())])

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                with tarfile.open(fileobj=pa.BufferReader(content.as_buffer()), mode="r:*") as tar:
                    found = ((m.name, tar.extractfile(m).read()) for m in tar if m.isfile())
                    rows = []
                    for r in samples(found, kinds, None, path.rpartition("/")[2]):
                        rows.append(r)
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(shard, member, size) of every file in the tars; bodies are passed over, not kept."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for path in b.column(0).to_pylist():
                with tarfile.open(path, mode="r|*") as tar:
                    rows = [(path.rpartition("/")[2], m.name, m.size) for m in tar if m.isfile()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["shard", "member", "size"])

    found = listed(paths)
    files = spark.createDataFrame([(p,) for p in found], "path string").repartition(min(len(found), 10_000))
    return files.mapInArrow(run, "shard string, member string, size long")


def member(path: str, name: str) -> bytes | None:
    """One file out of a tar; None if it is not there."""
    with tarfile.open(path) as tar:
        return next((tar.extractfile(m).read() for m in tar if m.isfile() and m.name == name), None)


def shard_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(shard, mb, samples) of every tar file in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(path)
    size = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), (F.col("length") / 1e6).alias("mb"))
    count = read_shards(spark, path, columns=("json",)).groupBy(F.col("shard").alias("q_shard")).agg(F.count("*").alias("samples"))
    return size.join(count, F.col("shard") == F.col("q_shard"), "left").select("shard", "mb", F.coalesce("samples", F.lit(0)).alias("samples"))


META = "uid string, face_bboxes array<array<double>>, caption string, url string, key string, status string, error_message string, width int, height int, original_width int, original_height int, exif string, sha256 string"


def with_meta(df: DataFrame, column: str = "meta") -> DataFrame:
    """df with the sample's JSON as a struct ``m``."""
    return df.withColumn("m", F.from_json(F.col(column), META))
