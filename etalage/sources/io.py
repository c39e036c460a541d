"""Scans and sinks: source tables, layer tables (landing / bronze / silver / gold / snapshots).

A layer table is a folder of versions. A write goes to a new version and is
published by the ``_SUCCESS`` file that Spark's committer writes last; a read
takes the newest published version. So a table can be rebuilt from itself, is
never overwritten while it is read, and keeps its last version if a job fails.
A version's folder has a name of its own, so writers that run at the same time do
not meet; the one that publishes last is read. Old versions are dropped on request.

``read_declared`` reads a source under a declared schema: columns that are missing
are NULL, and what does not fit (a value of another type, a column nobody declared)
is kept as text in a rescue column.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from etalage.session import checkpoint_dir

#: the tables' file format
FORMAT = "parquet"
#: Spark's setting to drop a query's shuffle files when it ends, not when the driver collects garbage
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LAYERS = ("landing", "bronze", "silver", "gold", "snapshots")


def read_source(
    spark: SparkSession, root: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan one parquet source table ``root/name.parquet``.

    Selecting the columns right at the scan keeps ``ReadSchema`` narrow even
    before Catalyst's column pruning has a projection to work from.
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: what follows neither
    recomputes it nor depends on the executors that made it."""
    path = f"{checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write shuffles goes when it ends: nobody asks the plan of a write for it again."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_declared(spark: SparkSession, root: str, name: str, declared: str | StructType, rescued: str = "_rescued") -> DataFrame:
    """A source table under a declared schema, and a map of what does not fit.

    A column of another type is cast; a value that the cast cannot keep is NULL and stands
    in the map as text, as do all values of columns that are not declared. The map is NULL
    where everything fits. Names are compared without case, as Spark resolves them.
    """
    kind = StructType.fromDDL(declared) if isinstance(declared, str) else declared
    df = spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{name}.parquet")
    there = {f.name.lower(): f for f in df.schema}
    out, odd = [], []
    for f in kind:
        found = there.pop(f.name.lower(), None)
        if found is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif found.dataType == f.dataType:
            out.append(F.col(found.name).alias(f.name))
        else:
            value = F.col(found.name).try_cast(f.dataType)
            out.append(value.alias(f.name))
            odd.append(F.when(F.col(found.name).isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("k"), F.col(found.name).cast("string").alias("v"))))
    odd += [F.when(F.col(f.name).isNotNull(), F.struct(F.lit(f.name).alias("k"), F.col(f.name).cast("string").alias("v"))) for f in there.values()]
    left = F.array_compact(F.array(*odd)) if odd else None
    rescue = F.when(F.size(left) > 0, F.map_from_entries(left)) if odd else F.lit(None).cast("map<string,string>")
    return df.select(*out, rescue.alias(rescued))


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder that may not be there."""
    folder, fs = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []


def _versions(spark: SparkSession, path: str) -> list[tuple[int, int | None, str]]:
    """(number, when it was published, folder) of the versions in a table's folder, in order."""
    found = []
    for name in subfolders(spark, path):
        number = name.removeprefix("v").split("-")[0]
        if name.startswith("v") and number.isdigit():
            done, fs = file_system(spark, f"{path}/{name}/_SUCCESS")
            when = fs.getFileStatus(done).getModificationTime() if fs.exists(done) else None
            found.append((int(number), when, name))
    return sorted(found, key=lambda v: (v[0], v[1] or 0, v[2]))


def published_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published versions, the one to read last."""
    return [name for _, when, name in _versions(spark, path) if when is not None]


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    fmt: str | None = None,
    partition_by: Sequence[str] | None = None,
) -> str:
    """Full-refresh write of one model into a new version; returns its path."""
    spark, table = df.sparkSession, layer_path(root, layer, name)
    path = f"{table}/v{max((n for n, _, _ in _versions(spark, table)), default=0) + 1:06d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt or FORMAT).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(spark):
        writer.save(path)
    return path


def read_model(
    spark: SparkSession, root: str, layer: str, name: str, fmt: str | None = None
) -> DataFrame:
    """Scan the newest published version of a model written by :func:`write_layer`."""
    table = layer_path(root, layer, name)
    published = published_versions(spark, table)
    if not published:
        raise FileNotFoundError(f"no published version of {table}")
    return spark.read.format(fmt or FORMAT).load(f"{table}/{published[-1]}")


def drop_versions(spark: SparkSession, root: str, layer: str, name: str, keep: int = 2) -> list[str]:
    """Remove all published versions but the newest ``keep``; returns what is gone. For a time
    when no job reads an older one."""
    if keep < 1:
        raise ValueError("the newest version stays")
    table = layer_path(root, layer, name)
    old = published_versions(spark, table)[:-keep]
    for version in old:
        folder, fs = file_system(spark, f"{table}/{version}")
        fs.delete(folder, True)
    return old
