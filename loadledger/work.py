"""The shared folder for checkpoints, stream state and written intermediate tables.

The session names it in ``spark.checkpoint.dir``; where that is unset, a folder under
``spark.sql.warehouse.dir`` serves, which executors share as well. What is written there belongs to
the innermost open :func:`workspace`, which deletes it at its end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_OPEN: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session, or else one under its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_work"


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses; the first write creates it."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def workspace(spark: SparkSession) -> Iterator[list[str]]:
    """Owns every folder that :func:`new_dir` hands out inside, and deletes them at the end.

    Frames are lazy: write or collect the result inside. Without an open workspace the folders stay,
    as a frame that is returned may still read them.
    """
    owned: list[str] = []
    _OPEN.append(owned)
    try:
        yield owned
    finally:
        _OPEN.remove(owned)
        for path in owned:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is; one that was never written is no fault."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.delete(target, True)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it is done, not when the driver next collects garbage.

    What is run inside should be written, as by :func:`cut_lineage`, not run a second time.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few rows the driver knows, as a local relation: one partition, and a size Catalyst can see."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def plain(value, kind):
        if isinstance(kind, T.StructType) and value is not None:
            return {f.name: plain(v, f.dataType) for f, v in zip(kind, value)}
        return value

    table = pa.Table.from_pylist([plain(row, shape) for row in rows], schema=to_arrow_schema(shape))
    return spark.createDataFrame(table, shape)


def paths(spark: SparkSession, pattern: str) -> list[str]:
    """What is stored at a path or matches a pattern, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.globStatus(path)
    return [] if found is None else [status.getPath().toString() for status in found]


def folder_bytes(spark: SparkSession, folder: str, suffix: str = ".parquet") -> int:
    """What the files of a folder with a suffix hold, from one listing of it; no mark in its path counts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sum(s.getLen() for s in files.listStatus(path) if s.getPath().getName().endswith(suffix))


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything is stored at a path or below a pattern."""
    return bool(paths(spark, pattern))


def cut_lineage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    Whatever is lost later, nothing before this point is computed again, so a partitioning that might
    come out differently stays as it was. Being columnar, the table is read only where it is needed.
    """
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
