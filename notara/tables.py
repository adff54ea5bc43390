"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and the master is local (tests), a temporary folder that is then set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not at:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="notara-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


#: Rows and bytes of an Arrow batch where the session has Spark's defaults of 10,000 and 64 MB: a worker holds a batch of whole texts.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the rest of the session, unless it sets its own."""
    for key, default, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, default).lower() in (default, "64mb", "64m", f"{default}b"):
            spark.conf.set(key, str(value))


def _files(spark: SparkSession, path: str):
    """The path for the JVM, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


_scopes: list[set[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is deleted at the end of a scratch() around it, or when the application ends."""
    root = os.path.join(shared_dir(spark), "notara", spark.sparkContext.applicationId)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    at, files = _files(spark, root)
    files.mkdirs(at)
    files.deleteOnExit(at)
    if _scopes:
        _scopes[-1].add(path)
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives executors.  See new_path(); drop() deletes it too."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt out over all cores where its files give fewer partitions: rows that cost far more than their bytes in the file tell."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(4 * n)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end the tables saved within it, but for those that the function it gives was called on."""
    _scopes.append(set())

    def keep(table: DataFrame) -> DataFrame:
        read = table.inputFiles()
        _scopes[-1].difference_update({p for p in _scopes[-1] if any(os.path.basename(p) in x for x in read)})
        return table

    try:
        yield keep
    finally:
        for path in _scopes.pop():
            at, files = _files(spark, path)
            files.delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Delete tables of save() that nothing reads any more."""
    for df in tables:
        for folder in {os.path.dirname(x) for x in df.inputFiles()}:
            at, files = _files(df.sparkSession, folder)
            files.delete(at, True)
