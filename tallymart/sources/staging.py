"""Intermediate tables written to shared storage, to cut lineage and to know their size."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="tallymart-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder().name


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every write inside as soon as its rows are stored.

    Otherwise they stay until the driver's garbage collector finds that nothing refers to them.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


_within: list[str] = []


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Delete at the end what is staged inside, once the results that need it are stored."""
    folder = f"{_application_folder(spark)}/run-{uuid.uuid4().hex}"
    _within.append(folder)
    try:
        yield folder
    finally:
        _within.remove(folder)
        _delete(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = _within[-1] if _within else _application_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallymart-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> bool:
    """Delete what this application has staged, once its results are stored elsewhere."""
    return _delete(spark, _application_folder(spark))


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    What follows scans only the columns it needs, never repeats the work behind ``df`` when an
    executor is lost, and lets the optimizer choose joins by the real size of the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
