"""Tables written on the way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..errors import ConfigurationError
from ..sources.discovery import _fs

_collecting: list[list[str]] = []
#: Spark's setting by which the shuffle files of a query go when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only where the session names none and all runs in one
    process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigurationError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="isohyet-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A folder for a table; it goes when the application ends, if not before."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    if _collecting:
        _collecting[-1].append(path)
    return path


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, so a lost executor costs no recomputation and
    values that depend on partitioning stay as they were first drawn.  The shuffle files of that job go with its end."""
    path = new_path(df.sparkSession, what)
    with clean_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def clean_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that write meanwhile leave no shuffle files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


@contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Paths of the tables written meanwhile go to the list; remove() deletes them when nothing reads them any more."""
    _collecting.append(paths)
    try:
        yield
    finally:
        _collecting.remove(paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    paths.clear()


def hand_over(paths: list[str]) -> None:
    """Paths that were collected go with those that whoever is outside collects."""
    if _collecting:
        _collecting[-1] += paths
