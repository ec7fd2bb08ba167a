"""Published tables out, and the shared scratch folder jobs may use."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillstar.sources.delimited import KEEP_SPACES

# Whether the shuffle files of an action go when it ends, not when the driver collects garbage.
_FREEING_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    rows_per_file: int = 10_000_000,
    compression: str | None = None,
) -> None:
    """Replace the table at ``path``.

    Files are written by as many tasks as the data has partitions; ``rows_per_file``
    only bounds the size of one file. ``compression`` is the format's own if not given.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer = writer.options(header=True, **KEEP_SPACES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only a session whose tasks run inside the driver's own process may lack the setting; it
    gets a folder for its lifetime, named in that setting from then on.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tillstar-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch root."""
    return f"{scratch_root(spark)}/tillstar/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it exists."""
    place, files = _located(spark, path)
    files.delete(place, True)


def size_of(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files at ``paths``; what is not there counts as nothing."""
    total = 0
    for path in paths:
        place, files = _located(spark, path)
        total += files.getContentSummary(place).getLength() if files.exists(place) else 0
    return total


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for the length of a block; the session's own returns after it."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Of the actions of a block no shuffle file stays on disk."""
    return setting(spark, _FREEING_SETTING, "true")


def staged(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    """A function that stores a DataFrame once in the scratch folder and reads it back."""
    return lambda df: materialise(df, scratch_path(spark, name))


def staged_alone(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    """``staged``, and of the work behind the stored table no shuffle file stays on disk."""

    def store(df: DataFrame) -> DataFrame:
        with freed_shuffles(spark):
            return staged(spark, name)(df)

    return store


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: the work behind it is not repeated after a loss."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
