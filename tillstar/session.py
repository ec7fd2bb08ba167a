"""Session settings that follow from the size of the input and of the cluster."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Bytes one task should read, and bytes one shuffle partition should hold.
SCAN_BYTES = 256 * MIB
SHUFFLE_BYTES = 192 * MIB


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Enough shuffle partitions for each to fit in memory, and never fewer than cores.

    The adaptive settings join small partitions again and split the large ones of a
    skewed join, also where that costs an extra shuffle afterwards.
    """
    partitions = max(cores, ceil(input_bytes / SHUFFLE_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def tune(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Apply ``settings_for`` to a running session."""
    cores = spark.sparkContext.defaultParallelism
    for name, value in settings_for(input_bytes, cores).items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def tuned(spark: SparkSession, input_bytes: int) -> Iterator[SparkSession]:
    """``tune`` for the length of a block; the session's own settings return after it."""
    names = settings_for(input_bytes, 1)
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        yield tune(spark, input_bytes)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
