"""Published tables: a folder for every run, and a manifest that says which folders count.

A run writes its tables below ``_runs`` and publishes them by adding one line to the manifest.
Spark's commit shows the file with that line in one step, so a reader finds all tables of the
run or none of them; nothing is moved or deleted before. The newest line names the folder of
every table: the run's own, and for other tables what the line before named.

Folders that none of the newest lines name may be deleted (``clean``). Readers that opened a
table under one of the kept lines are not disturbed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sources.sinks import remove

MANIFEST, RUNS = "_manifest", "_runs"

# Lines of the manifest whose folders stay.
KEPT_VERSIONS = 3

PLACE = T.StructType(
    [T.StructField("folder", T.StringType()), T.StructField("format", T.StringType())]
)
SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("tables", T.MapType(T.StringType(), PLACE)),
    ]
)


def new_folder(run_id: str) -> str:
    """A fresh folder below a target, also for a run id that was used before."""
    return f"{RUNS}/{run_id}-{uuid.uuid4().hex[:12]}"


def versions(spark: SparkSession, target: str, newest: int) -> list[Row]:
    """The newest lines of the manifest, newest first."""
    try:
        lines = spark.read.schema(SCHEMA).json(f"{target}/{MANIFEST}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return lines.orderBy(F.desc("version"), F.desc("time"), F.desc("run_id")).limit(newest).collect()


def publish(
    spark: SparkSession, target: str, run_id: str, folder: str, tables: Mapping[str, str]
) -> None:
    """Name ``folder`` (see ``new_folder``) as the place of ``tables``, given with their formats."""
    [*last] = versions(spark, target, 1)
    named = {t: (p.folder, p.format) for t, p in (last[0].tables if last else {}).items()}
    named |= {t: (f"{folder}/{t}", fmt) for t, fmt in tables.items()}
    entries = [
        x
        for table, (place, fmt) in named.items()
        for x in (F.lit(table), F.struct(F.lit(place).alias("folder"), F.lit(fmt).alias("format")))
    ]
    line = spark.range(0, 1, 1, 1).select(
        F.lit(last[0].version + 1 if last else 1).cast("long").alias("version"),
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("time"),
        F.create_map(*entries).alias("tables"),
    )
    line.write.mode("append").json(f"{target}/{MANIFEST}")


def read(spark: SparkSession, target: str, table: str, schema: T.StructType | str) -> DataFrame:
    """The table as the newest line names it."""
    [*last] = versions(spark, target, 1)
    if not last or table not in last[0].tables:
        raise LookupError(f"{target}: no published table {table}")
    place = last[0].tables[table]
    reader = spark.read.schema(schema)
    if place.format == "csv":
        reader = reader.option("header", True)
    return reader.format(place.format).load(f"{target}/{place.folder}")


def _run_folders(lines: Iterable[Row]) -> set[str]:
    return {p.folder.rpartition("/")[0] for line in lines for p in line.tables.values()}


def clean(spark: SparkSession, target: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Delete the run folders that only lines before the newest ``keep`` name."""
    lines = versions(spark, target, 1_000)
    gone = sorted(_run_folders(lines[keep:]) - _run_folders(lines[:keep]))
    for folder in gone:
        remove(spark, f"{target}/{folder}")
    return gone
