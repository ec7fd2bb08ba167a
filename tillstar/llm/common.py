"""Helpers the corpus operators share: text batches, scratch tables, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sources.sinks import freed_shuffles, scratch_path, setting

# Bytes of text worked on at once inside a task, few enough for a core's cache; one longer
# text is a slice of its own.
SLICE_BYTES = 256 * 1024


# Rows that a task hands to Python at once while an intermediate table is written: texts are
# long, and each batch is held by both sides.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Batches of ``BATCH_ROWS`` for the jobs of a block; the session's setting returns."""
    return setting(spark, _BATCH_SETTING, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and of the work behind it no shuffle file stays on disk."""
    with freed_shuffles(df.sparkSession):
        return stored(df, name)


def text_slices(
    batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of ``batch`` with the UTF-8 bytes of their texts and the text offsets.

    Nulls are empty texts. A slice ends before ``limit`` bytes unless one text is longer.
    """
    column = pc.fill_null(batch.column(name), "").cast(pa.large_binary())
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(ends, ends[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, whole[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


def chosen(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (as long) and the text, under fixed names, whatever else ``df`` holds."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as make it unlike every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def text_key() -> Column:
    """Tells apart the texts of rows that repeat an id."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def spread(spark: SparkSession) -> int:
    """Partitions for a shuffle: the session's own number."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): root is the least node.

    Alternates large-star and small-star steps; each step is two grouped passes over the
    edges and is written to the shared scratch folder, so lineage stays short. Only one
    line of counts per step reaches the driver.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stored, so that the join deals both sides anew and can split the rows of a hot node.
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "least")
        large = (
            both.filter("b > a")
            .join(least.withColumn("m", F.least("a", "m")), "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = stored(large, "edges")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        ends = F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))
        small = (
            large.join(least, "a")
            .select(F.explode(ends).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        edges = stored(small, "edges")
        line = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if tuple(line) == seen:
            break
        seen = tuple(line)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b"), F.col("b")).distinct())


def appended(df: DataFrame, make, columns: dict[str, pa.DataType], types: str) -> DataFrame:
    """``df`` with new columns that ``make(batch)`` computes as Arrow arrays, row by row in
    step with the batch. Columns of these names that ``df`` has already are replaced."""
    kept = df.drop(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [
                pa.array(values, kind) if not isinstance(values, pa.Array) else values
                for values, kind in zip(make(batch), columns.values(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *columns]
            )

    schema = T.StructType([*kept.schema.fields, *T.StructType.fromDDL(types).fields])
    return kept.mapInArrow(run, schema)
