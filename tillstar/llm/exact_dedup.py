"""Exact duplicates by recipes of content-defined chunks.

A text is cut where its own bytes say so, so equal stretches give equal chunks. Each text
becomes a recipe: the ordered identifiers of its chunks, a few bytes for each two kilobytes.
Only recipes are shuffled; no text moves. An identifier is a 64-bit hash with the chunk's
length, verified by SHA-256: where one identifier has several digests, a variant number tells
them apart, so equal recipes mean equal texts.

Texts are equal when identical after lower-casing A-Z. Nulls are empty texts, all empty texts
are equal. Of equal texts the row with the largest id stays; rows that repeat this id all
count as kept, a group without any id keeps its rows without id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import chosen, mix, stored, text_slices

# A chunk ends where the hash of its last eight bytes is a multiple of MEAN_CHUNK, and after
# MAX_CHUNK bytes at the latest.
MEAN_CHUNK, MAX_CHUNK = 2_048, 16_384
VARIANTS = "array<struct<at:int,variant:bigint>>"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions where a chunk may end, from the eight bytes before each."""
    if len(data) < 8:
        return np.zeros(0, np.int64)
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8))
    marks = mix(eight.view(np.uint64).ravel())
    return np.flatnonzero((marks & np.uint64(MEAN_CHUNK - 1)) == 0) + 8


def chunks(text: bytes, ends: list[int]) -> list[bytes]:
    """``text`` cut at ``ends``, longer pieces cut again at fixed steps."""
    parts, low = [], 0
    for high in [*ends, len(text)]:
        parts += [text[at : min(at + MAX_CHUNK, high)] for at in range(low, high, MAX_CHUNK)]
        low = high
    return parts


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_sha256", pa.string()),
            ("n_bytes", pa.int64()),
            ("weak", pa.list_(pa.int64())),
            ("strong", pa.list_(pa.binary())),
        ]
    )
    for batch in batches:
        for low, high, data, offsets in text_slices(batch):
            data = _LOWER[data]
            raw, ends = data.tobytes(), cuts(data)
            whole, sizes, weak, strong = [], [], [], []
            for start, end in zip(offsets[:-1], offsets[1:], strict=True):
                text = raw[start:end]
                own = ends[np.searchsorted(ends, start + 8) : np.searchsorted(ends, end)] - start
                parts = chunks(text, own.tolist())
                whole.append(sha256(text).hexdigest())
                sizes.append(len(text))
                weak.append([xxhash.xxh64_intdigest(p, len(p)) - (1 << 63) for p in parts])
                strong.append([sha256(p).digest() for p in parts])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[low:high],
                    pa.array(whole),
                    pa.array(sizes, pa.int64()),
                    pa.array(weak, schema.field("weak").type),
                    pa.array(strong, schema.field("strong").type),
                ],
                schema=schema,
            )


def _with_variants(recipes: DataFrame) -> DataFrame:
    """``recipes`` with v: the variant of each chunk whose identifier has several digests.

    Identifiers with several digests are looked for first; mostly there is none.
    """
    steps = recipes.select(
        "doc_id", "text_sha256", F.posexplode(F.arrays_zip("weak", "strong")).alias("at", "c")
    ).select("doc_id", "text_sha256", "at", "c.weak", "c.strong")
    kinds = steps.select("weak", "strong").distinct().groupBy("weak")
    clashes = kinds.agg(F.sort_array(F.collect_list("strong")).alias("kinds"))
    clashes = stored(clashes.filter(F.size("kinds") > 1), "clashes")
    if clashes.isEmpty():
        return recipes.withColumn("v", F.expr(f"cast(array() as {VARIANTS})"))
    told = steps.join(clashes, "weak").select(
        "doc_id",
        "text_sha256",
        F.struct("at", F.array_position("kinds", F.col("strong")).alias("variant")).alias("v"),
    )
    told = told.groupBy("doc_id", "text_sha256").agg(F.sort_array(F.collect_set("v")).alias("v"))
    told = told.withColumnsRenamed({"doc_id": "told_id", "text_sha256": "told_sha256"})
    same = recipes["doc_id"].eqNullSafe(told["told_id"])
    same &= recipes["text_sha256"] == told["told_sha256"]
    listed = recipes.join(told, same, "left").drop("told_id", "told_sha256")
    return listed.withColumn("v", F.coalesce("v", F.expr(f"cast(array() as {VARIANTS})")))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One line per row: doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks."""
    recipes = chosen(df, id_col, text_col).mapInArrow(
        _recipes,
        "doc_id long, text_sha256 string, n_bytes long, weak array<long>, strong array<binary>",
    )
    recipes = stored(recipes, "recipes")
    listed = _with_variants(recipes).drop("strong")
    groups = listed.groupBy("weak", "v").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # Stored, so that the join deals both sides anew and can split the rows of a large group.
    groups = stored(groups, "groups")
    return listed.join(groups, ["weak", "v"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "n_bytes",
        F.size("weak").cast("long").alias("n_chunks"),
    )
