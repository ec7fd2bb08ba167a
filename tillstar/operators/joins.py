"""Joins that stay balanced when one key holds a large share of the rows.

Two shapes are used throughout the library:

* ``join_dimension``: rows against a dimension. The dimension is measured first;
  it is broadcast only when it fits a byte bound, else both sides are shuffled
  with the heavy keys spread over several slices.
* ``keep_matching``: rows whose key is in a key table (a semi join), with the
  same spreading.

A slice number depends only on the task's partition and the row's content, so a
re-run of a lost task sends every row to the same place. Exact copies of one row
still spread, because they sit in different input partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.rules import any_of

# A side is broadcast only when its measured text size is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024

# Bytes a value costs beside its text.
ROW_OVERHEAD = 16

# Rows of one key that need no spreading, whatever the size of the input.
ROWS_PER_SLICE = 1_000_000

# Slices for the rows without a key.
MISSING_KEY_SLICES = 1_000_000

_SLICES = "__slices"
_SLICE = "__slice"
_WEIGHT = "__weight"


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one distributed aggregate (one row comes back)."""
    text = F.octet_length(F.concat_ws("", *df.columns)).cast("long")
    row_bytes = text + F.lit(ROW_OVERHEAD * len(df.columns))
    measured = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("size")).first()
    return measured["size"] <= limit


def slice_rows(counts: DataFrame, weight: str, rows_per_slice: int) -> Column:
    """Rows of one key a slice takes: ``rows_per_slice``, or an even share of all rows
    over the shuffle partitions if that is more.

    So a key above it holds more than one partition's share, and there can be no more
    such keys than shuffle partitions.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.coalesce(F.sum(weight), F.lit(0))).scalar()
    return F.greatest(F.lit(rows_per_slice).cast("double"), total / F.lit(partitions))


def heavy_keys(
    counts: DataFrame, key: Sequence[str], weight: str, rows_per_slice: int
) -> DataFrame:
    """Every key that needs several slices, with their number: fewer keys than there are
    shuffle partitions (see ``slice_rows``), which is what bounds the broadcast of this list."""
    share = slice_rows(counts, weight, rows_per_slice)
    slices = slices_for(F.col(weight), share)
    return counts.select(*key, slices.alias(_SLICES)).filter(F.col(_SLICES) > 1)


def slices_for(weight: Column, share: Column) -> Column:
    return F.ceil(weight / share).cast("int")


def _slice_rows(rows: DataFrame, key: Sequence[str], heavy: DataFrame) -> DataFrame:
    """Give every row one slice: zero, unless its key is heavy or missing.

    A missing key matches nothing, so its rows may go anywhere; an outer join keeps
    them, and without slices they would all meet in one task.
    """
    place = F.xxhash64(F.spark_partition_id(), *rows.columns)
    missing = any_of(F.col(k).isNull() for k in key)
    return (
        rows.join(F.broadcast(heavy), list(key), "left")
        .withColumn(
            _SLICE,
            F.when(F.col(_SLICES).isNotNull(), F.pmod(place, F.col(_SLICES)))
            .when(missing, F.pmod(place, F.lit(MISSING_KEY_SLICES)))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop(_SLICES)
    )


def _repeat_per_slice(df: DataFrame, slices: Column) -> DataFrame:
    last = F.coalesce(slices, F.lit(1)) - 1
    return df.withColumn(_SLICE, F.explode(F.sequence(F.lit(0), last)))


def keep_matching(
    rows: DataFrame,
    keys: DataFrame,
    key: str | Sequence[str],
    weight: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    heaviest: int | None = None,
) -> DataFrame:
    """Rows whose key is listed in ``keys``; null keys never match.

    ``keys`` holds one row per key with its number of rows in ``weight``. A key is
    repeated once per ``rows_per_slice`` of its rows, so all repeats together stay
    below ``keys + rows / rows_per_slice``. ``heaviest`` is the greatest of those numbers,
    if the caller knows it: where it fits one slice, nothing needs spreading.
    """
    key = [key] if isinstance(key, str) else list(key)
    if heaviest is not None and heaviest <= rows_per_slice:
        if len(key) == 1:
            # A filter, which Spark moves to where the key comes from, below the joins of ``rows``.
            return rows.filter(F.col(key[0]).isin(keys.select(*key)))
        return rows.join(keys.select(*key), key, "left_semi").select(*rows.columns)
    weighed = keys.select(*key, weight)
    heavy = heavy_keys(weighed, key, weight, rows_per_slice)
    share = slice_rows(weighed, weight, rows_per_slice)
    sliced_keys = _repeat_per_slice(weighed, slices_for(F.col(weight), share))
    return (
        _slice_rows(rows, key, heavy)
        .join(sliced_keys.select(*key, _SLICE), [*key, _SLICE], "left_semi")
        .select(*rows.columns)
    )


def join_spread(
    rows: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_slice: int = ROWS_PER_SLICE,
    counted: DataFrame | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Shuffle join on ``key`` with the heavy keys of ``rows`` spread over slices.

    ``counted`` has the keys of ``rows`` as often, if they are read there at less cost. With
    ``hashed`` every task holds its share of ``other``, and the wider ``rows`` are not sorted.
    """
    keys = rows if counted is None else counted
    counts = keys.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(_WEIGHT))
    heavy = heavy_keys(counts, [key], _WEIGHT, rows_per_slice)
    repeated = _repeat_per_slice(other.join(F.broadcast(heavy), key, "left"), F.col(_SLICES))
    repeated = repeated.drop(_SLICES)
    if hashed:
        repeated = repeated.hint("shuffle_hash")
    return _slice_rows(rows, [key], heavy).join(repeated, [key, _SLICE], how).drop(_SLICE)


def join_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    small: bool | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows against a dimension on ``key``, one key column out.

    ``small`` skips the measurement when the caller has already made it.
    """
    if small is None:
        small = fits_broadcast(dimension)
    if small:
        return rows.join(F.broadcast(dimension), key, how)
    return join_spread(rows, dimension, key, how, rows_per_slice)
