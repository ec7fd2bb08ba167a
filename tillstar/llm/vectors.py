"""Integer vectors of an embeddings table, shared by the operators that work on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Scaled components stay below this, so that squared distances fit into 64 bits.
LARGEST = 1 << 26

# Rows worked on at once inside a task.
SLICE_ROWS = 2_000


def integer_vectors(
    df: DataFrame, scale: int, id_col: str, vec_col: str, *also: str, size: int | None = None
) -> DataFrame:
    """(vec_id, ints, and the columns ``also`` under their names) of the usable rows.

    ``ints`` holds floor(scale * x) of every component x, taken as double. Rows without a
    vector, with a null or non-finite component, or with one that scales beyond ``LARGEST``
    are left out; so are vectors of another length than ``size``, if given.
    """
    vector = F.col(f"`{vec_col}`")
    usable = F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float(LARGEST))
    )
    if size is not None:
        usable = usable & (F.size(vector) == size)
    return df.filter(vector.isNotNull() & usable).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).try_cast("int")).alias("ints"),
        *[F.col(f"`{c}`") for c in also],
    )


def matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors of a batch as rows; all have ``size`` components."""
    flat = batch.column("ints").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(batch.num_rows, size)


def squared(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all points."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(points).max(initial=0)))
    if 4 * most * most * max(rows.shape[1], 1) >= 1 << 53:
        return np.stack([((rows - p) ** 2).sum(axis=1) for p in points], 1)
    # Every product and sum is a whole number that a double holds exactly.
    a, b = rows.astype(np.float64), points.astype(np.float64)
    out = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    return out.astype(np.int64)


def group_sums(group: np.ndarray, rows: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of rows and sum of the rows of every group, in whole numbers."""
    count = np.bincount(group, minlength=groups)
    total = np.zeros((groups, rows.shape[1]), np.int64)
    if len(group):
        order = np.argsort(group, kind="stable")
        used = np.flatnonzero(count)
        first = (np.cumsum(count) - count)[used]
        total[used] = np.add.reduceat(rows[order], first, axis=0)
    return count, total
