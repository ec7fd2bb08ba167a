"""Centroid clustering of whole-number vectors, nearest centroids by the threshold algorithm.

Every dimension has a list of the centroids sorted by their value there. For a vector, each list
is walked outward from the vector's own value, the closer side first. A centroid that a list
shows for the first time gets its exact squared distance. No centroid still unseen is closer in
any dimension than that dimension's frontier, so once the sum of the squared frontier distances
strictly exceeds the best exact distance, the search is over and no tie is lost. All numbers are
whole. The vectors of a slice are walked together, and leave as they are done.

Centroids start as the vectors with the least SHA-256 of ``seed:id``. Each round assigns every
vector and replaces each non-empty centroid by the floor of its vectors' mean. Centroids have a
fixed size and are sent to all tasks; a task returns one line of counts and sums for each.

Rows without a vector, with null or non-finite components, of another length than ``size``, or
with components whose square would leave 64 bits are dropped. Of a repeated id every row counts;
equal ids start in the order of their vectors, null ids last. Equal distances go to the smaller
centroid number. Fewer vectors than centroids start as many centroids as there are vectors; an
empty table gives an empty result. Vectors have a fixed length, so none is very long. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import stored
from tillstar.llm.vectors import SLICE_ROWS, group_sums, integer_vectors, matrix

SCALE, SIZE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, 1

# More than any difference of two components, and its square still fits.
BEYOND = 1 << 30


class Lists:
    """Per dimension the centroids sorted by their value, with both ends marked as beyond."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable").T
        values = np.take_along_axis(centroids.T, order, axis=1)
        # One place before and one after each list, so that a walk may run off its end.
        self.order = np.pad(order, ((0, 0), (1, 1)))
        self.values = values
        self.dimension = np.arange(centroids.shape[1])

    def _gap(self, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < self.values.shape[1])
        value = self.values[self.dimension, np.clip(place, 0, self.values.shape[1] - 1)]
        return np.where(inside, np.abs(rows - value), BEYOND)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Centroid number and squared distance of every row; exact distances computed."""
        number = np.zeros(len(rows), np.int64)
        best = np.full(len(rows), np.iinfo(np.int64).max)
        below = np.stack(
            [np.searchsorted(v, x, side="right") - 1 for v, x in zip(self.values, rows.T, strict=True)], 1
        )
        above = below + 1
        seen = np.zeros((len(rows), len(self.centroids)), bool)
        active, computed = np.arange(len(rows)), 0
        while len(active):
            x, low, high = rows[active], below[active], above[active]
            gap_low, gap_high = self._gap(x, low), self._gap(x, high)
            down = gap_low <= gap_high
            shown = self.order[self.dimension, np.where(down, low, high) + 1]
            below[active], above[active] = low - down, high + ~down
            fresh = np.zeros((len(active), len(self.centroids)), bool)
            fresh[np.arange(len(active))[:, None], shown] = True
            fresh &= ~seen[active]
            seen[active] |= fresh
            row, centroid = np.nonzero(fresh)  # ascending numbers within a row
            exact = np.full(fresh.shape, np.iinfo(np.int64).max)
            exact[row, centroid] = ((x[row] - self.centroids[centroid]) ** 2).sum(axis=1)
            computed += len(row)
            found = exact.argmin(axis=1)
            distance = exact[np.arange(len(active)), found]
            better = (distance < best[active]) | (
                (distance == best[active]) & (found < number[active])
            )
            best[active[better]], number[active[better]] = distance[better], found[better]
            frontier = (np.minimum(gap_low, gap_high) ** 2).sum(axis=1)
            active = active[(frontier <= best[active]) & ~seen[active].all(axis=1)]
        return number, best, computed


@dataclass
class Clusters:
    """Stored rows (vec_id, cluster, distance), the final centroids and what they sum up to."""

    rows: DataFrame
    centroids: np.ndarray

    def sums(self) -> DataFrame:
        """(cluster, n_vectors, cluster_inertia, inertia, centroid_sha256): one line for each
        cluster in use. Sums beyond 64 bits are null."""
        each = self.rows.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n_vectors"), F.try_sum("distance").alias("cluster_inertia")
        )
        total = self.rows.agg(F.try_sum("distance")).scalar()
        marks = [
            (k, sha256(",".join(map(str, c)).encode()).hexdigest())
            for k, c in enumerate(self.centroids.tolist())
        ]
        named = self.rows.sparkSession.createDataFrame(marks, "cluster int, centroid_sha256 string")
        return each.withColumn("inertia", total).join(F.broadcast(named), "cluster")


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    shared = vectors.sparkSession.sparkContext.broadcast(Lists(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        count = np.zeros(len(lists.centroids), np.int64)
        total = np.zeros_like(lists.centroids)
        for batch in batches:
            rows = matrix(batch, total.shape[1])
            for low in range(0, len(rows), SLICE_ROWS):
                own = rows[low : low + SLICE_ROWS]
                more, sums = group_sums(lists.nearest(own)[0], own, len(count))
                count += more
                total += sums
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": used.astype(np.int32),
                "n": count[used],
                "sums": pa.array(total[used].tolist(), pa.list_(pa.int64())),
            }
        )

    lines = vectors.select("ints").mapInArrow(run, "cluster int, n long, sums array<long>")
    each = [F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(centroids.shape[1])]
    moved = centroids.copy()
    for line in lines.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect():
        moved[line.cluster] = np.array(line[2:], np.int64) // line.n
    return moved


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(Lists(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(low, SLICE_ROWS)
                number, distance, _ = lists.nearest(matrix(piece, lists.centroids.shape[1]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": piece.column("vec_id"),
                        "cluster": number.astype(np.int32),
                        "distance": distance,
                    }
                )

    return vectors.select("vec_id", "ints").mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    size: int = SIZE,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> Clusters:
    """Cluster of every usable row. At most ``centroids`` lines reach the driver a round."""
    vectors = integer_vectors(df, scale, id_col, vec_col, size=size)
    vectors = stored(vectors, "cluster-vectors")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = vectors.orderBy(mark.asc_nulls_last(), "ints").limit(centroids).select("ints")
    middle = np.array([r.ints for r in start.collect()], np.int64).reshape(-1, size)
    for _ in range(rounds if len(middle) else 0):
        middle = _moved(vectors, middle)
    return Clusters(stored(_assigned(vectors, middle), "clusters"), middle)
