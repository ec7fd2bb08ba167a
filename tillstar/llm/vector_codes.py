"""Vector codes: every part of a vector becomes the number of its nearest codebook entry.

Vectors of whole numbers are cut into equal consecutive parts. The codebook of a part starts as
that part of the vectors with the smallest ids; each round assigns all parts to their nearest
entries and replaces every used entry by the floor of its parts' mean.

The entries of a codebook are searched through a GNAT: a node holds split points, and for every
pair of split point and child the least and greatest distance between the split point and what
the child holds. A query's distances to the split points leave a child out where the triangle
inequality puts all of it strictly beyond the best entry so far. Bounds are widened by more than
the rounding of square roots; what decides are whole squared distances, then the entry number.

Codebooks and trees have a fixed size and are sent to all tasks. A task returns one line of
counts and sums for each entry, so a vector that fills the table costs no more than another; the
driver sees one line an entry and round.

Rows without a vector, with null or non-finite components, or with components whose square would
leave 64 bits are dropped (see ``vectors``), as are vectors of another length than that of the
smallest kept id: their parts could not be compared. Vectors whose length does not divide into
the parts are dropped too. Of a repeated id every row counts; equal ids are taken in the order
of their vectors, null ids last. With fewer vectors than entries a codebook is shorter; an empty
table gives an empty result. Vectors are read whole, however long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import stored
from tillstar.llm.vectors import SLICE_ROWS, group_sums, integer_vectors, matrix, squared

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4

# Split points of a node, and entries that need no further node.
DEGREE, LEAF = 12, 10

# Factors that widen a bound by more than the rounding of square roots and of one sum.
UP, DOWN = 1 + 1e-14, 1 - 1e-14


@dataclass
class Node:
    """Entries with their points; of the split points, the distance ranges to each child."""

    entries: np.ndarray
    points: np.ndarray
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    children: tuple[Node | None, ...] = ()


def gnat(points: np.ndarray, entries: np.ndarray | None = None) -> Node:
    """The tree over ``points``, whose numbers are ``entries`` (ascending)."""
    if entries is None:
        entries = np.arange(len(points))
    if len(points) <= LEAF:
        return Node(entries, points)
    chosen = [0]
    least = squared(points, points[:1])[:, 0]
    while len(chosen) < DEGREE and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(points, points[chosen[-1:]])[:, 0])
    if len(chosen) < 2:  # all points are equal
        return Node(entries, points)
    chosen = np.sort(chosen)
    rest = np.setdiff1d(np.arange(len(points)), chosen)
    apart = squared(points[rest], points[chosen])
    home = apart.argmin(axis=1)
    away = np.sqrt(apart)
    near, far = (np.zeros((len(chosen), len(chosen))) for _ in range(2))
    children: list[Node | None] = []
    for k in range(len(chosen)):
        own = home == k
        if own.any():
            near[:, k] = away[own].min(axis=0) * DOWN
            far[:, k] = away[own].max(axis=0) * UP
            children.append(gnat(points[rest[own]], entries[rest[own]]))
        else:
            children.append(None)
    return Node(entries[chosen], points[chosen], near, far, tuple(children))


class Search:
    """Nearest entry of every query row: its number, squared distance, and the work done."""

    def __init__(self, root: Node, queries: np.ndarray):
        self.queries = queries
        self.distance = np.full(len(queries), np.iinfo(np.int64).max)
        self.entry = np.full(len(queries), np.iinfo(np.int64).max)
        self.compared = 0
        if len(queries):
            self._visit(root, np.arange(len(queries)))

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        apart = squared(self.queries[rows], node.points)
        self.compared += apart.size
        closest = apart.argmin(axis=1)  # the first of equals, so the smallest entry
        distance = apart[np.arange(len(rows)), closest]
        entry = node.entries[closest]
        better = (distance < self.distance[rows]) | (
            (distance == self.distance[rows]) & (entry < self.entry[rows])
        )
        self.distance[rows[better]] = distance[better]
        self.entry[rows[better]] = entry[better]
        away = np.sqrt(apart)
        # The child of the closest split point first: it is likely to shrink the radius.
        for first in (True, False):
            for k, child in enumerate(node.children):
                own = np.flatnonzero((closest == k) == first)
                if child is None or not len(own):
                    continue
                radius = np.sqrt(self.distance[rows[own]])[:, None]
                beyond = ((away[own] + radius) * UP < node.near[:, k]) | (
                    away[own] * DOWN > (node.far[:, k] + radius) * UP
                )
                left = own[~beyond.any(axis=1)]
                if len(left):
                    self._visit(child, rows[left])


@dataclass
class Codebooks:
    """For every part its entries, one row each."""

    entries: list[np.ndarray]
    size: int

    def sha256(self) -> str:
        """Of all components in decimal by part, entry and position, joined by commas."""
        text = ",".join(str(x) for part in self.entries for x in part.ravel().tolist())
        return sha256(text.encode()).hexdigest()

    def cut(self, rows: np.ndarray) -> list[np.ndarray]:
        return np.split(rows, len(self.entries), axis=1)


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums) of each task: what its parts add to the entries they are next to."""
    shared = vectors.sparkSession.sparkContext.broadcast((books, [gnat(p) for p in books.entries]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trees = shared.value
        counts = [np.zeros(len(p), np.int64) for p in own.entries]
        totals = [np.zeros_like(p) for p in own.entries]
        for batch in batches:
            rows = matrix(batch, own.size)
            for low in range(0, len(rows), SLICE_ROWS):
                for k, part in enumerate(own.cut(rows[low : low + SLICE_ROWS])):
                    found = Search(trees[k], part)
                    count, total = group_sums(found.entry, part, len(counts[k]))
                    counts[k] += count
                    totals[k] += total
        for k, (count, total) in enumerate(zip(counts, totals, strict=True)):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": np.full(len(used), k, np.int32),
                    "entry": used.astype(np.int32),
                    "n": count[used],
                    "sums": pa.array(total[used].tolist(), pa.list_(pa.int64())),
                }
            )

    return vectors.select("ints").mapInArrow(run, "part int, entry int, n long, sums array<long>")


def kept_vectors(
    df: DataFrame, id_col: str, vec_col: str, *also: str, scale: int = SCALE, parts: int = PARTS
) -> tuple[DataFrame, int]:
    """The usable vectors, stored, and their length (0 if there are none)."""
    vectors = integer_vectors(df, scale, id_col, vec_col, *also)
    vectors = vectors.filter((F.size("ints") > 0) & (F.size("ints") % parts == 0))
    vectors = stored(vectors, "code-vectors")
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select(F.size("ints")).first()
    size = first[0] if first else 0
    return vectors.filter(F.size("ints") == size), size


def trained(
    vectors: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks of ``kept_vectors``: at most ``entries`` lines reach the driver at the start,
    and one for each part and entry in each round."""
    start = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries)
    first = [r.ints for r in start.select("ints").collect()]
    rows = np.array(first, np.int64).reshape(len(first), size)
    books = Codebooks([p.copy() for p in np.split(rows, parts, axis=1)], size)
    width = size // parts
    for _ in range(rounds if len(rows) else 0):
        sums = _sums(vectors, books).groupBy("part", "entry")
        each = [F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(width)]
        for line in sums.agg(F.sum("n").alias("n"), *each).collect():
            total = np.array(line[3:], np.int64)
            books.entries[line.part][line.entry] = total // line.n
    return books


def encoded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The columns of ``vectors`` but for ``ints``, with ``codes`` (entry numbers in the order of
    the parts) and ``error`` (squared distance to those entries)."""
    shared = vectors.sparkSession.sparkContext.broadcast((books, [gnat(p) for p in books.entries]))
    kept = vectors.drop("ints")
    types = T.StructType.fromDDL("codes array<int>, error long").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trees = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(low, SLICE_ROWS)
                found = [
                    Search(tree, part)
                    for tree, part in zip(trees, own.cut(matrix(piece, own.size)), strict=True)
                ]
                codes = np.stack([f.entry for f in found], 1).astype(np.int32)
                columns = {c: piece.column(c) for c in piece.schema.names if c != "ints"}
                columns["codes"] = pa.array(codes.tolist(), pa.list_(pa.int32()))
                columns["error"] = sum(f.distance for f in found)
                yield pa.RecordBatch.from_pydict(columns)

    ordered = vectors.select(*kept.columns, "ints")
    return ordered.mapInArrow(run, T.StructType([*kept.schema.fields, *types]))


def decoded(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``approximation``: the middle of the entries' steps, as doubles."""
    shared = codes.sparkSession.sparkContext.broadcast(books)
    types = T.StructType.fromDDL("approximation array<double>").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            flat = batch.column("codes").flatten().to_numpy(zero_copy_only=False)
            numbers = flat.reshape(batch.num_rows, len(own.entries))
            rows = np.concatenate([e[numbers[:, k]] for k, e in enumerate(own.entries)], 1)
            values = pa.array(((rows + 0.5) / scale).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, values], names=[*batch.schema.names, "approximation"]
            )

    kept = codes.drop("approximation")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *types]))


def coded(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    *also: str,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, the columns ``also``, codes, error) of every usable row, stored, and the
    codebooks."""
    vectors, size = kept_vectors(df, id_col, vec_col, *also, scale=scale, parts=parts)
    books = trained(vectors, size, parts, entries, rounds)
    return stored(encoded(vectors, books), "vector-codes"), books


def with_label_errors(codes: DataFrame, label_col: str) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over equal labels, nulls together; null
    where the sum leaves 64 bits. Labels are reduced before they are joined back, and stored, so
    that the join can split a hot one."""
    label = F.col(f"`{label_col}`")
    sums = codes.groupBy(label.alias("__label")).agg(F.try_sum("error").alias("label_error"))
    sums = stored(sums, "label-errors")
    return codes.join(sums, label.eqNullSafe(F.col("__label")), "left").drop("__label")
