"""Vector codes and centroid clusters against plain Python over odd rows, ties and empty tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest

from tillstar.llm import centroid_clusters, vector_codes
from tillstar.llm.vectors import LARGEST, squared

SCHEMA = "vec_id long, embedding array<double>, label int, codes string, cluster string"


def odd_vectors(size: int, rows: int, seed: int = 3) -> list[tuple]:
    """Clustered vectors with ties, copies, repeated ids, and rows that cannot be used."""
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    out = []
    for k in range(rows):
        own = [m + rng.gauss(0, 0.1) for m in rng.choice(middles)]
        if k % 3 == 0:
            own = [round(x) / 2 for x in own]  # many equal distances
        out.append((k, own, rng.choice([None, 1, 2]), "x", "y"))
    out += [(k + rows, out[5][1], 1, None, None) for k in range(rows // 2)]  # a hot vector
    out += [out[0], out[0], (0, out[7][1], 2, "", "")]
    out.append((None, out[1][1], 1, None, None))
    bad = [None, [], [None] * size, [float("nan")] * size, [0.0] * (size - 1) + [float("inf")]]
    bad += [[0.5] * (size - 4), [0.5] * (size + 1), [1e30] * size]
    return out + [(10_000 + k, b, None, None, None) for k, b in enumerate(bad)]


def whole(rows, scale: int, size: int) -> list[tuple]:
    """(vec_id, whole components, label) of the usable rows."""
    return [
        (i, [floor(scale * x) for x in v], label)
        for i, v, label, *_ in rows
        if v is not None
        and len(v) == size
        and all(x is not None and isfinite(x) and abs(x * scale) < LARGEST for x in v)
    ]


def best(point, entries) -> tuple[int, int]:
    """Least squared distance and the first entry that has it."""
    return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), k) for k, e in enumerate(entries))


def moved(points, entries):
    own = defaultdict(list)
    for p in points:
        own[best(p, entries)[1]].append(p)
    return [
        [sum(x) // len(own[k]) for x in zip(*own[k], strict=True)] if own[k] else e
        for k, e in enumerate(entries)
    ]


def id_order(row):
    return (row[0] is None, row[0] or 0, row[1])


def brute_codes(rows, scale, size, parts, entries, rounds):
    kept = whole(rows, scale, size)
    width = size // parts
    cut = [[v[p * width : (p + 1) * width] for _, v, _ in sorted(kept, key=id_order)] for p in range(parts)]
    books = [c[:entries] for c in cut]
    for _ in range(rounds):
        books = [moved(c, b) for c, b in zip(cut, books, strict=True)]
    out = []
    for i, v, label in kept:
        found = [best(v[p * width : (p + 1) * width], b) for p, b in enumerate(books)]
        out.append((i, tuple(k for _, k in found), sum(d for d, _ in found), label))
    errors = Counter()
    for _, _, error, label in out:
        errors[label] += error
    return Counter((i, c, e, errors[label]) for i, c, e, label in out), books


@pytest.mark.parametrize("rounds", [0, 3])
def test_codes_against_plain_python(spark, rounds):
    rows = odd_vectors(8, 120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    codes, books = vector_codes.coded(df, "vec_id", "embedding", "label", entries=40, rounds=rounds)
    expected, plain = brute_codes(rows, 1024, 8, 4, 40, rounds)
    assert [b.tolist() for b in books.entries] == plain
    found = vector_codes.with_label_errors(codes, "label").collect()
    assert Counter((r.vec_id, tuple(r.codes), r.error, r.label_error) for r in found) == expected
    text = ",".join(str(x) for part in plain for entry in part for x in entry)
    assert books.sha256() == sha256(text.encode()).hexdigest()


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    df = spark.createDataFrame(odd_vectors(8, 60), SCHEMA)
    codes, books = vector_codes.coded(df, "vec_id", "embedding", entries=256)
    near = {i: v for i, v, _ in whole(odd_vectors(8, 60), 1024, 8)}
    for r in vector_codes.decoded(codes, books).collect():
        if r.vec_id:  # id 0 is repeated with another vector
            entry = [floor(x * 1024) for x in r.approximation]
            assert sum((a - b) ** 2 for a, b in zip(near[r.vec_id], entry, strict=True)) == r.error


def test_tree_finds_the_first_of_the_nearest_and_skips_subtrees():
    rng = np.random.default_rng(5)
    for spread, far in ((2, 3), (400, 6_000), (1 << 20, 1 << 25)):
        middles = rng.integers(-far, far, (12, 4))
        points = np.concatenate([m + rng.integers(-spread, spread, (25, 4)) for m in middles])
        points = np.concatenate([points, points[:40], np.repeat(points[:1], 30, axis=0)])
        queries = np.concatenate([points, points + rng.integers(-spread, spread, points.shape)])
        found = vector_codes.Search(vector_codes.gnat(points), queries)
        exact = np.stack([((queries - p) ** 2).sum(axis=1) for p in points], 1)
        assert (found.entry == exact.argmin(axis=1)).all()
        assert (found.distance == exact.min(axis=1)).all()
        assert spread == 2 or found.compared < exact.size / 2
    same = vector_codes.Search(vector_codes.gnat(np.zeros((50, 3), np.int64)), np.ones((2, 3), np.int64))
    assert same.entry.tolist() == [0, 0] and same.distance.tolist() == [3, 3]


def test_squared_distances_are_exact_for_large_components():
    rng = np.random.default_rng(6)
    a, b = (rng.integers(-LARGEST, LARGEST, (20, 16)) for _ in range(2))
    plain = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert squared(a, b).tolist() == plain


def brute_clusters(rows, scale, size, centroids, rounds, seed=1):
    kept = whole(rows, scale, size)

    def mark(row):
        return row[0] is None, sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1]

    middle = [v for _, v, _ in sorted(kept, key=mark)[:centroids]]
    for _ in range(rounds):
        middle = moved([v for _, v, _ in kept], middle)
    out = [(i, *reversed(best(v, middle))) for i, v, _ in kept]
    inertia = Counter()
    for _, k, d in out:
        inertia[k] += d
    marks = [sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    total = sum(inertia.values())
    return Counter((i, k, d, inertia[k], total, marks[k]) for i, k, d in out)


@pytest.mark.parametrize("rounds", [0, 3])
def test_clusters_against_plain_python(spark, rounds):
    rows = odd_vectors(64, 90)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clusters = centroid_clusters.clustered(df, rounds=rounds)
    found = clusters.rows.join(clusters.sums(), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
    assert Counter(map(tuple, found.collect())) == brute_clusters(rows, 64, 64, 16, rounds)


def test_walk_outward_keeps_ties_and_stops_early():
    rng = np.random.default_rng(8)
    centroids = rng.integers(-4, 4, (30, 3))
    rows = rng.integers(-5, 5, (400, 3))
    number, distance, _ = centroid_clusters.Lists(centroids).nearest(rows)
    exact = np.stack([((rows - c) ** 2).sum(axis=1) for c in centroids], 1)
    assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    centroids, rows = rng.integers(-4000, 4000, (300, 2)), rng.integers(-4000, 4000, (400, 2))
    number, _, computed = centroid_clusters.Lists(centroids).nearest(rows)
    exact = np.stack([((rows - c) ** 2).sum(axis=1) for c in centroids], 1)
    assert (number == exact.argmin(axis=1)).all()
    assert computed < exact.size / 4


def test_few_and_no_vectors(spark):
    for rows in ([], odd_vectors(8, 10)[-8:], [(3, [0.25] * 64, None, None, None)]):
        df = spark.createDataFrame(rows, SCHEMA)
        usable = int(bool(rows) and rows[0][0] == 3)
        codes, books = vector_codes.coded(df.filter("vec_id = 3"), "vec_id", "embedding", "label")
        assert vector_codes.with_label_errors(codes, "label").count() == usable
        assert len(books.entries[0]) == usable
        clusters = centroid_clusters.clustered(df)
        assert clusters.rows.join(clusters.sums(), "cluster").count() == usable
