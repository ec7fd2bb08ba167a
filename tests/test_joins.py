"""Joins with one hot key: same rows as the plain join, whatever the spreading."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstar.operators import joins

FEW = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def hot_rows(spark, n=6_000):
    """A third of the rows on key 7, exact copies among them, the rest spread, some null."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    return spark.range(0, n, numPartitions=8).select(
        key.cast("long").alias("k"), (F.col("id") % 11).alias("v")
    )


@pytest.fixture
def many_partitions(spark):
    """So many shuffle partitions that an even share is smaller than the slices asked for."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def weighed(df):
    return df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def test_keep_matching_with_a_hot_key(spark, rows):
    df = hot_rows(spark)
    keys = weighed(df).filter((F.col("n") > 1) & (F.col("k") % 2 == 1))
    plain = df.join(keys.select("k"), "k", "left_semi")
    for per_slice in (10, 100, 1_000_000):
        assert rows(joins.keep_matching(df, keys, "k", "n", per_slice)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("per_slice", [10, 1_000_000])
def test_join_spread_with_a_hot_key(spark, rows, how, per_slice):
    df = hot_rows(spark)
    dimension = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    plain = df.join(dimension, "k", how)
    assert rows(joins.join_spread(df, dimension, "k", how, per_slice)) == rows(plain)


def test_join_spread_keeps_repeated_dimension_keys(spark, rows):
    df = hot_rows(spark, 600)
    dimension = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (None, "z")], "k long, d string")
    plain = df.join(dimension, "k", "inner")
    assert rows(joins.join_spread(df, dimension, "k", "inner", 10)) == rows(plain)


def test_every_key_above_its_share_is_spread(spark, many_partitions):
    """However many heavy keys there are, each one reaches several slices."""
    df = spark.range(0, 60_000, numPartitions=8).select((F.col("id") % 1200).alias("k"), "id")
    heavy = joins.heavy_keys(weighed(df).coalesce(8), ["k"], "n", 10)
    assert heavy.count() == 1200
    slices = joins._slice_rows(df, ["k"], heavy).groupBy("k")
    slices = slices.agg(F.count_distinct("__slice").alias("s"))
    assert slices.agg(F.min("s")).first()[0] > 1


def test_heavy_keys_are_fewer_than_partitions(spark):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(0, 6_000).select((F.col("id") % 40).alias("k"))
    assert joins.heavy_keys(weighed(df), ["k"], "n", 1).count() <= partitions


def test_many_hot_keys_lose_no_rows(spark, rows):
    df = hot_rows(spark)
    keys = weighed(df).filter(F.col("n") > 1)
    plain = df.join(keys.select("k"), "k", "left_semi")
    assert rows(joins.keep_matching(df, keys, "k", "n", 3)) == rows(plain)
    dimension = spark.range(0, 600).select(F.col("id").alias("k"))
    assert rows(joins.join_spread(df, dimension, "k", "left", 3)) == rows(df)


def test_hot_rows_reach_several_tasks(spark, many_partitions):
    """The third of the rows that shares a key is divided, exact copies included."""
    df = hot_rows(spark)
    heavy = joins.heavy_keys(weighed(df), ["k"], "n", 100)
    assert [r["k"] for r in heavy.collect()] == [7]
    slices = joins._slice_rows(df, ["k"], heavy).filter("k = 7").groupBy("__slice").count()
    counts = [r["count"] for r in slices.collect()]
    assert len(counts) > 10
    assert max(counts) < sum(counts) / 4


def test_rows_without_a_key_reach_several_tasks(spark):
    df = hot_rows(spark).withColumn("k", F.when(F.col("v") > 3, F.col("k")))
    sliced = joins._slice_rows(df, ["k"], joins.heavy_keys(weighed(df), ["k"], "n", 10_000))
    assert sliced.filter("k IS NULL").select("__slice").distinct().count() > 50
    assert sliced.filter("k IS NOT NULL AND __slice <> 0").isEmpty()


def test_slices_are_the_same_on_every_run(spark, rows):
    df = hot_rows(spark)
    heavy = joins.heavy_keys(weighed(df), ["k"], "n", 100)
    assert rows(joins._slice_rows(df, ["k"], heavy)) == rows(joins._slice_rows(df, ["k"], heavy))


@FEW
@given(
    left=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)), min_size=1, max_size=40),
    right=st.lists(st.integers(0, 6), max_size=8),
)
def test_spread_joins_equal_plain_joins(spark, rows, left, right):
    df = spark.createDataFrame(left, "k long, v long")
    dimension = spark.createDataFrame([(r, r * 10) for r in right], "k long, d long")
    for how in ("inner", "left"):
        assert rows(joins.join_spread(df, dimension, "k", how, 3)) == rows(
            df.join(dimension, "k", how)
        )


def test_dimension_size_decides(spark):
    small = spark.range(100).select(F.col("id").alias("k"))
    assert joins.fits_broadcast(small, 10_000)
    assert not joins.fits_broadcast(small, 100)
    assert joins.fits_broadcast(small.filter("k < 0"), 0)
    df = hot_rows(spark, 60)
    broadcast = joins.join_dimension(df, small, "k")
    shuffled = joins.join_dimension(df, small, "k", small=False)
    assert "BroadcastHashJoin" in plan(broadcast) and "__slice" not in plan(broadcast)
    assert "__slice" in plan(shuffled)
    assert sorted(map(tuple, broadcast.collect())) == sorted(map(tuple, shuffled.collect()))


def test_null_and_long_texts_are_measured(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "k long, t string")
    assert not joins.fits_broadcast(df, 1000)
    assert joins.fits_broadcast(df, 1200)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
