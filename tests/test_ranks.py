"""Exact order statistics against sorted values, and keyed hashes whose key no plan shows."""

from __future__ import annotations

import random
from hashlib import sha256
from math import ceil

import pytest
from pyspark.sql import functions as F

from tillstar.functions import privacy
from tillstar.operators import profile, ranks
from tillstar.sources import sinks

SHARES = [0.0, 0.001, 0.25, 0.5, 0.75, 1.0]


def plain(values):
    known = sorted(v for v in values if v is not None)
    return [known[max(1, ceil(s * len(known))) - 1] if known else None for s in SHARES]


@pytest.mark.parametrize("listed", [10_000, 7])
def test_quantiles_are_exact(spark, monkeypatch, listed):
    monkeypatch.setattr(ranks, "LISTED_VALUES", listed)
    rng = random.Random(5)
    spread = [rng.lognormvariate(0, 9) * rng.choice([-1, 1]) for _ in range(700)]
    hot = [*spread[:80], *[2.5] * 300, *[-0.25] * 150, None, None]
    for values in (spread, hot, [1.5], [None], [7.0] * 40):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
        found = ranks.exact_quantiles(df, "v", SHARES, sinks.staged(spark, "ranks"))
        assert found == plain(values)
    empty = spark.createDataFrame([], "v long")
    assert ranks.exact_quantiles(empty, "v", SHARES, sinks.staged(spark, "ranks")) == [None] * 6


def test_summary_of_distinct_values_is_exact(spark):
    df = spark.range(200_003).select(((F.col("id") * 7919) % 200_003).alias("v"))
    row = profile.exact_summary(df, "v", sinks.staged(spark, "ranks")).first()
    assert (row["count"], row["min"], row["max"]) == (200_003, 0, 200_002)
    assert [row[p] for p in ("p25", "p50", "p75")] == [ceil(200_003 * s) - 1 for s in (0.25, 0.5, 0.75)]


def shown(df):
    plans = df._jdf.queryExecution()
    modes = ["simple", "extended", "codegen", "cost", "formatted"]
    kind = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return plans.toString() + "".join(plans.explainString(kind.fromString(m)) for m in modes)


def test_a_secret_is_in_no_plan(spark, tmp_path):
    (tmp_path / "key.txt").write_text("pepper-4711\n")
    df = spark.createDataFrame([("a@x.com",), (None,)], "email string")
    expected = sha256(b"pepper-4711a@x.com").hexdigest()
    for secret in ("pepper-4711", privacy.secret_at(spark, f"{tmp_path}/key.txt")):
        hashed = df.select(privacy.pseudonym(F.col("email"), secret).alias("h")).distinct()
        assert {r.h for r in hashed.collect()} == {expected, None}
        assert "pepper" not in shown(hashed)
    (tmp_path / "two.txt").write_text("a\nb\n")
    (tmp_path / "none.txt").write_text("\n")
    for name in ("two", "none"):
        with pytest.raises(ValueError, match="expected one line"):
            privacy.secret_at(spark, f"{tmp_path}/{name}.txt")
