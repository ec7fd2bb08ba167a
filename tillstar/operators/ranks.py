"""Exact order statistics of a column of any size.

Values are counted, counts are dealt out by ranges of values and stored, and each part's total is
added up before it: that tells the part a rank falls into, and the rank within it. The part is
dealt out again until it has few enough values to be read in order. Nothing is sorted whole, no
task holds more than its part, and one line a part reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Values that are read in order on the driver.
LISTED_VALUES = 10_000


def _cumulated(lines: Iterable, ranks: list[int]) -> dict[int, tuple]:
    """For each rank the first of the ordered ``lines`` whose ``n`` reach it, and the sum before."""
    found, before, wanted = {}, 0, sorted(set(ranks))
    for line in lines:
        while wanted and wanted[0] <= before + line["n"]:
            found[wanted.pop(0)] = (line, before)
        before += line["n"]
    return found


def _at_ranks(
    counts: DataFrame, values: int, ranks: list[int], store: Callable[[DataFrame], DataFrame]
) -> dict[int, object]:
    """Value at each rank (from 1) of ``counts`` (value, n), which has ``values`` lines."""
    if values <= LISTED_VALUES:
        found = _cumulated(counts.orderBy("value").collect(), ranks)
        return {rank: line["value"] for rank, (line, _) in found.items()}
    most = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2, min(ceil(values / LISTED_VALUES), most))
    dealt = counts.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id())
    dealt = store(dealt)
    lines = dealt.groupBy("part").agg(
        F.min("value").alias("least"), F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")
    )
    inside: dict[int, tuple] = {}
    for rank, (line, before) in _cumulated(lines.orderBy("least").collect(), ranks).items():
        inside.setdefault(line["part"], (line["values"], []))[1].append((rank, rank - before))
    out = {}
    for part, (size, own) in inside.items():
        chosen = dealt.filter(F.col("part") == part).select("value", "n")
        found = _at_ranks(chosen, size, [within for _, within in own], store)
        out |= {rank: found[within] for rank, within in own}
    return out


def exact_quantiles(
    df: DataFrame, column: str, shares: list[float], store: Callable[[DataFrame], DataFrame]
) -> list:
    """For every share the least value that at least this share of the known values do not
    exceed; None where there are none. ``store`` keeps a DataFrame (see ``sinks.staged``)."""
    known = df.filter(F.col(column).isNotNull())
    counts = store(known.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")).first()
    if not total["values"]:
        return [None] * len(shares)
    ranks = [max(1, ceil(share * total["n"])) for share in shares]
    found = _at_ranks(counts, total["values"], ranks, store)
    return [found[rank] for rank in ranks]
