"""Delimited records with line breaks inside quotes, read by as many tasks as the files have splits.

Whether a line begins inside a quoted value depends on all lines before it. Each line is a step
of a machine with two states: it has one end state if it begins outside a quoted value and one
if it begins inside. Steps are of four kinds: both end outside or both inside (the state before
does not matter), each state stays, or each changes. So the state anywhere follows from the last
step that does not depend on the state before it, and the number of changes since: sums and last
values along a split, and once more along the splits of a file. A split is sorted by itself and
has a bounded size; of a split one line goes into the order of its file.

Records of one line go straight on; only lines of longer records are brought together. A value
that is never closed takes the rest of its file, without the file's last line break.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class HeaderMismatch(ValueError):
    """The header of a file does not have the names of its contract."""


def closed(line: Column, sep: str, quote: str, escape: str) -> Column:
    """Whether a line that begins outside a quoted value also ends outside. A quote opens a value
    only as its first character; what follows a closing quote belongs to the value up to the
    separator."""
    s, q, e = (re.escape(c) for c in (sep, quote, escape))
    quoted = f"{q}(?:[^{q}{e}]|{e}(?s:.))*+{q}[^{s}]*+"
    plain = f"(?!{q})[^{s}]*+"
    return F.rlike(line, F.lit(f"^(?:{quoted}|{plain})(?:{s}(?:{quoted}|{plain}))*+$"))


# A record's lines in order: the split's place in the file, then the line's in the split.
PLACE = ("split", "line")


def _lines(spark: SparkSession, path: str | list[str], dialect: dict) -> DataFrame:
    """(file, split, line, value, out, into): each line with its end state after beginning
    outside and inside a quoted value; true is inside."""
    reader = spark.read.option("lineSep", "\n")
    if "pathGlobFilter" in dialect:
        reader = reader.option("pathGlobFilter", dialect["pathGlobFilter"])
    text = reader.text(path)
    value = F.regexp_replace("value", "\r$", "")
    signs = (dialect["sep"], dialect["quote"], dialect["escape"])
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        value.alias("value"),
    ).select(
        "*",
        (~closed(F.col("value"), *signs)).alias("out"),
        (~closed(F.concat(F.lit(dialect["quote"]), "value"), *signs)).alias("into"),
    )


def _known(known: Column, changes: Column, start: Column) -> Column:
    """State after the last step of known end and some changes; ``start`` if there was none."""
    return F.coalesce(known, start) != (changes % 2 == 1)


def _states(lines: DataFrame) -> DataFrame:
    """``lines`` with ``inside`` (at the begin of the line) and ``head`` (place of the line that
    begins its record)."""
    along = Window.partitionBy("file", "split").orderBy("line")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    sure = F.when(F.col("out") == F.col("into"), F.col("out"))
    change = (F.col("out") & ~F.col("into")).cast("int")
    steps = lines.select("*", sure.alias("sure"), F.sum(change).over(upto).alias("turns"))
    since = F.when(F.col("sure").isNotNull(), F.col("turns"))
    steps = steps.select(
        "*",
        F.last("sure", True).over(before).alias("known"),
        (
            F.coalesce(F.last("turns").over(before), F.lit(0))
            - F.coalesce(F.last(since, True).over(before), F.lit(0))
        ).alias("changes"),
    )
    # What a split as a whole does, from its last line.
    sums = steps.groupBy("file", "split").agg(
        F.max_by(F.struct("sure", "known", "changes", "out", "into"), "line").alias("x")
    )
    changed = F.col("x.changes") + (F.col("x.out") & ~F.col("x.into")).cast("int")
    sums = sums.select(
        "file",
        "split",
        F.coalesce(F.col("x.sure"), F.col("x.known")).alias("sure"),
        F.when(F.col("x.sure").isNotNull(), F.lit(0)).otherwise(changed).alias("odd"),
    )
    files = Window.partitionBy("file").orderBy("split")
    total = F.sum("odd").over(files.rowsBetween(Window.unboundedPreceding, 0))
    sums = sums.withColumn("total", total)
    # Changes in a split that ends in a known state count from that state on.
    base = F.when(F.col("sure").isNotNull(), F.col("total") - F.col("odd"))
    past = files.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "file",
        "split",
        _known(
            F.last("sure", True).over(past),
            F.coalesce(F.last("total").over(past), F.lit(0))
            - F.coalesce(F.last(base, True).over(past), F.lit(0)),
            F.lit(False),
        ).alias("begin"),
    )
    told = steps.join(sums, ["file", "split"])
    told = told.withColumn("inside", _known(F.col("known"), F.col("changes"), F.col("begin")))
    place = F.struct(*PLACE)
    head = F.last(F.when(~F.col("inside"), place), True).over(upto)
    told = told.select("file", *PLACE, "value", "out", "into", "inside", head.alias("head"))
    # Lines before the first record of a split go on the last record of an earlier one.
    last = told.groupBy("file", "split").agg(F.max_by("head", "line").alias("last"))
    last = last.select("file", "split", F.last("last", True).over(past).alias("earlier"))
    told = told.join(last, ["file", "split"])
    return told.withColumn("head", F.coalesce("head", "earlier")).drop("earlier")


def records(spark: SparkSession, path: str | list[str], dialect: dict) -> DataFrame:
    """(file, head, record) of every record that is not empty, header records included."""
    told = _states(_lines(spark, path, dialect))
    after = F.when(F.col("inside"), F.col("into")).otherwise(F.col("out"))
    alone = ~F.col("inside") & ~after
    one = told.filter(alone).select("file", "head", F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct(*PLACE, "value")))
    text = F.array_join(F.transform(parts, lambda x: x["value"]), "\n")
    more = told.filter(~alone).groupBy("file", "head").agg(text.alias("record"))
    return one.unionByName(more).filter("record <> ''")


def read_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, dialect: dict, corrupt: str
) -> DataFrame:
    """The records as the columns of ``schema``; ``corrupt`` keeps those that do not split.

    With a header, the first record of every file must name the columns of ``schema`` (but for
    ``corrupt``); one line for each different header reaches the driver.
    """
    rows = records(spark, path, dialect)
    options = {k: str(v) for k, v in dialect.items() if k not in ("header", "pathGlobFilter")}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    if dialect.get("header"):
        first = rows.filter("head.split = 0").groupBy("file")
        first = first.agg(F.min(F.struct("head", "record")).alias("first"))
        wanted = [c for c in schema.names if c != corrupt]
        names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(wanted))])
        names.add(corrupt, T.StringType())
        header = F.from_csv("first.record", F.lit(names.simpleString()[7:-1].replace(":", " ")), options)
        for line in first.select("first.record", header.alias("x")).distinct().collect():
            if line.x[corrupt] is not None or list(line.x)[: len(wanted)] != wanted:
                raise HeaderMismatch(
                    f"{path}: the header {line.record!r} does not have the columns {wanted}"
                )
        heads = first.select("file", F.col("first.head").alias("head"))
        rows = rows.join(heads, ["file", "head"], "left_anti")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("record", F.lit(kinds), options).alias("row")).select("row.*")
