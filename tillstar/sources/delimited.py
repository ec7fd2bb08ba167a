"""Delimited files in: landing to raw copy, and typed reads under a contract."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sources import multiline

# Column that keeps a line the reader could not split into the contract's columns.
CORRUPT = "_corrupt_line"

# How the files of a raw copy begin, and those that hold the fields of such lines.
WHOLE, UNSPLIT = "part", "unsplit"

# The dialect of the raw files.
RAW_DIALECT = {"header": True, "sep": ",", "quote": '"', "escape": "\\"}

# The CSV writer trims values unless told not to; blanks are findings, so keep them.
KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _text_schema(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def read_text(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multi_line: bool = False,
    **options,
) -> DataFrame:
    """Every contract column as text, plus the lines that do not fit the contract.

    Header names are checked against the contract by the reader. Every column is
    parsed whatever a query selects, else a line that does not split would be
    noticed in some queries only. Set ``multi_line`` for fields that contain line breaks: the
    records are then found first (see ``multiline``), also by as many tasks as the files have
    splits, and the header is checked at once.
    """
    if multi_line:
        dialect = {**RAW_DIALECT, **options}
        return multiline.read_records(spark, path, _text_schema(schema), dialect, CORRUPT)
    return (
        spark.read.schema(_text_schema(schema))
        .options(**{**RAW_DIALECT, **options})
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .csv(path)
    )


def typed(text: DataFrame, schema: T.StructType, *also: str) -> DataFrame:
    """Text columns as the contract's types; what does not convert becomes null."""
    return text.select(*[_convert(f) for f in schema.fields], *also)


def _convert(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    return F.col(field.name).try_cast(field.dataType).alias(field.name)


def lost_values(schema: T.StructType) -> Column:
    """Per row of ``read_text`` the values that do not convert, and the line if it does not
    split, as (column, value)."""
    lost = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("value")),
        )
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    line = F.struct(F.lit(CORRUPT).alias("column"), F.col(CORRUPT).alias("value"))
    return F.array_compact(F.array(*lost, F.when(F.col(CORRUPT).isNotNull(), line)))


def contract_violations(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, the values that do not convert; and the lines that do not split."""
    lost = {
        f.name: F.count_if(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        )
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    }
    lost[CORRUPT] = F.count(CORRUPT)
    lines = [F.struct(F.lit(c).alias("column"), n.alias("lost")) for c, n in lost.items()]
    return text.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: T.StructType, **options
) -> DataFrame:
    """Typed rows of raw delimited files."""
    return typed(read_text(spark, path, schema, **options), schema)


def landing_to_raw(
    spark: SparkSession,
    landing: str | list[str],
    raw: str,
    schema: T.StructType,
    multi_line: bool = False,
    compression: str | None = None,
    **landing_options,
) -> None:
    """Copy one landing source to its own raw folder as quoted text.

    Nothing is typed or dropped on the way; all values stay text. A landing line that does not
    split is set aside whole, with its readable fields, as JSON in ``unsplit_path(raw)``. The
    copy holds these fields too, in files named after ``UNSPLIT``, so that ``read_raw`` can put
    the whole lines in their place. The copy runs in as many tasks as the source has splits, and
    is plain text unless ``compression`` names a codec, such as gzip.
    """
    text = read_text(spark, landing, schema, multi_line, **landing_options)
    broken = F.col(CORRUPT).isNotNull()
    text.filter(broken).write.mode("overwrite").json(unsplit_path(raw), compression=compression)
    _write_raw(text.filter(~broken), raw, "overwrite", WHOLE, compression)
    aside = read_unsplit(spark, raw, schema)
    if not aside.isEmpty():
        _write_raw(aside, raw, "append", UNSPLIT, compression)


def _write_raw(
    text: DataFrame, raw: str, mode: str, name: str, compression: str | None
) -> None:
    copy = text.drop(CORRUPT).write.mode(mode).option("mapreduce.output.basename", name)
    copy = copy.options(**RAW_DIALECT, **KEEP_SPACES, quoteAll=True)
    copy.csv(raw, compression=compression)


def unsplit_path(raw: str) -> str:
    """Where the landing lines that do not split are kept."""
    return f"{raw.rstrip('/')}_unsplit"


def read_unsplit(spark: SparkSession, raw: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_text_schema(schema)).json(unsplit_path(raw))


def read_raw(
    spark: SparkSession, raw: str, schema: T.StructType, multi_line: bool = False, **options
) -> DataFrame:
    """``read_text`` of a raw copy, in which lines that did not split on the way in are whole.

    Their rows come from the set-aside lines rather than from the copy's files of them. A folder
    that has nothing set aside beside it is read as it is.
    """
    try:
        aside = read_unsplit(spark, raw, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_text(spark, raw, schema, multi_line, **options)
    whole = read_text(spark, raw, schema, multi_line, pathGlobFilter=f"{WHOLE}-*", **options)
    return whole.unionByName(aside)
