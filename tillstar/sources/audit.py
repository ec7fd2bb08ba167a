"""One line per pipeline run: name, status, run id, UTC time; and what each run found."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas

SUCCEEDED = "Succeeded"
FAILED = "Failed"


def run_record(
    spark: SparkSession, pipeline_name: str, status: str, run_id: str, time: datetime | None = None
) -> DataFrame:
    time = time or datetime.now(timezone.utc)
    return spark.createDataFrame([(pipeline_name, status, run_id, time)], schemas.AUDIT)


def append_run(
    spark: SparkSession, path: str, pipeline_name: str, status: str, run_id: str
) -> None:
    run_record(spark, pipeline_name, status, run_id).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AUDIT).parquet(path)


def write_findings(found: DataFrame, path: str, run_id: str) -> None:
    """Keep the findings (finding, row_count) of a run, in place of any it left before."""
    (
        found.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FINDINGS).parquet(path)
