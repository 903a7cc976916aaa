"""The latest moment in each run of a store, kept beside the run: a window of days before it needs no scan to find it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.sources.manifest import Run

FOLDER = "_extremes"

#: The columns by which windows of time are cut.
MOMENTS = {"transactions": "transaction_date"}


def write_extremes(spark: SparkSession, root: str, run: Run) -> None:
    """The latest moment of a run that has been written, in microseconds; of the run only that column is read."""
    if run.table not in MOMENTS:
        return
    column = MOMENTS[run.table]
    rows = spark.read.schema(f"{column} timestamp").parquet(f"{root}/{run.path}")
    rows.agg(F.max(F.unix_micros(column)).alias("latest")).write.parquet(f"{root}/{FOLDER}/{run.path}")


def latest_moment(spark: SparkSession, root: str, runs: list[Run]) -> Column:
    """The latest moment of some runs, as a literal; null where they have none. One number per run is read."""
    micros = None
    if runs:
        kept: DataFrame = spark.read.schema("latest bigint").parquet(*[f"{root}/{FOLDER}/{run.path}" for run in runs])
        micros = kept.agg(F.max("latest")).first()[0]
    return F.timestamp_micros(F.lit(micros).cast("bigint"))
