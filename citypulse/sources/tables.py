"""Parquet tables of the flat and the wide stage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citypulse.session import exists
from citypulse.sources import commits

CITY = ("meta_city",)
#: Layout of the markers that a serving database has.
RUNS = "run STRING, newest TIMESTAMP_NTZ"


def write_by_city(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = CITY,
    spread_by: Sequence[str] | None = None,
    replace: str = "static",
) -> None:
    """Write a flat table partitioned by city, or by what ``partition_by`` names.

    The rebalance (by ``spread_by``, else by the partition columns) keeps the number of files near
    (data size / advisory partition size) instead of (tasks x cities), and splits a city that holds
    much of the data over several tasks. With ``mode="overwrite"``, ``replace`` says what goes: the
    whole folder ("static") or the partitions that the rows belong to ("dynamic"), whatever the
    session says.
    """
    writer = df.hint("rebalance", *(spread_by or partition_by)).write.mode(mode)
    writer.option("partitionOverwriteMode", replace).partitionBy(*partition_by).parquet(path)


def observed(seen: Observation) -> dict[str, object]:
    """What an observation has counted; empty where not one row was left behind it, for which Spark may have no values."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.getClass().getName():
            raise
        return {}


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table with its declared schema, or None where the path does not exist.

    The schema is passed, so that partition values keep their type (a city called "1" stays a
    string) and the files of an empty or partial run cannot change the columns. Any other
    problem with the path is raised.
    """
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


# --- tables of runs: rows by run and date, and a commit for every run that is complete ----
def run_after(watermark: datetime | None) -> str:
    """What the run that goes on from a watermark is committed as; there is one such run."""
    return "first" if watermark is None else f"after-{watermark:%Y%m%dT%H%M%S}"


def write_run(rows: DataFrame, path: str, run: str) -> datetime | None:
    """Write the rows of an attempt at a run below ``run=R/bucket_date=D``. Their newest bucket, None without rows."""
    seen = Observation()
    dated = rows.withColumn("bucket_date", F.to_date("time_bucket")).observe(seen, F.max("time_bucket").alias("newest"))
    write_by_city(dated, f"{path}/run={run}", partition_by=("bucket_date",))
    return observed(seen).get("newest")


def newest_of(table: DataFrame) -> datetime | None:
    """The newest bucket of a table."""
    return table.agg(F.max("time_bucket")).first()[0]


def commit_run(spark: SparkSession, path: str, run: str, newest: datetime) -> None:
    """Make an attempt's rows count. ``Conflict`` if another run has gone on from the same watermark."""
    days = commits.days_of(spark, f"{path}/run={run}", "bucket_date")
    name = commits.purpose_of(run)
    if not commits.put(spark, path, name, attempt=run, days=days, newest=commits.written(newest)):
        raise commits.Conflict(f"another run has committed {name} to {path}")


def watermark_of(spark: SparkSession, path: str) -> datetime | None:
    """Newest bucket of the complete runs, from their commits; None before the first."""
    runs = commits.entries(spark, path)
    newest = None if runs is None else runs.agg(F.max("newest")).first()[0]
    return None if newest is None else datetime.fromisoformat(newest)


def read_runs(
    spark: SparkSession, path: str, schema: str, first: date | None = None, last: date | None = None
) -> DataFrame | None:
    """The rows of complete runs with their ``bucket_date``, of a span of days. None before the first run."""
    rows = commits.read_live(spark, path, f"{schema}, bucket_date DATE", "run", "bucket_date", first, last)
    return None if rows is None else rows.drop("run")


def on_dates(df: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Rows of a span of times, where the table says by date which folders those are in."""
    if "bucket_date" not in df.columns:
        return df
    if first is not None:
        df = df.filter(F.col("bucket_date") >= F.to_date(first))
    return df if last is None else df.filter(F.col("bucket_date") <= F.to_date(last))
