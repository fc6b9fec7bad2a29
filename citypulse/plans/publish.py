"""Publication of the wide table to a serving table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.session import fresh_path, remove
from citypulse.sources.serving import JdbcTable, ParquetServing
from citypulse.sources.tables import newest_of, on_dates


def unpublished(gold: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows strictly newer than the watermark; all rows of a first publication."""
    if watermark is None:
        return gold
    mark = F.lit(watermark).cast("timestamp_ntz")
    return on_dates(gold, mark).filter(F.col("time_bucket") > mark)


def publish(gold: DataFrame, target: JdbcTable | ParquetServing) -> bool:
    """Append what the target does not have yet. False if it is up to date already.

    The rows are computed once, into a folder that is removed in the end. They are appended under a
    run's name, in parallel; a marker then makes the run count. Whatever fails before it leaves
    rows that no reader takes, and the next publication brings the same rows again.
    """
    spark = gold.sparkSession
    watermark = target.watermark()
    rows = unpublished(gold, watermark).drop("bucket_date")
    staged = fresh_path(spark, "publish")
    try:
        rows.write.parquet(staged)
        table = spark.read.schema(rows.schema).parquet(staged)
        newest = newest_of(table)
        if newest is None:
            return False
        run = target.run_after(watermark)
        target.append(table, run)
        target.commit(run, newest)
        return True
    finally:
        remove(spark, staged)
