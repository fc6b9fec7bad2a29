"""Time buckets and the calendar columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.scalars import naive_timestamp


def bucket_start(ts: Column, width: str = S.BUCKET_WIDTH) -> Column:
    """Start of the epoch-aligned tumbling bucket. Not affected by daylight saving."""
    return F.window(ts, width).start


def with_ts(df: DataFrame, time_col: str = "meta_scraped_at") -> DataFrame:
    """Add ``ts`` where a table only has the scrape time as text."""
    return df if "ts" in df.columns else df.withColumn("ts", naive_timestamp(F.col(time_col)))


def with_bucket(df: DataFrame, width: str = S.BUCKET_WIDTH, time_col: str = "meta_scraped_at") -> DataFrame:
    """Add ``ts`` (if need be) and ``time_bucket``.

    Rows without a readable time have no bucket and drop out here; ``bucket_bounds``
    counts them.
    """
    return with_ts(df, time_col).withColumn("time_bucket", bucket_start(F.col("ts"), width))


def with_calendar(df: DataFrame) -> DataFrame:
    """Add hour of day and day of week (1 is Sunday) of the bucket."""
    return df.withColumns(
        {"hour_of_day": F.hour("time_bucket"), "day_of_week": F.dayofweek("time_bucket")}
    )
