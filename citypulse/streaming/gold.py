"""The wide feature table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citypulse import schemas as S
from citypulse.functions.buckets import with_calendar, with_ts
from citypulse.plans.gold import features, measurements


# Names under which a session runs in UTC.
UTC = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00"}


def _event_time(df: DataFrame) -> DataFrame:
    """Watermarks need a zoned timestamp: the zone-free scrape time read as UTC."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC:
        raise ValueError(f"set spark.sql.session.timeZone to UTC (is {zone}): scrape times carry no zone")
    return with_ts(df).withColumn("ts", F.col("ts").cast("timestamp"))


def gold_stream(
    traffic: DataFrame,
    weather: DataFrame,
    transit: DataFrame,
    width: str = S.BUCKET_WIDTH,
    delay: str = "0 seconds",
    per_source: bool = False,
    cells: list[str] | None = None,
) -> DataFrame:
    """Wide rows of closed buckets, in append mode.

    By default the watermark follows the newest time over all sources, as the batch build does.
    ``per_source`` sets one watermark per source, so the slowest decides and a lagging source
    loses no rows; ``delay`` keeps buckets open longer. One aggregation, whose state is a
    single row per city and open bucket.
    """
    traffic, weather, transit = (_event_time(df) for df in (traffic, weather, transit))
    if per_source:
        traffic, weather, transit = (df.withWatermark("ts", delay) for df in (traffic, weather, transit))
        narrow = measurements(traffic, weather, transit)
    else:
        narrow = measurements(traffic, weather, transit).withWatermark("ts", delay)
    cells = cells or S.grid_ids()
    means = [F.expr(f"avg({m}) FILTER (WHERE slot = '{slot}') AS {name}") for slot, m, name in features(cells)]
    wide = (
        narrow.groupBy("meta_city", F.window("ts", width).alias("bucket"))
        .agg(*means)
        .withColumn("time_bucket", F.col("bucket.start").cast("timestamp_ntz"))
    )
    return with_calendar(wide).select(*S.wide_columns(cells))


def write_gold_stream(gold: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        gold.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
