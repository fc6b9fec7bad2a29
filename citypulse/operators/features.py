"""Per-source features of a city and bucket, and the keys they are joined on.

All inputs carry ``meta_city`` and ``time_bucket``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.buckets import bucket_start
from citypulse.functions.scalars import transit_mode

KEYS = ("meta_city", "time_bucket")


def traffic_pivot(traffic: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Mean congestion and speed of every grid cell, one column each."""
    return (
        traffic.groupBy(*KEYS)
        .pivot("grid_id", cells or S.grid_ids())
        .agg(F.avg("congestion_ratio").alias("congestion"), F.avg("current_speed").alias("speed"))
    )


def weather_pivot(weather: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Mean rain and temperature of every grid cell, one column each."""
    return (
        weather.groupBy(*KEYS)
        .pivot("grid_id", cells or S.grid_ids())
        .agg(F.avg("rain_1h_mm").alias("rain"), F.avg("temp").alias("temp"))
    )


def with_mode(transit: DataFrame) -> DataFrame:
    """Split departures into road and rail by their line name."""
    return transit.withColumn("mode", transit_mode(F.col("line")))


def stressed(delay: str = "delay", threshold: int = S.STRESS_SECONDS) -> str:
    """SQL: 1 for a departure later than the threshold, 0 for any other, a null delay included."""
    return f"IF({delay} > {threshold}, 1, 0)"


def transit_stats(transit: DataFrame, threshold: int = S.STRESS_SECONDS) -> DataFrame:
    """Mean delay and stressed share of rail and road, null where a mode had no departures."""
    aggregates = []
    for mode in ("rail", "bus"):
        late = f"sum({stressed('delay', threshold)}) FILTER (WHERE mode = '{mode}')"
        departures = f"count(*) FILTER (WHERE mode = '{mode}')"
        aggregates += [
            F.expr(f"avg(delay) FILTER (WHERE mode = '{mode}') AS {mode}_avg_delay"),
            F.expr(f"try_divide({late}, {departures}) AS {mode}_stress_index"),
        ]
    return with_mode(transit).groupBy(*KEYS).agg(*aggregates)


def master_keys(*sources: DataFrame) -> DataFrame:
    """Every city and bucket that any source has rows for."""
    keys = sources[0].select(*KEYS)
    for other in sources[1:]:
        keys = keys.unionByName(other.select(*KEYS))
    return keys.distinct()


def bucket_bounds(
    traffic: DataFrame, weather: DataFrame, transit: DataFrame, width: str = S.BUCKET_WIDTH
) -> DataFrame:
    """Per source: rows, rows without a readable time, newest scrape time and newest bucket.

    One pass over one column of each source; the newest time is bucketed, not every row.
    Inputs need ``ts`` only. A source without any readable time has no newest bucket.
    """
    named = {"traffic": traffic, "weather": weather, "transit": transit}
    parts = [df.select(F.lit(name).alias("source"), "ts") for name, df in named.items()]
    bounds = (
        parts[0]
        .unionByName(parts[1])
        .unionByName(parts[2])
        .groupBy("source")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("ts").isNull()).alias("rows_without_time"),
            F.max("ts").alias("newest"),
        )
    )
    return with_newest_bucket(bounds, width)


def with_newest_bucket(bounds: DataFrame, width: str = S.BUCKET_WIDTH) -> DataFrame:
    """Add the bucket of ``newest``, null where that is null."""
    # Bucketing drops rows without a time, so those get a stand-in first.
    some_time = F.coalesce("newest", F.lit("1970-01-01").cast("timestamp_ntz"))
    bucket = F.when(F.col("newest").isNotNull(), bucket_start(some_time, width))
    return bounds.withColumn("newest_bucket", bucket)
