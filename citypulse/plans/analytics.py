"""Reports over the wide feature table.

``gold`` is any DataFrame with the wide columns. Reports over recent data take the end of
their period in ``as_of``, by default now.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.sources.tables import on_dates

DIAGONAL = ("grid_0_0", "grid_1_1", "grid_2_2")
CELL = "grid_0_0"


def _at(time: str | datetime) -> Column:
    return F.lit(time).cast("timestamp_ntz")


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def _within(gold: DataFrame, period: str, as_of: str | datetime | None) -> DataFrame:
    end = _now() if as_of is None else _at(as_of)
    first = end - F.expr(f"INTERVAL {period}")
    return on_dates(gold, first).filter(F.col("time_bucket") >= first)


def _between(gold: DataFrame, start: str | datetime | None, end: str | datetime | None) -> DataFrame:
    """Rows of a time range, ends included; by default the last 12 hours."""
    last = _now() if end is None else _at(end)
    first = last - F.expr("INTERVAL 12 hours") if start is None else _at(start)
    return on_dates(gold, first, last).filter(F.col("time_bucket").between(first, last))


def _total(cells: list[str] | tuple[str, ...], metric: str, default: str | None = None) -> str:
    terms = [f"{c}_{metric}" if default is None else f"coalesce({c}_{metric}, {default})" for c in cells]
    return "(" + " + ".join(terms) + ")"


def strict_mean(cells: list[str] | tuple[str, ...], metric: str) -> Column:
    """Mean over cells of one row, null as soon as one cell is."""
    return F.expr(f"{_total(cells, metric)} / {len(cells)}")


def known_mean(cells: list[str], metric: str) -> Column:
    """Mean over the cells of one row that have a value."""
    present = " + ".join(f"IF({c}_{metric} IS NULL, 0, 1)" for c in cells)
    return F.expr(f"try_divide({_total(cells, metric, '0')}, {present})")


def _minutes(seconds: str) -> Column:
    return F.col(seconds) / F.lit(60.0)


# --- dashboard panels -------------------------------------------------------
def congestion_by_hour(gold: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Congestion throughout the day; a cell without a value counts as 0."""
    cells = cells or S.grid_ids()
    total = F.expr(_total(cells, "congestion", default="0"))
    return (
        gold.groupBy("hour_of_day")
        .agg((F.avg(total) / F.lit(len(cells))).alias("avg_congestion"))
        .orderBy("hour_of_day")
        .select(F.col("hour_of_day").cast("string").alias("hour"), "avg_congestion")
    )


def _over_time(gold: DataFrame, start, end, value: Column, name: str) -> DataFrame:
    return (
        _between(gold, start, end)
        .select(F.col("time_bucket").alias("time"), "meta_city", value.alias(name))
        .orderBy("time", "meta_city")
    )


def temp_over_time(gold: DataFrame, start: str | datetime | None = None, end: str | datetime | None = None) -> DataFrame:
    return _over_time(gold, start, end, strict_mean(DIAGONAL, "temp"), "avg_temp")


def speed_over_time(gold: DataFrame, start: str | datetime | None = None, end: str | datetime | None = None) -> DataFrame:
    return _over_time(gold, start, end, strict_mean(DIAGONAL, "speed"), "avg_speed_kmh")


def congestion_over_time(
    gold: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    cells: list[str] | None = None,
) -> DataFrame:
    return _over_time(gold, start, end, strict_mean(cells or S.grid_ids(), "congestion"), "avg_congestion")


# --- time-series reports ----------------------------------------------------
def congestion_avg(gold: DataFrame, as_of=None, period: str = "7 days", cell: str = CELL) -> DataFrame:
    """Congestion of one cell per bucket and city."""
    return (
        _within(gold, period, as_of)
        .filter(F.col(f"{cell}_congestion").isNotNull())
        .groupBy(F.col("time_bucket").alias("time"), "meta_city")
        .agg(F.avg(f"{cell}_congestion").alias("avg_congestion"))
        .orderBy("time", "meta_city")
    )


def rail_stress(gold: DataFrame, as_of=None, period: str = "24 hours") -> DataFrame:
    """Share of late rail departures, in percent."""
    return (
        _within(gold, period, as_of)
        .filter("rail_stress_index IS NOT NULL")
        .select(
            F.col("time_bucket").alias("time"),
            "meta_city",
            (F.col("rail_stress_index") * 100).alias("stress_percentage"),
        )
        .orderBy("time", "meta_city")
    )


def weather_vs_traffic(gold: DataFrame, as_of=None, period: str = "7 days", cell: str = CELL) -> DataFrame:
    """Rain against congestion of one cell, where both are known."""
    rain, congestion = f"{cell}_rain", f"{cell}_congestion"
    return (
        _within(gold, period, as_of)
        .filter(F.col(rain).isNotNull() & F.col(congestion).isNotNull())
        .groupBy(F.col("time_bucket").alias("time"), "meta_city")
        .agg(F.avg(rain).alias("rainfall_mm"), F.avg(congestion).alias("congestion_ratio"))
        .orderBy("time", "meta_city")
    )


def rain_congestion_correlation(
    gold: DataFrame, as_of=None, period: str = "7 days", cell: str = CELL
) -> DataFrame:
    """Correlation of rain and congestion of one cell, for every city.

    Over the buckets where both are known; null where fewer than two are, or one of both is constant.
    """
    rain, congestion = f"{cell}_rain", f"{cell}_congestion"
    both = _within(gold, period, as_of).filter(F.col(rain).isNotNull() & F.col(congestion).isNotNull())
    spread = F.stddev_pop(rain) * F.stddev_pop(congestion)
    return (
        both.groupBy("meta_city")
        .agg(F.count("*").alias("buckets"), F.try_divide(F.covar_pop(rain, congestion), spread).alias("correlation"))
        .orderBy("meta_city")
    )


def bus_vs_rail(gold: DataFrame, as_of=None, period: str = "24 hours") -> DataFrame:
    """Mean delays in minutes, where both modes ran."""
    return (
        _within(gold, period, as_of)
        .filter("bus_avg_delay IS NOT NULL AND rail_avg_delay IS NOT NULL")
        .select(
            F.col("time_bucket").alias("time"),
            "meta_city",
            _minutes("bus_avg_delay").alias("bus_delay_minutes"),
            _minutes("rail_avg_delay").alias("rail_delay_minutes"),
        )
        .orderBy("time", "meta_city")
    )


def hourly_patterns(gold: DataFrame, as_of=None, period: str = "30 days", cell: str = CELL) -> DataFrame:
    return (
        _within(gold, period, as_of)
        .groupBy("hour_of_day", "meta_city")
        .agg(
            F.avg(f"{cell}_congestion").alias("avg_congestion"),
            F.avg("rail_stress_index").alias("avg_rail_stress"),
        )
        .orderBy("hour_of_day", "meta_city")
    )


# --- table checks -----------------------------------------------------------
def first_rows(gold: DataFrame, n: int = 5) -> DataFrame:
    return gold.orderBy("time_bucket", "meta_city").limit(n)


def row_count(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count("*").alias("rows"))


def city_rows(gold: DataFrame, city: str, n: int | None = None) -> DataFrame:
    """Rows of one city in the order of time, the first ``n`` of them if given."""
    ordered = (
        gold.filter(F.col("meta_city") == city)
        .select("meta_city", "time_bucket", f"{CELL}_speed", "rail_stress_index")
        .orderBy("time_bucket")
    )
    return ordered if n is None else ordered.limit(n)


# --- recommended views ------------------------------------------------------
def heatmap(gold: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Mean congestion by hour and day of week."""
    return (
        gold.groupBy("hour_of_day", "day_of_week")
        .agg(F.avg(known_mean(cells or S.grid_ids(), "congestion")).alias("avg_congestion"))
        .orderBy("hour_of_day", "day_of_week")
    )


def city_comparison(gold: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """All measures side by side, one row per city."""
    cells = cells or S.grid_ids()
    grid = [F.avg(known_mean(cells, m)).alias(f"avg_{m}") for m in ("congestion", "speed", "rain", "temp")]
    transit = [
        F.avg(c).alias(f"mean_{c}")
        for c in ("rail_avg_delay", "rail_stress_index", "bus_avg_delay", "bus_stress_index")
    ]
    return gold.groupBy("meta_city").agg(F.count("*").alias("buckets"), *grid, *transit).orderBy("meta_city")


def peak_hours(gold: DataFrame, n: int = 3, cells: list[str] | None = None) -> DataFrame:
    """The ``n`` hours with the slowest traffic (a low ratio is a jam)."""
    return (
        gold.groupBy("hour_of_day")
        .agg(F.avg(known_mean(cells or S.grid_ids(), "congestion")).alias("avg_congestion"))
        .orderBy("avg_congestion", "hour_of_day")
        .limit(n)
    )


def delay_trend(gold: DataFrame) -> DataFrame:
    """Mean bus and rail delay per day, in minutes."""
    return (
        gold.groupBy(F.to_date("time_bucket").alias("day"))
        .agg(
            (F.avg("bus_avg_delay") / 60.0).alias("bus_delay_minutes"),
            (F.avg("rail_avg_delay") / 60.0).alias("rail_delay_minutes"),
        )
        .orderBy("day")
    )
