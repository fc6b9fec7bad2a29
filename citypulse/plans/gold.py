"""The wide feature table: one row per city and time bucket.

``gold_wide`` is the plan to use. ``gold_wide_join`` computes the same table from the
per-source features with a key spine and three joins, and serves as its cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.buckets import with_bucket, with_calendar, with_ts
from citypulse.functions.scalars import transit_mode
from citypulse.operators.features import (
    KEYS,
    master_keys,
    stressed,
    traffic_pivot,
    transit_stats,
    weather_pivot,
)

# Measures of a narrow row. Traffic fills the first pair, weather the second; a transit mode,
# which is no grid cell, has the first pair to itself.
MEASURES = ("m1", "m2", "m3", "m4")
_GRID_NAMES = dict(zip(MEASURES, ("congestion", "speed", "rain", "temp")))
_MODE_NAMES = dict(zip(MEASURES, ("avg_delay", "stress_index")))
_MODES = ("rail", "bus")
# What a slot's name begins with, so that a cell called "bus" is no mode.
_CELL, _MODE = "cell:", "mode:"


def features(cells: list[str]) -> list[tuple[str, str, str]]:
    """(slot, measure, output column) of every feature, in the order of the wide table."""
    pairs = (MEASURES[:2], MEASURES[2:])
    grid = [(_CELL + cell, m, f"{cell}_{_GRID_NAMES[m]}") for pair in pairs for cell in cells for m in pair]
    return grid + [(_MODE + mode, m, f"{mode}_{name}") for mode in _MODES for m, name in _MODE_NAMES.items()]


def measurements(
    traffic: DataFrame, weather: DataFrame, transit: DataFrame, threshold: int = S.STRESS_SECONDS
) -> DataFrame:
    """The three sources as one narrow table: city, time, slot and the slot's measures.

    A slot is a grid cell or a transit mode. Every feature is the mean of a measure over the
    rows of a slot; the stressed share is the mean of a 0/1 flag. Rows that belong to no slot (a
    null line, a foreign cell) stay, since they still make their city and bucket appear. Works
    on streams as on tables.
    """

    def part(df: DataFrame, slot: Column, *measures: str) -> DataFrame:
        values = [F.expr(f"CAST({value} AS DOUBLE) AS {m}") for m, value in zip(MEASURES, measures)]
        return with_ts(df).filter("meta_city IS NOT NULL").select("meta_city", "ts", slot.alias("slot"), *values)

    cell = F.concat(F.lit(_CELL), F.col("grid_id"))
    mode = F.concat(F.lit(_MODE), transit_mode(F.col("line")))
    return (
        part(traffic, cell, "congestion_ratio", "current_speed", "NULL", "NULL")
        .unionByName(part(weather, cell, "NULL", "NULL", "rain_1h_mm", "temp"))
        .unionByName(part(transit, mode, "delay", stressed("delay", threshold), "NULL", "NULL"))
    )


def widen(narrow: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Bucketed measurements -> wide rows.

    First the means per (city, bucket, slot): a few running sums per input row, combined before
    the shuffle. Only these few rows are then spread over the columns, where each column has
    one value to pick. No shuffle carries raw rows, so neither a busy city nor a busy bucket
    makes a heavy task, and a report that needs few columns computes only those.
    """
    return spread(narrow.groupBy(*KEYS, "slot").agg(*[F.avg(m).alias(m) for m in MEASURES]), cells)


def spread(means: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Means by city, bucket and slot -> wide rows."""
    columns = [
        F.expr(f"max({m}) FILTER (WHERE slot = '{slot}') AS {name}") for slot, m, name in features(cells or S.grid_ids())
    ]
    return with_calendar(means.groupBy(*KEYS).agg(*columns))


def gold_wide(
    traffic: DataFrame,
    weather: DataFrame,
    transit: DataFrame,
    width: str = S.BUCKET_WIDTH,
    cells: list[str] | None = None,
    threshold: int = S.STRESS_SECONDS,
) -> DataFrame:
    """All buckets of all cities, the open one included."""
    return widen(with_bucket(measurements(traffic, weather, transit, threshold), width), cells)


def gold_wide_join(
    traffic: DataFrame,
    weather: DataFrame,
    transit: DataFrame,
    width: str = S.BUCKET_WIDTH,
    cells: list[str] | None = None,
    threshold: int = S.STRESS_SECONDS,
) -> DataFrame:
    """The same table as ``gold_wide``, from one aggregation per source."""
    traffic, weather, transit = (
        with_bucket(df, width).filter("meta_city IS NOT NULL") for df in (traffic, weather, transit)
    )
    parts = [traffic_pivot(traffic, cells), weather_pivot(weather, cells), transit_stats(transit, threshold)]
    wide = master_keys(*parts)
    for part in parts:
        wide = wide.join(part, list(KEYS), "left")
    return with_calendar(wide)
