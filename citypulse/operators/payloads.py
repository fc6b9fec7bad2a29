"""API responses -> sample rows.

Input rows carry one response in ``payload`` next to the columns that say where and when it
was asked for: ``meta_city``, ``meta_scraped_at`` and, for grid probes, ``grid_id``, ``lat``
and ``lon``. Other columns in ``keep`` are handed through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions.scalars import (
    congestion_ratio,
    normalise_grid_id,
    read_object,
    whole_number,
    whole_object,
)
from citypulse.operators.parsing import explode_present

PROBE_KEYS = ("meta_city", "meta_scraped_at", "grid_id", "lat", "lon")
STOP_KEYS = ("meta_city", "meta_scraped_at")

TRAFFIC_PAYLOAD = "flowSegmentData STRUCT<currentSpeed: DOUBLE, freeFlowSpeed: DOUBLE, confidence: DOUBLE>"
WEATHER_PAYLOAD = (
    "main STRUCT<temp: DOUBLE, humidity: INT>, "
    "weather ARRAY<STRUCT<main: STRING, description: STRING>>, "
    "wind STRUCT<speed: DOUBLE>, rain MAP<STRING, DOUBLE>, visibility INT"
)
NON_EMPTY_OBJECT = r'^\s*\{\s*"'
DEPARTURE_PAYLOAD = (
    "line STRUCT<name: STRING>, direction STRING, plannedWhen STRING, delay INT, platform STRING, tripId STRING"
)


def traffic_samples(responses: DataFrame, keep: Sequence[str] = PROBE_KEYS) -> DataFrame:
    """Speeds, ratio and confidence of each probe; a response without a segment gives no row.

    A missing speed or confidence counts as 0.
    """
    segment = F.from_json("payload", TRAFFIC_PAYLOAD)["flowSegmentData"]
    flow = F.col("flow")
    current = F.coalesce(flow["currentSpeed"], F.lit(0.0))
    free = F.coalesce(flow["freeFlowSpeed"], F.lit(0.0))
    return explode_present(responses, keep, F.array_compact(F.array(segment)), "flow").select(
        *keep,
        whole_number(current).alias("current_speed"),
        whole_number(free).alias("free_flow_speed"),
        congestion_ratio(current, free).alias("congestion_ratio"),
        F.coalesce(flow["confidence"], F.lit(0.0)).alias("confidence"),
    )


def weather_samples(responses: DataFrame, keep: Sequence[str] = PROBE_KEYS) -> DataFrame:
    """Weather readings of each probe; an absent, empty or broken response gives no row.

    Broken is text that is not one whole JSON object. An object without readings, such as an error
    message, is a response all the same and gives a row of nulls. Rain is 0 where the response has
    no one-hour entry, and null where that entry is null.
    """
    w = F.col("w")
    first = F.get(w["weather"], F.lit(0))
    rain = F.when(F.map_contains_key(w["rain"], "1h"), w["rain"]["1h"]).otherwise(F.lit(0.0))
    objects = responses.filter(F.col("payload").rlike(NON_EMPTY_OBJECT))
    read = objects.select(*keep, read_object(F.col("payload"), WEATHER_PAYLOAD, strict=True).alias("read"))
    whole = F.array_compact(F.array(whole_object(F.col("read"))))
    return explode_present(read, keep, whole, "w").select(
        *keep,
        w["main"]["temp"].alias("temp"),
        w["main"]["humidity"].alias("humidity"),
        first["main"].alias("weather_main"),
        first["description"].alias("description"),
        w["wind"]["speed"].alias("wind_speed"),
        rain.alias("rain_1h_mm"),
        w["visibility"].alias("visibility"),
    )


def departures(responses: DataFrame, keep: Sequence[str] = STOP_KEYS) -> DataFrame:
    """One row per departure of a response, given as ``{"departures": [...]}`` or a bare array.

    A departure without a delay is on time (0); one whose delay is null stays null.
    """
    payload = F.col("payload")
    entries = F.when(F.ltrim(payload).startswith("["), F.from_json(payload, "array<string>")).otherwise(
        F.from_json(payload, "departures ARRAY<STRING>")["departures"]
    )
    dep = F.col("dep")
    # Only for a null delay is it worth a second look whether the departure names one.
    names_delay = F.array_contains(F.json_object_keys("entry"), "delay")
    delay = F.when(dep["delay"].isNull() & ~names_delay, F.lit(0)).otherwise(dep["delay"])
    return (
        explode_present(responses, keep, entries, "entry")
        .select(*keep, "entry", F.from_json("entry", DEPARTURE_PAYLOAD).alias("dep"))
        .select(
            *keep,
            dep["line"]["name"].alias("line"),
            dep["direction"].alias("direction"),
            dep["plannedWhen"].alias("planned_time"),
            delay.alias("delay"),
            dep["platform"].alias("platform"),
            dep["tripId"].alias("raw_id"),
        )
    )


def normalise_flat(records: DataFrame) -> DataFrame:
    """Flat one-record-per-cell input -> the row shape of exploded documents.

    Cell ids get their prefix. Flat traffic input has a record of zeros for a probe that
    failed; documents have no sample for it, so it is left out.
    """
    rows = records.withColumn("grid_id", normalise_grid_id(F.col("grid_id")))
    if "confidence" not in rows.columns:
        return rows
    failed = (F.col("current_speed") == 0) & (F.col("free_flow_speed") == 0) & (F.col("confidence") == 0)
    return rows.filter(~F.coalesce(failed, F.lit(False)))
