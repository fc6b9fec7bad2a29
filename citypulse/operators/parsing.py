"""Raw topic values -> flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.scalars import MARK, is_json_object, naive_timestamp, read_object, whole_object


def parse_values(raw: DataFrame, schema: str) -> DataFrame:
    """Decode the ``value`` column (bytes or text) with a declared schema.

    Permissive: unknown fields are ignored, a field of the wrong type is null, text that is not
    one whole JSON object gives a row of nulls.
    """
    read = raw.select(read_object(F.col("value").cast("string"), schema).alias("read"))
    return read.select(whole_object(F.col("read")).alias("data")).select("data.*").drop(MARK)


def explode_present(df: DataFrame, keep: Sequence[str], array: Column, name: str) -> DataFrame:
    """One row per array element, none for a null or empty array.

    Same rows as ``explode``. That one makes the optimizer filter on the array's size below the
    projection that parses it, and the JSON text would be parsed twice; the position of an outer
    explode can only be filtered on afterwards.
    """
    exploded = df.select(*keep, F.posexplode_outer(array).alias("_pos", name))
    return exploded.filter("_pos IS NOT NULL").drop("_pos")


def explode_samples(documents: DataFrame) -> DataFrame:
    """One row per sample; a document with a null or empty array gives none."""
    meta = ("meta_city", "meta_scraped_at")
    return explode_present(documents, meta, F.col("samples"), "sample").select(*meta, "sample.*")


def stamp(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the parsed scrape time, its date, and the processing time (``now``, else the query's own)."""
    return (
        rows.withColumn("ts", naive_timestamp(F.col("meta_scraped_at")))
        .withColumn("scraped_date", F.to_date("ts"))
        .withColumn("ingestion_time", F.current_timestamp() if now is None else now)
    )


def flatten_traffic(raw: DataFrame) -> DataFrame:
    return stamp(explode_samples(parse_values(raw, S.TRAFFIC_DOCUMENT)))


def flatten_weather(raw: DataFrame) -> DataFrame:
    return stamp(explode_samples(parse_values(raw, S.WEATHER_DOCUMENT)))


def flatten_transit(raw: DataFrame) -> DataFrame:
    return stamp(parse_values(raw, S.DEPARTURE_RECORD))


# Why a value is not used.
FAULTS = ("no_city", "no_time", "ahead")


def value_fault(city: Column, scraped_at: Column, tolerance: str, now: Column | None = None) -> Column:
    """One of ``FAULTS``, or null for a value that can be used.

    ``ahead`` is a time later than ``now`` by more than ``tolerance`` (such as "1 day"). Jobs that are to agree must
    be given the same ``now``; without, each query takes its own.
    """
    ts = naive_timestamp(scraped_at)
    now = F.current_timestamp() if now is None else now
    limit = now.cast("timestamp_ntz") + F.expr(f"INTERVAL {tolerance}")
    return F.when(city.isNull(), "no_city").when(ts.isNull(), "no_time").when(ts > limit, "ahead")


def unusable_values(raw: DataFrame, tolerance: str, now: Column | None = None) -> DataFrame:
    """Values with a fault, and the reason: one of ``FAULTS``, or malformed for no whole JSON object.

    The complement of the values that the tables take.
    """
    value = F.col("value").cast("string")
    meta = F.col("meta")
    fault = value_fault(meta["meta_city"], meta["meta_scraped_at"], tolerance, now)
    read = raw.select(value.alias("value"), read_object(value, S.META).alias("read"))
    broken = ~F.coalesce(is_json_object(F.col("value")), F.lit(False))
    return (
        read.select("value", whole_object(F.col("read")).alias("meta"))
        .select("value", fault.alias("fault"))
        .filter("fault IS NOT NULL")
        .select("value", F.when(broken, "malformed").otherwise(F.col("fault")).alias("reason"))
    )
