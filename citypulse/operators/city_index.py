"""City-wide traffic index per scrape, and what a collection cycle delivered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.buckets import bucket_start
from citypulse.functions.scalars import naive_timestamp, round_half_even, traffic_status

SCRAPE_KEYS = ("meta_city", "meta_scraped_at")


def trusted_sums(min_confidence: float = S.MIN_CONFIDENCE) -> dict[str, Column]:
    """Aggregates: current and free-flow speed summed over the trusted samples."""
    trusted = F.col("confidence") > min_confidence
    return {
        "_current": F.sum(F.when(trusted, F.col("current_speed"))),
        "_free": F.sum(F.when(trusted, F.col("free_flow_speed"))),
    }


def index_of_sums() -> Column:
    """Sum of current over sum of free-flow speed, else 1.0."""
    return F.when(F.col("_free") > 0, F.try_divide(F.col("_current"), F.col("_free"))).otherwise(F.lit(1.0))


def city_congestion_index(
    samples: DataFrame, keys: Sequence[str] = SCRAPE_KEYS, min_confidence: float = S.MIN_CONFIDENCE
) -> DataFrame:
    """Rounded index and status band of every scrape; the band looks at the unrounded index."""
    return (
        samples.groupBy(*keys)
        .agg(*[c.alias(k) for k, c in trusted_sums(min_confidence).items()])
        .withColumn("ratio", index_of_sums())
        .select(
            *keys,
            round_half_even(F.col("ratio"), 2).alias("average_congestion_ratio"),
            traffic_status(F.col("ratio")).alias("status_label"),
        )
    )


def cycle_summary(
    traffic_documents: DataFrame,
    weather_documents: DataFrame,
    departure_rows: DataFrame,
    width: str = S.CYCLE_WIDTH,
    keys: Sequence[str] = SCRAPE_KEYS,
) -> DataFrame:
    """Cities, samples and records each source delivered per collection cycle.

    A record is a scrape (``keys``), however many documents it was split into, or a departure.
    """

    def part(df: DataFrame, source: str) -> DataFrame:
        cycle = bucket_start(naive_timestamp(F.col("meta_scraped_at")), width)
        return df.withColumns({"source": F.lit(source), "cycle": cycle})

    def scrapes(df: DataFrame, source: str) -> DataFrame:
        same = list(dict.fromkeys(("source", "cycle", "meta_city", *keys)))
        whole = part(df, source).groupBy(*same).agg(F.sum(F.size("samples")).alias("n"))
        return whole.select("source", "cycle", "meta_city", "n")

    records = part(departure_rows, "transit").select("source", "cycle", "meta_city", F.lit(1).cast("long").alias("n"))
    documents = scrapes(traffic_documents, "traffic").unionByName(scrapes(weather_documents, "weather"))
    return (
        documents.unionByName(records)
        .groupBy("source", "cycle", "meta_city")
        .agg(F.count("*").alias("records"), F.sum("n").alias("samples"))
        .groupBy("source", "cycle")
        .agg(
            F.count("*").alias("cities_processed"),
            F.sum("records").alias("records_collected"),
            F.sum("samples").alias("total_samples"),
        )
    )
