"""Sample rows -> nested documents, one or a fixed number per scrape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.scalars import naive_timestamp, round_half_even, traffic_status
from citypulse.operators.city_index import SCRAPE_KEYS, index_of_sums, trusted_sums


def _readable() -> Column:
    return naive_timestamp(F.col("meta_scraped_at")).isNotNull()


def untimed(samples: DataFrame) -> DataFrame:
    """Samples without a readable scrape time, for quarantine: they belong to no scrape."""
    return samples.filter(~_readable())


def _nest(samples: DataFrame, keys: Sequence[str], parts: int, sums: dict[str, Column]) -> DataFrame:
    """keys, part, part_count, samples, and the sums of each part.

    A row's part is a hash of its content, so that rows cross one shuffle, by scrape and part.
    Exploding the documents gives the same rows whatever ``parts`` is.
    """
    fields = [c for c in samples.columns if c not in keys]
    part = F.pmod(F.xxhash64(*fields), F.lit(parts)).cast("int")
    collected = F.sort_array(F.collect_list(F.struct(*fields))).alias("samples")
    return (
        samples.filter(_readable())
        .withColumn("part", part)
        .groupBy(*keys, "part")
        .agg(collected, *[c.alias(k) for k, c in sums.items()])
        .withColumn("part_count", F.lit(parts))
    )


def _grid_label(size: int) -> Column:
    return F.lit(f"{size}x{size}")


def _whole_scrape(samples: DataFrame, documents: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """The documents with the sums of their whole scrape in the place of their part's.

    The sums of a scrape are combined before they are shuffled, and go to its parts; the documents
    stay where they are.
    """
    sums = trusted_sums()
    whole = samples.filter(_readable()).groupBy(*keys).agg(*[c.alias(k) for k, c in sums.items()])
    each = whole.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    each = each.select(*[F.col(k).alias(f"_{k}") for k in (*keys, "part")], *sums)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, "part")]
    return documents.drop(*sums).join(each, same)


def nest_traffic(
    samples: DataFrame, keys: Sequence[str] = SCRAPE_KEYS, size: int = S.GRID_SIZE, parts: int = 1
) -> DataFrame:
    """Traffic documents, with the index and status of their whole scrape.

    ``parts`` documents per scrape, fewer where a part has no sample; 1 suits the grid of a
    collector. Take more where a scrape key holds samples without bound (a default time).
    """
    documents = _nest(samples, keys, parts, trusted_sums())
    if parts > 1:
        documents = _whole_scrape(samples, documents, keys, parts)
    ratio = index_of_sums()
    return documents.select(
        *keys,
        F.lit(S.TRAFFIC_META_TYPE).alias("meta_type"),
        _grid_label(size).alias("grid_size"),
        round_half_even(ratio, 2).alias("average_congestion_ratio"),
        traffic_status(ratio).alias("status_label"),
        "samples",
        "part",
        "part_count",
    )


def nest_weather(
    samples: DataFrame, keys: Sequence[str] = SCRAPE_KEYS, size: int = S.GRID_SIZE, parts: int = 1
) -> DataFrame:
    """Weather documents, split as :func:`nest_traffic` does."""
    return _nest(samples, keys, parts, {}).select(
        *keys,
        F.lit(S.WEATHER_META_TYPE).alias("meta_type"),
        _grid_label(size).alias("grid_size"),
        "samples",
        "part",
        "part_count",
    )


def to_lines(records: DataFrame) -> DataFrame:
    """Records as one JSON text per row, in a ``value`` column."""
    return records.select(F.to_json(F.struct("*")).alias("value"))
