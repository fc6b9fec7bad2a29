"""Incremental building of the wide table: only closed buckets, each written once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.buckets import bucket_start, with_ts
from citypulse.operators.features import KEYS, with_newest_bucket
from citypulse.plans.gold import gold_wide
from citypulse.sources.commits import attempt_of, compact, entries, span_of
from citypulse.sources.tables import commit_run, read_runs, run_after, watermark_of, write_run


@dataclass(frozen=True)
class Bounds:
    """What a run may write: buckets after ``floor`` and before ``ceiling``.

    Without a ``ceiling`` there is nothing to write; without a ``floor`` everything is new.
    """

    floor: datetime | None
    ceiling: datetime | None


def _interval(width: str) -> Column:
    return F.expr(f"INTERVAL {width}")


def rows_after(df: DataFrame, floor: datetime | None, width: str = S.BUCKET_WIDTH) -> DataFrame:
    """Rows of buckets later than ``floor``, which is a bucket start.

    The condition is put on the stored columns instead of the computed bucket. Parquet keeps
    statistics for ``scraped_date``, so the scan skips old row groups by it, and old folders if
    the table is partitioned by date.
    """
    if floor is None:
        return df
    first = F.lit(floor).cast("timestamp_ntz") + _interval(width)
    if "scraped_date" in df.columns:
        df = df.filter(F.col("scraped_date") >= F.to_date(first))
    return df.filter(F.col("ts") >= first)


def rows_before(df: DataFrame, ceiling: datetime) -> DataFrame:
    """Rows of buckets earlier than ``ceiling``, which is a bucket start."""
    return df.filter(F.col("ts") < F.lit(ceiling).cast("timestamp_ntz"))


def run_bounds(
    sources: list[DataFrame],
    floor: datetime | None,
    width: str = S.BUCKET_WIDTH,
    hold_back: str | None = None,
    flush: bool = False,
) -> Bounds:
    """Bounds of a run over the rows of ``sources`` (already past ``floor``).

    One job over the one time column of all sources; its result is a single row. The bucket
    is taken of the extremes, not of every row.
    """
    times = sources[0].select("ts")
    for other in sources[1:]:
        times = times.unionByName(other.select("ts"))
    extremes = times.agg(F.min("ts").alias("oldest"), F.max("ts").alias("newest"))
    return _bounds(extremes, floor, width, hold_back, flush)


def committed_bounds(
    spark: SparkSession,
    paths: Sequence[str],
    floor: datetime | None,
    width: str = S.BUCKET_WIDTH,
    hold_back: str | None = None,
    flush: bool = False,
) -> Bounds:
    """:func:`run_bounds` of flat tables, from the spans of time in their commits: no data file is read.

    To be taken before the tables are read, so that they hold whatever the commits spoke of. The commits do
    not tell whether there is a row right after ``floor``, only that there may be one: where time has a gap
    there, a ceiling is found and no bucket before it.
    """
    extremes = span_of(spark, paths)
    if floor is not None:
        first = F.lit(floor).cast("timestamp_ntz") + _interval(width)
        extremes = extremes.select(F.greatest("oldest", first).alias("oldest"), "newest")
    return _bounds(extremes, floor, width, hold_back, flush)


def committed_totals(spark: SparkSession, paths: dict[str, str], width: str = S.BUCKET_WIDTH) -> DataFrame:
    """What ``bucket_bounds`` says of the sources, by the commits of their flat tables (name: path); no data file is read.

    ``rows_without_time`` are the values that went to quarantine for want of a readable time, as the tables hold no
    such rows. A source without a commit has no row.
    """
    noted = spark.createDataFrame([], "source STRING, count BIGINT, untimed BIGINT, newest STRING")
    for name, path in paths.items():
        log = entries(spark, path)
        if log is not None:
            faults = F.element_at("faults", "no_time").alias("untimed")
            noted = noted.unionByName(log.select(F.lit(name).alias("source"), "count", faults, "newest"))
    totals = noted.groupBy("source").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("untimed"), F.lit(0)).alias("rows_without_time"),
        F.max(F.col("newest").cast("timestamp_ntz")).alias("newest"),
    )
    return with_newest_bucket(totals, width)


def _bounds(
    extremes: DataFrame, floor: datetime | None, width: str, hold_back: str | None, flush: bool
) -> Bounds:
    """Bounds from one row with the ``oldest`` and the ``newest`` time there is, both null without any."""
    edge = F.col("newest")
    if flush:
        edge = edge + _interval(width)
    elif hold_back:
        edge = edge - _interval(hold_back)
    # Bucketing drops the row when no source has a single readable time.
    row = extremes.select("oldest", bucket_start(edge, width).alias("ceiling")).first()
    if row is None or row["oldest"] >= row["ceiling"]:
        return Bounds(floor, None)
    return Bounds(floor, row["ceiling"])


def closed_buckets(
    traffic: DataFrame,
    weather: DataFrame,
    transit: DataFrame,
    floor: datetime | None = None,
    width: str = S.BUCKET_WIDTH,
    hold_back: str | None = None,
    flush: bool = False,
    bounds: Bounds | None = None,
    **options,
) -> tuple[Bounds, DataFrame | None]:
    """Wide rows of the buckets after ``floor`` that can no longer grow; None without any.

    The newest bucket any source has reached stays open. ``hold_back`` (such as "1 hour") keeps
    more buckets open, for sources that lag; ``flush`` closes all of them, for when collection
    has ended. Rows of buckets up to ``floor`` are late and do not count any more. ``bounds`` that are known
    already take the place of all three.
    """
    floor = floor if bounds is None else bounds.floor
    sources = [rows_after(with_ts(df), floor, width) for df in (traffic, weather, transit)]
    bounds = run_bounds(sources, floor, width, hold_back, flush) if bounds is None else bounds
    if bounds.ceiling is None:
        return bounds, None
    return bounds, gold_wide(*[rows_before(df, bounds.ceiling) for df in sources], width=width, **options)


def append_increment(
    spark: SparkSession,
    traffic: DataFrame,
    weather: DataFrame,
    transit: DataFrame,
    gold_path: str,
    cells: list[str] | None = None,
    bounds: Bounds | None = None,
    **options,
) -> Bounds:
    """One scheduled run: read the watermark, build what closed since, write it, commit it.

    The watermark comes from the commits of complete runs. A run that fails before its own leaves rows that no
    reader sees, whatever they cover. Of two runs from the same watermark one is committed; the other one
    ends with ``Conflict``, and what it wrote does not count. ``bounds`` are those of :func:`committed_bounds`, if
    the caller has them; their floor is the watermark the run goes on from. Without a closed bucket the result has no ceiling.
    """
    floor = watermark_of(spark, gold_path) if bounds is None else bounds.floor
    bounds, increment = closed_buckets(traffic, weather, transit, floor, cells=cells, bounds=bounds, **options)
    if increment is None:
        return bounds
    run = attempt_of(run_after(floor))
    newest = write_run(increment, gold_path, run)
    if newest is None:
        return Bounds(floor, None)
    commit_run(spark, gold_path, run, newest)
    return bounds


def read_gold(
    spark: SparkSession,
    path: str,
    cells: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame | None:
    """The wide table with its ``bucket_date``, of a span of days, or None before the first complete run."""
    return read_runs(spark, path, S.wide_schema(cells), first, last)


def compact_gold(
    spark: SparkSession,
    path: str,
    cells: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> int:
    """Bring the days of the wide table that several runs have written into few files, by city and time. Their number."""
    schema = f"{S.wide_schema(cells)}, bucket_date DATE"
    return compact(spark, path, schema, "run", "bucket_date", ("bucket_date",), KEYS, first, last)
