"""The wide table in a form that late rows still change, and roll-ups kept from it.

A feature is the mean of a measure over a slot, so what has to be kept is its sum and its count. A run takes
the batches of the flat tables that no run has taken before, whatever times their rows have, and adds
their sums to a table by day; a bucket's value is the quotient of all its sums. Nothing is late.

A roll-up has one row for a day, hour and city, again of sums and counts. It is kept by day: days that have
got new sums since are computed anew, from the sums of these days alone, and swapped in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.buckets import with_bucket
from citypulse.operators.features import KEYS
from citypulse.plans.analytics import CELL, known_mean
from citypulse.plans.gold import MEASURES, measurements, spread
from citypulse.sources import commits
from citypulse.sources.tables import observed, write_by_city
from citypulse.streaming.silver import LAYOUT, Source

SUMS = (
    "meta_city STRING, time_bucket TIMESTAMP_NTZ, slot STRING, "
    + ", ".join(f"{m}_sum DOUBLE, {m}_n BIGINT" for m in MEASURES)
    + ", bucket_date DATE"
)
#: Sums and counts that a roll-up keeps: of one cell's congestion, the mean over a row's cells, and the rail's stress.
ROLLED = ("cell", "grid", "rail")
ROLLUP = (
    "meta_city STRING, hour_of_day INT, day_of_week INT, "
    + ", ".join(f"{m}_sum DOUBLE, {m}_n BIGINT" for m in ROLLED)
    + ", bucket_date DATE"
)


# --- sums by slot ------------------------------------------------------------
def slot_sums(
    traffic: DataFrame, weather: DataFrame, transit: DataFrame, width: str = S.BUCKET_WIDTH, threshold: int = S.STRESS_SECONDS
) -> DataFrame:
    """Sum and count of every measure by city, bucket and slot. Rows of no slot keep their city and bucket."""
    narrow = with_bucket(measurements(traffic, weather, transit, threshold), width)
    parts = [a for m in MEASURES for a in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    return narrow.groupBy(*KEYS, "slot").agg(*parts).withColumn("bucket_date", F.to_date("time_bucket"))


def merged(sums: DataFrame) -> DataFrame:
    """Sums of several runs as those of one. Associative, so it may be done to any part of the runs first."""
    parts = [F.sum(f"{m}_{part}").alias(f"{m}_{part}") for m in MEASURES for part in ("sum", "n")]
    return sums.groupBy("bucket_date", *KEYS, "slot").agg(*parts)


def wide_of(sums: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """The wide rows of sums, with their ``bucket_date``."""
    means = [F.expr(f"try_divide({m}_sum, {m}_n)").alias(m) for m in MEASURES]
    wide = spread(merged(sums).select(*KEYS, "slot", *means), cells)
    return wide.withColumn("bucket_date", F.to_date("time_bucket"))


def add_sums(
    spark: SparkSession,
    path: str,
    traffic: DataFrame,
    weather: DataFrame,
    transit: DataFrame,
    inputs: Iterable[str] = (),
    **options,
) -> list[str]:
    """Add the sums of rows that have not been added before. The days they touch.

    The commit names what has been taken (``inputs``). Of two runs at once that have seen the same log one
    is committed, the other ends with ``Conflict``: no batch is taken twice.
    """
    inputs, name = list(inputs), commits.next_name(spark, path, "sums")
    attempt, seen = commits.attempt_of(name), Observation()
    sums = slot_sums(traffic, weather, transit, **options).observe(seen, F.max("time_bucket").alias("newest"))
    write_by_city(sums, f"{path}/part={attempt}", partition_by=("bucket_date",))
    days = commits.days_of(spark, f"{path}/part={attempt}", "bucket_date")
    newest = commits.written(observed(seen).get("newest"))
    if (days or inputs) and not commits.put(spark, path, name, attempt=attempt, days=days, newest=newest, inputs=inputs):
        raise commits.Conflict(f"another run has added sums to {path}")
    return days


def take_batches(spark: SparkSession, path: str, flat: Mapping[str, tuple[str, Source]], **options) -> list[str]:
    """Add the sums of all batches of the flat tables that are new. ``flat``: traffic, weather and transit with path and source.

    Batches are read as they were written, even if they have been compacted meanwhile; folders must
    therefore be kept for longer than lies between two runs.
    """
    tables, inputs = [], []
    for name in ("traffic", "weather", "transit"):
        where, source = flat[name]
        new = commits.untaken(spark, where, "batch", path, name)
        inputs += [f"{name}/{attempt}" for attempt in new]
        tables.append(commits.read_attempts(spark, where, source.table, "batch", LAYOUT[0], new).drop("batch"))
    return add_sums(spark, path, *tables, inputs=inputs, **options) if inputs else []


def read_sums(spark: SparkSession, path: str, days: Iterable[str] | None = None, **span: date | None) -> DataFrame | None:
    rows = commits.read_live(spark, path, SUMS, "part", "bucket_date", days=days, **span)
    return None if rows is None else rows.drop("part")


def read_amended(
    spark: SparkSession,
    path: str,
    cells: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
    with_open: bool = False,
) -> DataFrame | None:
    """The wide rows of closed buckets as all rows make them that have come so far; None before the first run.

    A bucket is closed once any source has gone beyond it, as in the incremental build; ``with_open`` has the newest one too.
    """
    sums = read_sums(spark, path, first=first, last=last)
    if sums is None:
        return None
    newest = commits.entries(spark, path).agg(F.max("newest")).first()[0]
    if not with_open:
        sums = sums.filter(F.col("time_bucket") < F.lit(newest).cast("timestamp_ntz"))
    return wide_of(sums, cells)


def compact_sums(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> int:
    """Merge the sums of days that several runs have added to, and swap them in. The number of days."""
    return commits.compact(
        spark, path, SUMS, "part", "bucket_date", ("bucket_date",), KEYS, first, last, merge=merged
    )


# --- roll-ups ------------------------------------------------------------------
def by_hour(wide: DataFrame, cells: list[str] | None = None, cell: str = CELL) -> DataFrame:
    """Roll-up rows of wide rows."""
    values = {"cell": F.col(f"{cell}_congestion"), "grid": known_mean(cells or S.grid_ids(), "congestion"), "rail": F.col("rail_stress_index")}
    parts = [a for m, v in values.items() for a in (F.sum(v).alias(f"{m}_sum"), F.count(v).alias(f"{m}_n"))]
    return wide.groupBy("bucket_date", "meta_city", "hour_of_day", "day_of_week").agg(*parts)


def maintain(spark: SparkSession, path: str, rollup: str, cells: list[str] | None = None, cell: str = CELL) -> list[str]:
    """Compute the days anew that have got sums since the last time, and swap them in. Those days."""
    name = commits.next_name(spark, rollup, "roll")
    new = commits.untaken(spark, path, "sums", rollup)
    days = sorted({day for _, day in commits.pairs_of(spark, path, new)})
    if not days:
        return []
    attempt = commits.attempt_of(name)
    rows = by_hour(wide_of(read_sums(spark, path, days), cells), cells, cell)
    write_by_city(rows, f"{rollup}/part={attempt}", partition_by=("bucket_date",))
    old = [{"attempt": a, "day": d} for a, d in commits.live(spark, rollup) or [] if d in set(days)]
    written = commits.days_of(spark, f"{rollup}/part={attempt}", "bucket_date")
    if not commits.put(spark, rollup, name, attempt=attempt, days=written, replaces=old, inputs=new):
        raise commits.Conflict(f"{rollup} has been brought up to date by another job meanwhile")
    return days


def read_rollup(spark: SparkSession, rollup: str, first: date | None = None, last: date | None = None) -> DataFrame | None:
    rows = commits.read_live(spark, rollup, ROLLUP, "part", "bucket_date", first, last)
    return None if rows is None else rows.drop("part")


def _mean(name: str, alias: str) -> Column:
    return F.expr(f"try_divide(sum({name}_sum), sum({name}_n))").alias(alias)


def hourly_patterns(
    spark: SparkSession, path: str, rollup: str, as_of: datetime, period: timedelta = timedelta(days=30), cells: list[str] | None = None
) -> DataFrame:
    """The report of that name from the roll-up; of the day on which the period begins, from its sums."""
    first = as_of - period
    edge = read_sums(spark, path, first=first.date(), last=first.date())
    begun = edge.filter(F.col("time_bucket") >= F.lit(first).cast("timestamp_ntz"))
    whole = read_rollup(spark, rollup, first.date() + timedelta(days=1))
    rows = by_hour(wide_of(begun, cells), cells).unionByName(whole)
    means = (_mean("cell", "avg_congestion"), _mean("rail", "avg_rail_stress"))
    return rows.groupBy("hour_of_day", "meta_city").agg(*means).orderBy("hour_of_day", "meta_city")


def heatmap(spark: SparkSession, rollup: str) -> DataFrame:
    """The report of that name from the roll-up."""
    rows = read_rollup(spark, rollup)
    return rows.groupBy("hour_of_day", "day_of_week").agg(_mean("grid", "avg_congestion")).orderBy("hour_of_day", "day_of_week")
