"""Topics -> flat, city-partitioned tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Observation
from pyspark.sql.streaming import StreamingQuery

from citypulse import schemas as S
from citypulse.operators.parsing import (
    FAULTS,
    explode_samples,
    parse_values,
    stamp,
    unusable_values,
    value_fault,
)
from citypulse.sources import commits
from citypulse.sources.tables import observed, read_table, write_by_city


@dataclass(frozen=True)
class Source:
    """How the values of one topic become rows."""

    document: str
    nested: bool
    table: str


TRAFFIC = Source(S.TRAFFIC_DOCUMENT, True, S.SILVER_TRAFFIC)
WEATHER = Source(S.WEATHER_DOCUMENT, True, S.SILVER_WEATHER)
TRANSIT = Source(S.DEPARTURE_RECORD, False, S.SILVER_TRANSIT)


# Below an attempt's folder: by date, so that a run reads the days it needs, then by city.
LAYOUT = ("scraped_date", "meta_city")
# Times further ahead than this are taken for a wrong clock. One of them would close every open bucket.
TOLERANCE = "1 day"


def _claim(spark: SparkSession, path: str, owner: str, adopt: bool) -> None:
    """Note which checkpoint writes a table, and refuse another one."""
    note = f"{path}-owner"
    known = read_table(spark, note, "owner STRING")
    held = {r.owner for r in known.collect()} if known is not None else set()
    if held and owner not in held and not adopt:
        raise ValueError(
            f"{path} is written from another checkpoint; a new one reads its topic from the start and would repeat "
            "rows. Pass adopt=True if it is meant to go on with this table"
        )
    if owner not in held:
        spark.createDataFrame([(owner,)], "owner STRING").coalesce(1).write.mode("append").parquet(note)


class BatchWriter:
    """Function for ``foreachBatch`` that writes a micro-batch as flat rows.

    A batch is named after the stream's checkpoint and its number there. Each attempt at it writes folders of
    its own, and one commit of the batch's name makes an attempt's rows count. A replay of a committed batch
    does nothing; one after a crash writes anew, and what the crash left is never seen, nor is
    an attempt that another one has overtaken. Another checkpoint is refused, unless ``adopt``
    says that it takes the table over.

    Values without a city or a readable time, and those whose time is more than ``tolerance``
    ahead of the attempt's clock, are counted while the batch is written; only if there are any, they are written to
    ``quarantine`` with the reason, by the same clock, which the commit keeps. ``quarantined`` adds up the
    counts of this run by reason.
    """

    def __init__(
        self, source: Source, path: str, quarantine: str, tolerance: str = TOLERANCE, adopt: bool = False
    ) -> None:
        self.source, self.path, self.quarantine = source, path, quarantine
        self.tolerance, self.adopt = tolerance, adopt
        self.quarantined: Counter[str] = Counter()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        _claim(spark, self.path, owner, self.adopt)
        name = f"batch-{owner}-{batch_id}"
        if not commits.holds(spark, self.path, name):
            self._write(batch, name)

    def retry(self, spark: SparkSession, repair: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Take the values in quarantine once more, as a batch of its own. How many there were.

        For times that are no longer ahead, or after a fix: ``repair`` gets ``value`` and ``reason`` and returns
        what is to be read as ``value``. What still cannot be used is in quarantine again, with its reason
        of now. One commit takes the values out of quarantine and their rows in; of two retries at once
        the second one fails with ``Conflict`` and changes nothing.
        """
        name = commits.next_name(spark, self.path, "batch-retry")
        held = _quarantined(spark, self.path)
        if not held:
            return 0
        values = _read_quarantine(spark, self.quarantine, list(held))
        if not self._write(values.select("value") if repair is None else repair(values), name, list(held)):
            raise commits.Conflict(f"the quarantine of {self.path} has been taken by another job meanwhile")
        return sum(held.values())

    def _write(self, batch: DataFrame, name: str, inputs: Sequence[str] = ()) -> bool:
        """An attempt at what ``name`` stands for. False if another one has been committed."""
        spark = batch.sparkSession
        attempt, clock = commits.attempt_of(name), datetime.now(timezone.utc)
        now = F.lit(clock)
        counts, times = Observation(), Observation()
        fault = value_fault(F.col("meta_city"), F.col("meta_scraped_at"), self.tolerance, now)
        parsed = parse_values(batch, self.source.document).withColumn("_fault", fault)
        counters = [F.count_if(F.col("_fault") == f).alias(f) for f in FAULTS]
        counted = parsed.observe(counts, *counters)
        usable = counted.filter("_fault IS NULL").drop("_fault")
        rows = stamp(explode_samples(usable) if self.source.nested else usable, now)
        extremes = F.min("ts").alias("oldest"), F.max("ts").alias("newest")
        timed = rows.observe(times, *extremes, F.count(F.lit(1)).alias("count"))
        folder = f"{self.path}/batch={attempt}"
        write_by_city(timed, folder, partition_by=LAYOUT)
        # Where no value can be used, Spark leaves the empty rows out at run time, and the counters with them.
        found = observed(counts) or parsed.agg(*counters).first().asDict()
        faults = {f: n for f, n in found.items() if n}
        span = observed(times)
        if faults:
            bad = unusable_values(batch, self.tolerance, now)
            bad.write.parquet(f"{self.quarantine}/batch={attempt}")
        done = commits.put(
            spark, self.path, name, attempt=attempt, days=commits.days_of(spark, folder, LAYOUT[0]), faults=faults,
            oldest=commits.written(span.get("oldest")), newest=commits.written(span.get("newest")),
            count=span.get("count") or 0, clock=commits.written(clock), inputs=list(inputs),
        )
        if done:
            self.quarantined.update(faults)
        return done


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Start processing what is there now; the checkpoint resumes where the last run ended."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_all(jobs: Sequence[tuple[DataFrame, Callable[[DataFrame, int], None], str]]) -> None:
    """Drain several sources side by side and wait for all of them."""
    running = [drain(*job) for job in jobs]
    for query in running:
        query.awaitTermination()


def read_silver(
    spark: SparkSession, path: str, source: Source, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Rows of all committed batches, of a span of days; no folders of other days are listed.

    Empty, with its columns, before the first batch.
    """
    rows = commits.read_live(spark, path, source.table, "batch", LAYOUT[0], first, last)
    return spark.createDataFrame([], source.table) if rows is None else rows.drop("batch")


def _quarantined(spark: SparkSession, path: str) -> dict[str, int]:
    """Attempts that put values in quarantine which no retry has taken, and how many each."""
    log = commits.entries(spark, path)
    if log is None:
        return {}
    taken = log.select(F.explode("inputs").alias("attempt"))
    found = log.where("size(faults) > 0").join(taken, "attempt", "left_anti").select("attempt", "faults")
    return {r.attempt: sum(r.faults.values()) for r in found.orderBy("attempt").collect()}


def _read_quarantine(spark: SparkSession, quarantine: str, attempts: Sequence[str]) -> DataFrame:
    found = [f"{quarantine}/batch={a}" for a in attempts]
    reader = spark.read.schema("value STRING, reason STRING")
    return reader.parquet(*found) if found else spark.createDataFrame([], "value STRING, reason STRING")


def read_quarantine(spark: SparkSession, path: str, quarantine: str) -> DataFrame:
    """value, reason: what the committed batches of a table could not use and no retry has taken."""
    return _read_quarantine(spark, quarantine, list(_quarantined(spark, path)))


def compact(
    spark: SparkSession, path: str, source: Source, first: date | None = None, last: date | None = None
) -> int:
    """Bring the days that several batches have written into few files each, by city and time. The number of days.

    For days that get few rows any more. Readers and streams go on meanwhile.
    """
    return commits.compact(spark, path, source.table, "batch", LAYOUT[0], LAYOUT, ("ts",), first, last)
