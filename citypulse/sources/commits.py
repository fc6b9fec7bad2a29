"""Which folders of a table count: a log of commits beside it, each a small JSON file that is created once.

Data is written under the name of an attempt, which no other attempt has, in folders by day below it. A
commit names an attempt and its days; until then no reader sees the rows, and afterwards all of them at once.
The commit's own name says what may be done only once: a micro-batch, a run after a certain watermark, the
n-th compaction. Whoever comes second finds the name taken.

The log is also the index of days: a reader asks it for the folders of the days it needs and lists no others.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.session import exists, folder_of, remove

ENTRY = (
    "name STRING, attempt STRING, days ARRAY<STRING>, replaces ARRAY<STRUCT<attempt: STRING, day: STRING>>, "
    "oldest STRING, newest STRING, count BIGINT, clock STRING, faults MAP<STRING, BIGINT>, inputs ARRAY<STRING>"
)
KEEP = timedelta(days=7)


class Conflict(RuntimeError):
    """Somebody else has committed what this attempt was to commit; its rows do not count."""


def log_of(path: str) -> str:
    return f"{path}-log"


def written(moment: datetime | None) -> str | None:
    """A moment as text whose order is that of time."""
    return None if moment is None else moment.isoformat(timespec="microseconds")


def attempt_of(name: str) -> str:
    """A name for one attempt at what ``name`` stands for."""
    return f"{name}-{uuid.uuid4().hex}"


def purpose_of(attempt: str) -> str:
    return attempt.rsplit("-", 1)[0]


def put(spark: SparkSession, path: str, name: str, **entry) -> bool:
    """Create a commit. False, and nothing done, if there is one of that name.

    The file is written whole under a hidden name. It gets its own by a hard link on a local or mounted file
    system, elsewhere by a rename that refuses to overwrite; both either happen or fail as a whole where
    the store is one with atomic renames, as HDFS is.
    """
    log = log_of(path)
    temporary, store = folder_of(spark, f"{log}/.{uuid.uuid4().hex}")
    final, _ = folder_of(spark, f"{log}/{name}.json")
    out = store.create(temporary, True)
    try:
        out.write(json.dumps({"name": name, **entry}).encode())
    finally:
        out.close()
    try:
        if store.getUri().getScheme() == "file":
            os.link(temporary.toUri().getPath(), final.toUri().getPath())
        else:
            _rename(spark, temporary, final)
        return True
    except FileExistsError:
        return False
    finally:
        store.delete(temporary, False)


def _rename(spark: SparkSession, source, target) -> None:
    """Rename, or raise FileExistsError."""
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise FileExistsError(target.toString()) from error
        raise


def holds(spark: SparkSession, path: str, name: str) -> bool:
    return exists(spark, f"{log_of(path)}/{name}.json")


def entries(spark: SparkSession, path: str) -> DataFrame | None:
    """The commits, or None where there has never been one."""
    log = log_of(path)
    return spark.read.schema(ENTRY).json(log) if exists(spark, log) else None


def live(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> list[tuple[str, str]] | None:
    """(attempt, day) of what counts, of a span of days. None where there has never been a commit.

    As many as there are folders to be read.
    """
    log = entries(spark, path)
    if log is None:
        return None
    held = log.select("attempt", F.explode("days").alias("day"))
    if first is not None:
        held = held.where(F.col("day") >= first.isoformat())
    if last is not None:
        held = held.where(F.col("day") <= last.isoformat())
    gone = log.select(F.explode("replaces").alias("r")).select("r.attempt", "r.day")
    return sorted(map(tuple, held.join(gone, ["attempt", "day"], "left_anti").collect()))


def span_of(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """oldest, newest: one row with the first and the last time that any commit of the tables has noted, nulls without one.

    Compactions note none and change none.
    """
    logs = [log for log in (entries(spark, path) for path in paths) if log is not None]
    noted = spark.createDataFrame([], "oldest STRING, newest STRING")
    for log in logs:
        noted = noted.unionByName(log.select("oldest", "newest"))
    return noted.agg(*[f(F.col(c).cast("timestamp_ntz")).alias(c) for f, c in ((F.min, "oldest"), (F.max, "newest"))])


def next_name(spark: SparkSession, path: str, prefix: str) -> str:
    """The name after the commits of a prefix there are; whoever else has seen the same ones has the same name."""
    log = entries(spark, path)
    return f"{prefix}-{0 if log is None else log.where(F.col('name').startswith(f'{prefix}-')).count():010d}"


def untaken(spark: SparkSession, path: str, prefix: str, by: str, label: str = "") -> list[str]:
    """Attempts committed to ``path`` under names of a prefix that no commit of the table ``by`` has among its inputs.

    ``label`` tells apart tables that one table takes from: its inputs are named label/attempt.
    """
    log, taken = entries(spark, path), entries(spark, by)
    if log is None:
        return []
    found = log.where(F.col("name").startswith(f"{prefix}-")).select("attempt")
    if taken is not None:
        done = taken.select(F.explode("inputs").alias("input"))
        found = found.join(done, F.concat(F.lit(f"{label}/" if label else ""), "attempt") == F.col("input"), "left_anti")
    return sorted(r.attempt for r in found.collect())


def pairs_of(spark: SparkSession, path: str, attempts: Iterable[str]) -> list[tuple[str, str]]:
    """(attempt, day) of attempts as they were committed, compacted or not."""
    log, wanted = entries(spark, path), list(attempts)
    if log is None or not wanted:
        return []
    held = log.where(F.col("attempt").isin(wanted)).select("attempt", F.explode("days").alias("day"))
    return sorted(map(tuple, held.collect()))


def days_of(spark: SparkSession, folder: str, column: str) -> list[str]:
    """The days an attempt has written."""
    path, store = folder_of(spark, folder)
    names = [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def folders(path: str, kind: str, column: str, pairs: Iterable[tuple[str, str]]) -> list[str]:
    return [f"{path}/{kind}={attempt}/{column}={day}" for attempt, day in pairs]


def read_live(
    spark: SparkSession,
    path: str,
    schema: str,
    kind: str,
    column: str,
    first: date | None = None,
    last: date | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame | None:
    """Rows that count, of a span of days or of ``days``, by the folders the log names. None where there has never been a commit.

    What is committed later is not seen, and what is compacted later stays until it is cleared away.
    """
    pairs = live(spark, path, first, last)
    if pairs is None:
        return None
    if days is not None:
        wanted = set(days)
        pairs = [(attempt, day) for attempt, day in pairs if day in wanted]
    return _read(spark, path, schema, kind, column, pairs)


def read_attempts(
    spark: SparkSession, path: str, schema: str, kind: str, column: str, attempts: Iterable[str]
) -> DataFrame:
    """Rows of certain committed attempts, compacted or not."""
    return _read(spark, path, schema, kind, column, pairs_of(spark, path, attempts))


def _read(
    spark: SparkSession, path: str, schema: str, kind: str, column: str, pairs: list[tuple[str, str]]
) -> DataFrame:
    declared = f"{schema}, {kind} STRING"
    if not pairs:
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).option("basePath", path).parquet(*folders(path, kind, column, pairs))


def compact(
    spark: SparkSession,
    path: str,
    schema: str,
    kind: str,
    column: str,
    partition_by: tuple[str, ...],
    cluster_by: tuple[str, ...],
    first: date | None = None,
    last: date | None = None,
    least_folders: int = 2,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write the days that lie in ``least_folders`` or more anew, ordered by ``cluster_by``, and swap them in. The number of days.

    The swap is one commit that names the folders it replaces; rows that come to a day meanwhile are not among them
    and stay. Of two compactions at once the second one fails with ``Conflict``. Files follow the size
    of the data: a day is split over tasks where it is large. ``merge`` may bring rows together that say the same.
    """
    name = next_name(spark, path, "swap")
    held: dict[str, list[str]] = {}
    for attempt, day in live(spark, path, first, last) or []:
        held.setdefault(day, []).append(attempt)
    pairs = [(a, day) for day, attempts in held.items() if len(attempts) >= least_folders for a in attempts]
    if not pairs:
        return 0
    rows = _read(spark, path, schema, kind, column, pairs).drop(kind)
    rows = rows if merge is None else merge(rows)
    attempt = attempt_of(name)
    folder = f"{path}/{kind}={attempt}"
    spread = rows.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *cluster_by)
    spread.write.partitionBy(*partition_by).parquet(folder)
    replaces = [{"attempt": a, "day": d} for a, d in pairs]
    if not put(spark, path, name, attempt=attempt, days=days_of(spark, folder, column), replaces=replaces):
        raise Conflict(f"{path} has been compacted by another job meanwhile")
    return len({day for _, day in pairs})


def clear(spark: SparkSession, path: str, kind: str, keep: timedelta = KEEP) -> list[str]:
    """Delete the folders of attempts that do not count (failed, or compacted away) and are older than ``keep``.

    ``keep`` must be longer than any job or query takes that writes or reads the table.
    """
    counted = {attempt for attempt, _ in live(spark, path) or []}
    oldest = (datetime.now(timezone.utc) - keep).timestamp() * 1000
    root, store = folder_of(spark, path)
    gone = []
    for status in store.listStatus(root) if store.exists(root) else []:
        attempt = status.getPath().getName().removeprefix(f"{kind}=")
        if status.isDirectory() and attempt not in counted and status.getModificationTime() < oldest:
            remove(spark, f"{path}/{kind}={attempt}")
            gone.append(attempt)
    return gone
