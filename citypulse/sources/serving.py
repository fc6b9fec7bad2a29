"""Serving tables the wide rows are published to.

Rows are appended under the name of a run. A marker says that a run is complete; the rows of other
runs do not count, and the watermark is the newest bucket of the complete ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.sources import tables
from citypulse.sources.commits import attempt_of

# SQL states by which databases say that there is no such table.
NO_SUCH_TABLE = {"42P01", "42S02", "42S04", "42X05"}


def _says_missing(error: BaseException) -> bool:
    """Whether some cause of the error is a database's answer that there is no such table."""
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        state = getattr(cause, "getSQLState", None)
        if state is not None:
            try:
                if state() in NO_SUCH_TABLE:
                    return True
            except Exception:  # noqa: BLE001 - a Java object has an attribute for any name
                pass
        cause = cause.getCause()
    return False


@dataclass(frozen=True)
class JdbcTable:
    """A table of a database every executor can reach, and beside it a table of markers.

    Readers take the rows of complete runs, as :meth:`visible_query` states it, best as a view.
    """

    spark: SparkSession
    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    quote: str = '"'

    @property
    def markers(self) -> str:
        return f"{self.table}_runs"

    def watermark_query(self, column: str, table: str) -> str:
        return f"(SELECT MAX({self.quote}{column}{self.quote}) AS max_ts FROM {table}) tmp"

    def visible_query(self) -> str:
        run = f"{self.quote}run{self.quote}"
        return f"SELECT * FROM {self.table} WHERE {run} IN (SELECT {run} FROM {self.markers})"

    def _newest(self, column: str, table: str) -> tuple[bool, datetime | None]:
        """Whether the table exists, and the maximum, which the database computes.

        Read as a zone-free timestamp, so that neither the session's nor the driver's zone
        shifts it.
        """
        properties = self.properties | {"preferTimestampNTZ": "true"}
        try:
            return True, self.spark.read.jdbc(self.url, self.watermark_query(column, table), properties=properties).first()[0]
        except Py4JJavaError as e:
            if _says_missing(e):
                return False, None
            raise

    def watermark(self) -> datetime | None:
        """Newest bucket of the complete runs; None if there is no table yet.

        A serving table that is older than its markers has the watermark of its rows. Any error but
        a missing table is raised: taken for a first publication it would repeat every row.
        """
        marked, newest = self._newest("newest", self.markers)
        if marked and newest is not None:
            return newest
        return self._newest("time_bucket", self.table)[1]

    def run_after(self, watermark: datetime | None) -> str:
        """A name of its own for every attempt: rows of a failed one cannot be replaced here."""
        return attempt_of(tables.run_after(watermark))

    def append(self, rows: DataFrame, run: str) -> None:
        """Append in parallel; the number of connections is the number of staged files."""
        named = rows.withColumn("run", F.lit(run))
        named.write.jdbc(self.url, self.table, mode="append", properties=self.properties)

    def commit(self, run: str, newest: datetime) -> None:
        marker = self.spark.createDataFrame([(run, newest)], tables.RUNS).coalesce(1)
        marker.write.jdbc(self.url, self.markers, mode="append", properties=self.properties)


@dataclass(frozen=True)
class ParquetServing:
    """A serving table kept as Parquet files in a shared folder."""

    spark: SparkSession
    path: str
    cells: list[str] | None = None

    def watermark(self) -> datetime | None:
        return tables.watermark_of(self.spark, self.path)

    def run_after(self, watermark: datetime | None) -> str:
        return attempt_of(tables.run_after(watermark))

    def append(self, rows: DataFrame, run: str) -> None:
        tables.write_run(rows, self.path, run)

    def commit(self, run: str, newest: datetime) -> None:
        tables.commit_run(self.spark, self.path, run, newest)

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame | None:
        """The rows of complete runs, of a span of days, or None before the first."""
        return tables.read_runs(self.spark, self.path, S.wide_schema(self.cells), first, last)
