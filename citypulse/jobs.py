"""The scheduled jobs, from landing files to the serving table.

    spark-submit ... citypulse/jobs.py route   --landing URI --servers HOST:PORT --lake URI
    spark-submit ... citypulse/jobs.py silver  --servers HOST:PORT --lake URI
    spark-submit ... citypulse/jobs.py retry   --lake URI
    spark-submit ... citypulse/jobs.py gold    --lake URI
    spark-submit ... citypulse/jobs.py publish --lake URI --url JDBC_URL --table NAME
    spark-submit ... citypulse/jobs.py amend   --lake URI
    spark-submit ... citypulse/jobs.py compact --lake URI --last DATE

Every job processes what is there, then ends; run again, it goes on where it stopped. Database
credentials are read from the file named by ``--properties`` (``key=value`` lines), never from
the command line.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from citypulse import schemas as S
from citypulse.plans import amend
from citypulse.plans.incremental import Bounds, append_increment, committed_bounds, compact_gold, read_gold
from citypulse.plans.publish import publish
from citypulse.sources import commits, kafka
from citypulse.sources.landing import LANDING_FILES
from citypulse.sources.serving import JdbcTable
from citypulse.sources.tables import watermark_of
from citypulse.streaming import bronze, silver

SOURCES = {"traffic": silver.TRAFFIC, "weather": silver.WEATHER, "transit": silver.TRANSIT}
TOPICS = {name: S.FOLDER_TOPICS[S.SOURCE_FOLDERS[name]] for name in SOURCES}


def route_job(spark: SparkSession, landing: str, servers: str, lake: str, glob: str = LANDING_FILES) -> None:
    """Landing files -> Kafka topics."""
    lines = bronze.routed_lines(spark, landing, glob)
    kafka.write_topics(lines, servers, f"{lake}/checkpoints/route").awaitTermination()


def _writer(name: str, lake: str, adopt: bool = False) -> silver.BatchWriter:
    return silver.BatchWriter(SOURCES[name], f"{lake}/silver/{name}", f"{lake}/quarantine/{name}", adopt=adopt)


def silver_job(
    spark: SparkSession, streams: dict[str, DataFrame], lake: str, adopt: bool = False
) -> dict[str, dict[str, int]]:
    """Topics -> flat tables, all sources side by side; bad values go to quarantine.

    Returns how many values did, by source and reason.
    """
    writers = {name: _writer(name, lake, adopt) for name in streams}
    silver.drain_all([(stream, writers[name], f"{lake}/checkpoints/{name}") for name, stream in streams.items()])
    return {name: dict(writer.quarantined) for name, writer in writers.items()}


def retry_job(
    spark: SparkSession, lake: str, repair: Callable[[DataFrame], DataFrame] | None = None
) -> dict[str, tuple[int, int]]:
    """Quarantine -> flat tables, for values that can be used by now or once ``repair`` has seen to them.

    By source, how many were taken out of quarantine and how many of these went back.
    """
    writers = {name: _writer(name, lake) for name in SOURCES}
    taken = {name: writer.retry(spark, repair) for name, writer in writers.items()}
    return {name: (n, writers[name].quarantined.total()) for name, n in taken.items()}


def gold_job(
    spark: SparkSession, lake: str, hold_back: str | None = None, flush: bool = False, **options
) -> Bounds:
    """Flat tables -> wide rows of the buckets that closed since the last run.

    What closed is known from the commits; where nothing did, no data file is read, and else only the days
    from the last run's to the one of the bucket that stays open.
    """
    floor = watermark_of(spark, f"{lake}/gold")
    tables = {f"{lake}/silver/{name}": source for name, source in SOURCES.items()}
    bounds = committed_bounds(spark, list(tables), floor, hold_back=hold_back, flush=flush)
    if bounds.ceiling is None:
        return bounds
    days = floor.date() if floor else None, bounds.ceiling.date()
    flat = [silver.read_silver(spark, path, source, *days) for path, source in tables.items()]
    return append_increment(spark, *flat, gold_path=f"{lake}/gold", bounds=bounds, **options)


def amend_job(spark: SparkSession, lake: str) -> list[str]:
    """New batches of the flat tables -> sums by slot, then the roll-up of the days they touch. Those days."""
    amend.take_batches(spark, f"{lake}/sums", {name: (f"{lake}/silver/{name}", source) for name, source in SOURCES.items()})
    return amend.maintain(spark, f"{lake}/sums", f"{lake}/rollup")


def compact_job(spark: SparkSession, lake: str, last: date, keep: timedelta = commits.KEEP) -> dict[str, int]:
    """Days up to ``last`` into few files, then folders that count no more removed. Days written anew, by table."""
    done = {name: silver.compact(spark, f"{lake}/silver/{name}", source, last=last) for name, source in SOURCES.items()}
    done["gold"] = compact_gold(spark, f"{lake}/gold", last=last)
    done["sums"] = amend.compact_sums(spark, f"{lake}/sums", last=last)
    for name in SOURCES:
        commits.clear(spark, f"{lake}/silver/{name}", "batch", keep)
    commits.clear(spark, f"{lake}/gold", "run", keep)
    for name in ("sums", "rollup"):
        commits.clear(spark, f"{lake}/{name}", "part", keep)
    return done


def publish_job(spark: SparkSession, lake: str, target) -> bool:
    """Wide rows -> serving table. False if there is nothing new."""
    gold = read_gold(spark, f"{lake}/gold")
    return gold is not None and publish(gold, target)


def _properties(path: str | None) -> dict[str, str]:
    lines = Path(path).read_text().splitlines() if path else []
    return dict(line.split("=", 1) for line in lines if "=" in line)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=("route", "silver", "retry", "gold", "publish", "amend", "compact"))
    parser.add_argument("--lake", required=True)
    parser.add_argument("--landing")
    parser.add_argument("--servers")
    parser.add_argument("--glob", default=LANDING_FILES)
    parser.add_argument("--max-offsets", type=int, default=S.MAX_OFFSETS, help="0: no bound")
    parser.add_argument("--adopt", action="store_true", help="a new checkpoint takes the flat tables over")
    parser.add_argument("--hold-back")
    parser.add_argument("--flush", action="store_true")
    parser.add_argument("--last", type=date.fromisoformat, help="the newest day to compact")
    parser.add_argument("--url")
    parser.add_argument("--table")
    parser.add_argument("--properties")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.appName(f"citypulse-{args.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    if args.job == "route":
        route_job(spark, args.landing, args.servers, args.lake, args.glob)
    elif args.job == "silver":
        streams = {
            name: kafka.read_topic(spark, args.servers, topic, max_offsets=args.max_offsets or None)
            for name, topic in TOPICS.items()
        }
        print("quarantined:", silver_job(spark, streams, args.lake, args.adopt))
    elif args.job == "retry":
        print("taken, and put back:", retry_job(spark, args.lake))
    elif args.job == "gold":
        bounds = gold_job(spark, args.lake, hold_back=args.hold_back, flush=args.flush)
        print(f"buckets after {bounds.floor} and before {bounds.ceiling}" if bounds.ceiling else "nothing closed")
    elif args.job == "amend":
        print("days amended:", amend_job(spark, args.lake))
    elif args.job == "compact":
        print("days written anew:", compact_job(spark, args.lake, args.last))
    else:
        target = JdbcTable(spark, args.url, args.table, _properties(args.properties))
        print("published" if publish_job(spark, args.lake, target) else "up to date")
    spark.stop()


if __name__ == "__main__":
    main()
