"""Landing files: JSON lines in one folder per source, below it by date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.scalars import JSON_SPACE, is_json_object, trim_json

# The collectors' files, and those that ``write_landing`` leaves.
LANDING_FILES = "*.{jsonl,json}"
# The file stream ignores files this much older than the newest one. Longer than any landing zone.
EVERY_FILE = "36500d"

DATE_PARTS = {"year": "yyyy", "month": "MM", "day": "dd"}


def read_lines(
    spark: SparkSession,
    root: str,
    glob: str = LANDING_FILES,
    streaming: bool = False,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Non-blank lines of all matching files below ``root``, with the file they come from.

    As a stream, the checkpoint of the query remembers which files are done. Every file is
    taken once, however old it is: restored and copied files carry old times. For a landing zone
    that keeps growing pass ``cleanSource`` to have finished files moved away, so that listing and
    bookkeeping stay bounded; ``maxFileAge`` would bound them too, but drops late files unseen.
    """
    reader = spark.readStream.option("maxFileAge", EVERY_FILE) if streaming else spark.read
    reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").options(**options)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.format("text").load(root)
    return lines.select("value", F.col("_metadata.file_path").alias("_source_file")).filter("length(value) > 0")


def topic_of(path: Column, routes: dict[str, str] | None = None) -> Column:
    """Topic of a landing file by the source folder in its path; null for other folders."""
    routes = routes or S.FOLDER_TOPICS
    folder = F.regexp_extract(path, f".*/({'|'.join(routes)})/", 1)
    topic = F.lit(None).cast("string")
    for name, target in routes.items():
        topic = F.when(folder == name, target).otherwise(topic)
    return topic


def _close_with(body: Column, extra: Column) -> Column:
    """Append the fields of one JSON object text to another, ``body`` being trimmed."""
    head = F.rtrim(F.expr("left(_body, length(_body) - 1)"), F.lit(JSON_SPACE))
    comma = F.when(head.endswith("{"), "").otherwise(",")
    return F.concat(head, comma, F.substr(extra, F.lit(2)))


def route(lines: DataFrame, routes: dict[str, str] | None = None) -> DataFrame:
    """Lines -> ``topic`` and ``value``, with provenance; ``dead_letter`` marks bad lines.

    A JSON object gets ``_source_file`` and ``_ingested_at`` added as its last fields; it is
    not taken apart, so its other fields keep their exact text. Any other line is kept whole
    as ``{"raw": ..., "_source_file": ...}``. Files outside the source folders are ignored.
    """
    source = F.col("_source_file")
    provenance = F.to_json(
        F.struct(
            source.alias("_source_file"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"),
        )
    )
    raw = F.to_json(F.struct(F.col("value").alias("raw"), source.alias("_source_file")))
    good = F.coalesce(is_json_object(F.col("value")), F.lit(False))
    return (
        lines.withColumn("topic", topic_of(source, routes))
        .filter("topic IS NOT NULL")
        .withColumn("_body", trim_json(F.col("value")))
        .withColumn("dead_letter", ~good)
        .select(
            "topic",
            F.when(F.col("dead_letter"), raw).otherwise(_close_with(F.col("_body"), provenance)).alias("value"),
            "dead_letter",
        )
    )


def write_landing(records: DataFrame, path: str, time_col: str = "meta_scraped_at", mode: str = "append") -> None:
    """Write records as JSON lines under ``year=/month=/day=`` folders of their scrape time."""
    ts = F.col(time_col).try_cast("timestamp_ntz")
    dated = records.withColumns({name: F.date_format(ts, fmt) for name, fmt in DATE_PARTS.items()})
    dated.hint("rebalance", *DATE_PARTS).write.mode(mode).partitionBy(*DATE_PARTS).json(path)


def read_landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landing records back, without the date folders."""
    return spark.read.option("recursiveFileLookup", "true").schema(schema).json(path)
