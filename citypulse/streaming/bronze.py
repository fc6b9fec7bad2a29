"""Landing files -> topics, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from citypulse.sources.landing import LANDING_FILES, read_lines, route


def routed_lines(
    spark: SparkSession, root: str, glob: str = LANDING_FILES, max_files: int | None = None, **options: str
) -> DataFrame:
    """Stream of ``topic``, ``value``, ``dead_letter`` over the landing files."""
    return route(read_lines(spark, root, glob, streaming=True, max_files=max_files, **options))


def write_topic_files(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain messages into one folder per topic, the file form of the Kafka sink."""
    return (
        messages.writeStream.format("parquet")
        .partitionBy("topic")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
