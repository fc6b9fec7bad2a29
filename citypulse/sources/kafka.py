"""Kafka topics. Needs the spark-sql-kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from citypulse import schemas as S


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = S.MAX_OFFSETS,
    **options: str,
) -> DataFrame:
    """Stream of a topic; ``max_offsets`` bounds what one micro-batch reads, None does not."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load()


def write_topics(messages: DataFrame, servers: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Drain a stream of ``topic``, ``value`` rows into Kafka, acknowledged by all replicas."""
    return (
        messages.select("topic", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(availableNow=True)
        .start()
    )
