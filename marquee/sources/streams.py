"""Streaming sources of raw messages, all with the schema of a message broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def broker_messages(spark: SparkSession, servers: str, topic: str, group: str) -> DataFrame:
    """Kafka messages from the earliest offset; needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", group)
        .option("startingOffsets", "earliest")
        .load()
        .select("key", "value", "timestamp")
    )


def parquet_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet file, folder or pattern as a stream of its files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(as_pattern(path))


def as_pattern(path: str) -> str:
    """``path`` as a glob that matches it alone: the file source takes one file only as a pattern."""
    return path if any(c in path for c in "*[{?") else f"{path[:-1]}[{path[-1]}]"
