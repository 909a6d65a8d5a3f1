"""Message and test sources for streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    topic: str, servers: str, starting: str | None = None, extra: Mapping[str, object] | None = None
) -> dict[str, str]:
    """Options of a Kafka subscription; ``starting`` unset leaves Spark's default (latest for streams)."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting is not None:
        options["startingOffsets"] = starting
    return options | {name: str(value) for name, value in (extra or {}).items()}


def read_kafka(
    spark: SparkSession,
    topic: str,
    servers: str,
    starting: str | None = "latest",
    extra: Mapping[str, object] | None = None,
) -> DataFrame:
    """A topic as a stream. Needs Spark's Kafka connector on the class path.

    ``extra`` takes options such as ``maxOffsetsPerTrigger`` (bound the batch after a backlog) or
    ``minPartitions`` (read a hot topic partition with several tasks).
    """
    return spark.readStream.format("kafka").options(**kafka_options(topic, servers, starting, extra)).load()


def read_socket(spark: SparkSession, host: str, port: int, include_timestamp: bool = False) -> DataFrame:
    """Lines from a TCP server, for trials: the source cannot be replayed after a failure."""
    reader = spark.readStream.format("socket").option("host", host).option("port", port)
    return reader.option("includeTimestamp", True).load() if include_timestamp else reader.load()


def read_rate(spark: SparkSession, rows_per_second: int = 1, partitions: int | None = None) -> DataFrame:
    """Numbered ticks. A continuous query holds one core per partition for as long as it runs."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    return (reader.option("numPartitions", partitions) if partitions else reader).load()


def read_rate_batches(spark: SparkSession, rows_per_batch: int, start_ms: int = 0, step_ms: int = 1000) -> DataFrame:
    """Numbered ticks with the same rows in every run."""
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    return reader.option("startTimestamp", start_ms).option("advanceMillisPerBatch", step_ms).load()
