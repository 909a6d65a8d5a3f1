"""Sinks for streams, and files and reports for batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators.decode import to_message
from kerbside.streaming.runtime import Trigger, writer

BATCH = "batch_id"


def to_console(
    df: DataFrame,
    mode: str = "append",
    trigger: Trigger = None,
    checkpoint: str | None = None,
    name: str | None = None,
    rows: int = 20,
    truncate: bool = False,
) -> StreamingQuery:
    out = writer(df, mode, trigger, checkpoint, name).format("console")
    return out.option("numRows", rows).option("truncate", truncate).start()


def to_memory(
    df: DataFrame, name: str, mode: str = "append", trigger: Trigger = None, checkpoint: str | None = None
) -> StreamingQuery:
    """A table in the driver's memory under the query's name, for small results only."""
    return writer(df, mode, trigger, checkpoint, name).format("memory").start()


def kafka_sink_options(topic: str, servers: str, producer: Mapping[str, object] | None = None) -> dict[str, str]:
    """Sink options; producer settings such as acks, retries, batch.size and linger.ms get Kafka's prefix."""
    settings = {f"kafka.{name}": str(value) for name, value in (producer or {}).items()}
    return {"kafka.bootstrap.servers": servers, "topic": topic} | settings


def messages_to_kafka(
    messages: DataFrame,
    topic: str,
    servers: str,
    checkpoint: str,
    producer: Mapping[str, object] | None = None,
    trigger: Trigger = None,
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Key and value columns to a topic, at least once. Needs Spark's Kafka connector on the class path."""
    out = writer(messages, mode, trigger, checkpoint, name).format("kafka")
    return out.options(**kafka_sink_options(topic, servers, producer)).start()


def to_kafka(df: DataFrame, topic: str, key: str, servers: str, checkpoint: str, **settings) -> StreamingQuery:
    """Rows as JSON messages under a key column; settings as for ``messages_to_kafka``."""
    return messages_to_kafka(to_message(df, key), topic, servers, checkpoint, **settings)


def to_files(
    df: DataFrame,
    kind: str,
    path: str,
    checkpoint: str,
    trigger: Trigger = None,
    name: str | None = None,
    options: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append files of a kind (csv, json, parquet), each batch exactly once."""
    out = writer(df, "append", trigger, checkpoint, name).format(kind)
    return out.options(**dict(options or {})).option("path", path).start()


BatchWriter = Callable[[DataFrame, int], None]


def to_many(
    df: DataFrame,
    writers: Sequence[BatchWriter],
    checkpoint: str,
    mode: str = "append",
    trigger: Trigger = None,
    name: str | None = None,
) -> StreamingQuery:
    """Several outputs per micro-batch, computed once.

    A batch can be repeated after a failure, so writers should overwrite what they wrote under the
    same batch id, as ``batch_files`` does. The batch is kept in executors' memory and disk while
    the writers run; a lost executor means its part is computed again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        shared = batch.persist() if len(writers) > 1 else batch
        try:
            for each in writers:
                each(shared, batch_id)
        finally:
            if len(writers) > 1:
                shared.unpersist()

    return writer(df, mode, trigger, checkpoint, name).foreachBatch(write).start()


def batch_files(path: str, kind: str = "parquet", **options: object) -> BatchWriter:
    """Write each batch to a folder named after its id, replacing an earlier attempt."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**options).format(kind).save(f"{path}/{BATCH}={batch_id}")

    return write


def to_snapshots(
    df: DataFrame, path: str, checkpoint: str, mode: str = "complete", trigger: Trigger = None, name: str | None = None
) -> StreamingQuery:
    """The output of every batch as parquet below ``path``; works in every mode."""
    return to_many(df, [batch_files(path)], checkpoint, mode, trigger, name)


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All batches of ``to_snapshots`` with their ``batch_id``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).withColumn(BATCH, F.col(BATCH).cast("long"))


def latest_snapshot(batches: DataFrame) -> DataFrame:
    """Complete mode: the rows of the last batch. Spark reads the files of that batch only."""
    last = batches.select(F.max(BATCH).alias(BATCH)).scalar()
    return batches.filter(F.col(BATCH) == last).drop(BATCH)


def latest_per_key(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update mode: the last row of each key, found by a plain aggregate that combines in each task."""
    values = [name for name in batches.columns if name not in (*keys, BATCH)]
    last = F.max_by(F.struct(*values), BATCH).alias("last__")
    return batches.groupBy(*keys).agg(last).select(*keys, "last__.*")


def write_report(report: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    """A fitted pipeline, replacing an earlier one."""
    model.write().overwrite().save(path)
