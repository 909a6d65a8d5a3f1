"""Ready-made jobs: the booking reports and the tweet enrichment, from any source to any sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside import schemas
from kerbside.operators import booking_windows as B
from kerbside.operators.decode import parse_bookings
from kerbside.operators.enrich import booking_summary, enrich_bookings
from kerbside.operators.tweets import enrich_tweets, enriched_messages, read_tweets
from kerbside.operators.decode import to_message
from kerbside.streaming.runtime import StreamSpec, Trigger, start_all
from kerbside.streaming.sinks import BatchWriter, messages_to_kafka, to_console, to_many, to_memory, to_snapshots


def enriched_stream(messages: DataFrame, passengers: DataFrame, night: str = "literal", salts: int = 1) -> DataFrame:
    """Booking messages (JSON in ``value``) as enriched bookings."""
    return enrich_bookings(parse_bookings(messages, schemas.BOOKING), passengers, night, salts)


def booking_reports(enriched: DataFrame) -> dict[str, DataFrame]:
    return {
        "operational_metrics": B.bk_operational(enriched),
        "customer_metrics": B.bk_customer(enriched),
        "surge_metrics": B.bk_surge(enriched),
        "route_analytics": B.bk_routes(enriched),
    }


# Name of each booking query: trigger, and the sink, output mode and shown rows of an interactive run.
BOOKING_QUERIES = {
    "enriched_bookings": ("15 seconds", to_console, "append", {"rows": 10}),
    "operational_metrics": ("30 seconds", to_console, "complete", {"rows": 15}),
    "customer_metrics": ("30 seconds", to_memory, "complete", {}),
    "surge_metrics": ("20 seconds", to_memory, "complete", {}),
    "route_analytics": ("60 seconds", to_console, "complete", {"rows": 10}),
}

#: Where the results of a job can go. The console (and the memory tables of an interactive run) bring
#: every batch's output to the driver and are for looking at small results only.
SINKS = ("files", "kafka", "console")


def sink_spec(
    name: str,
    df: DataFrame,
    mode: str,
    trigger: Trigger,
    checkpoint: str,
    sink: str = "files",
    output: str | None = None,
    servers: str | None = None,
) -> StreamSpec:
    """One query into one of ``SINKS``: below the folder ``output``, to the topic ``output``-name, or shown.

    Files and topics get the changed rows of a report (update mode) where the console would show all
    of it (complete mode), so that a batch writes what it touched and old windows can leave the state.
    """
    settings: dict[str, object] = {"trigger": trigger, "checkpoint": f"{checkpoint}/{name}"}
    if sink == "console":
        return StreamSpec(name, df, to_console, settings | {"mode": mode})
    if not output:
        raise ValueError(f"sink {sink!r} needs an output")
    settings["mode"] = "update" if mode == "complete" else mode
    if sink == "files":
        return StreamSpec(name, df, to_snapshots, settings | {"path": f"{output}/{name}"})
    if sink == "kafka":
        messages = df.select(F.lit(name).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
        return StreamSpec(name, messages, messages_to_kafka, settings | {"topic": f"{output}-{name}", "servers": servers})
    raise ValueError(f"sink must be one of {SINKS}, not {sink!r}")


def start_bookings(
    messages: DataFrame,
    passengers: DataFrame,
    checkpoint: str,
    trigger: Trigger = None,
    sink: str = "console",
    output: str | None = None,
    servers: str | None = None,
    salts: int = 1,
) -> list[StreamingQuery]:
    """The five booking queries. Each reads the source by itself; ``trigger`` overrides all triggers.

    ``salts`` spreads a hot passenger over that many join keys where passengers are too many to be
    broadcast. With the console as sink, two reports stay in memory tables to be queried.
    """
    enriched = enriched_stream(messages, passengers, salts=salts)
    frames = {"enriched_bookings": booking_summary(enriched)} | booking_reports(enriched)
    specs = []
    for name, (every, shown, mode, options) in BOOKING_QUERIES.items():
        if sink == "console":
            settings = {"mode": mode, "trigger": trigger or every, "checkpoint": f"{checkpoint}/{name}"} | options
            specs.append(StreamSpec(name, frames[name], shown, settings))
        else:
            specs.append(sink_spec(name, frames[name], mode, trigger or every, checkpoint, sink, output, servers))
    return start_all(specs)


def start_bookings_once_read(
    messages: DataFrame,
    passengers: DataFrame,
    writers: Mapping[str, BatchWriter],
    checkpoint: str,
    trigger: Trigger = None,
    salts: int = 1,
) -> StreamingQuery:
    """Read and enrich the stream once and hand each micro-batch to all writers."""
    enriched = enriched_stream(messages, passengers, salts=salts)
    return to_many(enriched, list(writers.values()), checkpoint, trigger=trigger, name="enriched_bookings")


def tweet_job(messages: DataFrame, sink: Callable[[DataFrame], StreamingQuery]) -> StreamingQuery:
    """Raw tweet messages -> checked, enriched, keyed messages -> sink, at least once."""
    return sink(enriched_messages(messages))


def tweet_job_with_rejects(
    messages: DataFrame, good: BatchWriter, bad: BatchWriter, checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """Like ``tweet_job``, writing rejected messages beside the good ones from the same pass."""

    def write_good(batch: DataFrame, batch_id: int) -> None:
        good(to_message(enrich_tweets(read_tweets(batch)[0]), "tweet_id"), batch_id)

    def write_bad(batch: DataFrame, batch_id: int) -> None:
        bad(read_tweets(batch)[1], batch_id)

    return to_many(messages, [write_good, write_bad], checkpoint, trigger=trigger, name="tweets")
