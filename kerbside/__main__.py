"""Jobs from the command line: ``python -m kerbside <job> ...`` or through ``spark-submit``.

Each job only chooses a source, a function of the library and a sink.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from kerbside import schemas
from kerbside.learning.models import MODEL_NAMES, run_ml
from kerbside.operators import trip_windows as T
from kerbside.operators.decode import parse_trips
from kerbside.operators.quality.report import monitoring, recommend, run_suite, summary, with_examples
from kerbside.session import build_session
from kerbside.sources.dimensions import load_datasets, load_dim
from kerbside.sources.files import read_csv
from kerbside.sources.messages import read_kafka, read_socket
from kerbside.streaming.jobs import SINKS, sink_spec, start_bookings, tweet_job
from kerbside.streaming.runtime import StreamSpec, finish_all, start_all, stop_all
from kerbside.streaming.sinks import messages_to_kafka, write_report

# Report, output mode and trigger of the trip jobs.
TRIP_JOBS = {
    "tumbling": {
        "TumblingTrips": (T.tw_trips, "append", "10 seconds"),
        "TumblingDistricts": (T.tw_districts, "append", "15 seconds"),
        "TumblingTaxiTypes": (T.tw_taxi_types, "append", "20 seconds"),
    },
    "sliding": {
        "SlidingTrends": (T.sw_trends, "append", "8 seconds"),
        "SlidingDistricts": (T.sw_districts, "append", "12 seconds"),
        "SlidingPerformance": (T.sw_performance, "append", "10 seconds"),
        "RushHourDetection": (T.sw_rush, "append", "15 seconds"),
    },
    "watermarks": {
        "StrictWatermark": (T.wm_strict, "append", "10 seconds"),
        "LenientWatermark": (T.wm_lenient, "append", "12 seconds"),
        "NoWatermark": (T.wm_none, "complete", "15 seconds"),
        "LateDataAnalysis": (T.wm_lateness, "append", "8 seconds"),
    },
}
DATASETS = ("taxis", "drivers", "passengers", "trips")


def trip_specs(
    messages: DataFrame, job: str, checkpoint: str, trigger: str | None = None, sink: str = "console", **where: str | None
) -> list[StreamSpec]:
    """The queries of one trip job over a stream of JSON messages, into one of the ``SINKS``."""
    trips = parse_trips(messages, schemas.TAXI_TRIP)
    return [
        sink_spec(name, report(trips), mode, trigger or every, checkpoint, sink, **where)
        for name, (report, mode, every) in TRIP_JOBS[job].items()
    ]


def quality(spark: SparkSession, paths: dict[str, str], output: str | None) -> DataFrame:
    """Run the suite; write the report, or return monitoring figures where no output is named."""
    datasets = load_datasets(spark, paths)
    report = run_suite(datasets)
    if output is None:
        return monitoring(report)
    report = with_examples(report, datasets)
    write_report(report, output)
    # The written report is small; the summary reads it back and does not run the checks again.
    verdict = summary(spark.read.schema(report.schema).json(output))
    recommend(verdict).orderBy("place").show(truncate=False)
    return verdict


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="kerbside")
    jobs = parser.add_subparsers(dest="job", required=True)
    bookings = jobs.add_parser("bookings", help="the five booking queries over a socket stream")
    bookings.add_argument("--source-host", default="localhost")
    bookings.add_argument("--source-port", type=int, default=9999)
    bookings.add_argument("--passengers", default="data/passengers.csv")
    trips = jobs.add_parser("trips", help="trip windows over a Kafka topic")
    trips.add_argument("report", choices=sorted(TRIP_JOBS))
    trips.add_argument("--servers", default="kafka:9092")
    trips.add_argument("--topic", default="taxi-trips")
    tweets = jobs.add_parser("tweets", help="tweet enrichment between two Kafka topics")
    tweets.add_argument("--servers", default="localhost:9092")
    tweets.add_argument("--raw", default="tweet-ingestion")
    tweets.add_argument("--enriched", default="tweet-processed")
    for stream in (bookings, trips, tweets):
        # A job that forgets where it was loses or repeats messages, so there is no default.
        stream.add_argument("--checkpoint", required=True, help="a folder that stays the same over restarts")
    for stream in (bookings, trips):
        stream.add_argument("--sink", choices=SINKS, default="files")
        stream.add_argument("--output", help="folder for files, or the first part of the topics' names")
        stream.add_argument("--sink-servers", help="brokers of the topics written to")
    bookings.add_argument("--salts", type=int, default=1, help="join keys over which a hot passenger is spread")
    checks = jobs.add_parser("quality", help="the quality suite over files")
    for name in DATASETS:
        checks.add_argument(f"--{name}")
    checks.add_argument("--output", default="data_quality_report")
    checks.add_argument("--monitoring", action="store_true")
    learning = jobs.add_parser("ml", help="train, evaluate, tune or predict")
    learning.add_argument("--action", choices=("train", "evaluate", "tune", "predict"), default="train")
    learning.add_argument("--data", required=True, help="CSV of trip samples")
    learning.add_argument("--models", nargs="+", choices=MODEL_NAMES, default=list(MODEL_NAMES))
    learning.add_argument("--folder", default="models")
    learning.add_argument("--output", help="parquet folder for predictions")
    return parser


def main(arguments: list[str] | None = None) -> None:
    given = _parser().parse_args(arguments)
    spark = build_session(f"kerbside-{given.job}")
    if given.job == "quality":
        paths = {name: getattr(given, name) for name in DATASETS if getattr(given, name)}
        quality(spark, paths, None if given.monitoring else given.output).show(50, truncate=False)
        return
    if given.job == "ml":
        found = run_ml(given.action, read_csv(spark, given.data), given.folder, given.models)
        if given.output:
            found.write.mode("overwrite").parquet(given.output)
        else:
            found.show(50, truncate=False)
        return
    checkpoint = given.checkpoint
    if given.job == "bookings":
        messages = read_socket(spark, given.source_host, given.source_port)
        where = {"sink": given.sink, "output": given.output, "servers": given.sink_servers, "salts": given.salts}
        running = start_bookings(messages, load_dim(spark, "passengers", given.passengers), checkpoint, **where)
    elif given.job == "trips":
        where = {"sink": given.sink, "output": given.output, "servers": given.sink_servers}
        running = start_all(trip_specs(read_kafka(spark, given.topic, given.servers), given.report, checkpoint, **where))
    else:
        raw = read_kafka(spark, given.raw, given.servers, starting="earliest")
        running = [tweet_job(raw, lambda df: messages_to_kafka(df, given.enriched, given.servers, f"{checkpoint}/tweets"))]
    try:
        finish_all(running)
    finally:
        stop_all(running)


if __name__ == "__main__":
    main()
