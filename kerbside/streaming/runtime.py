"""Starting, watching and stopping streaming queries."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

Trigger = str | None


def trigger_options(trigger: Trigger) -> dict[str, object]:
    """``"10 seconds"``, ``"available_now"``, ``"once"``, ``"continuous 10 seconds"`` or None."""
    if trigger is None:
        return {}
    if trigger in ("available_now", "once"):
        return {"availableNow": True} if trigger == "available_now" else {"once": True}
    if trigger.startswith("continuous "):
        return {"continuous": trigger.removeprefix("continuous ")}
    return {"processingTime": trigger}


def writer(
    df: DataFrame,
    mode: str = "append",
    trigger: Trigger = None,
    checkpoint: str | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """A configured writer; every query needs a checkpoint folder of its own."""
    if mode == "complete":
        log.info("complete mode keeps the state of every key for ever, also with a watermark")
    out = df.writeStream.outputMode(mode)
    if trigger is not None:
        out = out.trigger(**trigger_options(trigger))
    if checkpoint:
        out = out.option("checkpointLocation", checkpoint)
    return out.queryName(name) if name else out


class LateRows(StreamingQueryListener):
    """Adds up, batch by batch, what each query dropped behind its watermark.

    Register it with the session of the queries before they start:
    ``df.sparkSession.streams.addListener(late)``. Each task combines its
    rows before they meet the watermark, so this counts combined rows, not rows; ``late.late_rows`` gives the rows
    themselves. Spark drops by the watermark of the batch before. Progress arrives
    shortly after a batch; a query's ``lastProgress`` tells its last batch, ``seen`` what has arrived.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()
        self.seen: dict[str, int] = {}

    def of(self, query: StreamingQuery) -> int:
        return self.dropped[str(query.id)]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = str(progress.id)
        self.dropped[name] += sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.seen[name] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@dataclass(frozen=True)
class StreamSpec:
    """One query of a job: a name, its frame, and a function that starts it."""

    name: str
    df: DataFrame
    start: Callable[..., StreamingQuery]
    options: Mapping[str, object] = field(default_factory=dict)


def start_all(specs: Iterable[StreamSpec]) -> list[StreamingQuery]:
    """Start several queries; if one fails to start, those already running are stopped."""
    running: list[StreamingQuery] = []
    try:
        for spec in specs:
            running.append(spec.start(spec.df, name=spec.name, **spec.options))
    except Exception:
        stop_all(running)
        raise
    return running


def finish_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for the end of finite queries and raise what failed."""
    for query in queries:
        query.awaitTermination()


def stop_all(queries: Iterable[StreamingQuery], timeout: int = 60) -> None:
    """Stop every query; one that fails to stop does not keep the others running."""
    for query in queries:
        try:
            query.stop()
            query.awaitTermination(timeout)
        except Exception as error:  # noqa: BLE001 - the rest must still be stopped
            log.warning("query %s ended with %s", query.name, error)


STATUS = (
    "name string, active boolean, batch long, input_rate double, processing_rate double, state_rows long, "
    "late_combined_rows long"
)


def query_status(
    spark: SparkSession, queries: Iterable[StreamingQuery], late: LateRows | None = None
) -> DataFrame:
    """One row per query: whether it runs, its rates, its state, and its late rows (see ``LateRows``).

    Without a ``LateRows`` that has watched from the start, late rows are not known and null.
    """
    rows = []
    for query in queries:
        last = query.lastProgress or {}
        rows.append(
            (
                query.name,
                query.isActive,
                last.get("batchId"),
                float(last.get("inputRowsPerSecond") or 0.0),
                float(last.get("processedRowsPerSecond") or 0.0),
                state_rows(query),
                late.of(query) if late else None,
            )
        )
    return spark.createDataFrame(rows, STATUS)


def state_rows(query: StreamingQuery) -> int:
    """Keys held in state after the latest batch."""
    last = query.lastProgress
    return sum(operator["numRowsTotal"] for operator in last["stateOperators"]) if last else 0
