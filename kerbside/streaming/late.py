"""The rows of a stream that come too late for their window, as a stream of their own."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kerbside.streaming.state import milliseconds

NUMBER = "late_number"
# The state API renames columns that begin with an underscore.
_PART, _CLOSES = "late__part", "late__closes"


class LateRowsOnly(StatefulProcessor):
    """Lets through what belongs to a window that the watermark has closed, and counts it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        before = (self.count.get() or (0,))[0]
        n = before
        for part in rows:
            late = part[part[_CLOSES] <= mark].drop(columns=[_PART, _CLOSES])
            if len(late):
                yield late.assign(**{NUMBER: range(n + 1, n + len(late) + 1)})
                n += len(late)
        if n > before:
            self.count.update((n,))

    def close(self) -> None:
        pass


def late_rows(
    df: DataFrame,
    event_time: str,
    delay: str,
    size: str,
    slide: str | None = None,
    spread_by: Sequence[str] | None = None,
    parts: int = 32,
) -> DataFrame:
    """The rows whose last window is closed when their batch begins, with their running number in their part.

    Put it beside an aggregation over the same source, windows and delay, with a checkpoint of its own, and write it
    with any sink in append mode: every row that counts for nothing is there once, also after a restart. A row is
    late if its last window ends at or before the watermark; Spark itself drops by the watermark of the batch before,
    so it may still take a row of the first batch behind a new watermark. Rows without an event time are not late.

    Rows are dealt into ``parts`` by ``spread_by`` (the event time if none); a part's state is one number.
    """
    step, whole = milliseconds(slide or size), milliseconds(size)
    closes = F.floor(F.unix_millis(F.col(event_time)) / step) * step + whole
    part = F.pmod(F.xxhash64(*(spread_by or [event_time])), F.lit(parts))
    dealt = df.withWatermark(event_time, delay).where(F.col(event_time).isNotNull())
    # Without its mark as the event time, or Spark would drop the very rows that are looked for.
    unmarked = F.timestamp_micros(F.unix_micros(F.col(event_time)))
    dealt = dealt.withColumns({event_time: unmarked, _PART: part, _CLOSES: closes.cast("long")})
    schema = df.schema.add(NUMBER, "long")
    return dealt.groupBy(_PART).transformWithStateInPandas(LateRowsOnly(), schema, "Append", "EventTime")
