"""Event-time windows for batch frames and streams."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.measures import Measure

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str | int) -> int:
    """``"5 minutes"`` -> 300."""
    if isinstance(duration, int):
        return duration
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", duration.lower())
    if not match or match.group(2) not in _SECONDS:
        raise ValueError(f"not a window duration: {duration!r}")
    return int(match.group(1)) * _SECONDS[match.group(2)]


def watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Let state go once ``delay`` has passed since the latest event time. No effect on batch."""
    return df.withWatermark(ts, delay)


def windowed(
    df: DataFrame,
    ts: str,
    length: str | int,
    measures: Sequence[Measure],
    keys: Sequence[str] = (),
    slide: str | int | None = None,
    delay: str | None = None,
    keep_struct: bool = False,
) -> DataFrame:
    """Aggregate per window and key.

    Tumbling windows, and sliding windows of a stream, are one aggregation; Spark combines rows
    before the shuffle, so a hot key travels as one row per task. Sliding windows of a batch are
    first aggregated into panes of one slide each, and panes are then added up into windows: rows
    are not multiplied by length / slide, only the far fewer panes are. A stream does not take panes:
    a pane would close before the windows it belongs to, and late rows would be lost to all of them.
    """
    span, step = seconds(length), seconds(slide if slide is not None else length)
    if delay:
        df = watermark(df, ts, delay)
    if df.isStreaming or step == span or span % step:
        window = F.window(ts, f"{span} seconds", f"{step} seconds").alias("window")
        out = df.groupBy(window, *keys).agg(*[m.direct.alias(m.name) for m in measures])
    else:
        out = _from_panes(df, ts, span, step, measures, keys)
    if keep_struct:
        return out
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return out.select(*bounds, *keys, *[m.name for m in measures])


def _from_panes(
    df: DataFrame, ts: str, span: int, step: int, measures: Sequence[Measure], keys: Sequence[str]
) -> DataFrame:
    exact = [m for m in measures if m.distinct_of is not None]
    mergeable = [m for m in measures if m.distinct_of is None]
    # Values counted exactly ride along as pane keys, so each pane holds a value once.
    carried = [m.distinct_of.alias(f"{m.name}__value") for m in exact]
    pane = F.window(ts, f"{step} seconds")["start"].alias("pane")
    parts = [column.alias(name) for m in mergeable for name, column in m.parts.items()]
    panes = df.groupBy(pane, *keys, *carried).agg(*(parts or [F.count(F.lit(1)).alias("rows__n")]))
    window = F.window("pane", f"{span} seconds", f"{step} seconds").alias("window")
    merged = {m.name: m.merged({name: F.col(name) for name in m.parts}) for m in mergeable}
    merged |= {m.name: F.count_distinct(F.col(f"{m.name}__value")) for m in exact}
    return panes.groupBy(window, *keys).agg(*[merged[m.name].alias(m.name) for m in measures])


def tumbling(
    df: DataFrame, ts: str, length: str, measures: Sequence[Measure], keys: Sequence[str] = (), delay: str | None = None
) -> DataFrame:
    """Every row belongs to one window."""
    return windowed(df, ts, length, measures, keys, delay=delay)


def sliding(
    df: DataFrame,
    ts: str,
    length: str,
    slide: str,
    measures: Sequence[Measure],
    keys: Sequence[str] = (),
    delay: str | None = None,
) -> DataFrame:
    """Every row belongs to length / slide windows."""
    return windowed(df, ts, length, measures, keys, slide=slide, delay=delay)
