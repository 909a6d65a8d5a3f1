"""Windowed reports on trades, sensor readings, plain values and words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.scalars import words
from kerbside.functions.trip_model import buy_sell
from kerbside.operators import measures as M
from kerbside.operators.windows import windowed


def _sides() -> list[M.Measure]:
    return [M.total_int("TotalBuy", "Buy"), M.total_int("TotalSell", "Sell")]


def _bounds(df: DataFrame, *names: str) -> DataFrame:
    return df.select("window.start", "window.end", *names)


def st_tumble(df: DataFrame, ts: str = "CreatedTime") -> DataFrame:
    out = windowed(buy_sell(df), ts, "10 minutes", _sides(), keep_struct=True)
    return _bounds(out, "TotalBuy", "TotalSell")


def st_by_type(df: DataFrame, ts: str = "CreatedTime") -> DataFrame:
    return windowed(df, ts, "15 minutes", [M.total_int("total_amount", "Amount")], keys=["Type"], keep_struct=True)


def st_watermark(df: DataFrame, ts: str = "CreatedTime") -> DataFrame:
    out = windowed(buy_sell(df), ts, "15 minutes", _sides(), delay="30 minutes", keep_struct=True)
    return _bounds(out, "TotalBuy", "TotalSell")


def se_slide_15(df: DataFrame, ts: str = "CreatedTime", key: str = "SensorID") -> DataFrame:
    largest = [M.largest("MaxReading", "Reading")]
    out = windowed(df, ts, "15 minutes", largest, [key], slide="5 minutes", delay="30 minutes", keep_struct=True)
    return out.select(key, "window.start", "window.end", "MaxReading")


def se_slide_5(df: DataFrame, ts: str = "CreatedTime", key: str = "sensor_id") -> DataFrame:
    largest = [M.largest("MaxReading", "Reading")]
    out = windowed(df, ts, "5 minutes", largest, [key], slide="1 minute", delay="30 minutes", keep_struct=True)
    return out.select(key, "window.start", "window.end", "MaxReading")


def ev_slide(df: DataFrame, ts: str = "event_time") -> DataFrame:
    counts = [M.count_rows("count")]
    return windowed(df, ts, "60 seconds", counts, ["value"], slide="30 seconds", delay="60 seconds", keep_struct=True)


def word_counts(df: DataFrame, text: str = "value") -> DataFrame:
    """Running count per word; complete and update mode differ only in what they emit."""
    return words(df, text).groupBy("word").count()


wc_complete = word_counts
wc_update = word_counts


def running_totals(totals: DataFrame, order: str = "end", by: Sequence[str] = ()) -> DataFrame:
    """Running buy and sell totals over windows, and their difference.

    Totals run within a day first and the totals of all days before are added, so that one task sees
    the windows of one day, or one row per day, and never the whole history.
    """
    sides = ("TotalBuy", "TotalSell")
    dated = totals.withColumn("day__", F.date_trunc("day", order))
    same_day = Window.partitionBy(*by, "day__").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = dated.withColumns({f"R{side}": F.sum(side).over(same_day) for side in sides})
    earlier = Window.partitionBy(*by).orderBy("day__").rowsBetween(Window.unboundedPreceding, -1)
    days = dated.groupBy(*by, "day__").agg(*[F.sum(side).alias(side) for side in sides])
    before = days.select(
        *[F.col(name).alias(f"{name}__of") for name in (*by, "day__")],
        *[F.coalesce(F.sum(side).over(earlier), F.lit(0)).alias(f"{side}__before") for side in sides],
    )
    match = reduce(
        Column.__and__, [F.col(name).eqNullSafe(F.col(f"{name}__of")) for name in (*by, "day__")]
    )
    running = [(F.col(f"R{side}") + F.col(f"{side}__before")).alias(f"R{side}") for side in sides]
    return (
        within.join(before, match, "left")
        .select(*totals.columns, *running)
        .withColumn("NetValue", F.col("RTotalBuy") - F.col("RTotalSell"))
    )


def broker_totals(df: DataFrame, ts: str = "CreatedTime") -> DataFrame:
    """Ten-minute totals per broker, the input of running totals kept apart by broker."""
    out = windowed(buy_sell(df), ts, "10 minutes", _sides(), ["BrokerCode"], keep_struct=True)
    return out.select("BrokerCode", "window.start", "window.end", "TotalBuy", "TotalSell")


def last_n(df: DataFrame, key: Sequence[str] | str, ts: str, n: int = 50, tie: Sequence[str] = ()) -> DataFrame:
    """The latest n rows per key.

    Spark cuts each task's rows to n per key before the shuffle as long as n stays within
    ``spark.sql.optimizer.windowGroupLimitThreshold``. Beyond that, rows are first cut per key and
    hash bucket, so that a hot key is spread over many tasks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(ts).desc(), *[F.col(name).desc() for name in tie]]

    def cut(rows: DataFrame, groups: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        return rows.withColumn("place__", place).filter(F.col("place__") <= n).drop("place__")

    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        spread = df.withColumn("bucket__", F.pmod(F.xxhash64(*df.columns), F.lit(256)))
        return cut(cut(spread, [*keys, "bucket__"]).drop("bucket__"), keys)
    return cut(df, keys)
