"""Aggregate columns and small reports that are not tied to event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import as_column

NUMERIC = ("int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC]


def p95(value: Column | str, accuracy: int = 10_000) -> Column:
    """95th percentile from a mergeable sketch with rank error 1 / accuracy."""
    return F.percentile_approx(as_column(value), 0.95, accuracy)


def approx_distinct(value: Column | str, rsd: float = 0.05) -> Column:
    return F.approx_count_distinct(as_column(value), rsd)


def quartiles(df: DataFrame, columns: Sequence[str], err: float = 0.01) -> DataFrame:
    """q1, median and q3 of several columns from one pass, one row per column."""
    accuracy = F.lit(max(1, round(1 / err)))
    sketches = [F.percentile_approx(name, [0.25, 0.5, 0.75], accuracy).alias(name) for name in columns]
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(name)[0].cast("double").alias("q1"),
            F.col(name)[1].cast("double").alias("median"),
            F.col(name)[2].cast("double").alias("q3"),
        )
        for name in columns
    ]
    return df.agg(*sketches).select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, stddev, min and max of numeric columns from one pass, one row per column."""
    names = list(columns) if columns else numeric_columns(df)
    facts = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    one_row = df.agg(*[fact(name).alias(f"{name}__{key}") for name in names for key, fact in facts.items()])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"{name}__count").alias("count"),
            *[F.col(f"{name}__{key}").cast("double").alias(key) for key in ("mean", "stddev", "min", "max")],
        )
        for name in names
    ]
    return one_row.select(F.inline(F.array(*rows)))


def value_histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The multiset of a column per key as sorted (value, events) pairs.

    Values are counted first, so a key gathers one entry per different value and not one per row.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("events"))
    entry = F.struct(F.col(value).alias("minutes"), "events")
    return counted.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("histogram"))


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows in a stated order; Spark keeps n per task, it does not sort everything."""
    return df.orderBy(*order).limit(n)
