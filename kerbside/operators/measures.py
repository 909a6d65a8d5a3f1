"""Aggregates that can be taken in one step or as mergeable parts.

A measure knows three forms: ``direct`` over rows, ``parts`` over rows (columns that can be added
up), and ``merged`` over those parts. Sliding windows use the parts to aggregate every row once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.scalars import as_column, count_where, flag


@dataclass(frozen=True)
class Measure:
    name: str
    direct: Column
    parts: dict[str, Column] = field(default_factory=dict)
    merged: Callable[[dict[str, Column]], Column] | None = None
    distinct_of: Column | None = None


def _measure(name: str, direct: Column, merged: Callable, **parts: Column) -> Measure:
    return Measure(name, direct, {f"{name}__{part}": column for part, column in parts.items()}, merged)


def _added(name: str, part: str) -> Callable:
    return lambda at: F.sum(at[f"{name}__{part}"])


def count_rows(name: str) -> Measure:
    return _measure(name, F.count(F.lit(1)), _added(name, "n"), n=F.count(F.lit(1)))


def count_of(name: str, value: Column | str) -> Measure:
    value = as_column(value)
    return _measure(name, F.count(value), _added(name, "n"), n=F.count(value))


def count_if(name: str, condition: Column) -> Measure:
    return _measure(name, count_where(condition), _added(name, "n"), n=F.sum(flag(condition)))


def total(name: str, value: Column | str) -> Measure:
    """Sum of a fractional column, as Spark adds it up: NaN and infinity stay what they are."""
    value = as_column(value).cast("double")
    return _measure(name, F.sum(value), _added(name, "sum"), sum=F.sum(value))


def total_int(name: str, value: Column | str) -> Measure:
    value = as_column(value)
    return _measure(name, F.sum(value), _added(name, "sum"), sum=F.sum(value))


def mean(name: str, value: Column | str) -> Measure:
    value = as_column(value).cast("double")
    return _measure(
        name,
        F.avg(value),
        lambda at: F.try_divide(F.sum(at[f"{name}__sum"]), F.sum(at[f"{name}__n"])),
        sum=F.sum(value),
        n=F.count(value),
    )


def largest(name: str, value: Column | str) -> Measure:
    value = as_column(value)
    return _measure(name, F.max(value), lambda at: F.max(at[f"{name}__max"]), max=F.max(value))


def distinct(name: str, value: Column | str, exact: bool = False, rsd: float = 0.05) -> Measure:
    """Number of different values: a sketch, or exact (batch only).

    One step and merged parts use the same sketch of the same size, so batch and stream err alike, by
    ``rsd`` at most in two of three cases (estimates of merged sketches may differ a little from those
    of one sketch). A null is no value, and a group without values has 0 of them.
    """
    value = as_column(value)
    if exact:
        return Measure(name, F.count_distinct(value), distinct_of=value)
    size = F.lit(sketch_size(rsd))
    return _measure(
        name,
        F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(value, size)), F.lit(0)),
        lambda at: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(at[f"{name}__hll"])), F.lit(0)),
        hll=F.hll_sketch_agg(value, size),
    )


def sketch_size(rsd: float) -> int:
    """Log of the number of registers (4 to 21) that keeps the standard error, 1.04 / sqrt(registers), below ``rsd``."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))
