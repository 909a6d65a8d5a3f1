"""Places of pattern matches in texts, with column functions only and in time linear (or n log n) in the matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running_sums(lengths: Column) -> Column:
    """Sums of the first 1, 2, 3, ... entries: each round adds the entry 1, 2, 4, ... places before."""
    steps = F.array(*(F.lit(1 << at) for at in range(31)))
    rounds = F.slice(steps, 1, F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)))).cast("int"))

    def add(sums: Column, step: Column) -> Column:
        return F.transform(sums, lambda x, at: F.when(at >= step, x + F.get(sums, at - step)).otherwise(x))

    return F.aggregate(rounds, lengths, add)


def matches(text: Column, pattern: str, entry: Callable[[Column, Column, Column, Column, Column], Column]) -> Column:
    """``entry(start, end, match, gap before, gap after)`` of the leftmost non-overlapping matches, in order.

    Places are in code points, ends exclusive. A gap reaches to the next match, or to the text's end. The
    pattern must not match the empty string. Texts without a match have an empty array.
    """

    def found(whole: Column, parts: Column) -> Column:
        lengths = F.transform(whole, lambda match, at: F.length(F.get(parts, at)) + F.length(match))
        return bound(
            running_sums(lengths),
            lambda ends: F.transform(
                whole,
                lambda match, at: entry(
                    F.get(ends, at) - F.length(match), F.get(ends, at), match, F.get(parts, at), F.get(parts, at + 1)
                ),
            ),
        )

    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("whole"), F.split(text, pattern, -1).alias("parts")
    )
    filled = bound(pieces, lambda both: found(both["whole"], both["parts"]))
    return F.coalesce(F.when(F.regexp_like(text, F.lit(pattern)), filled), F.slice(filled, 1, 0))


def with_crossed(rows: DataFrame, base: Column, by: str = "uid") -> DataFrame:
    """The rows with ``crossed``: whether another row of the same text that is ``base`` overlaps its (start, end).

    Two sorted passes: what began before and reaches in, and what begins before its end.
    """
    limits = (Window.unboundedPreceding, -1)
    forth = Window.partitionBy(by).orderBy("start", base.desc(), "end").rowsBetween(*limits)
    back = Window.partitionBy(by).orderBy(F.col("start").desc(), base, "end").rowsBetween(*limits)
    reach = F.max(F.when(base, F.col("end"))).over(forth)
    begin = F.min(F.when(base, F.col("start"))).over(back)
    crossed = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(begin < F.col("end"), F.lit(False))
    return rows.withColumn("crossed", crossed)
