"""Small column builders used across the package."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def case(pairs: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First matching condition wins."""
    chain = F
    for condition, value in pairs:
        chain = chain.when(condition, value)
    return F.lit(default) if chain is F else chain.otherwise(default)


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def by_value(key: str, table: Mapping[object, object], default: object) -> Column:
    """Look a short fixed table up by equality with a column."""
    arms = " ".join(f"WHEN {sql_literal(entry)} THEN {sql_literal(value)}" for entry, value in table.items())
    return F.expr(f"CASE `{key}` {arms} ELSE {sql_literal(default)} END")


def first_step(value: Column, steps: Iterable[tuple[float, object]], default: object) -> Column:
    """The entry of the first threshold that ``value`` exceeds; list the thresholds downwards."""
    return case([(value > limit, F.lit(entry)) for limit, entry in steps], F.lit(default))


def in_set(value: Column | str, entries: Iterable[object]) -> Column:
    return as_column(value).isin(list(entries))


def hours(value: Column | str, *spans: tuple[int, int]) -> Column:
    """Whether an hour lies in any of the closed spans."""
    value = as_column(value)
    hit = value.between(*spans[0])
    for span in spans[1:]:
        hit = hit | value.between(*span)
    return hit


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Division that gives null, not an error, when the whole is zero or null."""
    return F.try_divide(as_column(part), as_column(whole))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    return F.sum(flag(condition))


def project(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(*columns)


def having(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition)


def defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column; other types than the column's are cast by Spark's rules."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in values.items()})


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds, each side truncated to the second first."""
    return F.unix_timestamp(as_column(later)) - F.unix_timestamp(as_column(earlier))


def time_parts(df: DataFrame, ts: str, hour: str = "hour_of_day", weekday: str = "day_of_week") -> DataFrame:
    """Hour 0..23 and weekday 1 (Sunday) .. 7."""
    return df.withColumns({hour: F.hour(ts), weekday: F.dayofweek(ts)})


def with_processing_time(df: DataFrame, name: str = "processing_time") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


# --- log lines -------------------------------------------------------------------------------

def message_length(text: Column | str) -> Column:
    return F.length(as_column(text))


def log_level(text: Column | str) -> Column:
    """Case-sensitive; an error outranks a warning."""
    text = as_column(text)
    return case([(text.contains("error"), "ERROR"), (text.contains("warn"), "WARNING")], "INFO")


def first_number(text: Column | str) -> Column:
    """Leading run of digits anywhere in the text, or the empty string."""
    return F.regexp_extract(as_column(text), r"(\d+)", 1)


def message_type(text: Column | str) -> Column:
    return F.when(as_column(text).rlike(r"\d"), "contains_number").otherwise("text_only")


def message_id() -> Column:
    """Unique per row, unlike a random suffix."""
    return F.concat(F.lit("msg_"), F.unix_timestamp().cast("string"), F.lit("_"), F.uuid())


def words(df: DataFrame, text: str, name: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per piece between single spaces, after any columns to keep; empty pieces are kept."""
    return df.select(*keep, F.explode(F.split(F.col(text), " ")).alias(name))


# --- sampling --------------------------------------------------------------------------------

def split(df: DataFrame, weights: Sequence[float], seed: int = 42, key: Sequence[str] | None = None) -> list[DataFrame]:
    """Split by a hash of the key columns (all columns if none are named).

    The side of a row depends only on its values, so recomputed partitions and other cluster sizes
    give the same split.
    """
    names = list(key) if key else df.columns
    point = F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(1_000_000)) / F.lit(1_000_000.0)
    total = float(sum(weights))
    parts, low = [], 0.0
    for place, weight in enumerate(weights):
        high = low + weight / total
        last = place == len(weights) - 1
        parts.append(df.filter(point >= low) if last else df.filter((point >= low) & (point < high)))
        low = high
    return parts
