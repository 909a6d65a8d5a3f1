"""Registry of named queries: a Spark function over the tables and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, TimestampType

from kerbside.plans.oracle_views import half_up, with_views
from kerbside.plans.tables import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), digits: dict[str, int] | None = None) -> Callable:
    """Register a query; ``views`` are put in front of its SQL.

    ``digits`` names sums and means of doubles, whose last bits depend on the order of the rows: the
    query and its SQL round them alike, well inside the precision of a double.
    """

    def add(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        steady = ", ".join(f"{half_up(column, places)} AS {column}" for column, places in (digits or {}).items())
        whole = f"SELECT * REPLACE ({steady}) FROM ({sql})" if sql and steady else sql

        @wraps(run)
        def rounded(t: Tables) -> DataFrame:
            return run(t).withColumns({c: F.round(c, places) for c, places in (digits or {}).items()})

        QUERIES[name] = Query(rounded if digits else run, with_views(whole, *views) if whole else None)
        return run

    return add


def plain(df: DataFrame) -> DataFrame:
    """Columns as other engines show them: no time zone, no window struct, arrays as text."""
    columns = []
    for field in df.schema.fields:
        if field.name == "window":
            columns += [
                F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            ]
        elif isinstance(field.dataType, TimestampType):
            columns.append(F.col(f"`{field.name}`").cast("timestamp_ntz").alias(field.name))
        elif isinstance(field.dataType, ArrayType):
            columns.append(F.array_join(F.col(f"`{field.name}`").cast("array<string>"), ",").alias(field.name))
        else:
            columns.append(F.col(f"`{field.name}`"))
    return df.select(*columns)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A named query as a function of a session and a folder. The modules with queries load on the first call."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        from kerbside.plans import all_queries

        return plain(all_queries()[name].run(Tables(spark, folder)))

    return run
