"""Lookups, key checks and flattening of nested dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key_pairs(on: Mapping[str, str] | Sequence[str] | str) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {name: name for name in on}


def lookup(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str] | Sequence[str] | str, how: str = "left", salts: int = 1
) -> DataFrame:
    """Add a dimension's columns to the rows of a batch or stream.

    No broadcast is forced: Spark broadcasts the dimension when its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise, where AQE splits
    hot keys of a batch. AQE does not act on stateful streams; for a stream joined with a dimension
    above the threshold, ``salts`` spreads each key over that many tasks, at the price of that many
    copies of the dimension.
    """
    pairs = _key_pairs(on)
    same = [name for name, other in pairs.items() if name == other]
    renamed = dim.withColumnsRenamed({name: f"{name}__dim" for name in same})
    other = {name: (f"{name}__dim" if name in same else key) for name, key in pairs.items()}
    if salts > 1:
        # Any spread will do, so the salt comes from the whole row: equal on every retry.
        df = df.withColumn("salt__", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        renamed = renamed.withColumn("salt__dim", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        other["salt__"] = "salt__dim"
    condition = reduce(Column.__and__, [df[name] == renamed[key] for name, key in other.items()])
    joined = df.join(renamed, condition, how)
    return joined.drop(*[f"{name}__dim" for name in same], "salt__", "salt__dim")


def join_capacity(trips: DataFrame, taxis: DataFrame) -> DataFrame:
    """Trips with the seat count of their taxi."""
    return lookup(trips, taxis.select("TaxiNumber", "TaxiPassengerCapacity"), "TaxiNumber")


def missing_keys(
    df: DataFrame, master: DataFrame, key: str, master_key: str | None = None, nulls: str = "skip"
) -> DataFrame:
    """Different keys in use that the master table lacks, one row each.

    Keys are made distinct before the shuffle, so a hot key costs one row per task. ``nulls="count"``
    takes null as a key of its own.
    """
    used = df.select(F.col(key).alias(key)).distinct()
    known = master.select(F.col(master_key or key).alias("known__")).distinct()
    if nulls == "skip":
        return used.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("known__"), "left_anti")
    return used.join(known, F.col(key).eqNullSafe(F.col("known__")), "left_anti")


def key_difference(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Set difference of two key columns; null is a member like any other."""
    known = right.select(F.col(right_key or key).alias(key)).distinct()
    return left.select(key).distinct().subtract(known)


def taxi_drivers(taxis: DataFrame) -> DataFrame:
    """One flat row per taxi and registered driver; taxis without drivers stay with nulls."""
    exploded = taxis.withColumn("driver__", F.explode_outer("RegisteredDrivers"))
    return exploded.select("Sno", "TaxiNumber", "TaxiType", "TaxiFeature.*", "TMDTID", "driver__.*")
