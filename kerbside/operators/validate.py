"""Record checks that set bad rows aside instead of failing the job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import as_column, case
from kerbside.operators.decode import BAD_RECORD

REASON = "reject_reason"

# Fixed values of the sensor checks.
TEMPERATURE_RANGE = (-50, 100)
HUMIDITY_RANGE = (0, 100)
HIGH_TEMPERATURE = 35.0


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Name the first rule a row breaks. A rule that gives null counts as broken."""
    broken = [(~F.coalesce(rule, F.lit(False)), reason) for reason, rule in rules.items()]
    return df.withColumn(REASON, case(broken))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the rule they broke."""
    marked = with_reject_reason(df, rules)
    good = marked.filter(F.col(REASON).isNull()).drop(REASON)
    return good, marked.filter(F.col(REASON).isNotNull())


def sensor_rules() -> dict[str, Column]:
    required = ("reading_id", "sensor_id", "location", "temperature", "humidity", "timestamp")
    rules = {f"missing {name}": F.col(name).isNotNull() for name in required}
    rules["temperature out of range"] = F.col("temperature").between(*TEMPERATURE_RANGE)
    rules["humidity out of range"] = F.col("humidity").between(*HUMIDITY_RANGE)
    return rules


def validate_sensor(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_valid(df, sensor_rules())


def high_temp(df: DataFrame, limit: float = HIGH_TEMPERATURE, column: str = "temperature") -> DataFrame:
    return df.filter(F.col(column) > limit)


def high_temp_flag(column: Column | str = "temperature", limit: float = HIGH_TEMPERATURE) -> Column:
    return F.when(as_column(column) > limit, True).otherwise(False)


def tweet_rules(marked: bool = True) -> dict[str, Column]:
    """Checks on parsed tweets; ``marked`` frames carry unparsable text in ``_corrupt_record``."""
    rules = {"not JSON": F.col(BAD_RECORD).isNull()} if marked else {}
    return rules | {f"missing {name}": F.col(name).isNotNull() for name in ("user_handle", "text")}


def normalise_tweet(df: DataFrame) -> DataFrame:
    """Fill the optional fields and take the leading @ signs off the handle.

    Generated ids are random. Where a job may be retried, give ``tweet_id`` at the producer.
    """
    now_ms = F.unix_millis(F.current_timestamp())
    return df.select(
        F.coalesce("tweet_id", F.uuid()).alias("tweet_id"),
        F.regexp_replace("user_handle", "^@+", "").alias("user_handle"),
        "text",
        F.coalesce("language", F.lit("en")).alias("language"),
        F.coalesce("created_at", now_ms).alias("created_at"),
        F.coalesce("retweet_count", F.lit(0)).alias("retweet_count"),
        F.coalesce("like_count", F.lit(0)).alias("like_count"),
    )


def numeric_only(df: DataFrame, column: str = "value") -> DataFrame:
    """Messages that are a number once trimmed; the number is added as ``number``."""
    number = F.trim(F.col(column).cast("string")).try_cast("double")
    return df.withColumn("number", number).filter(F.col("number").isNotNull())
