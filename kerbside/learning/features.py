"""Feature pipelines and the grouped inputs of the segment and demand models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import as_column, count_where, ratio
from kerbside.functions.trip_model import calendar_flags

# The columns that the models read, in the order of their vectors.
CATEGORIES = ("pickup_district", "dropoff_district", "taxi_type", "membership", "payment_method", "customer_gender")
NUMBERS = (
    "distance",
    "hour",
    "day_of_week",
    "surge_multiplier",
    "num_passengers",
    "customer_age",
    "historical_trips",
    "historical_spent",
    "is_weekend",
    "is_rush_hour",
    "is_night",
    "is_airport_trip",
)
SEGMENT_NUMBERS = (
    "customer_age",
    "total_trips",
    "total_spent",
    "avg_fare",
    "avg_distance",
    "avg_surge",
    "cancellation_rate",
    "avg_rating",
)
DEMAND_NUMBERS = ("hour", "day_of_week", "is_weekend", "is_rush_hour", "is_night", "avg_surge", "cancellation_rate")


def features() -> Pipeline:
    """Index and one-hot encode categories, join them with the numbers, scale to unit deviation.

    Categories not seen in training get an index of their own. All categories are indexed in one
    pass; the indexer holds their different values, which are few by nature.
    """
    index = [f"{name}_index" for name in CATEGORIES]
    encoded = [f"{name}_encoded" for name in CATEGORIES]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORIES), outputCols=index, handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=encoded),
            VectorAssembler(inputCols=[*NUMBERS, *encoded], outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features"),
        ]
    )


FEATURE_COLUMNS = (
    *[f"{name}_index" for name in CATEGORIES],
    *[f"{name}_encoded" for name in CATEGORIES],
    "raw_features",
    "features",
)


def prob_of(vector: Column | str, place: int) -> Column:
    """One element of a vector column."""
    return vector_to_array(as_column(vector))[place]


def segment_input(df: DataFrame) -> DataFrame:
    """Trips by age, gender and tier."""
    return (
        df.groupBy("customer_age", "customer_gender", "membership")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.avg("fare").alias("avg_fare"),
            F.sum("fare").alias("total_spent"),
            F.avg("distance").alias("avg_distance"),
            F.avg("surge_multiplier").alias("avg_surge"),
            count_where(F.col("is_cancelled")).alias("cancellations"),
            F.avg("rating").alias("avg_rating"),
        )
        .withColumn("cancellation_rate", ratio("cancellations", "total_trips"))
    )


def demand_input(df: DataFrame) -> DataFrame:
    """Demand by hour, weekday and district."""
    grouped = (
        df.groupBy("hour", "day_of_week", "pickup_district")
        .agg(
            F.count(F.lit(1)).alias("demand"),
            F.avg("surge_multiplier").alias("avg_surge"),
            count_where(F.col("is_cancelled")).alias("cancellations"),
        )
        .withColumn("cancellation_rate", ratio("cancellations", "demand"))
    )
    return calendar_flags(grouped)
