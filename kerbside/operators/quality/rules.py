"""Business rules and references between tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.joins import lookup, missing_keys
from kerbside.operators.quality.folding import Fold, fact, row, run_fold, text

# Fixed values of the rules.
SEATS_OF_TYPE = {
    "Mini Cab": (3, 4),
    "Standard": (4, 4),
    "Premier": (4, 5),
    "Maxi Cab": (6, 8),
    "Limosine": (4, 6),
}
RATING_RANGE = (1, 5)
FARE_PER_KM_RANGE = (1.0, 15.0)
MINUTES_PER_KM_RANGE = (1.0, 10.0)

# Fixed output: how the report words each rule.
RULE_TEXT = {
    "driver_ratings": "Driver ratings must be between 1 and 5",
    "taxi_capacity": "Taxi capacity must match taxi type",
    "fare_reasonableness": "Fare per km should be between $1-$15",
    "duration_reasonableness": "Duration per km should be between 1-10 minutes",
    "passenger_capacity": "Passenger count must not exceed taxi capacity",
    "taxi_references": "All trip taxi numbers must exist in taxi master data",
    "passenger_references": "All trip passenger IDs must exist in passenger master data",
    "driver_taxi_assignments": "All driver taxi assignments must reference valid taxis",
}


def _beyond(value: str, limits: tuple[float, float]) -> str:
    return f"({value} < {limits[0]} OR {value} > {limits[1]})"


def driver_rules() -> dict[str, str]:
    return {"driver_ratings": _beyond("Rating", RATING_RANGE)}


def taxi_rules() -> dict[str, str]:
    """Seats outside the limits of the taxi's type; other types have no limits."""
    wrong = [
        f"(TaxiType = {text(kind)} AND {_beyond('TaxiPassengerCapacity', limits)})"
        for kind, limits in SEATS_OF_TYPE.items()
    ]
    return {"taxi_capacity": " OR ".join(wrong)}


def trip_rules() -> dict[str, str]:
    """Per-kilometre rules; a trip of zero length breaks none."""
    return {
        "fare_reasonableness": _beyond("try_divide(TripFare, DistanceTravelled)", FARE_PER_KM_RANGE),
        "duration_reasonableness": _beyond(
            "try_divide(TripDurationInSeconds / 60, DistanceTravelled)", MINUTES_PER_KM_RANGE
        ),
    }


def rule_facts(rules: Mapping[str, str]) -> dict[str, str]:
    return {f"{name}::broken": f"count_if({broken})" for name, broken in rules.items()}


def _verdict(name: str, violations: str) -> str:
    return row(
        rule=text(name),
        description=text(RULE_TEXT[name]),
        violations=violations,
        status=f"CASE WHEN {violations} = 0 THEN 'PASS' ELSE 'FAIL' END",
    )


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """All row rules of one table in one pass."""
    rows = [_verdict(name, fact(name, "broken")) for name in rules]
    return run_fold(df, Fold(rule_facts(rules), rows))


def rule_driver_rating(drivers: DataFrame) -> DataFrame:
    return check_rules(drivers, driver_rules())


def rule_taxi_capacity(taxis: DataFrame) -> DataFrame:
    return check_rules(taxis, taxi_rules())


def rule_fare_per_km(trips: DataFrame) -> DataFrame:
    return check_rules(trips, {"fare_reasonableness": trip_rules()["fare_reasonableness"]})


def rule_minutes_per_km(trips: DataFrame) -> DataFrame:
    return check_rules(trips, {"duration_reasonableness": trip_rules()["duration_reasonableness"]})


def rule_seats(trips: DataFrame, taxis: DataFrame) -> DataFrame:
    """Trips with more passengers than seats; trips of unknown taxis break nothing.

    Trips are counted per taxi and group size before the join, so a busy taxi does not make a
    heavy task.
    """
    return seats_of_groups(taxi_groups(trips), taxis)


def taxi_groups(trips: DataFrame) -> DataFrame:
    """Trips per taxi and group size."""
    return trips.groupBy("TaxiNumber", "NumberOfPassengers").agg(F.count(F.lit(1)).alias("trips"))


def seats_of_groups(groups: DataFrame, taxis: DataFrame) -> DataFrame:
    """``rule_seats`` on ``taxi_groups``."""
    seated = lookup(groups, taxis.select("TaxiNumber", "TaxiPassengerCapacity"), "TaxiNumber")
    crowded = F.col("NumberOfPassengers") > F.col("TaxiPassengerCapacity")
    violations = F.coalesce(F.sum(F.when(crowded, F.col("trips"))), F.lit(0))
    one_row = seated.agg(violations.alias("crowded"))
    return one_row.selectExpr(f"inline(array({_verdict('passenger_capacity', 'crowded')}))")


REFERENCES = {
    # check: (table, key, master, master key, how a null key is taken)
    "taxi_references": ("trips", "TaxiNumber", "taxis", "TaxiNumber", "count"),
    "passenger_references": ("trips", "PassengerID", "passengers", "PassengerID", "skip"),
    "driver_taxi_assignments": ("drivers", "TaxiIDDriving", "taxis", "TaxiID", "skip"),
}


def ref_missing(datasets: Mapping[str, DataFrame], check: str) -> DataFrame:
    """The different keys that have no master row."""
    table, key, master, master_key, nulls = REFERENCES[check]
    return missing_keys(datasets[table], datasets[master], key, master_key, nulls)


def ref_check(datasets: Mapping[str, DataFrame], check: str) -> DataFrame:
    """How many different keys have no master row."""
    counted = ref_missing(datasets, check).agg(F.count(F.lit(1)).alias("missing"))
    verdict = counted.selectExpr(f"inline(array({_verdict(check, 'missing')}))")
    return verdict.withColumnRenamed("violations", "invalid_references")


def ref_sample(datasets: Mapping[str, DataFrame], check: str, n: int = 10) -> DataFrame:
    """The n smallest keys without a master row."""
    return ref_missing(datasets, check).orderBy(REFERENCES[check][1]).limit(n)
