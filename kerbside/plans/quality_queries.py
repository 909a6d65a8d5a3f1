"""Data-quality checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.operators.quality import checks as K
from kerbside.operators.quality import report as P
from kerbside.operators.quality import rules as R
from kerbside.plans.catalog import query
from kerbside.plans.tables import Tables


def _datasets(t: Tables):
    return {"taxis": t.taxis, "drivers": t.drivers, "passengers": t.all_passengers, "trips": t.passenger_trips}


_TRIP_COLUMNS = (
    "trip_id",
    "event_timestamp",
    "processing_timestamp",
    "pickup_district",
    "dropoff_district",
    "distance_km",
    "duration_seconds",
    "fare_amount",
    "taxi_type",
    "passenger_count",
    "is_late_data",
    "late_by_minutes",
)


def _complete_sql(table: str, columns, required=()) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) - count({name}) AS null_count, "
        f"count({name}) / count(*) AS completeness_rate, "
        f"CASE WHEN count({name}) / count(*) >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"{'count(*) > count(' + name + ')' if name in required else 'false'} AS critical FROM {table}"
        for name in columns
    )


@query("dq_complete", _complete_sql("trips_events", _TRIP_COLUMNS, ("trip_id", "is_late_data")), ("trips_events",))
def _(t):
    return K.completeness(t.trips_events, required=["trip_id", "is_late_data"])


def _unique_sql(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", d AS distinct_count, n AS total_count, d / n AS uniqueness_rate, "
        f"n - d AS duplicates, CASE WHEN d / n >= 0.99 THEN 'PASS' ELSE 'FAIL' END AS status, d / n < 0.99 AS critical "
        f"FROM (SELECT count(*) AS n, count(DISTINCT {name}) + CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END AS d "
        f"FROM {table})"
        for name in columns
    )


@query("dq_unique", _unique_sql("trips", "Sno", "TaxiNumber", "DistanceTravelled", "TripFare"), ("trips",))
def _(t):
    return K.uniqueness(t.trips, ["Sno", "TaxiNumber", "DistanceTravelled", "TripFare", "absent"])


def _range_sql(table: str, checks) -> str:
    parts = []
    for name, (low, high) in checks.items():
        bad = f"count(*) FILTER ({name} < {low} OR {name} > {high})"
        parts.append(
            f"SELECT '{name}' AS \"column\", {low}::DOUBLE AS min_expected, {high}::DOUBLE AS max_expected, "
            f"{bad} AS out_of_range_count, (count({name}) - {bad}) / count({name}) AS validity_rate, "
            f"CASE WHEN {bad} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, {bad} > count({name}) * 0.1 AS critical, "
            f"{bad} > 0 AND {bad} <= count({name}) * 0.1 AS warning FROM {table}"
        )
    return " UNION ALL ".join(parts)


_PASSENGER_RANGES = {"Age": (0, 120), "AmountSpent": (0, 50000)}


@query("dq_range", _range_sql("trips", P.RULES["trips"].ranges), ("trips",))
def _(t):
    return K.ranges(t.trips, P.RULES["trips"].ranges)


@query("dq_range_passengers", _range_sql("all_passengers", _PASSENGER_RANGES), ("all_passengers",))
def _(t):
    return K.ranges(t.all_passengers, _PASSENGER_RANGES)


@query(
    "dq_range_examples",
    "SELECT 'AmountSpent' AS \"column\", array_to_string(list(v ORDER BY v), ',') AS examples FROM (SELECT DISTINCT "
    "CAST(AmountSpent AS DOUBLE) AS v FROM all_passengers WHERE AmountSpent < 0 OR AmountSpent > 50000 ORDER BY v LIMIT 5)",
    ("all_passengers",),
)
def _(t):
    return K.range_examples(t.all_passengers, _PASSENGER_RANGES)


def _rule_sql(name: str, table: str, broken: str) -> str:
    return (
        f"SELECT '{name}' AS rule, '{R.RULE_TEXT[name]}' AS description, count(*) FILTER ({broken}) AS violations, "
        f"CASE WHEN count(*) FILTER ({broken}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {table}"
    )


@query("dq_rule_rating", _rule_sql("driver_ratings", "drivers", "NOT Rating BETWEEN 1 AND 5"), ("drivers",))
def _(t):
    return R.rule_driver_rating(t.drivers)


_SEATS = (
    "(SELECT * FROM all_taxis JOIN (VALUES ('Mini Cab', 3, 4), ('Standard', 4, 4), ('Premier', 4, 5), "
    "('Maxi Cab', 6, 8), ('Limosine', 4, 6)) s(kind, lo, hi) ON kind = TaxiType)"
)


@query(
    "dq_rule_capacity",
    _rule_sql("taxi_capacity", _SEATS, "TaxiPassengerCapacity NOT BETWEEN lo AND hi"),
    ("all_taxis",),
)
def _(t):
    return R.rule_taxi_capacity(t.all_taxis)


@query(
    "dq_rule_fare_km",
    _rule_sql("fare_reasonableness", "trips", "TripFare / DistanceTravelled NOT BETWEEN 1 AND 15"),
    ("trips",),
)
def _(t):
    return R.rule_fare_per_km(t.trips)


@query(
    "dq_rule_min_km",
    _rule_sql("duration_reasonableness", "trips", "TripDurationInSeconds / 60 / DistanceTravelled NOT BETWEEN 1 AND 10"),
    ("trips",),
)
def _(t):
    return R.rule_minutes_per_km(t.trips)


_SEATED = "(SELECT * FROM trips LEFT JOIN taxis USING (TaxiNumber))"


@query(
    "dq_rule_seats",
    _rule_sql("passenger_capacity", _SEATED, "NumberOfPassengers > TaxiPassengerCapacity"),
    ("trips", "taxis"),
)
def _(t):
    return R.rule_seats(t.trips, t.taxis)


def _ref_sql(check: str, used: str) -> str:
    return (
        f"SELECT '{check}' AS rule, '{R.RULE_TEXT[check]}' AS description, count(*) AS invalid_references, "
        f"CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({used})"
    )


_REFS = {
    "dq_ref_taxi": (
        "taxi_references",
        "SELECT TaxiNumber FROM trips EXCEPT SELECT TaxiNumber FROM taxis",
        ("trips", "taxis"),
    ),
    "dq_ref_passenger": (
        "passenger_references",
        "SELECT PassengerID FROM trips WHERE PassengerID IS NOT NULL EXCEPT SELECT PassengerID FROM passengers",
        ("trips", "passengers"),
    ),
    "dq_ref_driver": (
        "driver_taxi_assignments",
        "SELECT TaxiIDDriving FROM drivers WHERE TaxiIDDriving IS NOT NULL EXCEPT SELECT TaxiID FROM taxis",
        ("drivers", "taxis"),
    ),
}

for _name, (_check, _used, _views) in _REFS.items():

    @query(_name, _ref_sql(_check, _used), _views)
    def _(t, check=_check):
        return R.ref_check(_datasets(t) | {"passengers": t.passengers}, check)


@query(
    "dq_ref_sample",
    "SELECT TaxiNumber FROM (SELECT TaxiNumber FROM trips EXCEPT SELECT TaxiNumber FROM taxis) ORDER BY 1 LIMIT 10",
    ("trips", "taxis"),
)
def _(t):
    return R.ref_sample({"trips": t.trips, "taxis": t.taxis}, "taxi_references")


def _outlier_sql(table: str, *columns: str) -> str:
    parts = []
    for name in columns:
        parts.append(
            f"SELECT '{name}' AS \"column\", q1, median, q3, q3 - q1 AS iqr, count(*) FILTER (beyond) AS outliers, "
            "count(*) FILTER (beyond) / count(*) * 100 AS outlier_percentage, "
            "CASE WHEN count(*) FILTER (beyond) / count(*) * 100 < 5 THEN 'PASS' ELSE 'WARNING' END AS status, "
            "count(*) FILTER (beyond) / count(*) * 100 > 10 AS warning FROM (SELECT v, q1, median, q3, "
            "v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) AS beyond FROM (SELECT v, "
            + ", ".join(
                f"min(v) FILTER (place >= ceil({share} * n)) OVER () AS {label}"
                for share, label in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
            )
            + f" FROM (SELECT CAST({name} AS DOUBLE) AS v, row_number() OVER (ORDER BY {name}) AS place, "
            f"count(*) OVER () AS n FROM {table} WHERE {name} IS NOT NULL))) GROUP BY q1, median, q3"
        )
    return " UNION ALL ".join(parts)


_MEASURED = ("DistanceTravelled", "TripDurationInSeconds", "TripFare", "NumberOfPassengers")


@query(
    "dq_outlier_status",
    f"SELECT \"column\", status, warning FROM ({_outlier_sql('trips', *_MEASURED)})",
    ("trips",),
)
def _(t):
    return K.outliers(t.trips, columns=_MEASURED).select("column", "status", "warning")


def _profile_sql(table: str, columns) -> str:
    parts = []
    for name, kind in columns.items():
        numeric = kind in ("int", "bigint", "double")
        facts = {
            "count": f"count({name})",
            "mean": f"round(avg({name}), 4)",
            "stddev": f"round(stddev_samp({name}), 4)",
            "min": f"CAST(min({name}) AS DOUBLE)",
            "max": f"CAST(max({name}) AS DOUBLE)",
        }
        distinct = f"(count(DISTINCT {name}) + CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END)"
        parts.append(
            f"SELECT '{name}' AS \"column\", '{kind}' AS data_type, count(*) AS total_rows, "
            f"count(*) - count({name}) AS null_count, (count(*) - count({name})) / count(*) * 100 AS null_percentage, "
            f"{distinct} AS distinct_count, {distinct} / count(*) AS cardinality, "
            + ", ".join(f"{value if numeric else 'NULL'} AS \"{key}\"" for key, value in facts.items())
            + f" FROM {table}"
        )
    return " UNION ALL ".join(parts)


_PROFILED = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query("dq_profile", _profile_sql("lineitem", _PROFILED))
def _(t):
    found = K.profile(t.table("lineitem").select(*_PROFILED), exact=True, samples=0)
    return found.withColumns({name: F.round(name, 4) for name in ("mean", "stddev")})


@query(
    "dq_profile_samples",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", (SELECT array_to_string(list(v ORDER BY v), ',') FROM (SELECT DISTINCT {name} "
        f"AS v FROM documents ORDER BY v LIMIT 10)) AS sample_values"
        for name in ("text", "lang", "source")
    ),
)
def _(t):
    found = K.profile(t.table("documents"), exact=True)
    return found.where("sample_values IS NOT NULL").select("column", "sample_values")


# --- the suite -------------------------------------------------------------------------------

_COLUMNS = {
    "taxis": ("TaxiID", "TaxiNumber", "TaxiType", "TaxiPassengerCapacity"),
    "drivers": ("DriverID", "DriverName", "TaxiIDDriving", "Rating"),
    "passengers": ("PassengerID", "PassengerName", "tier", "Age", "Gender", "AmountSpent", "Address"),
    "trips": (
        "Sno",
        "TaxiNumber",
        "DistanceTravelled",
        "TripDurationInSeconds",
        "TripFare",
        "NumberOfPassengers",
        "PassengerID",
    ),
}
_VIEW_OF = {"taxis": "taxis", "drivers": "drivers", "passengers": "all_passengers", "trips": "trips"}
_VIEWS = ("taxis", "drivers", "all_passengers", "trips")
_NUMERIC = {
    "taxis": ("TaxiID", "TaxiPassengerCapacity"),
    "drivers": ("DriverID", "TaxiIDDriving", "Rating"),
    "passengers": ("PassengerID", "Age", "AmountSpent"),
    "trips": (
        "Sno",
        "DistanceTravelled",
        "TripDurationInSeconds",
        "TripFare",
        "NumberOfPassengers",
        "PassengerID",
    ),
}


@query("dq_outlier", _outlier_sql("trips", *_NUMERIC["trips"]), ("trips",))
def _(t):
    return K.outliers(_datasets(t)["trips"], exact=True)


#: The numbers of each check that are exact; quartiles, outliers and distinct estimates are sketches.
_EXACT = {
    "profiling": ("total_rows", "total_columns", "null_count", "null_percentage", "mean", "stddev", "min", "max"),
    "completeness": ("null_count", "completeness_rate"),
    "uniqueness": ("distinct_count", "total_count", "uniqueness_rate", "duplicates"),
    "ranges": ("min_expected", "max_expected", "out_of_range_count", "validity_rate"),
    "business_rules": ("violations",),
    "consistency": ("invalid_references",),
}


def _numbers_sql(names) -> str:
    """Named numbers to 4 digits, as text."""
    parts = (f"'{name}=' || coalesce(CAST(CAST({name} AS DECIMAL(30,4)) AS VARCHAR), '')" for name in names)
    return " || ' ' || ".join(parts) or "''"


def _suite_sql() -> str:
    """dataset, check, item, status, critical, warning, numbers of every check."""
    parts = []

    def add(dataset, check, item, rows, critical="false", warning="false"):
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{check}' AS \"check\", {item} AS item, status, {critical} AS critical, "
            f"{warning} AS warning, {_numbers_sql(_EXACT.get(check, ()))} AS numbers FROM ({rows})"
        )

    for name, columns in _COLUMNS.items():
        view, rules = _VIEW_OF[name], P.RULES[name]
        parts.append(
            f"SELECT '{name}' AS dataset, 'profiling' AS \"check\", 'table' AS item, 'INFO' AS status, false AS critical, "
            f"false AS warning, {_numbers_sql(_EXACT['profiling'][:2])} AS numbers "
            f"FROM (SELECT count(*) AS total_rows, {len(columns)} AS total_columns FROM {view})"
        )
        for column in columns:
            facts = f"count(*) - count({column}) AS null_count, (count(*) - count({column})) / count(*) * 100 AS null_percentage"
            names = _EXACT["profiling"][2:4]
            if column in _NUMERIC[name]:
                facts += f", avg({column}) AS mean, stddev_samp({column}) AS stddev, min({column}) AS min, max({column}) AS max"
                names = _EXACT["profiling"][2:]
            parts.append(
                f"SELECT '{name}', 'profiling', '{column}', 'INFO', false, false, {_numbers_sql(names)} FROM (SELECT {facts} FROM {view})"
            )
        add(name, "completeness", '"column"', _complete_sql(view, columns, rules.required), "critical")
        if rules.unique:
            add(name, "uniqueness", '"column"', _unique_sql(view, *rules.unique), "critical")
        add(name, "ranges", '"column"', _range_sql(view, rules.ranges), "critical", "warning")
        add(name, "distribution", '"column"', _outlier_sql(view, *_NUMERIC[name]), "false", "warning")
    for dataset, rows in (
        ("drivers", _rule_sql("driver_ratings", "drivers", "NOT Rating BETWEEN 1 AND 5")),
        ("taxis", _rule_sql("taxi_capacity", _SEATS.replace("all_taxis", "taxis"), "TaxiPassengerCapacity NOT BETWEEN lo AND hi")),
        ("trips", _rule_sql("fare_reasonableness", "trips", "TripFare / DistanceTravelled NOT BETWEEN 1 AND 15")),
        (
            "trips",
            _rule_sql(
                "duration_reasonableness", "trips", "TripDurationInSeconds / 60 / DistanceTravelled NOT BETWEEN 1 AND 10"
            ),
        ),
        ("trips", _rule_sql("passenger_capacity", _SEATED, "NumberOfPassengers > TaxiPassengerCapacity")),
    ):
        add(dataset, "business_rules", "rule", rows)
    for check, used, _ in _REFS.values():
        dataset = "drivers" if check == "driver_taxi_assignments" else "trips"
        add(dataset, "consistency", "rule", _ref_sql(check, used.replace("FROM passengers", "FROM all_passengers")))
    return " UNION ALL ".join(parts).replace("'tier'", "'MemSilvererStGoldtus'")


def _suite(t: Tables):
    return P.run_suite(_datasets(t))


@query("dq_suite", _suite_sql(), _VIEWS)
def _(t):
    """Exact numbers as text, in the order of the check; of the sketches, what must hold."""
    whole = _suite(t)
    number = F.create_map(*(part for check, names in _EXACT.items() for part in (F.lit(check), F.array(*map(F.lit, names)))))
    named = F.filter(F.try_element_at(number, F.col("check")), lambda name: F.map_contains_key("metrics", name))
    shown = F.transform(
        named,
        lambda name: F.concat(
            name, F.lit("="), F.coalesce(F.try_element_at("metrics", name).cast("decimal(30,4)").cast("string"), F.lit(""))
        ),
    )
    return whole.withColumn("numbers", F.coalesce(F.array_join(shown, " "), F.lit(""))).drop("metrics")


_COUNTED = "\"check\" IN ('completeness', 'uniqueness', 'ranges', 'business_rules', 'consistency')"
_SUMMARY = f"""(SELECT *, CASE WHEN pass_rate < 80 THEN 'POOR' WHEN pass_rate < 90 THEN 'ACCEPTABLE'
  WHEN pass_rate < 95 THEN 'GOOD' ELSE 'EXCELLENT' END AS overall FROM (SELECT *,
  passed_checks / total_checks * 100 AS pass_rate FROM (SELECT count(*) FILTER ({_COUNTED}) AS total_checks,
  count(*) FILTER ({_COUNTED} AND status = 'PASS') AS passed_checks,
  count(*) FILTER ({_COUNTED} AND status <> 'PASS') AS failed_checks, count(*) FILTER (critical) AS critical_issues,
  count(*) FILTER (warning) AS warnings FROM ({_suite_sql()}))))"""


@query("dq_summary", f"SELECT * FROM {_SUMMARY}", _VIEWS)
def _(t):
    return P.summary(_suite(t))


@query(
    "dq_recommend",
    f"""SELECT * FROM (SELECT 1 AS place, 'Address ' || critical_issues || ' critical issues immediately' AS advice
  FROM {_SUMMARY} WHERE critical_issues > 0 UNION ALL
  SELECT 2, 'Investigate and fix ' || failed_checks || ' failed quality checks' FROM {_SUMMARY} WHERE failed_checks > 0
  UNION ALL SELECT 3, 'Review ' || warnings || ' warning conditions' FROM {_SUMMARY} WHERE warnings > 0
  UNION ALL SELECT 4, 'Implement data validation rules to prevent future quality issues' FROM {_SUMMARY}
  WHERE pass_rate < 100)""",
    _VIEWS,
)
def _(t):
    return P.recommend(P.summary(_suite(t)))


@query(
    "dq_metrics",
    f"SELECT 'data_quality_score' AS metric, pass_rate AS value FROM {_SUMMARY} "
    f"UNION ALL SELECT 'critical_issues', critical_issues FROM {_SUMMARY} "
    f"UNION ALL SELECT 'warnings', warnings FROM {_SUMMARY} UNION ALL SELECT 'total_checks', total_checks FROM {_SUMMARY} "
    + " ".join(
        f"UNION ALL SELECT '{name}_row_count', count(*) FROM {_VIEW_OF[name]} "
        f"UNION ALL SELECT '{name}_column_count', {len(columns)}"
        for name, columns in _COLUMNS.items()
    )
    + " UNION ALL SELECT 'timestamp', 1",
    _VIEWS,
)
def _(t):
    """The time is shown as the truth that it is now."""
    found = P.monitoring(_suite(t))
    now = (F.abs(F.col("value") - F.unix_millis(F.current_timestamp()) / 1000) < 86400).cast("double")
    return found.withColumn("value", F.when(F.col("metric") == "timestamp", now).otherwise(F.col("value")))
