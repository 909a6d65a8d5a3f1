"""The whole suite over a set of tables, its summary, advice and monitoring figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import case, ratio
from kerbside.operators.aggregates import numeric_columns
from kerbside.operators.quality import checks as K
from kerbside.operators.quality import rules as R
from kerbside.operators.quality.folding import Fold, fact, item, metrics, run_fold

COUNTED = ("completeness", "uniqueness", "ranges", "business_rules", "consistency")


@dataclass(frozen=True)
class TableRules:
    required: Sequence[str] = ()
    unique: Sequence[str] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)


# The rule set of each dataset.
RULES = {
    "taxis": TableRules(
        ("TaxiID", "TaxiNumber", "TaxiType"), ("TaxiID", "TaxiNumber"), {"TaxiPassengerCapacity": (1, 10)}
    ),
    "drivers": TableRules(("DriverID", "DriverName"), ("DriverID",), {"Rating": (1.0, 5.0)}),
    "passengers": TableRules(
        ("PassengerID", "PassengerName"), ("PassengerID",), {"Age": (0, 120), "AmountSpent": (0, 50000)}
    ),
    "trips": TableRules(
        ("TaxiNumber", "PassengerID"),
        (),
        {
            "DistanceTravelled": (0.1, 100),
            "TripFare": (3.5, 500),
            "TripDurationInSeconds": (60, 14400),
            "NumberOfPassengers": (1, 10),
        },
    ),
}
ROW_RULES = {"drivers": R.driver_rules, "taxis": R.taxi_rules, "trips": R.trip_rules}


def _fold(name: str, df: DataFrame, rules: TableRules) -> Fold:
    """Profile, completeness, ranges, outliers, row rules and the row count of one table; reads its ``_sketches``."""
    row_rules = ROW_RULES[name]() if name in ROW_RULES else {}
    limits = {column: pair for column, pair in rules.ranges.items() if column in df.columns}
    numeric = numeric_columns(df)
    facts = K.profile_facts(df) | K.range_facts(limits) | K.outlier_facts(numeric) | R.rule_facts(row_rules)
    size = {"total_rows": K.TOTAL, "total_columns": str(len(df.columns))}
    rows = [item("profiling", "table", "'INFO'", size)]
    for place, column in enumerate(df.columns):
        rows.append(item("profiling", column, "'INFO'", K.profile_values(column, column in numeric, f"given.d{place}")))
        of = K.completeness_values(column, rules.required)
        numbers = {key: of[key] for key in ("null_count", "completeness_rate")}
        rows.append(item("completeness", column, of["status"], numbers, of["critical"]))
    for column, pair in limits.items():
        of = K.range_values(column, pair)
        numbers = {key: of[key] for key in ("min_expected", "max_expected", "out_of_range_count", "validity_rate")}
        # A column of nulls has no range to check; its row goes with the null status.
        state = f"CASE WHEN {fact(column, 'present')} > 0 THEN {of['status']} END"
        rows.append(item("ranges", column, state, numbers, of["critical"], of["warning"]))
    for place, column in enumerate(numeric):
        of = K.outlier_values(column, place)
        numbers = {key: of[key] for key in ("q1", "median", "q3", "iqr", "outliers", "outlier_percentage")}
        state = f"CASE WHEN {fact(column, 'present')} > 0 THEN {of['status']} END"
        rows.append(item("distribution", column, state, numbers, warning=of["warning"]))
    for rule in row_rules:
        broken = fact(rule, "broken")
        state = f"CASE WHEN {broken} = 0 THEN 'PASS' ELSE 'FAIL' END"
        rows.append(item("business_rules", rule, state, {"violations": broken}))
    return Fold(facts, rows)


def _sketches(df: DataFrame, rel_err: float) -> Column:
    """Quartiles of numeric columns (c0, c1, ...) and distinct counts of all (d0, d1, ...), from one pass.

    A subquery: plain facts stay in a fold of generated code, and readers of the same table share one pass.
    """
    quartiles = K.quartile_sketches(numeric_columns(df), rel_err)
    named = [f"{sql} AS c{at}" for at, sql in enumerate(quartiles)]
    named += [f"{sql} AS d{at}" for at, sql in enumerate(K.distinct_sketches(df.columns))]
    return df.selectExpr(f"struct({', '.join(named)}) AS sketches").scalar()


def _report_rows(df: DataFrame, check: str, name: str, *numbers: str, critical: str = "false"):
    """Rows of a single check in the layout of the report."""
    return df.selectExpr(
        f"'{check}' AS check",
        f"{name} AS item",
        "status",
        f"{critical} AS critical",
        "false AS warning",
        f"{metrics({number: number for number in numbers})} AS metrics",
    )


def run_suite(
    datasets: Mapping[str, DataFrame], rules: Mapping[str, TableRules] | None = None, rel_err: float = 0.01
) -> DataFrame:
    """(dataset, check, item, status, critical, warning, metrics) rows of every check.

    Nothing runs before the report is read. Per dataset, one pass takes sketches (quartiles, distinct counts), one the
    plain facts of profile, completeness, ranges and rules and the outliers against the quartiles, and one the
    values of unique columns. Trips are counted per taxi and group size for the seats and the taxi references;
    passenger references read the trips' ids.
    """
    rules = RULES if rules is None else rules
    parts: list[tuple[str, DataFrame]] = []
    for name, df in datasets.items():
        of = rules.get(name, TableRules())
        parts.append((name, run_fold(df, _fold(name, df, of), "status IS NOT NULL", _sketches(df, rel_err))))
        unique = [column for column in of.unique if column in df.columns]
        if unique:
            of_key = ("distinct_count", "total_count", "uniqueness_rate", "duplicates")
            parts.append((name, _report_rows(K.uniqueness(df, unique), "uniqueness", "column", *of_key, critical="critical")))
    by_taxi = dict(datasets)
    if {"trips", "taxis"} <= set(datasets):
        by_taxi["trips"] = R.taxi_groups(datasets["trips"])
        crowded = R.seats_of_groups(by_taxi["trips"], datasets["taxis"])
        parts.append(("trips", _report_rows(crowded, "business_rules", "rule", "violations")))
    for check, (table, _, master, _, _) in R.REFERENCES.items():
        if {table, master} <= set(datasets):
            found = R.ref_check(by_taxi if check == "taxi_references" else datasets, check)
            parts.append((table, _report_rows(found, "consistency", "rule", "invalid_references")))
    labelled = [part.select(F.lit(name).alias("dataset"), "*") for name, part in parts]
    return reduce(DataFrame.unionByName, labelled)


def with_examples(report: DataFrame, datasets: Mapping[str, DataFrame], values: int = 5, keys: int = 10) -> DataFrame:
    """The report with ``examples``: the smallest values out of range and the smallest keys without a master.

    Reads each dataset with ranges once more.
    """
    parts = []
    for name, df in datasets.items():
        limits = {c: pair for c, pair in RULES.get(name, TableRules()).ranges.items() if c in df.columns}
        if limits:
            found = K.range_examples(df, limits, values).selectExpr(
                f"'{name}' AS dataset", "'ranges' AS check", "column AS item", "cast(examples as array<string>) AS examples"
            )
            parts.append(found)
    for check, (table, key, master, _, _) in R.REFERENCES.items():
        if {table, master} <= set(datasets):
            sample = R.ref_sample(datasets, check, keys).agg(F.sort_array(F.collect_list(F.col(key).cast("string"))).alias("examples"))
            parts.append(sample.selectExpr(f"'{table}' AS dataset", "'consistency' AS check", f"'{check}' AS item", "examples"))
    if not parts:
        return report.withColumn("examples", F.lit(None).cast("array<string>"))
    return report.join(reduce(DataFrame.unionByName, parts), ["dataset", "check", "item"], "left")


def summary(report: DataFrame) -> DataFrame:
    """One row: checks passed and failed, critical issues, warnings, pass rate and verdict."""
    counted = F.col("check").isin(*COUNTED)
    facts = report.agg(
        F.count_if(counted).alias("total_checks"),
        F.count_if(counted & (F.col("status") == "PASS")).alias("passed_checks"),
        F.count_if(counted & (F.col("status") != "PASS")).alias("failed_checks"),
        F.count_if("critical").alias("critical_issues"),
        F.count_if("warning").alias("warnings"),
    )
    rate = F.coalesce(ratio("passed_checks", "total_checks") * 100, F.lit(0.0))
    grades = [(F.col("pass_rate") >= 95, "EXCELLENT"), (F.col("pass_rate") >= 90, "GOOD"), (F.col("pass_rate") >= 80, "ACCEPTABLE")]
    return facts.withColumn("pass_rate", rate).withColumn("overall", case(grades, "POOR"))


def recommend(summary_row: DataFrame) -> DataFrame:
    """Up to four lines of advice in order of urgency."""
    # Fixed output: the wording of the advice.
    lines = (
        ("critical_issues > 0", "concat('Address ', critical_issues, ' critical issues immediately')"),
        ("failed_checks > 0", "concat('Investigate and fix ', failed_checks, ' failed quality checks')"),
        ("warnings > 0", "concat('Review ', warnings, ' warning conditions')"),
        ("pass_rate < 100", "'Implement data validation rules to prevent future quality issues'"),
    )
    listed = ", ".join(
        f"CASE WHEN {when} THEN named_struct('place', {place}, 'advice', {advice}) END"
        for place, (when, advice) in enumerate(lines, 1)
    )
    return summary_row.selectExpr(f"inline(array_compact(array({listed})))")


def monitoring(report: DataFrame) -> DataFrame:
    """(metric, value) rows for monitoring: score, issues, the size of each dataset, and when (seconds since 1970)."""
    figures = {
        "data_quality_score": "pass_rate",
        "critical_issues": "critical_issues",
        "warnings": "warnings",
        "total_checks": "total_checks",
    }
    figures["timestamp"] = "unix_millis(current_timestamp()) / 1000"
    totals = summary(report).selectExpr(f"explode({metrics(figures)}) AS (metric, value)")
    sizes = report.filter("check = 'profiling' AND item = 'table'").selectExpr(
        "explode(map(concat(dataset, '_row_count'), metrics['total_rows'], "
        "concat(dataset, '_column_count'), metrics['total_columns'])) AS (metric, value)"
    )
    return totals.unionByName(sizes)
