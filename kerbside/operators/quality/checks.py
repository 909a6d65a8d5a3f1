"""Completeness, uniqueness, ranges, outliers and profiles of one table."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.aggregates import numeric_columns
from kerbside.operators.quality.folding import ROWS, Fold, fact, quoted, row, run_fold, status, text
from kerbside.session import stored

# Thresholds of the checks.
COMPLETE_FROM = 0.95
UNIQUE_FROM = 0.99
CRITICAL_RANGE_SHARE = 0.1
OUTLIER_PASS_BELOW = 5
OUTLIER_WARN_ABOVE = 10
IQR_REACH = 1.5

TOTAL = quoted(ROWS)


def row_count() -> dict[str, str]:
    return {ROWS: "count(1)"}


# --- completeness ----------------------------------------------------------------------------

def completeness_facts(columns: Sequence[str]) -> dict[str, str]:
    return row_count() | {f"{name}::present": f"count({quoted(name)})" for name in columns}


def completeness_values(name: str, required: Sequence[str] = (), threshold: float = COMPLETE_FROM) -> dict[str, str]:
    present = fact(name, "present")
    rate = f"try_divide({present}, {TOTAL})"
    return {
        "null_count": f"{TOTAL} - {present}",
        "completeness_rate": rate,
        "status": status(f"{rate} >= {threshold!r}D", TOTAL),
        "critical": f"{TOTAL} > {present}" if name in required else "false",
    }


def completeness(df: DataFrame, required: Sequence[str] = (), threshold: float = COMPLETE_FROM) -> DataFrame:
    """Nulls per column; a null in a required column is critical whatever the rate."""
    rows = [row(column=text(name), **completeness_values(name, required, threshold)) for name in df.columns]
    return run_fold(df, Fold(completeness_facts(df.columns), rows))


# --- uniqueness ------------------------------------------------------------------------------

WHOLE = ("tinyint", "smallint", "int", "bigint")
REAL = ("float", "double")
NESTED = ("struct", "array", "map")


def _slot(name: str, kind: str) -> tuple[str, str]:
    """The type a column's values are compared in, and the value in that type."""
    value = quoted(name)
    if kind in WHOLE:
        return "bigint", f"cast({value} as bigint)"
    if kind in REAL:
        return "double", f"cast({value} as double)"
    if kind.startswith(NESTED):
        return "string", f"to_json(named_struct('value', {value}))"
    return kind, value


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs, null being a value too.

    Each row becomes one narrow row per column: the column's name, and one field per type in use, of
    which the column's own holds the value (``as_string``, ``as_bigint``, ...). Numbers stay numbers.
    Equal rows are combined inside each task before the shuffle, so a value that fills a third of the
    table travels once per task, and the work is linear in the number of columns.
    """
    kinds = dict(df.dtypes)
    slots = {name: _slot(name, kinds[name]) for name in columns}
    types = sorted({kind for kind, _ in slots.values()} | {"string"})

    def narrow(name: str) -> str:
        own, value = slots[name]
        fields = {field(kind): value if kind == own else f"cast(null as {kind})" for kind in types}
        return row(column=text(name), **fields)

    def field(kind: str) -> str:
        return "as_" + re.sub(r"\W+", "_", kind)

    rows = df.selectExpr(f"inline(array({', '.join(narrow(name) for name in columns)}))")
    return rows.groupBy("column", *[field(kind) for kind in types]).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of different values per column, null included."""
    return value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_count"))


def uniqueness(df: DataFrame, columns: Sequence[str], threshold: float = UNIQUE_FROM) -> DataFrame:
    """Distinct share per declared column; below the threshold it is critical. One pass: values count the rows as well."""
    present = [name for name in columns if name in df.columns]
    counts = value_counts(df, present).groupBy("column")
    counts = counts.agg(F.count(F.lit(1)).alias("distinct_count"), F.sum("n").alias("total_count"))
    listed = df.sparkSession.createDataFrame([(name,) for name in present], "column string")
    counted = listed.join(counts, "column", "left").fillna(0, ["distinct_count", "total_count"])
    return counted.selectExpr(
        "*",
        "try_divide(distinct_count, total_count) AS uniqueness_rate",
        "total_count - distinct_count AS duplicates",
    ).selectExpr(
        "*",
        f"{status(f'uniqueness_rate >= {threshold!r}D', 'total_count')} AS status",
        f"coalesce(uniqueness_rate < {threshold!r}D, false) AS critical",
    )


# --- ranges ----------------------------------------------------------------------------------

def _outside(name: str, limits: tuple[float, float]) -> str:
    low, high = (f"{limit!r}D" if isinstance(limit, float) else str(limit) for limit in limits)
    return f"({quoted(name)} < {low} OR {quoted(name)} > {high})"


def range_facts(checks: Mapping[str, tuple[float, float]]) -> dict[str, str]:
    outside = {f"{name}::outside": f"count_if({_outside(name, limits)})" for name, limits in checks.items()}
    return outside | {f"{name}::present": f"count({quoted(name)})" for name in checks}


def range_values(name: str, limits: tuple[float, float]) -> dict[str, str]:
    outside, present = fact(name, "outside"), fact(name, "present")
    allowed = f"{present} * {CRITICAL_RANGE_SHARE!r}D"
    return {
        "min_expected": f"{float(limits[0])!r}D",
        "max_expected": f"{float(limits[1])!r}D",
        "out_of_range_count": outside,
        "validity_rate": f"try_divide({present} - {outside}, {present})",
        "status": f"CASE WHEN {outside} = 0 THEN 'PASS' ELSE 'FAIL' END",
        "critical": f"{outside} > {allowed}",
        "warning": f"{outside} > 0 AND {outside} <= {allowed}",
    }


def ranges(df: DataFrame, checks: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside closed limits per column. Nulls are not counted; a column of nulls gives no row."""
    known = {name: limits for name, limits in checks.items() if name in df.columns}
    rows = [
        row(column=text(name), present=fact(name, "present"), **range_values(name, limits))
        for name, limits in known.items()
    ]
    return run_fold(df, Fold(range_facts(known), rows), "present > 0").drop("present")


def range_examples(df: DataFrame, checks: Mapping[str, tuple[float, float]], n: int = 5) -> DataFrame:
    """The n smallest different values outside the limits of each column."""
    pairs = [
        f"CASE WHEN {_outside(name, limits)} "
        f"THEN {row(column=text(name), value=f'cast({quoted(name)} as double)')} END"
        for name, limits in checks.items()
        if name in df.columns
    ]
    found = df.selectExpr(f"inline(array_compact(array({', '.join(pairs)})))").distinct()
    return _smallest(found, n).groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("examples"))


def _smallest(values: DataFrame, n: int) -> DataFrame:
    """n rows per column; Spark cuts each task's rows to n per column before the shuffle."""
    place = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    return values.withColumn("place__", place).filter(F.col("place__") <= n).drop("place__")


# --- outliers --------------------------------------------------------------------------------

def quartile_sketches(names: Sequence[str], rel_err: float) -> list[str]:
    """One sketch per column, with rank error ``rel_err``: an array of q1, median and q3."""
    accuracy = max(1, round(1 / rel_err))
    return [f"percentile_approx(cast({quoted(name)} as double), array(0.25, 0.5, 0.75), {accuracy})" for name in names]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75), buckets: int = 4096
) -> dict[str, list[float] | None]:
    """For each column the smallest value with at least that share of the values at or below it; nulls and NaN aside.

    Selection by narrowing: every pass counts the values between two bounds in ``buckets`` equal parts, for all columns
    and shares at once, and goes on with the smallest and largest value of the part that holds the wanted one,
    until these are equal. Tasks send counts of parts only, whatever the number of rows, and no value list or sort is
    needed; evenly spread values take two or three passes. A column without values gives None.
    """
    values = df.select(*(F.nullif(F.col(quoted(name)).cast("double"), F.lit(float("nan"))).alias(f"c{at}") for at, name in enumerate(columns)))
    facts = [f(f"c{at}").alias(f"{kind}{at}") for at in range(len(columns)) for kind, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    first = values.agg(*facts).first()
    # (column, share) -> number below the bounds, wanted rank, bounds
    open_ = {
        (at, place): (0, max(1, math.ceil(share * first[f"n{at}"])), first[f"lo{at}"], first[f"hi{at}"])
        for at in range(len(columns))
        for place, share in enumerate(shares)
        if first[f"n{at}"]
    }
    found = {}
    while True:
        found |= {key: lo for key, (_, _, lo, hi) in open_.items() if lo == hi}
        open_ = {key: of for key, of in open_.items() if key not in found}
        if not open_:
            break
        keys = sorted(open_)
        parts = F.array(*(_part(F.col(f"c{key[0]}"), at, open_[key], buckets) for at, key in enumerate(keys)))
        counted = values.select(F.inline(F.array_compact(parts))).groupBy("target", "part").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        upto = F.sum("n").over(Window.partitionBy("target").orderBy("part"))
        wanted = F.element_at(F.array(*(F.lit(open_[key][1] - open_[key][0]) for key in keys)), F.col("target") + 1)
        holding = counted.withColumn("upto", upto).where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted))
        for row in holding.collect():
            below, rank, _, _ = open_[keys[row.target]]
            open_[keys[row.target]] = (below + row.upto - row.n, rank, row.lo, row.hi)
    return {
        name: [found[at, place] for place in range(len(shares))] if first[f"n{at}"] else None for at, name in enumerate(columns)
    }


def _part(value: Column, target: int, of: tuple[int, int, float, float], buckets: int) -> Column:
    """(target, part, value) of a value between the bounds; halves keep the width of the whole range of doubles finite."""
    low, high = (max(-sys.float_info.max, min(sys.float_info.max, bound)) for bound in of[2:])
    share = (value / 2 - low / 2) / (high / 2 - low / 2) * buckets
    part = F.greatest(F.lit(0), F.least(F.lit(buckets - 1), F.floor(share).cast("int")))
    # The bounds have parts of their own: they may be infinite, and a part of few values next to one would not shrink.
    part = F.when(value == of[2], -1).when(value == of[3], buckets).otherwise(part)
    inside = value.between(F.lit(of[2]), F.lit(of[3]))
    return F.when(inside, F.struct(F.lit(target).alias("target"), part.alias("part"), value.alias("value")))


def outliers(
    df: DataFrame,
    rel_err: float = 0.01,
    columns: Sequence[str] | None = None,
    quartiles: Column | None = None,
    exact: bool = False,
) -> DataFrame:
    """Quartiles and values beyond 1.5 times their distance, per numeric column.

    Two passes whatever the number of columns: one sketch pass for the quartiles (rank error
    ``rel_err``), one pass that counts against them. The quartiles reach the second pass as a scalar
    subquery, not through the driver or a join; ``quartiles`` (a struct of arrays c0, c1, ...) saves
    the first pass. ``exact`` selects them exactly instead (``exact_quantiles``), at once, from a copy of the columns
    below the shared folder. A column of nulls gives no row.
    """
    names = list(columns) if columns else numeric_columns(df)
    if exact:
        # Kept in a table: every pass would make the rows anew, with the joins behind them.
        numbers = df.select(*(F.col(quoted(name)).alias(f"c{at}") for at, name in enumerate(names)))
        df = stored(numbers, "numbers").toDF(*names)
        known = exact_quantiles(df, names)
        given = (F.lit(known[name]).cast("array<double>").alias(f"c{at}") for at, name in enumerate(names))
        quartiles = F.struct(*given)
    if quartiles is None:
        listed = ", ".join(f"{sketch} AS c{place}" for place, sketch in enumerate(quartile_sketches(names, rel_err)))
        quartiles = df.selectExpr(f"struct({listed}) AS quartiles").scalar()
    facts = outlier_facts(names) | {f"{name}::present": f"count({quoted(name)})" for name in names}
    rows = [
        row(column=text(name), **outlier_values(name, place), present=fact(name, "present")) for place, name in enumerate(names)
    ]
    return run_fold(df, Fold(facts, rows), "present > 0", quartiles).drop("present")


def _quartiles(place: int) -> tuple[str, str, str]:
    return f"given.c{place}[0]", f"given.c{place}[1]", f"given.c{place}[2]"


def outlier_facts(names: Sequence[str]) -> dict[str, str]:
    """Values beyond the reach of the quartiles, which are ``given`` as c0, c1, ... in the order of the names."""
    facts = {}
    for place, name in enumerate(names):
        q1, _, q3 = _quartiles(place)
        reach, value = f"({q3} - {q1}) * {IQR_REACH!r}D", quoted(name)
        facts[f"{name}::beyond"] = f"count_if({value} < {q1} - {reach} OR {value} > {q3} + {reach})"
    return facts


def outlier_values(name: str, place: int) -> dict[str, str]:
    q1, median, q3 = _quartiles(place)
    beyond = fact(name, "beyond")
    share = f"try_divide({beyond}, {fact(name, 'present')}) * 100"
    return {
        "q1": q1,
        "median": median,
        "q3": q3,
        "iqr": f"{q3} - {q1}",
        "outliers": beyond,
        "outlier_percentage": share,
        "status": f"CASE WHEN {share} < {OUTLIER_PASS_BELOW} THEN 'PASS' ELSE 'WARNING' END",
        "warning": f"{share} > {OUTLIER_WARN_ABOVE}",
    }


# --- profile ---------------------------------------------------------------------------------

NUMBER_FACTS = {"mean": "avg", "stddev": "stddev", "min": "min", "max": "max"}


def distinct_sketches(names: Sequence[str], rsd: float = 0.05) -> list[str]:
    """One sketch per column; null is left out."""
    return [f"approx_count_distinct({quoted(name)}, {rsd!r}D)" for name in names]


def profile_facts(df: DataFrame) -> dict[str, str]:
    """Nulls and number facts of every column."""
    facts, numeric = completeness_facts(df.columns), set(numeric_columns(df))
    for name in df.columns:
        for key, function in NUMBER_FACTS.items() if name in numeric else ():
            facts[f"{name}::{key}"] = f"cast({function}({quoted(name)}) as double)"
    return facts


def profile_values(name: str, numeric: bool, distinct: str) -> dict[str, str]:
    """The numbers of a profile that come from ``profile_facts``, and the SQL of a sketch's estimate."""
    nulls = f"{TOTAL} - {fact(name, 'present')}"
    values = {"null_count": nulls, "null_percentage": f"try_divide({nulls}, {TOTAL}) * 100"}
    values["distinct_estimate"] = f"{distinct} + CASE WHEN {nulls} > 0 THEN 1 ELSE 0 END"
    return values | ({key: fact(name, key) for key in NUMBER_FACTS} if numeric else {})


def profile(df: DataFrame, exact: bool = False, samples: int = 10, rsd: float = 0.05) -> DataFrame:
    """One row per column: type, nulls, different values, number facts and sample values.

    Different values are estimated by a sketch that is folded into the one pass, so nothing but one
    row per task is shuffled, and no samples are taken. ``exact`` counts them, which shuffles each
    different value of every column once, long texts included, and takes the smallest values of text
    columns as samples.
    """
    kinds = dict(df.dtypes)
    numeric = set(numeric_columns(df))
    facts, rows = completeness_facts(df.columns), []
    for name in df.columns:
        present = fact(name, "present")
        nulls = f"{TOTAL} - {present}"
        values = {
            "column": text(name),
            "data_type": text(kinds[name]),
            "total_rows": TOTAL,
            "null_count": nulls,
            "null_percentage": f"try_divide({nulls}, {TOTAL}) * 100",
            "count": present if name in numeric else "cast(null as long)",
        }
        for key, function in NUMBER_FACTS.items():
            if name in numeric:
                facts[f"{name}::{key}"] = f"cast({function}({quoted(name)}) as double)"
            values[key] = fact(name, key) if name in numeric else "cast(null as double)"
        if not exact:
            # A sketch leaves null out; as a value of the column it counts once.
            facts[f"{name}::distinct"] = f"approx_count_distinct({quoted(name)}, {rsd!r}D)"
            values["distinct_count"] = f"{fact(name, 'distinct')} + CASE WHEN {nulls} > 0 THEN 1 ELSE 0 END"
        rows.append(row(**values))
    found = run_fold(df, Fold(facts, rows))
    if exact:
        counts = value_counts(df, df.columns)
        distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_count"))
        found = found.join(distinct, "column", "left").fillna(0, "distinct_count")
        listed = [name for name, kind in kinds.items() if kind == "string"]
        if samples and listed:
            seen = counts.filter(F.col("column").isin(listed) & F.col("as_string").isNotNull())
            smallest = _smallest(seen.select("column", F.col("as_string").alias("value")), samples)
            found = found.join(
                smallest.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("sample_values")),
                "column",
                "left",
            )
    return found.withColumn("cardinality", F.expr("coalesce(try_divide(distinct_count, total_rows), 0.0D)"))
