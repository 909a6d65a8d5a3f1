"""Many metrics, one pass.

A check contributes aggregates under unique names, and rows that are computed from the single row of
aggregates. All checks of a table are folded into one aggregation, so the number of jobs does not
depend on the number of columns or checks. Both are kept as SQL text: a table of a thousand columns
is then one ``selectExpr`` call and not tens of thousands of column objects.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import sql_literal

ROWS = "table::rows"


def quoted(name: str) -> str:
    """A column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


@dataclass
class Fold:
    facts: dict[str, str] = field(default_factory=dict)
    rows: list[str] = field(default_factory=list)


def run_fold(df: DataFrame, fold: Fold, where: str | None = None, scalar: Column | None = None) -> DataFrame:
    """Result rows of a fold; all rows must have the same fields and types.

    ``scalar`` is a one-value subquery that facts and rows can read as ``given``.
    """
    facts = [F.expr(f"{sql} AS {quoted(name)}") for name, sql in fold.facts.items()]
    one_row = (df.withColumn("given", scalar) if scalar is not None else df).agg(*facts)
    if scalar is not None:
        one_row = one_row.withColumn("given", scalar)
    rows = one_row.selectExpr(f"inline(array({', '.join(fold.rows)}))")
    return rows.filter(where) if where else rows


def row(**fields: str) -> str:
    """A result row from SQL text per field."""
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def fact(name: str, part: str | None = None) -> str:
    return quoted(f"{name}::{part}" if part else name)


def text(value: str) -> str:
    return sql_literal(value)


def status(passed: str, total: str) -> str:
    """PASS or FAIL; EMPTY for a table without rows."""
    return f"CASE WHEN {total} = 0 THEN 'EMPTY' WHEN {passed} THEN 'PASS' ELSE 'FAIL' END"


def metrics(values: Mapping[str, str]) -> str:
    """Named numbers of a report row."""
    return "map(" + ", ".join(f"'{name}', cast({sql} as double)" for name, sql in values.items()) + ")"


def item(
    check: str, name: str, state: str, numbers: Mapping[str, str], critical: str = "false", warning: str = "false"
) -> str:
    """A report row."""
    return row(
        check=text(check), item=text(name), status=state, critical=critical, warning=warning, metrics=metrics(numbers)
    )
