"""Building blocks of check result rows.

A check row is written as one SQL struct. Arguments that are :class:`Sql` are expressions over the metrics row; plain
Python values are literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfoot.runtime import literal, quoted
from crossfoot.schemas import CHECK_RESULT, FAIL, INFO, PASS


class Sql(str):
    """SQL text of an expression, as opposed to a string value."""


def as_sql(value) -> str:
    if isinstance(value, Sql):
        return str(value)
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return literal(value) if isinstance(value, str) else repr(value)


def text(*parts) -> Sql:
    """Concatenation of literals and expressions; NULL shows as NULL instead of swallowing the text."""
    return Sql("concat(" + ", ".join(f"coalesce(cast({as_sql(part)} AS string), 'NULL')" for part in parts) + ")")


def check(
    check_id,
    category: str,
    name,
    table,
    ok,
    severity: str,
    expected,
    observed,
    difference,
    affected,
    when_ok,
    when_not,
    *,
    status: str = FAIL,
    tolerance=None,
) -> Sql:
    """One check result. ``status`` and ``severity`` apply when ``ok`` is not true; the message follows the status."""
    passed = f"coalesce({as_sql(ok)}, false)"
    values = {
        "check_id": as_sql(check_id),
        "check_category": as_sql(category),
        "check_name": as_sql(name),
        "table_name": as_sql(table),
        "status": f"if({passed}, '{PASS}', '{status}')",
        "severity": f"if({passed}, '{INFO}', '{severity}')",
        "expected": as_sql(expected),
        "observed": as_sql(observed),
        "difference": as_sql(difference),
        "affected_records": as_sql(affected),
        "tolerance": as_sql(tolerance),
        "message": f"if({passed}, {as_sql(when_ok)}, {as_sql(when_not)})",
    }
    cells = [f"cast({values[f.name]} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in CHECK_RESULT.fields]
    return Sql(f"struct({', '.join(cells)})")


def check_rows(metrics: DataFrame, checks: list[Sql]) -> DataFrame:
    """Result rows of several checks that read the same row of metrics."""
    return metrics.select(F.expr(f"inline(array({', '.join(checks)}))"))


def with_run(results: DataFrame, run_id: str, suite: str) -> DataFrame:
    """Result rows stamped with run, suite and time."""
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(suite).alias("suite"), "*", F.current_timestamp().alias("executed_at")
    )
