"""Orderings and groupings of status values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order of severities, most severe first, and display class of every status.
SEVERITY_RANK = {"CRITICAL": 0, "ERROR": 1, "WARNING": 2, "INFO": 3}
STATUS_CLASS = {
    "PASS": "good",
    "COMPLETED": "good",
    "NO_MATERIAL_STATISTICAL_CHANGE": "good",
    "RESOLVED": "good",
    "FAIL": "bad",
    "FAILED": "bad",
    "CRITICAL": "bad",
    "OPEN": "bad",
    "UNRESOLVED": "warn",
    "WARNING": "warn",
    "STATISTICALLY_DIFFERENT": "warn",
    "ERROR": "warn",
    "STARTED": "info",
    "ACKNOWLEDGED": "info",
    "INFO": "info",
}


def _lookup(table: dict, key: Column, default) -> Column:
    pairs = [F.lit(item) for entry in table.items() for item in entry]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(key)), F.lit(default))


def severity_rank(severity: Column) -> Column:
    """0 for the most severe; unknown severities come last."""
    return _lookup(SEVERITY_RANK, severity, 99)


def status_class(status: Column) -> Column:
    """good, bad, warn or info; neutral for everything else."""
    return _lookup(STATUS_CLASS, status, "neutral")


def is_blocking(status: Column, severity: Column) -> Column:
    """A failure that must stop promotion: FAIL of severity CRITICAL or ERROR."""
    return F.coalesce((F.upper(status) == "FAIL") & F.upper(severity).isin("CRITICAL", "ERROR"), F.lit(False))


def health(failures: Column, warnings: Column) -> Column:
    return F.when(failures > 0, "FAIL").when(warnings > 0, "WARNING").otherwise("HEALTHY")
