"""Column expressions that compare amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crossfoot.config import StatsConfig, Tolerance
from crossfoot.schemas import DIFFERENT, INFO, NO_CHANGE, NOT_APPLICABLE, PASS, WARNING


def zero_if_null(value: Column) -> Column:
    """Treat a blank as 0 inside a calculation; the stored value keeps its NULL."""
    return F.coalesce(value, F.lit(0))


def absolute_difference(expected: Column, observed: Column) -> Column:
    return F.abs(observed - expected)


def relative_difference(expected: Column, observed: Column, tolerance: Tolerance) -> Column:
    """Difference as a share of the expected amount; NULL when that amount is 0, unless configured as a pass."""
    relative = F.try_divide(absolute_difference(expected, observed), F.abs(expected))
    if tolerance.zero_expected == "pass":
        return F.when(expected == 0, F.lit(0.0)).otherwise(relative)
    return relative


def agrees(expected: Column, observed: Column, tolerance: Tolerance) -> Column:
    """Within the absolute or the relative bound; an absent amount never agrees."""
    by_amount = absolute_difference(expected, observed) <= tolerance.absolute
    by_share = relative_difference(expected, observed, tolerance) <= tolerance.relative
    return F.coalesce(by_amount, F.lit(False)) | F.coalesce(by_share, F.lit(False))


def advisory_status(ok: Column) -> Column:
    return F.when(ok, PASS).otherwise(WARNING)


def advisory_severity(ok: Column) -> Column:
    return F.when(ok, INFO).otherwise(WARNING)


# Codes of the note on a change.
NOTE_NULL, NOTE_ZERO, NOTE_CALCULATED = "NULL_VALUE_PRESENT", "NOT_APPLICABLE: ZERO_DENOMINATOR", "CALCULATED"


def present(amount: Column) -> Column:
    """The amount, with NaN as NULL."""
    return F.nullif(amount.cast("double"), F.lit(float("nan")))


def change(reference: Column, comparison: Column) -> Column:
    return present(comparison) - present(reference)


def change_pct(reference: Column, comparison: Column) -> Column:
    """Change in percent of the reference; NULL when either is absent or NaN, or the reference is 0."""
    return F.try_divide(change(reference, comparison), present(reference)) * 100.0


def change_note(reference: Column, comparison: Column) -> Column:
    return (
        F.when(present(reference).isNull() | present(comparison).isNull(), NOTE_NULL)
        .when(reference == 0, NOTE_ZERO)
        .otherwise(NOTE_CALCULATED)
    )


def change_status(pct: Column, config: StatsConfig) -> Column:
    return (
        F.when(pct.isNull(), NOT_APPLICABLE)
        .when(F.abs(pct) <= config.change_threshold_pct, NO_CHANGE)
        .otherwise(DIFFERENT)
    )
