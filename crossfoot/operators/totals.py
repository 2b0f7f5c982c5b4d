"""Computed sums of a table against the totals published with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfoot.config import Tolerance
from crossfoot.functions.amounts import zero_if_null
from crossfoot.operators.reshape import union_all
from crossfoot.operators.results import Sql, as_sql, check, check_rows, text
from crossfoot.schemas import CRITICAL
from crossfoot.sources.crosstab import COLUMN, GRAND, ROW


def computed_totals(cells: DataFrame, axes: list[str]) -> DataFrame:
    """(table_name, axis, entity, value): column, row and grand sums of ``cells(table_name, code, entity, value)``.

    All axes come from one grouped pass, combined before the shuffle. NULL cells count as 0.
    """
    labels = {COLUMN: F.col("entity"), ROW: F.col("code"), GRAND: F.lit(GRAND)}
    keys = F.array(*[F.struct(F.lit(axis).alias("axis"), labels[axis].alias("entity")) for axis in axes])
    spread = cells.select("table_name", "value", F.explode(keys).alias("k"))
    return spread.groupBy("table_name", "k.axis", "k.entity").agg(zero_if_null(F.sum("value")).alias("value"))


def total_differences(computed: DataFrame, reported: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """(table_name, axis, entity, computed, reported, difference, within) for every total of either side.

    An entity without cells has the computed sum 0. A total that was not published is not within tolerance. The two
    sides meet in one grouping, which copes with any skew.
    """
    tagged = union_all(
        [
            computed.select("table_name", "axis", "entity", F.col("value").alias("computed"), F.lit(None).alias("reported")),
            reported.select("table_name", "axis", "entity", F.lit(None).alias("computed"), F.col("value").alias("reported")),
        ]
    )
    met = tagged.groupBy("table_name", "axis", "entity").agg(
        zero_if_null(F.sum("computed")).alias("computed"), F.max("reported").alias("reported")
    )
    difference = F.abs(F.col("computed") - F.col("reported"))
    return met.withColumn("difference", difference).withColumn(
        "within", F.coalesce(difference <= tolerance.absolute, F.lit(False))
    )


def total_checks(
    differences: DataFrame, ids: dict[tuple[str, str], str], tolerance: Tolerance = Tolerance()
) -> DataFrame:
    """One result row per (table, axis); affected records are the totals that fail."""
    metrics = differences.groupBy("table_name", "axis").agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("within")).alias("bad"),
        F.count_if(F.col("reported").isNull()).alias("absent"),
        F.max("difference").cast("double").alias("worst"),
    )
    known = ", ".join(as_sql(x) for (table, axis), name in ids.items() for x in (f"{table}/{axis}", name))
    name = Sql(f"coalesce(try_element_at(map({known}), concat_ws('/', table_name, axis)), 'REC-V')")
    row = total_row(name, Sql("axis"), Sql("bad"), Sql("n"), Sql("absent"), Sql("worst"), tolerance)
    return check_rows(metrics, [row])


def total_row(name, axis, bad: Sql, n: Sql, absent: Sql, worst: Sql, tolerance: Tolerance) -> Sql:
    return check(name, "SOURCE_TOTAL", text("Sums against published totals, axis ", axis), Sql("table_name"),
                 Sql(f"{bad} = 0"), CRITICAL, "sums match published totals", text(bad, " of ", n, " totals differ"),
                 worst, bad, text("All ", n, " totals match."),
                 text(bad, " totals differ, ", absent, " of them missing."), tolerance=tolerance.absolute)


def cross_foot(reported: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """(table_name, axis, summed, grand, difference, within): published totals of each axis against the corner.

    Both axes are tested. Tables that publish no grand total are left out.
    """
    sums = reported.groupBy("table_name").agg(
        *[zero_if_null(F.sum(F.when(F.col("axis") == axis, F.col("value")))).alias(axis) for axis in (COLUMN, ROW)],
        *[F.count_if(F.col("axis") == axis).alias(f"n_{axis}") for axis in (COLUMN, ROW, GRAND)],
        F.max(F.when(F.col("axis") == GRAND, F.col("value"))).alias("grand"),
    )
    sides = F.array(
        *[
            F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("summed"), F.col(f"n_{axis}").alias("parts"))
            for axis in (COLUMN, ROW)
        ]
    )
    long = sums.where(F.col(f"n_{GRAND}") > 0).select("table_name", "grand", F.inline(sides)).where(F.col("parts") > 0)
    difference = F.abs(F.col("summed") - F.col("grand"))
    return long.select(
        "table_name",
        "axis",
        "summed",
        "grand",
        difference.alias("difference"),
        F.coalesce(difference <= tolerance.absolute, F.lit(False)).alias("within"),
    )


def cross_foot_checks(
    reported: DataFrame, ids: dict[str, str], tolerance: Tolerance = Tolerance()
) -> DataFrame:
    """One result row per table and axis of :func:`cross_foot`."""
    known = ", ".join(as_sql(x) for entry in ids.items() for x in entry)
    name = Sql(f"coalesce(try_element_at(map({known}), table_name), 'REC-V')")
    row = cross_foot_row(name, Sql("axis"), Sql("grand"), Sql("summed"), Sql("difference"), Sql("within"), tolerance)
    return check_rows(cross_foot(reported, tolerance), [row])


def cross_foot_row(name, axis, grand: Sql, summed: Sql, difference: Sql, within: Sql, tolerance: Tolerance) -> Sql:
    return check(text(name, "-", axis), "SOURCE_TOTAL", "Published totals against the grand total",
                 Sql("table_name"), within, CRITICAL, grand, summed, difference, Sql(f"if({within}, 0, 1)"),
                 "Totals add up to the grand total.", "Totals do not add up to the grand total.",
                 tolerance=tolerance.absolute)
