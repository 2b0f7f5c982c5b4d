"""Reconciliation of related tables. Advisory: a difference is a WARNING, never a FAIL.

Inputs are the long tables ``matrix(origin, destination, value)``, ``summary(code, description, value)`` and the
category tables ``outward``, ``inward`` and ``internal(code, description, entity, value)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.config import Tolerance
from crossfoot.functions.amounts import (
    absolute_difference,
    advisory_severity,
    advisory_status,
    agrees,
    relative_difference,
    zero_if_null,
)
from crossfoot.functions.cells import sentence
from crossfoot.operators.reshape import union_all
from crossfoot.schemas import RECONCILIATION_RESULT, UNRESOLVED, UNRESOLVED_TEXT, WARNING
from crossfoot.sources.crosstab import GRAND

Tables = dict[str, DataFrame]


def grand_sums(tables: Tables, names: list[str]) -> DataFrame:
    """One row with the sum of each table, 0 for an empty or absent one. Each table is aggregated once and sends one row."""
    tagged = union_all(
        [
            tables[name].agg(zero_if_null(F.sum("value")).alias("total")).select(F.lit(name).alias("table_name"), "total")
            for name in names
            if name in tables
        ]
    )
    return tagged.agg(*[zero_if_null(F.sum(F.when(F.col("table_name") == n, F.col("total")))).alias(n) for n in names])


# Where each entity sum comes from: table and the expression that names its entity.
MEASURES = {
    "origin_total": ("matrix", "origin"),
    "destination_total": ("matrix", "destination"),
    "diagonal": ("matrix", "if(origin = destination, origin, NULL)"),
    "outward": ("outward", "entity"),
    "inward": ("inward", "entity"),
    "internal": ("internal", "entity"),
}


def entity_sums(tables: Tables, entities: DataFrame, names: list[str]) -> DataFrame:
    """One row per expected entity with the named sums of ``MEASURES``; entities outside the list are left out.

    Each table is read once and all sums share one grouping. An entity without rows has 0, as in an absent table.
    """
    frames = []
    for table in dict.fromkeys(MEASURES[name][0] for name in names):
        if table not in tables:
            continue
        keys = [
            F.struct(F.expr(MEASURES[name][1]).alias("entity"), F.lit(name).alias("measure"))
            for name in names
            if MEASURES[name][0] == table
        ]
        frames.append(tables[table].select("value", F.inline(F.array(*keys))).where(F.col("entity").isNotNull()))
    sums = (
        union_all(frames)
        .groupBy("entity")
        .agg(*[F.sum(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name in names])
    )
    expected = entities.select(F.col(entities.columns[0]).alias("entity")).distinct()
    return expected.join(sums, "entity", "left").na.fill(0, names)


@dataclass(frozen=True)
class Rule:
    """One reconciliation rule: what is compared, over which tables, under which name."""

    code: str
    sources: str
    dimension: str
    expected: str
    observed: str

    def case(self) -> Column:
        return F.struct(
            F.lit(self.code).alias("rule_code"),
            F.lit(self.sources).alias("source_tables"),
            F.lit(self.dimension).alias("dimension"),
            F.expr(self.expected).cast("double").alias("expected_value"),
            F.expr(self.observed).cast("double").alias("observed_value"),
        )


DO01 = Rule("REC-DO01", "matrix, summary", "NATIONAL", "published_national", "matrix")
DO02 = Rule("REC-DO02", "outward, inward", "OUTWARD_INWARD_TOTAL", "published_inward", "outward")
DO03 = [
    Rule("REC-DO03", "summary, outward, internal", "OUTWARD_INTERNAL_PARTITION", "summary", "outward + internal"),
    Rule("REC-DO03", "summary, inward, internal", "INWARD_INTERNAL_PARTITION", "summary", "inward + internal"),
]
DO04 = Rule("REC-DO04", "matrix, outward, internal", "ORIGIN_MARGINAL", "outward + internal", "origin_total")
DO05 = Rule("REC-DO05", "matrix, inward, internal", "DESTINATION_MARGINAL", "inward + internal", "destination_total")
DO06 = Rule("REC-DO06", "matrix, internal", "DIAGONAL_VS_INTERNAL", "internal", "diagonal")


def compare(
    sums: DataFrame,
    rules: list[Rule],
    tolerance: Tolerance,
    exceptions: tuple[str, ...] = (),
    exception_mode: str = "outside",
) -> DataFrame:
    """Result rows of the rules over rows of sums; rows without an ``entity`` are national.

    An entity in ``exceptions`` gets UNRESOLVED instead of WARNING under DO06 when it is outside the tolerance, or in
    any case with ``exception_mode="always"``.
    """
    entity = F.col("entity") if "entity" in sums.columns else F.lit("NATIONAL")
    rows = sums.select(entity.alias("entity"), F.inline(F.array(*[rule.case() for rule in rules])))
    e, o = F.col("expected_value"), F.col("observed_value")
    ok = agrees(e, o, tolerance)
    open_case = F.lit(False)
    if exceptions:
        open_case = (F.col("rule_code") == DO06.code) & F.col("entity").isin(*exceptions)
        if exception_mode == "outside":
            open_case = open_case & ~ok
    gap = F.format_number(absolute_difference(e, o), 6)
    message = (
        F.when(open_case, UNRESOLVED_TEXT)
        .when(ok, sentence(F.col("dimension"), " agrees within tolerance."))
        .otherwise(sentence(F.col("dimension"), " differs by ", gap, " for ", F.col("entity"), "."))
    )
    values = {
        "absolute_difference": absolute_difference(e, o),
        "relative_difference": relative_difference(e, o, tolerance),
        "absolute_tolerance": F.lit(tolerance.absolute),
        "relative_tolerance": F.lit(tolerance.relative),
        "status": F.when(open_case, UNRESOLVED).otherwise(advisory_status(ok)),
        "severity": F.when(open_case, WARNING).otherwise(advisory_severity(ok)),
        "message": message,
    }
    return rows.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RECONCILIATION_RESULT.fields]
    )


def published_grand_total(reported: DataFrame, table: str, fallback: float | None = None) -> Column:
    """Published grand total of a table; ``fallback`` stands in only when it is NULL or absent."""
    value = reported.where((F.col("table_name") == table) & (F.col("axis") == GRAND)).agg(F.max("value")).scalar()
    return value if fallback is None else F.coalesce(value, F.lit(fallback))


def national_sums(tables: Tables, names: list[str], reported: DataFrame | None = None, fallback: dict | None = None) -> DataFrame:
    """:func:`grand_sums` with the published totals ``published_national`` and ``published_inward``."""
    sums = grand_sums(tables, names)
    if reported is None:
        return sums
    spare = fallback or {}
    return sums.withColumn("published_national", published_grand_total(reported, "summary", spare.get("summary"))).withColumn(
        "published_inward", published_grand_total(reported, "inward", spare.get("inward"))
    )


def matrix_vs_national(tables: Tables, reported: DataFrame, tolerance: Tolerance = Tolerance(), fallback: dict | None = None) -> DataFrame:
    """DO01: sum of the matrix against the published total of the flat list."""
    return compare(national_sums(tables, ["matrix"], reported, fallback), [DO01], tolerance)


def outward_vs_inward_total(tables: Tables, reported: DataFrame, tolerance: Tolerance = Tolerance(), fallback: dict | None = None) -> DataFrame:
    """DO02: sum of the outward cells against the published grand total of the inward table."""
    return compare(national_sums(tables, ["outward"], reported, fallback), [DO02], tolerance)


def partition_of_total(tables: Tables, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """DO03: outward + internal and inward + internal each make up the category total."""
    return compare(national_sums(tables, ["summary", "outward", "inward", "internal"]), DO03, tolerance)


def origin_marginals(tables: Tables, entities: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """DO04: per entity, the matrix summed over destinations against outward + internal."""
    return compare(entity_sums(tables, entities, ["origin_total", "outward", "internal"]), [DO04], tolerance)


def destination_marginals(tables: Tables, entities: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """DO05: per entity, the matrix summed over origins against inward + internal."""
    return compare(entity_sums(tables, entities, ["destination_total", "inward", "internal"]), [DO05], tolerance)


def diagonal_vs_internal(
    tables: Tables,
    entities: DataFrame,
    exceptions: tuple[str, ...] = (),
    tolerance: Tolerance = Tolerance(),
    exception_mode: str = "outside",
) -> DataFrame:
    """DO06: per entity, the diagonal of the matrix against internal."""
    sums = entity_sums(tables, entities, ["diagonal", "internal"])
    return compare(sums, [DO06], tolerance, exceptions, exception_mode)


def reconcile_all(
    tables: Tables,
    reported: DataFrame,
    entities: DataFrame,
    exceptions: tuple[str, ...] = (),
    tolerance: Tolerance = Tolerance(),
    exception_mode: str = "outside",
    fallback: dict | None = None,
) -> DataFrame:
    """All six rules: 4 national rows and three rows per entity.

    Each table is read twice in all, once for its grand sum and once for its entity sums.
    """
    national = national_sums(tables, ["matrix", "summary", "outward", "inward", "internal"], reported, fallback)
    by_entity = entity_sums(tables, entities, list(MEASURES))
    return compare(national, [DO01, DO02, *DO03], tolerance).unionByName(
        compare(by_entity, [DO04, DO05, DO06], tolerance, exceptions, exception_mode)
    )


def reconciliation_profile(tables: Tables) -> DataFrame:
    """One report row: table totals, their differences and the diagonal against internal."""
    names = ["matrix", "summary", "outward", "inward", "internal"]
    own = {**tables, "diagonal": tables["matrix"].where(F.col("origin") == F.col("destination"))}
    sums = grand_sums(own, [*names, "diagonal"])
    return sums.select(
        *[F.col(name).alias(f"{name}_total") for name in [*names, "diagonal"]],
        (F.col("matrix") - F.col("summary")).alias("matrix_minus_summary"),
        (F.col("outward") - F.col("inward")).alias("outward_minus_inward"),
        (F.col("outward") + F.col("internal") - F.col("summary")).alias("parts_minus_summary"),
        (F.col("diagonal") - F.col("internal")).alias("diagonal_minus_internal"),
    )
