"""Two snapshots of the same tables side by side."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.config import StatsConfig
from crossfoot.functions.amounts import change, change_note, change_pct, change_status
from crossfoot.functions.cells import sentence
from crossfoot.operators.distribution import COMPARISON, REFERENCE, ks_test, ordered_counts, psi_test
from crossfoot.operators.reshape import canonical, union_all
from crossfoot.runtime import materialize
from crossfoot.schemas import DIFFERENT, NO_CHANGE, STATISTICAL_RESULT

Tables = dict[str, DataFrame]

# Dimension names of the comparison.
CATEGORY_DIMENSION = "CATEGORY_NATIONAL"
KINDS = ("outward", "inward", "internal")
# Bins of the stability index per dimension.
SUITE_BINS = {
    CATEGORY_DIMENSION: 10,
    **{f"ENTITY_{kind.upper()}": 5 for kind in KINDS},
    **{f"CATEGORY_ENTITY_{kind.upper()}": 10 for kind in KINDS},
}


def comparable_dimensions(reference: Tables, comparison: Tables, mapping: dict[str, str] | None = None) -> DataFrame:
    """(dimension, code, entity, reference, comparison) for the seven comparable dimensions of two snapshots.

    ENTITY_<kind>: entity totals. CATEGORY_NATIONAL: flat list. CATEGORY_ENTITY_<kind>: single cells. Entity labels
    are made canonical first. Keys of either snapshot are kept; a group of only NULL cells stays NULL.

    Cells and entity totals of both snapshots come from one grouping, combined before the shuffle, instead of one
    outer join per dimension.
    """
    frames = []
    for side, tables in ((REFERENCE, reference), (COMPARISON, comparison)):
        tag = F.lit(side).alias("side")
        none = F.lit(None).cast("string")
        frames.append(
            tables["summary"].select(
                tag, F.lit(CATEGORY_DIMENSION).alias("dimension"), "code", none.alias("entity"), "value"
            )
        )
        for kind in KINDS:
            levels = F.array(
                F.struct(F.lit(f"ENTITY_{kind.upper()}").alias("dimension"), none.alias("code")),
                F.struct(F.lit(f"CATEGORY_ENTITY_{kind.upper()}").alias("dimension"), F.col("code").alias("code")),
            )
            cells = tables[kind].select(
                "value", canonical(F.col("entity"), mapping or {}).alias("entity"), F.inline(levels)
            )
            frames.append(cells.select(tag, "dimension", "code", "entity", "value"))
    side = F.col("side")
    return (
        union_all(frames)
        .groupBy("dimension", "code", "entity")
        .agg(
            F.sum(F.when(side == REFERENCE, F.col("value"))).alias("reference"),
            F.sum(F.when(side == COMPARISON, F.col("value"))).alias("comparison"),
        )
    )


def pair_snapshots(reference: DataFrame, comparison: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer pairing of two ``(keys…, value)`` frames as (keys…, reference, comparison); keys may be NULL.

    One grouping instead of an outer join, so one very frequent key does not overload a task.
    """
    none = F.lit(None)
    both = union_all(
        [
            reference.select(*keys, F.col("value").alias("reference"), none.alias("comparison")),
            comparison.select(*keys, none.alias("reference"), F.col("value").alias("comparison")),
        ]
    )
    return both.groupBy(*keys).agg(F.sum("reference").alias("reference"), F.sum("comparison").alias("comparison"))


def suite_config(config: StatsConfig = StatsConfig()) -> StatsConfig:
    """The configuration with the suite's bin counts where it names none."""
    return replace(config, bins={**SUITE_BINS, **config.bins})


def samples_of(pairs: DataFrame) -> DataFrame:
    """(dimension, side, value) for the distribution tests."""
    sides = F.array(
        F.struct(F.lit(REFERENCE).alias("side"), F.col("reference").cast("double").alias("value")),
        F.struct(F.lit(COMPARISON).alias("side"), F.col("comparison").cast("double").alias("value")),
    )
    return pairs.select("dimension", F.inline(sides))


def _result(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Rows of the statistical result schema; columns that are not given are NULL."""
    return df.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STATISTICAL_RESULT.fields
        ]
    )


def year_over_year(pairs: DataFrame, config: StatsConfig = StatsConfig()) -> DataFrame:
    """Change of every entity total and of every category as statistical result rows."""
    ref_value, comp_value = F.col("reference").cast("double"), F.col("comparison").cast("double")
    pct = change_pct(ref_value, comp_value)
    wanted = F.col("dimension").startswith("ENTITY_") | (F.col("dimension") == CATEGORY_DIMENSION)
    metric = F.coalesce("entity", "code")
    return _result(
        pairs.where(wanted),
        {
            "dimension": F.concat("dimension", F.lit("_YOY")),
            "metric": metric,
            "test_method": F.lit("YOY_CHANGE"),
            "statistic": change(ref_value, comp_value),
            "pct_change": pct,
            "status": change_status(pct, config),
            "interpretation": F.when(
                pct.isNotNull(), sentence(metric, ": ", F.format_number(ref_value, 2), " -> ", F.format_number(comp_value, 2))
            ).otherwise(sentence(metric, ": percentage change not applicable (", change_note(ref_value, comp_value), ")")),
        },
    )


def macro_change(pairs: DataFrame) -> DataFrame:
    """(dimension, reference, comparison, change, pct_change) of the totals over all entities or categories."""
    totals = (
        pairs.where(~F.col("dimension").startswith("CATEGORY_ENTITY_"))
        .groupBy("dimension")
        .agg(F.sum("reference").alias("reference"), F.sum("comparison").alias("comparison"))
    )
    r, c = F.col("reference").cast("double"), F.col("comparison").cast("double")
    return totals.select(
        "dimension", r.alias("reference"), c.alias("comparison"), change(r, c).alias("change"), change_pct(r, c).alias("pct_change")
    )


def distribution_results(pairs: DataFrame, config: StatsConfig = StatsConfig(), method: str = "exact") -> DataFrame:
    """KS and PSI rows of every dimension."""
    config = suite_config(config)
    ordered = ordered_counts(samples_of(pairs))
    ks = ks_test(ordered, config, method)
    psi = psi_test(ordered, config)
    sizes = {"dimension": F.col("dimension"), "n_reference": F.col("n_reference"), "n_comparison": F.col("n_comparison")}
    ks_rows = _result(
        ks,
        {
            **sizes,
            "metric": F.concat("dimension", F.lit("_DISTRIBUTION")),
            "test_method": F.lit("KS_TEST"),
            "statistic": F.col("statistic"),
            "p_value": F.col("p_value"),
            "alpha": F.col("alpha"),
            "status": F.col("status"),
            "interpretation": F.format_string("statistic = %.4f, p-value = %.2e", "statistic", "p_value"),
        },
    )
    psi_rows = _result(
        psi,
        {
            **sizes,
            "metric": F.concat("dimension", F.lit("_STABILITY")),
            "test_method": F.lit("PSI"),
            "psi_value": F.col("psi_value"),
            "psi_threshold": F.col("psi_threshold"),
            "status": F.col("status"),
            "interpretation": F.format_string("PSI = %.4f", "psi_value"),
        },
    )
    return ks_rows.unionByName(psi_rows)


def exception_audit(reference: Tables, comparison: Tables, entity: str, tolerance: float = 1e-4) -> DataFrame:
    """Diagonal against internal of one entity in both snapshots, one result row; the label may differ in case.

    ``statistic`` is the difference in the comparison snapshot. The cause is not asserted.
    """
    name = entity.strip().upper()
    frames = []
    for side, tables in ((REFERENCE, reference), (COMPARISON, comparison)):
        own = (F.upper(F.trim("origin")) == name) & (F.upper(F.trim("destination")) == name)
        frames.append(tables["matrix"].where(own).select(F.lit(f"diagonal_{side}").alias("part"), "value"))
        frames.append(
            tables["internal"].where(F.upper(F.trim("entity")) == name).select(F.lit(f"internal_{side}").alias("part"), "value")
        )
    parts = [f"{kind}_{side}" for side in (REFERENCE, COMPARISON) for kind in ("diagonal", "internal")]
    sums = union_all(frames).agg(
        *[F.coalesce(F.sum(F.when(F.col("part") == p, F.col("value"))), F.lit(0)).cast("double").alias(p) for p in parts]
    )
    gap_ref = F.abs(F.col("diagonal_ref") - F.col("internal_ref"))
    gap_comp = F.abs(F.col("diagonal_comp") - F.col("internal_comp"))
    return _result(
        sums,
        {
            "dimension": F.lit("CROSS_PERIOD_AUDIT"),
            "metric": F.lit(f"{name}_DIAGONAL_INTERNAL"),
            "test_method": F.lit("CROSS_PERIOD_OBSERVATION"),
            "statistic": gap_comp,
            "status": F.when(F.greatest(gap_ref, gap_comp) <= tolerance, NO_CHANGE).otherwise(DIFFERENT),
            "interpretation": sentence("difference ", F.format_number(gap_ref, 6), " -> ", F.format_number(gap_comp, 6)),
        },
    )


def compare_snapshots(
    reference: Tables,
    comparison: Tables,
    audited_entity: str,
    mapping: dict[str, str] | None = None,
    config: StatsConfig = StatsConfig(),
    method: str = "exact",
    periods: tuple[str | None, str | None] = (None, None),
) -> DataFrame:
    """Whole suite: KS and PSI per dimension, change per entity and category, one audited entity.

    ``periods`` name the two snapshots in the columns reference_period and comparison_period.
    """
    pairs = materialize(comparable_dimensions(reference, comparison, mapping))
    named = {name: F.lit(period).cast("string") for name, period in zip(("reference_period", "comparison_period"), periods)}
    return reduce(
        DataFrame.unionByName,
        [
            distribution_results(pairs, config, method),
            year_over_year(pairs, config),
            exception_audit(reference, comparison, audited_entity),
        ],
    ).withColumns(named)
