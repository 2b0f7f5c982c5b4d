"""Two-sample comparison of value distributions, any number of dimensions at once.

Input of every function: ``samples(dimension, side, value)``, side ``ref`` or ``comp``. Values are first reduced to
one row per distinct value and dimension, so a value that makes up a large share of the rows costs one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.config import StatsConfig
from crossfoot.functions.kolmogorov import exact_p, series_p
from crossfoot.operators.ordered import Ordered, running_totals
from crossfoot.schemas import DIFFERENT, INSUFFICIENT, NO_CHANGE

REFERENCE, COMPARISON = "ref", "comp"


def value_counts(samples: DataFrame) -> DataFrame:
    """(dimension, value, n_ref, n_comp) without NULL and NaN values; a NULL dimension becomes the empty one."""
    value = F.col("value").cast("double")
    dimension = F.coalesce(F.col("dimension").cast("string"), F.lit(""))
    return (
        samples.select(dimension.alias("dimension"), "side", value.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("dimension", "value")
        .agg(F.count_if(F.col("side") == REFERENCE).alias("n_ref"), F.count_if(F.col("side") == COMPARISON).alias("n_comp"))
    )


def ordered_counts(samples: DataFrame) -> Ordered:
    """:func:`value_counts` in value order, with running and total counts of both sides."""
    return running_totals(value_counts(samples), ["dimension"], ["value"], ["n_ref", "n_comp"])


def _enough(config: StatsConfig) -> Column:
    return F.least("n_reference", "n_comparison") >= config.min_sample_size


def ks_statistic(ordered: Ordered) -> DataFrame:
    """(dimension, n_reference, n_comparison, statistic): largest gap between the two distribution functions."""
    reference = F.try_divide(F.col("cum_n_ref"), F.col("total_n_ref"))
    comparison = F.try_divide(F.col("cum_n_comp"), F.col("total_n_comp"))
    return ordered.running.groupBy("dimension").agg(
        F.max("total_n_ref").alias("n_reference"),
        F.max("total_n_comp").alias("n_comparison"),
        F.max(F.abs(reference - comparison)).alias("statistic"),
    )


def ks_test(ordered: Ordered, config: StatsConfig = StatsConfig(), method: str = "exact") -> DataFrame:
    """Two-sample KS test per dimension.

    The caller names how the p-value is computed, for all sample sizes alike: ``"exact"`` counts paths, at a cost that
    grows with the sum of the sizes times the width of the band they stay in, ``"series"`` sums the asymptotic series.
    The result says which. Status compares ``p < alpha``.
    """
    if method not in ("exact", "series"):
        raise ValueError(f"unknown p-value method {method!r}")
    enough = _enough(config)
    n, m, d = F.col("n_reference"), F.col("n_comparison"), F.col("statistic")
    base = ks_statistic(ordered).withColumn("statistic", F.when(enough, d))
    p = F.when(enough, series_p(d, n, m))
    if method == "exact":
        bound = F.round(d * n * m).cast("long")
        p = exact_p(F.when(enough, n), F.when(enough, m), F.when(enough, bound))
    status = F.when(~enough, INSUFFICIENT).when(F.col("p_value") < config.alpha, DIFFERENT).otherwise(NO_CHANGE)
    return (
        base.withColumn("p_value", p)
        .withColumn("alpha", F.lit(config.alpha))
        .withColumn("status", status)
        .withColumn("p_method", F.lit(method))
        .select("dimension", "n_reference", "n_comparison", "statistic", "p_value", "p_method", "alpha", "status")
    )


def _fractions(bins: int) -> Column:
    return F.array(*[F.lit(float(q)) for q in np.linspace(0, 100, bins + 1) / 100.0])


def _quantile_fractions(config: StatsConfig) -> Column:
    """Quantile positions of a dimension: its own number of bins, else the common one."""
    grid = _fractions(config.n_bins)
    for dimension, bins in config.bins.items():
        grid = F.when(F.col("dimension") == dimension, _fractions(bins)).otherwise(grid)
    return grid


def quantile_edges(ordered: Ordered, config: StatsConfig = StatsConfig()) -> DataFrame:
    """(dimension, edges): distinct quantiles of the reference values, linear interpolation, ascending.

    Exact. The order statistics next to each quantile position are looked up by running count, so no task ever holds
    the values of a whole dimension.
    """
    first, last = F.col("cum_n_ref") - F.col("n_ref"), F.col("cum_n_ref") - 1
    hits = (
        ordered.running.where(F.col("n_ref") > 0)
        .withColumn("positions", F.transform(_quantile_fractions(config), lambda q: (F.col("total_n_ref") - 1) * q))
        .select("dimension", "value", first.alias("first"), last.alias("last"), "positions")
        .withColumn(
            "hit",
            F.filter("positions", lambda p: (F.ceil(p) >= F.col("first")) & (F.floor(p) <= F.col("last"))),
        )
        .where(F.size("hit") > 0)
        .select("dimension", "value", "first", "last", F.explode("hit").alias("position"))
    )
    low = F.when(F.floor("position") >= F.col("first"), F.col("value"))
    high = F.when(F.ceil("position") <= F.col("last"), F.col("value"))
    share = F.col("position") - F.floor("position")
    step = F.col("high") - F.col("low")
    edge = F.when(share >= 0.5, F.col("high") - step * (1.0 - share)).otherwise(F.col("low") + step * share)
    return (
        hits.groupBy("dimension", "position")
        .agg(F.max(low).alias("low"), F.min(high).alias("high"))
        .select("dimension", edge.alias("edge"))
        .groupBy("dimension")
        .agg(F.sort_array(F.collect_set("edge")).alias("edges"))
    )


def histogram(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """(dimension, n_bins, bin, n_ref, n_comp) over half-open bins, last one closed.

    Values outside the edges are left out. Bins without values are not listed; ``n_bins`` says how many there are.
    """
    below = F.size(F.filter("edges", lambda edge: edge <= F.col("value")))
    bin_no = F.when(F.col("value") == F.element_at("edges", -1), F.col("n_bins")).otherwise(below)
    return (
        counts.join(edges.withColumn("n_bins", F.size("edges") - 1), "dimension")
        .withColumn("bin", bin_no)
        .where(F.col("bin").between(F.lit(1), F.col("n_bins")))
        .groupBy("dimension", "n_bins", "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_comp").alias("n_comp"))
    )


def _widen(edges: Column) -> Column:
    """Moves the outer edges out by a millionth so that the extreme values fall inside."""
    last = F.size(edges) - 1
    return F.transform(edges, lambda e, i: F.when(i == 0, e - 1e-6).when(i == last, e + 1e-6).otherwise(e))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, value: acc + value)


def stability_index(bins: DataFrame, epsilon: float) -> DataFrame:
    """(dimension, psi): sum of ``(a - e) * ln(a / e)`` over all bins, after adding ``epsilon`` to every count.

    The arrays hold one number per bin, never sample values.
    """
    filled = bins.groupBy("dimension", "n_bins").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n_ref"))).alias("ref_by_bin"),
        F.map_from_entries(F.collect_list(F.struct("bin", "n_comp"))).alias("comp_by_bin"),
    )

    def smoothed(by_bin: str) -> Column:
        numbers = F.sequence(F.lit(1), F.col("n_bins"))
        return F.transform(numbers, lambda b: F.coalesce(F.try_element_at(by_bin, b), F.lit(0)) + F.lit(epsilon))

    counts = filled.select("dimension", smoothed("ref_by_bin").alias("e"), smoothed("comp_by_bin").alias("a"))
    totals = counts.select("dimension", "e", "a", _total(F.col("e")).alias("e_all"), _total(F.col("a")).alias("a_all"))

    def part(e: Column, a: Column) -> Column:
        expected, actual = e / F.col("e_all"), a / F.col("a_all")
        return (actual - expected) * F.ln(actual / expected)

    return totals.select("dimension", _total(F.zip_with("e", "a", part)).alias("psi"))


def psi_test(ordered: Ordered, config: StatsConfig = StatsConfig()) -> DataFrame:
    """Population stability index per dimension, bins from the quantiles of the reference values."""
    edges = quantile_edges(ordered, config).where(F.size("edges") >= 2).withColumn("edges", _widen(F.col("edges")))
    index = stability_index(histogram(ordered.rows, edges), config.psi_epsilon)
    sizes = ordered.rows.groupBy("dimension").agg(
        F.sum("n_ref").alias("n_reference"), F.sum("n_comp").alias("n_comparison")
    )
    enough = _enough(config)
    status = (
        F.when(~enough | F.col("psi").isNull(), INSUFFICIENT)
        .when(F.col("psi") >= config.psi_moderate, DIFFERENT)
        .otherwise(NO_CHANGE)
    )
    return (
        sizes.join(index, "dimension", "left")
        .withColumn("status", status)
        .withColumn("psi_value", F.when(enough, F.coalesce("psi", F.lit(0.0))))
        .withColumn("psi_threshold", F.lit(config.psi_significant))
        .select("dimension", "n_reference", "n_comparison", "psi_value", "psi_threshold", "status")
    )
