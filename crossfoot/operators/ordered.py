"""Running totals over sorted groups of any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossfoot.runtime import materialize, ref


@dataclass(frozen=True)
class Ordered:
    """``rows`` as they were given, and ``running``: the same rows with ``cum_<m>`` and ``total_<m>`` per measure."""

    rows: DataFrame
    running: DataFrame


def running_totals(df: DataFrame, group: list[str], order: list[str], measures: list[str]) -> Ordered:
    """Running sum and group total of each measure, in ``order`` inside each group.

    A plain window would sort one whole group in one task. Here the rows are range-partitioned over (group, order),
    each slice is summed on its own, and the sums of the earlier slices of the group are added afterwards. Only one
    row per slice and group takes part in the second step. (group, order) must identify a row; group columns hold no NULL.

    The sliced rows are written once, because slice borders come from a sample and both steps must see the same ones.
    """
    keys = [ref(name) for name in group]
    sliced = (
        df.repartitionByRange(*keys, *[ref(name) for name in order])
        .withColumn("_slice", F.spark_partition_id())
        .transform(materialize)
    )

    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(*[F.sum(ref(name)).alias(f"_part_{name}") for name in measures])
        .select(
            *keys,
            "_slice",
            *[F.coalesce(F.sum(f"_part_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in measures],
            *[F.sum(f"_part_{name}").over(whole).alias(f"total_{name}") for name in measures],
        )
    )

    inside = Window.partitionBy(*keys, "_slice").orderBy(*[ref(name) for name in order])
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.select(
        *[ref(name) for name in sliced.columns],
        *[F.sum(ref(name)).over(inside).alias(f"_local_{name}") for name in measures],
    )
    running = local.alias("l").join(offsets, [*group, "_slice"]).select(
        *[F.col(f"l.`{name}`") for name in df.columns],
        *[(F.col(f"_local_{name}") + F.col(f"_before_{name}")).alias(f"cum_{name}") for name in measures],
        *[F.col(f"total_{name}") for name in measures],
    )
    return Ordered(sliced.drop("_slice"), running)


def ordinal_positions(df: DataFrame, group: list[str], order: list[str], name: str = "position") -> DataFrame:
    """1-based position of every row in ``order`` inside its group, without sorting a group in one task."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), group, order, ["_one"]).running
    return counted.withColumnRenamed("cum__one", name).drop("_one", "total__one")
