"""Profiles of tables and differences between two snapshots of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.functions.cells import inferred_type, is_filled
from crossfoot.operators.ordered import ordinal_positions
from crossfoot.operators.reshape import union_all
from crossfoot.runtime import inline_cells, literal, quoted, ref
from crossfoot.sources.files import row_numbers


def missing(df: DataFrame, column: str) -> str:
    """SQL text: whether a cell counts as NULL; NaN does."""
    nan = f" OR isnan({quoted(column)})" if dict(df.dtypes)[column] in ("double", "float") else ""
    return f"({quoted(column)} IS NULL{nan})"


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, n_rows, n_columns, n_null): one pass over all columns."""
    nulls = F.expr(" + ".join(["0L", *[f"cast({missing(df, c)} AS bigint)" for c in df.columns]]))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("n_null"),
    ).select(F.lit(table).alias("table_name"), "*")


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, n_rows, n_null) for every column, one pass."""
    counts = df.selectExpr("count(*) AS _n", *[f"count_if({missing(df, c)}) AS {quoted(c)}" for c in df.columns])
    cells = [{"column_name": literal(c), "n_null": quoted(c)} for c in df.columns]
    return counts.select(F.lit(table).alias("table_name"), F.col("_n").alias("n_rows"), inline_cells(cells))


def cells_as_text(df: DataFrame) -> DataFrame:
    """(column_name, cell) of every cell; each row turns into its own cells, no shuffle."""
    cells = [{"column_name": literal(c), "cell": f"cast({quoted(c)} AS string)"} for c in df.columns]
    return df.select(inline_cells(cells))


def cell_type_distribution(df: DataFrame, table: str) -> DataFrame:
    """(table_name, cell_type, n_cells) with types empty, number, text."""
    kinds = cells_as_text(df).groupBy(inferred_type(F.col("cell")).alias("cell_type"))
    return kinds.agg(F.count("*").alias("n_cells")).select(F.lit(table).alias("table_name"), "*")


def bounding_box(cells: DataFrame) -> DataFrame:
    """(table_name, min_row, max_row, min_col, max_col) of the filled cells of staged cells."""
    filled = cells.where(is_filled(F.col("value")))
    return filled.groupBy("table_name").agg(
        F.min("source_row").alias("min_row"),
        F.max("source_row").alias("max_row"),
        F.min("source_col").alias("min_col"),
        F.max("source_col").alias("max_col"),
    )


def empty_lines(cells: DataFrame) -> DataFrame:
    """(table_name, axis, line): source rows and columns without a filled cell."""
    lines = F.array(
        F.struct(F.lit("ROW").alias("axis"), F.col("source_row").cast("long").alias("line")),
        F.struct(F.lit("COLUMN").alias("axis"), F.col("source_col").cast("long").alias("line")),
    )
    spread = cells.select("table_name", is_filled(F.col("value")).alias("filled"), F.inline(lines))
    return (
        spread.groupBy("table_name", "axis", "line")
        .agg(F.bool_or("filled").alias("used"))
        .where(~F.col("used"))
        .drop("used")
    )


def sparsity(cells: DataFrame) -> DataFrame:
    """(table_name, n_cells, n_null, null_share) of a long frame (table_name, value)."""
    return (
        cells.groupBy("table_name")
        .agg(F.count("*").alias("n_cells"), F.expr(f"count_if({missing(cells, 'value')})").alias("n_null"))
        .withColumn("null_share", F.col("n_null") / F.col("n_cells"))
    )


def snapshot_diff(reference: DataFrame, comparison: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Keys whose presence or attributes differ: keys, change, differing attribute names.

    ``change`` is ADDED, REMOVED or CHANGED. Both sides hold one row per key; they meet in one grouping.
    """
    fields = F.struct(*[ref(a) for a in attributes])
    tagged = union_all(
        [
            reference.select(*keys, fields.alias("before"), F.lit(None).alias("after")),
            comparison.select(*keys, F.lit(None).alias("before"), fields.alias("after")),
        ]
    )
    met = tagged.groupBy(*keys).agg(
        F.max("before").alias("before"),
        F.max("after").alias("after"),
        F.count("before").alias("n_before"),
        F.count("after").alias("n_after"),
    )
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"before.{a}").eqNullSafe(F.col(f"after.{a}")), F.lit(a)) for a in attributes])
    )
    kind = F.when(F.col("n_before") == 0, "ADDED").when(F.col("n_after") == 0, "REMOVED").when(F.size(differing) > 0, "CHANGED")
    return met.select(*keys, kind.alias("change"), F.array_join(differing, ",").alias("attributes")).where(
        F.col("change").isNotNull()
    )


def changed_rows(
    reference: DataFrame, comparison: DataFrame, keys: list[str], coarse: int = 4096, fine: int = 256
) -> DataFrame:
    """(keys, change, rows_before, rows_after) of the keys whose rows differ, found through digests of key ranges.

    Keys are hashed into ``coarse`` ranges of ``fine`` parts each. The digest of a range is the sum of its rows' digests
    on one side minus those on the other, so one grouping into at most ``coarse`` rows tells which ranges differ; only
    their rows are summed again by part, and only rows of differing parts are shuffled by key. Equal snapshots are never
    shuffled row by row. Both lists of ranges are bounded by the parameters and therefore broadcast.

    ``change`` is ADDED, REMOVED or CHANGED. A key may hold several rows on each side; it differs when the rows do,
    whatever their order. NULL is a key like any other. Both sides must have the same columns; columns may have any name.
    """
    if sorted(reference.columns) != sorted(comparison.columns):
        raise ValueError("both snapshots must have the same columns")

    def signed(df: DataFrame, sign: int) -> DataFrame:
        ordered = df.select(*[ref(c) for c in sorted(reference.columns)])
        place = F.pmod(F.xxhash64(*[F.struct(ref(k).isNull(), ref(k)) for k in keys]), F.lit(coarse * fine))
        first, second = (number * sign for number in row_numbers(ordered))
        return ordered.select(
            F.struct(*[ref(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"), place.alias("part"),
            F.lit(sign).alias("sign"), first.alias("first"), second.alias("second"),
        )

    rows = signed(reference, 1).unionByName(signed(comparison, -1))

    def differing(df: DataFrame, by: Column, name: str) -> DataFrame:
        sums = df.groupBy(by.alias(name)).agg(*[F.sum(c).alias(c) for c in ("sign", "first", "second")])
        return F.broadcast(sums.where("sign <> 0 OR first <> 0 OR second <> 0").select(name))

    in_range = F.floor(F.col("part") / fine)
    open_rows = rows.withColumn("range", in_range).join(differing(rows, in_range, "range"), "range", "left_semi").drop("range")
    left = open_rows.join(differing(open_rows, F.col("part"), "part"), "part", "left_semi")
    met = left.groupBy("key").agg(
        F.count_if(F.col("sign") > 0).alias("rows_before"),
        F.count_if(F.col("sign") < 0).alias("rows_after"),
        F.sum("first").alias("first"),
        F.sum("second").alias("second"),
    )
    kind = F.when(F.col("rows_before") == 0, "ADDED").when(F.col("rows_after") == 0, "REMOVED").otherwise("CHANGED")
    unequal = met.where("rows_before <> rows_after OR first <> 0 OR second <> 0")
    return unequal.select(*[F.col(f"key.k{i}").alias(k) for i, k in enumerate(keys)], kind.alias("change"), "rows_before", "rows_after")


def label_set_diff(reference: DataFrame, comparison: DataFrame, label: str) -> DataFrame:
    """(label, in_reference, in_comparison) of the labels that only one side has; empty when the sets are equal."""
    tagged = union_all(
        [
            reference.select(ref(label).alias("label"), F.lit(True).alias("r"), F.lit(False).alias("c")),
            comparison.select(ref(label).alias("label"), F.lit(False).alias("r"), F.lit(True).alias("c")),
        ]
    )
    sides = tagged.groupBy("label").agg(F.bool_or("r").alias("in_reference"), F.bool_or("c").alias("in_comparison"))
    return sides.where(F.col("in_reference") != F.col("in_comparison"))


def label_positions(frames: dict[str, DataFrame], label: str, order: list[str], within: list[str] | None = None) -> DataFrame:
    """([within...,] position, one column per frame, all_equal): labels of several tables side by side by position.

    ``order`` gives the position inside each table, or inside each group of ``within`` columns of it.
    """
    groups = within or []
    tagged = union_all(
        [df.select(F.lit(name).alias("source"), *[ref(c) for c in groups], ref(label).alias("label"), *[ref(c) for c in order if c != label]) for name, df in frames.items()]
    )
    keys = [("label" if c == label else c) for c in order]
    placed = ordinal_positions(tagged.select("source", *groups, "label", *[k for k in keys if k != "label"]), ["source", *groups], keys)
    wide = placed.groupBy(*groups, "position").pivot("source", list(frames)).agg(F.max("label"))
    first, *others = [ref(name) for name in frames]
    same = F.lit(True)
    for other in others:
        same = same & first.eqNullSafe(other)
    return wide.withColumn("all_equal", same)
