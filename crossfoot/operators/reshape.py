"""Wide to long, long to wide, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfoot.config import CrosstabSpec
from crossfoot.functions.cells import clean_label
from crossfoot.runtime import quoted, ref
from crossfoot.sources.crosstab import body, entity_columns


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unpivot_matrix(df: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """Square table to (origin, destination, value): columns are origins, rows are destinations. Blanks stay NULL."""
    origins = entity_columns(df, spec)
    long = body(df, spec).unpivot([ref(spec.row_label)], [quoted(name) for name in origins], "origin", "value")
    return long.select("origin", ref(spec.row_label).alias("destination"), "value")


def flat_list(df: DataFrame, spec: CrosstabSpec, value: str) -> DataFrame:
    """Flat list to (code, description, value)."""
    code, description = spec.label_columns
    return body(df, spec).select(ref(code).alias("code"), ref(description).alias("description"), ref(value).alias("value"))


def unpivot_categories(df: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """Category table to (code, description, entity, value); the total column is not an entity. Blanks stay NULL."""
    labels = [quoted(name) for name in spec.label_columns]
    long = body(df, spec).unpivot(labels, [quoted(name) for name in entity_columns(df, spec)], "entity", "value")
    code, description = spec.label_columns
    return long.select(ref(code).alias("code"), ref(description).alias("description"), "entity", "value")


def unified_fact(tables: dict[str, DataFrame]) -> DataFrame:
    """All category tables in one: (movement_type, code, entity, value). One aggregate then serves every table."""
    return union_all(
        [df.select(F.lit(kind).alias("movement_type"), "code", "entity", "value") for kind, df in tables.items()]
    )


def canonical(label: Column, mapping: dict[str, str]) -> Column:
    """Trimmed label, replaced when the mapping knows it; NULL becomes the empty label."""
    trimmed = F.coalesce(clean_label(label), F.lit(""))
    if not mapping:
        return trimmed
    pairs = F.create_map(*[F.lit(item) for entry in mapping.items() for item in entry])
    return F.coalesce(F.try_element_at(pairs, trimmed), trimmed)


def canonical_by_table(df: DataFrame, column: str, mapping: DataFrame, into: str) -> DataFrame:
    """As :func:`canonical` with a mapping table (label, canonical_label) of any size; the raw label is kept.

    A label listed more than once counts with its first canonical label in order of name, see
    :func:`mapping_conflicts`, so no row is ever multiplied.
    """
    known = mapping.groupBy(clean_label(F.col("label")).alias("_label")).agg(F.min("canonical_label").alias("_canonical"))
    trimmed = F.coalesce(clean_label(ref(column)), F.lit(""))
    joined = df.withColumn("_trimmed", trimmed).join(known, F.col("_trimmed") == F.col("_label"), "left")
    return joined.withColumn(into, F.coalesce("_canonical", "_trimmed")).drop("_label", "_canonical", "_trimmed")


def mapping_conflicts(mapping: DataFrame) -> DataFrame:
    """(label, canonical_labels) of the labels that a mapping sends to several canonical labels."""
    by_label = mapping.groupBy(clean_label(F.col("label")).alias("label")).agg(F.sort_array(F.collect_set("canonical_label")).alias("canonical_labels"))
    return by_label.where(F.size("canonical_labels") > 1)


def pivot_counts(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts of ``columns`` values per ``rows`` value; combinations that do not occur are 0."""
    return df.groupBy(ref(rows)).pivot(columns, values).count().na.fill(0)


def header_labels(df: DataFrame, column: str) -> list[str]:
    """Sorted labels of a dimension table that become the header of a wide table.

    A header lives on the driver like any column name. More labels than Spark's own pivot limit raise an error.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = df.select(ref(column).alias("label")).where(ref(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} labels, too many for a table header")
    return sorted(row.label for row in rows)


def resolve_column(df: DataFrame, name: str) -> str:
    """Actual name of a column given in any case; error when none or several match."""
    matches = [column for column in df.columns if column.strip().upper() == name.strip().upper()]
    if len(matches) != 1:
        raise ValueError(f"{name!r} matches {matches or 'no column'}")
    return matches[0]


def densify(df: DataFrame, rows: DataFrame, row: str, column: str, labels: list[str], value: str = "value") -> DataFrame:
    """Every (row, column) cell of the table; a cell without data is a row with NULL value.

    Goes through the wide form: one grouped pass, then one join with the row dimension. Nothing is multiplied out
    before the aggregation.
    """
    wide = df.groupBy(ref(row)).pivot(column, labels).agg(F.sum(ref(value)))
    full = rows.select(ref(row)).distinct().join(wide, row, "left")
    return full.unpivot([quoted(row)], [quoted(label) for label in labels], column, value)


def missing_cells(df: DataFrame, rows: DataFrame, row: str, column: str, labels: list[str]) -> DataFrame:
    """(row, column) keys that the dimensions allow and the table lacks. Emits the missing keys only.

    The set gathered per row holds header labels only, so it never exceeds the header.
    """
    present = (
        df.where(ref(column).isin(labels)).groupBy(ref(row)).agg(F.collect_set(ref(column)).alias("_present"))
    )
    nothing = F.array().cast("array<string>")
    everything = F.array(*[F.lit(label) for label in labels])
    return (
        rows.select(ref(row))
        .distinct()
        .join(present, row, "left")
        .select(ref(row), F.explode(F.array_except(everything, F.coalesce("_present", nothing))).alias(column))
    )
