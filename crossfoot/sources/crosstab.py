"""Published wide tables: reading, splitting off the published totals, staging raw cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crossfoot.config import CrosstabSpec
from crossfoot.functions.cells import clean_label, is_filled, numeric
from crossfoot.runtime import inline_cells, literal, quoted, ref

BODY, FOOTER = "BODY", "FOOTER"
COLUMN, ROW, GRAND = "COLUMN", "ROW", "GRAND"


class MissingTablesError(ValueError):
    """A source lacks tables that the run needs."""


def require_tables(available: list[str], expected: list[str]) -> list[str]:
    """Stops the run before any work when an expected table is absent."""
    missing = [name for name in expected if name not in set(available)]
    if missing:
        raise MissingTablesError(f"missing tables: {missing}")
    return expected


def available_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables below ``folder``: one file or sub-folder each. Lists paths only, reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    inside = F.element_at(F.split("path", F.lit(folder.rstrip("/") + "/"), 2), -1)
    name = F.regexp_replace(F.element_at(F.split(inside, "/"), 1), r"\.[A-Za-z]+$", "")
    return sorted(row.name for row in files.select(name.alias("name")).distinct().collect())


def number_source_rows(df: DataFrame, name: str = "source_row") -> DataFrame:
    """1-based row number in file order, for rows read straight from files: by file name, then by place in the file.

    Spark reads a file in blocks, in any order. One grouping counts the rows of each block, and the blocks before it give
    the number of its first row. The block's own first id ends the dependence on how blocks were dealt to tasks.
    """
    place = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id()}
    marked = df.select("*", *[column.alias(alias) for alias, column in place.items()])
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        marked.groupBy("_file", "_block")
        .agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
        .select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    numbered = marked.join(starts, ["_file", "_block"]).withColumn(name, F.col("_start") + F.col("_id") - F.col("_first") + 1)
    return numbered.select(*[ref(column) for column in df.columns], name)


def read_crosstab(
    spark: SparkSession, path: str, spec: CrosstabSpec, fmt: str = "csv", typed: bool = True, **options: str
) -> DataFrame:
    """One wide table from CSV or any other Spark format.

    Header and row labels are trimmed, blank cells become NULL. ``typed`` parses the value cells; without it text
    cells stay text so that the checks can report what does not parse.
    """
    settings = {"header": "true", **options} if fmt == "csv" else options
    raw = spark.read.format(fmt).options(**settings).load(path)
    raw = raw.toDF(*[name.strip() for name in raw.columns])
    if spec.source_row not in raw.columns:
        raw = number_source_rows(raw, spec.source_row)
    return tidy_crosstab(raw, spec, typed)


def tidy_crosstab(df: DataFrame, spec: CrosstabSpec, typed: bool = True) -> DataFrame:
    """Trims the labels and turns the value cells into numbers (or blank-free text)."""

    def cell(name: str) -> Column:
        if name in spec.label_columns or name == spec.row_role:
            return clean_label(ref(name)).alias(name)
        if name == spec.source_row:
            return ref(name)
        value = numeric(df, name) if typed else F.when(is_filled(ref(name)), ref(name))
        return value.alias(name)

    return df.select(*[cell(name) for name in df.columns])


def entity_columns(df: DataFrame, spec: CrosstabSpec) -> list[str]:
    """Header labels that stand for entities; labels, roles and totals are not entities."""
    return [name for name in df.columns if not spec.is_reserved(name)]


def body(df: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """Rows of the table proper, without the published footer."""
    if spec.row_role not in df.columns:
        return df
    return df.where(F.coalesce(ref(spec.row_role), F.lit(BODY)) == BODY)


def footer(df: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """The published footer row."""
    return df.where(ref(spec.row_role) == FOOTER)


def reported_totals(df: DataFrame, spec: CrosstabSpec, flat_value: str | None = None) -> DataFrame:
    """Published totals of one table as (table_name, axis, entity, value).

    COLUMN: footer cell of each entity. ROW: total column of each body row. GRAND: footer cell of the total column,
    or of ``flat_value`` for a flat list.
    """
    table = F.lit(spec.name).alias("table_name")
    corner = flat_value or spec.total_column
    entities = [name for name in entity_columns(df, spec) if name != flat_value]
    cells = [{"axis": literal(COLUMN), "entity": literal(e), "value": quoted(e)} for e in entities]
    if corner:
        cells.append({"axis": literal(GRAND), "entity": literal(GRAND), "value": quoted(corner)})
    bottom = footer(df, spec).select(table, inline_cells(cells))
    if not spec.total_column:
        return bottom
    side = body(df, spec).select(
        table, F.lit(ROW).alias("axis"), ref(spec.row_label).alias("entity"), ref(spec.total_column).alias("value")
    )
    return bottom.unionByName(side)


@dataclass(frozen=True)
class Source:
    """Tables of one source and where each came from."""

    tables: dict[str, DataFrame]
    provenance: DataFrame


def load_source(
    spark: SparkSession, paths: dict[str, str], specs: dict[str, CrosstabSpec], fmt: str = "csv", typed: bool = True
) -> Source:
    """Every table of ``specs`` plus (table_name, source_file, source_path, loaded_at)."""
    require_tables(list(paths), list(specs))
    tables = {name: read_crosstab(spark, paths[name], spec, fmt, typed) for name, spec in specs.items()}
    rows = [(name, paths[name].rstrip("/").rsplit("/", 1)[-1], paths[name]) for name in specs]
    origin = spark.createDataFrame(rows, "table_name string, source_file string, source_path string")
    return Source(tables, origin.withColumn("loaded_at", F.current_timestamp()))


def stage_cells(df: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """Raw body cells in long form with their place in the source.

    (table_name, labels…, entity, value, is_summary, source_row, source_col); one pass, no shuffle.
    """
    positions = [name for name in df.columns if name not in (spec.row_role, spec.source_row)]
    cells = [
        {
            "entity": literal(name),
            "value": quoted(name),
            "is_summary": str(name == spec.total_column).lower(),
            "source_col": str(position),
        }
        for position, name in enumerate(positions, start=1)
        if name not in spec.label_columns
    ]
    kept = [ref(name) for name in (*spec.label_columns, spec.source_row) if name in df.columns]
    return body(df, spec).select(F.lit(spec.name).alias("table_name"), *kept, inline_cells(cells))


def stage_metadata(df: DataFrame, spec: CrosstabSpec, flat_value: str | None = None) -> DataFrame:
    """One row per table: rows, columns, blank cells, published grand total, published entity totals as JSON."""
    entities = entity_columns(df, spec)
    corner = flat_value or spec.total_column
    is_footer = ref(spec.row_role) == FOOTER if spec.row_role in df.columns else F.lit(False)
    blanks = F.expr(" + ".join(["0L", *[f"cast({quoted(name)} IS NULL AS bigint)" for name in entities]]))
    published = [name for name in entities if name != flat_value]
    by_entity = F.to_json(F.expr(f"map({', '.join(f'{literal(name)}, {quoted(name)}' for name in published)})"))
    has_totals = spec.row_role in df.columns
    return df.agg(
        F.count_if(~is_footer).alias("row_count"),
        F.lit(len([name for name in df.columns if name not in (spec.row_role, spec.source_row)])).alias("column_count"),
        F.coalesce(F.sum(F.when(~is_footer, blanks)), F.lit(0)).alias("null_cells_count"),
        (F.max(F.when(is_footer, ref(corner))) if corner and has_totals else F.lit(None).cast("double")).alias(
            "reported_total"
        ),
        (F.max(F.when(is_footer, by_entity)) if published and has_totals else F.lit(None).cast("string")).alias(
            "reported_entity_totals"
        ),
    ).select(F.lit(spec.name).alias("table_name"), "*")
