"""Sheets as they are published: a title, a header, the table, its printed totals and notes, all in one text file.

Nothing tells the parts apart but where they stand and what their cells say. The header is the first row with the label
columns side by side, wherever they begin. The printed totals are the first row below it whose label says so; without
one, the last row with values if its label cell is blank. The table is what stands between, without blank rows; where no
totals are printed it ends at the first blank row. What follows are notes.

Lines are numbered over all blocks of the file, whatever order Spark reads them in, and parsed once. Finding the layout
takes four aggregates of one row each; rows themselves are split in one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.config import CrosstabSpec
from crossfoot.runtime import materialize, quoted, ref
from crossfoot.sources.crosstab import BODY, FOOTER, footer, number_source_rows, stage_metadata, tidy_crosstab

#: Labels of a row of printed totals.
TOTAL_LABEL = r"(?i)^(grand\s+|sub-?\s*)?totals?\b.*"


class LayoutError(ValueError):
    """A sheet has no header with the expected labels, or two columns of one name."""


@dataclass(frozen=True)
class SheetLayout:
    """Where the parts of a sheet stand; rows and columns count from 1, None where a part is absent."""

    table_name: str
    title: str | None
    header_row: int
    data_start_row: int | None
    data_end_row: int | None
    footer_row: int | None
    first_col: int
    last_col: int
    columns: tuple[tuple[int, str], ...]


@dataclass(frozen=True)
class Sheet:
    """A table with its roles and source rows, ready for the crosstab operators, and the layout it came from."""

    table: DataFrame
    layout: SheetLayout


def sheet_cells(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """(source_row, cells) of every line; cells are trimmed, blank ones NULL. Quoted cells hold no line ends.

    Written once: every later look at a cell would otherwise parse its line again.
    """
    lines = number_source_rows(spark.read.text(path))
    # Separators within quotes count too, so this is enough columns and maybe more; those beyond the header go.
    width = lines.agg(F.max(F.length("value") - F.length(F.replace(F.col("value"), F.lit(separator), F.lit(""))))).first()[0]
    names = [f"c{i}" for i in range((width or 0) // len(separator) + 1)]
    parsed = F.from_csv("value", F.lit(", ".join(f"{n} STRING" for n in names)), {"sep": separator, "escape": '"'})
    cells = lines.select("source_row", parsed.alias("row")).select("source_row", F.array(*[F.col(f"row.{n}") for n in names]).alias("cells"))
    return materialize(cells.select("source_row", F.transform("cells", lambda c: F.nullif(F.trim(c), F.lit(""))).alias("cells")))


def _header(cells: DataFrame, spec: CrosstabSpec) -> tuple[int, int, list[str | None]]:
    """Row of the header, place of its first label, and its cells from there on."""
    wanted = [label.strip().lower() for label in spec.label_columns]
    lowered = F.transform("cells", lambda c: F.lower(c))
    place = F.array_position(lowered, wanted[0]).cast("int")
    matches = F.coalesce((place > 0) & (F.slice(lowered, F.greatest(place, F.lit(1)), len(wanted)) == F.array(*map(F.lit, wanted))), F.lit(False))
    found = cells.filter(matches).agg(F.min(F.struct("source_row", place.alias("place"), "cells")).alias("first")).first()["first"]
    if found is None:
        raise LayoutError(f"{spec.name}: no row holds the labels {list(spec.label_columns)}")
    return found["source_row"], found["place"], found["cells"][found["place"] - 1 :]


def locate_layout(cells: DataFrame, spec: CrosstabSpec, total_label: str = TOTAL_LABEL) -> SheetLayout:
    """The parts of a sheet; only single rows reach the driver."""
    header_row, first_col, names = _header(cells, spec)
    n_labels = len(spec.label_columns)
    columns = [(first_col + i, spec.label_columns[i] if i < n_labels else name) for i, name in enumerate(names) if name is not None]
    doubled = sorted({name for _, name in columns if [n for _, n in columns].count(name) > 1})
    if doubled:
        raise LayoutError(f"{spec.name}: columns {doubled} stand in the header more than once")

    def cell(place: int) -> Column:
        return F.col("cells")[place - 1]

    row, below = F.col("source_row"), F.col("source_row") > header_row
    labels = [cell(place) for place, _ in columns[:n_labels]]
    values = F.array(*[cell(place) for place, _ in columns[n_labels:]])
    has_values = F.exists(values, lambda c: c.isNotNull())
    says_total = F.exists(F.array(*labels), lambda c: F.coalesce(F.rlike(c, F.lit(total_label)), F.lit(False)))
    blank = ~has_values & ~F.exists(F.array(*labels), lambda c: c.isNotNull())
    titled = F.struct(row, F.filter("cells", lambda c: c.isNotNull())[0].alias("text"))
    found = cells.agg(
        F.min(F.when((row < header_row) & F.exists("cells", lambda c: c.isNotNull()), titled)).alias("title"),
        F.min(F.when(below & has_values & says_total, row)).alias("by_label"),
        F.max(F.when(below & has_values, F.struct(row, labels[0].isNull().alias("unlabelled")))).alias("last"),
        F.min(F.when(below & blank, row)).alias("blank"),
        F.max(F.when(below, row)).alias("end"),
    ).first()
    by_place = found["last"]["source_row"] if found["last"] is not None and found["last"]["unlabelled"] else None
    footer_row = found["by_label"] or by_place
    stop = footer_row or found["blank"] or (found["end"] or header_row) + 1
    body = cells.filter(below & (row < stop) & ~blank).agg(F.min(row).alias("first"), F.max(row).alias("last")).first()
    title = found["title"]["text"] if found["title"] else None
    return SheetLayout(spec.name, title, header_row, body["first"], body["last"], footer_row, first_col, columns[-1][0], tuple(columns))


def split_sheet(cells: DataFrame, layout: SheetLayout, spec: CrosstabSpec, typed: bool = True) -> DataFrame:
    """Body and printed totals of a located sheet as one wide table with ``row_role`` and ``source_row``."""
    row = F.col("source_row")
    in_body = row.between(layout.data_start_row, layout.data_end_row) if layout.data_start_row else F.lit(False)
    filled = F.exists(F.array(*[F.col("cells")[place - 1] for place, _ in layout.columns]), lambda c: c.isNotNull())
    is_footer = row == layout.footer_row if layout.footer_row else F.lit(False)
    role = F.when(is_footer, FOOTER).when(in_body & filled, BODY)
    named = [F.col("cells")[place - 1].alias(name) for place, name in layout.columns]
    parts = cells.select(*named, role.alias(spec.row_role), row.alias(spec.source_row)).filter(ref(spec.row_role).isNotNull())
    return tidy_crosstab(parts, spec, typed)


def read_sheet(spark: SparkSession, path: str, spec: CrosstabSpec, separator: str = ",", total_label: str = TOTAL_LABEL, typed: bool = True) -> Sheet:
    """A published sheet, split into body and printed totals by position and label."""
    cells = sheet_cells(spark, path, separator)
    layout = locate_layout(cells, spec, total_label)
    return Sheet(split_sheet(cells, layout, spec, typed), layout)


def sheet_metadata(sheet: Sheet, spec: CrosstabSpec, flat_value: str | None = None) -> DataFrame:
    """The table's metadata with its title and the rows and columns its parts stand in."""
    at = sheet.layout
    places = ("header_row", "data_start_row", "data_end_row", "footer_row", "first_col", "last_col")
    return stage_metadata(sheet.table, spec, flat_value).select(
        "*", F.lit(at.title).cast("string").alias("title"), *[F.lit(getattr(at, name)).cast("long").alias(name) for name in places]
    )


def write_sheet(df: DataFrame, spec: CrosstabSpec, path: str, title: str, notes: tuple[str, ...] = (), margin: int = 1) -> None:
    """Print a wide table as publishers do: title, blank line, header, rows by label, totals, blank line, notes.

    ``margin`` blank columns stand on the left. Rows are sorted by range over any number of files, whose names follow
    their order.
    """
    names = [c for c in df.columns if c not in (spec.row_role, spec.source_row)]
    left = [F.lit("").alias(f"m{i}") for i in range(margin)]
    is_footer = F.coalesce(ref(spec.row_role) == FOOTER, F.lit(False)) if spec.row_role in df.columns else F.lit(False)
    line = F.to_csv(F.struct(*left, *[F.coalesce(ref(c).cast("string"), F.lit("")).alias(c) for c in names]), {"escape": '"', "emptyValue": ""})
    rows = df.select(F.when(is_footer, 4).otherwise(3).alias("part"), ref(spec.row_label).cast("string").alias("label"), line.alias("value"))

    def printed(*texts: str) -> str:
        return "," * margin + ",".join('"' + t.replace('"', '""') + '"' for t in texts)

    fixed = [(0, "", printed(title)), (1, "", ""), (2, "", printed(*names)), (5, "", ""), *[(6, f"{i:09d}", printed(note)) for i, note in enumerate(notes)]]
    rest = df.sparkSession.createDataFrame(fixed, "part int, label string, value string")
    rows.unionByName(rest).orderBy("part", "label").select("value").write.text(path)


def printed_total(sheet: Sheet, spec: CrosstabSpec, column: str) -> DataFrame:
    """The printed total of one column; no row where the sheet prints none."""
    return footer(sheet.table, spec).select(F.lit(spec.name).alias("table_name"), F.expr(quoted(column)).alias("value"))
