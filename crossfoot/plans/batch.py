"""A loaded source as one batch: its tables, their shapes, and the rules that apply to them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from crossfoot.config import CrosstabSpec, Tolerance
from crossfoot.operators.reshape import flat_list, union_all, unpivot_categories, unpivot_matrix
from crossfoot.schemas import CRITICAL, ERROR
from crossfoot.sources.crosstab import COLUMN, GRAND, ROW, Source, reported_totals, require_tables, stage_metadata
from crossfoot.sources.layout import Sheet, read_sheet, sheet_metadata


@dataclass(frozen=True)
class LabelRule:
    """Every domain label of ``column`` occurs in ``table`` and, if ``symmetric``, no other label does."""

    check_id: str
    table: str
    column: str
    symmetric: bool
    severity: str


@dataclass(frozen=True)
class Rules:
    """What a run knows about its tables beyond the specification of each.

    ``flat`` names the value column of flat lists. ``total_ids`` gives the check of each printed total (table, axis),
    ``cross_foot_ids`` that of each table whose printed totals must add up to its corner. ``reshaped`` lists tables whose
    cells must all arrive in the long form. ``reconcile(long, reported, entities, exceptions, tolerance)`` returns
    reconciliation rows; without it tables are not compared with each other.
    """

    crosstabs: dict[str, CrosstabSpec]
    flat: dict[str, str] = field(default_factory=dict)
    total_ids: dict[tuple[str, str], str] = field(default_factory=dict)
    cross_foot_ids: dict[str, str] = field(default_factory=dict)
    label_rules: tuple[LabelRule, ...] = ()
    reshaped: tuple[str, ...] = ()
    reconcile: Callable[[dict[str, DataFrame], DataFrame, DataFrame, tuple[str, ...], Tolerance], DataFrame] | None = None


@dataclass(frozen=True)
class Batch:
    """Wide tables of one source with the dimension of their entities. ``sheets`` are the raw sheets they came from."""

    wide: dict[str, DataFrame]
    entities: DataFrame
    labels: list[str]
    rules: Rules
    sheets: dict[str, Sheet] = field(default_factory=dict)

    def long(self) -> dict[str, DataFrame]:
        """Every table in long form by its shape: flat list, matrix (one label column) or categories by entity."""
        return {name: self._long(name) for name in self.wide}

    def _long(self, name: str) -> DataFrame:
        df, spec = self.wide[name], self.rules.crosstabs[name]
        if name in self.rules.flat:
            return flat_list(df, spec, self.rules.flat[name])
        return unpivot_matrix(df, spec) if len(spec.label_columns) == 1 else unpivot_categories(df, spec)

    def totals(self) -> DataFrame:
        """Printed totals of every table that has any; tables without a role column print none."""
        rules = self.rules
        frames = [
            reported_totals(df, rules.crosstabs[name], rules.flat.get(name))
            for name, df in self.wide.items()
            if rules.crosstabs[name].row_role in df.columns and len(rules.crosstabs[name].label_columns) > 1
        ]
        if frames:
            return union_all(frames)
        return self.entities.sparkSession.createDataFrame([], "table_name string, axis string, entity string, value double")

    def metadata(self) -> DataFrame:
        """One row per table; title and places of header, body and totals where the table came from a sheet."""
        rows = None
        for name, df in self.wide.items():
            spec, flat = self.rules.crosstabs[name], self.rules.flat.get(name)
            sheet = self.sheets.get(name)
            one = sheet_metadata(Sheet(df, sheet.layout), spec, flat) if sheet else stage_metadata(df, spec, flat)
            one = one.withColumn("reported_total", one["reported_total"].cast("double"))
            rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
        return rows


def batch_of_source(source: Source, rules: Rules, entities: DataFrame) -> Batch:
    """A source read by ``load_source``."""
    require_tables(list(source.tables), list(rules.crosstabs))
    return Batch(dict(source.tables), entities, _entity_names(source.tables, rules), rules)


def batch_of_sheets(spark: SparkSession, paths: dict[str, str], rules: Rules, entities: DataFrame) -> Batch:
    """Raw sheets, split by position and label; an expected sheet that is absent stops the run before any work."""
    require_tables(list(paths), list(rules.crosstabs))
    sheets = {name: read_sheet(spark, paths[name], spec) for name, spec in rules.crosstabs.items()}
    wide = {name: sheet.table for name, sheet in sheets.items()}
    return Batch(wide, entities, _entity_names(wide, rules), rules, sheets)


def _entity_names(tables: dict[str, DataFrame], rules: Rules) -> list[str]:
    """Header labels of the tables in order of appearance; flat lists have none."""
    names: dict[str, None] = {}
    for name, df in tables.items():
        if name not in rules.flat:
            names |= dict.fromkeys(c for c in df.columns if not rules.crosstabs[name].is_reserved(c))
    return list(names)


#: Label rules, printed totals and corners of the five tables that ``plans/flow.py`` derives. Check ids.
FLOW_LABELS = (
    LabelRule("CMP-06", "summary", "code", True, ERROR),
    LabelRule("CMP-07", "matrix", "origin", False, CRITICAL),
)
FLOW_TOTALS = {
    ("summary", GRAND): "REC-V01",
    ("outward", COLUMN): "REC-V02",
    ("inward", COLUMN): "REC-V03",
    ("inward", ROW): "REC-V04",
    ("internal", COLUMN): "REC-V06",
    ("internal", ROW): "REC-V07",
}
FLOW_CORNERS = {"inward": "REC-V05", "internal": "REC-V08"}
