"""Parameters of the operators. Nothing here names a concrete entity or data set."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tolerance:
    """Bounds within which two amounts agree.

    ``zero_expected`` decides what happens when the expected amount is 0 and no relative difference exists:
    ``"absolute"`` leaves the decision to the absolute bound, ``"pass"`` counts the relative difference as 0.
    """

    absolute: float = 1e-4
    relative: float = 1e-7
    zero_expected: str = "absolute"


@dataclass(frozen=True)
class StatsConfig:
    """Thresholds of the snapshot comparison. ``bins`` names dimensions with another number of bins than ``n_bins``."""

    alpha: float = 0.05
    psi_moderate: float = 0.10
    psi_significant: float = 0.25
    psi_epsilon: float = 1e-4
    min_sample_size: int = 5
    n_bins: int = 10
    change_threshold_pct: float = 25.0
    bins: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class CrosstabSpec:
    """Shape of a published wide table: label columns, then one value column per entity.

    ``total_column`` is the published row-total column, if the table has one. ``row_role`` tells body rows from
    the published footer row. Every other column is an entity.
    """

    name: str
    label_columns: tuple[str, ...]
    total_column: str | None = None
    row_role: str = "row_role"
    source_row: str = "source_row"

    @property
    def row_label(self) -> str:
        return self.label_columns[0]

    def is_reserved(self, column: str) -> bool:
        reserved = (*self.label_columns, self.row_role, self.source_row, self.total_column)
        return column in reserved


@dataclass(frozen=True)
class TableSpec:
    """What the checks need to know about one long table.

    ``domains`` maps a column to the one-column DataFrame (or list) of its allowed labels; ``expected_from`` names
    the columns whose domains multiply to the expected row count.
    """

    name: str
    required: tuple[str, ...]
    key: tuple[str, ...]
    value: str = "value"
    code: str | None = None
    code_pattern: str = "^[0-9]{2}$"
    entities: tuple[str, ...] = ()
    expected_from: tuple[str, ...] = ()
    expected_nulls: int | None = None
    domains: dict[str, DataFrame | list[str]] = field(default_factory=dict)
