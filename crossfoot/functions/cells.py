"""Cell-level cleaning: labels, numbers, blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.runtime import ref

_BLANKS = " \t\n\r\f\v "
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"


def clean_label(label: Column) -> Column:
    """Label without surrounding white space; inner white space and spelling stay."""
    return F.trim(label.cast("string"), F.lit(_BLANKS))


def is_filled(cell: Column) -> Column:
    """True for a cell that is neither NULL nor blank."""
    return F.coalesce(F.length(clean_label(cell)) > 0, F.lit(False))


def is_number_text(text: Column) -> Column:
    """True when the whole text is a number. Spark alone would also accept ``3d``."""
    trimmed = clean_label(text)
    return trimmed.rlike(_NUMBER) | trimmed.rlike(_INFINITE)


def text_to_double(text: Column) -> Column:
    """Number held in a text cell, NULL for anything else."""
    trimmed = clean_label(text)
    infinite = F.when(trimmed.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double")).when(trimmed.rlike(_INFINITE), infinite)


def numeric(df: DataFrame, name: str) -> Column:
    """Numeric view of a column whatever its stored type: text is parsed, NaN counts as NULL."""
    kind = df.schema[name].dataType
    column = ref(name)
    if isinstance(kind, T.StringType):
        return text_to_double(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    if isinstance(kind, T.NumericType):
        return column
    return column.try_cast("double")


def is_non_numeric(df: DataFrame, name: str) -> Column:
    """True for a present value that is not a number."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.lit(False)
    column = ref(name)
    return column.isNotNull() & ~F.coalesce(is_number_text(column.cast("string")), F.lit(False))


def is_infinite(value: Column) -> Column:
    return F.coalesce(F.abs(value.cast("double")) == F.lit(float("inf")), F.lit(False))


def inferred_type(cell: Column) -> Column:
    """Type name a text cell would be given: empty, number or text."""
    return F.when(~is_filled(cell), "empty").when(is_number_text(cell), "number").otherwise("text")


def sentence(*parts) -> Column:
    """Concatenation of literals and columns for a message; a NULL part is left out."""
    return F.concat_ws("", *[part if isinstance(part, Column) else F.lit(part) for part in parts])
