"""Checks of several long tables in one pass: the tables are stacked and every count is taken once for all of them.

The cells of all tables are grouped by natural key, those sums by label, those by face, and the few face rows by table.
A face is one way of looking at a table: ``GRAND`` (all rows under one label), each key column that is a code, an entity
or spans the table, and ``entities`` where several columns share one domain. Domain labels and published totals are
stacked next to the observed labels, so that membership, absence and totals need no join. Every grouping is combined
before its shuffle; a label of a third of the rows is one row per task.

Key columns are compared as text. NaN counts as NULL. Exact numbers are summed as decimals, others as doubles, each by
itself, so a text column in one table does not blur the sums of another.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.config import TableSpec, Tolerance
from crossfoot.functions.cells import is_infinite, is_non_numeric, numeric
from crossfoot.operators.checks import Domain
from crossfoot.operators.results import Sql, as_sql
from crossfoot.runtime import literal, materialize, ref
from crossfoot.sources.crosstab import COLUMN, GRAND, ROW

ENTITIES, WIDE = "entities", "wide"
COUNTS = ("n", "n_duplicates", "n_non_numeric", "n_negative", "n_infinite", "n_null")
#: Labels that a message names; each is found by a limited window, so no task holds more than this many per face.
EXAMPLES = 3


@dataclass(frozen=True)
class Face:
    """``columns`` of a table seen as labels, and the labels they may hold."""

    name: str
    columns: tuple[str, ...]
    domain: Domain | None = None


def faces(spec: TableSpec) -> list[Face]:
    names = list(dict.fromkeys((*spec.expected_from, *([spec.code] if spec.code else []), *spec.entities)))
    found = [Face(GRAND, ()), *[Face(name, (name,), spec.domains.get(name)) for name in names]]
    if len(spec.entities) > 1:
        found.append(Face(ENTITIES, tuple(spec.entities), spec.domains.get(spec.entities[0])))
    return found


def entity_face(spec: TableSpec) -> str:
    return ENTITIES if len(spec.entities) > 1 else spec.entities[0]


def axis_face(spec: TableSpec, axis: str) -> str:
    """Face whose labels carry the published totals of an axis."""
    return {COLUMN: entity_face(spec) if spec.entities else COLUMN, ROW: spec.code or ROW}.get(axis, axis)


def can_stack(df: DataFrame | None, spec: TableSpec) -> bool:
    """True when the table has the columns its checks need, and its labels are part of its key."""
    labels = {name for face in faces(spec) for name in face.columns}
    return df is not None and {*spec.key, spec.value} <= set(df.columns) and labels <= set(spec.key)


def _cells(df: DataFrame, spec: TableSpec, width: int) -> DataFrame:
    stored = df.schema[spec.value].dataType
    value = numeric(df, spec.value)
    exact = isinstance(stored, (T.DecimalType, T.IntegralType))
    missing = ref(spec.value).isNull()
    if isinstance(stored, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(ref(spec.value))
    none = F.lit(None)
    return df.select(
        F.lit(spec.name).alias("table_name"),
        *[(ref(spec.key[i]).cast("string") if i < len(spec.key) else none.cast("string")).alias(f"key_{i}") for i in range(width)],
        (value.cast(stored if isinstance(stored, T.DecimalType) else "decimal(20,0)") if exact else none.cast("decimal(20,0)")).alias("exact"),
        (none.cast("double") if exact else value.cast("double")).alias("approximate"),
        is_non_numeric(df, spec.value).alias("non_numeric"),
        is_infinite(value).alias("infinite"),
        missing.alias("missing"),
    )


def _by_key(tables: dict[str, DataFrame], specs: list[TableSpec]) -> DataFrame:
    width = max(len(spec.key) for spec in specs)
    stack = None
    for spec in specs:
        cells = _cells(tables[spec.name], spec, width)
        stack = cells if stack is None else stack.unionByName(cells)
    negative = (F.col("exact") < 0) | (F.col("approximate") < 0)
    return stack.groupBy("table_name", *[f"key_{i}" for i in range(width)]).agg(
        F.count("*").alias("n"),
        F.when(F.count("*") > 1, F.count("*")).otherwise(0).alias("n_duplicates"),
        F.count_if("non_numeric").alias("n_non_numeric"),
        F.count_if(negative).alias("n_negative"),
        F.count_if("infinite").alias("n_infinite"),
        F.count_if("missing").alias("n_null"),
        F.min(F.when(F.col("exact") < 0, F.col("exact"))).alias("min_exact"),
        F.min(F.when(F.col("approximate") < 0, F.col("approximate"))).alias("min_approximate"),
        F.sum("exact").alias("exact"),
        F.sum("approximate").alias("approximate"),
    )


def _faced(keyed: DataFrame, specs: list[TableSpec]) -> DataFrame:
    """One row per key and label it counts for."""
    cases = []
    for spec in specs:
        place = {name: f"key_{i}" for i, name in enumerate(spec.key)}
        labels = [f"struct({literal(face.name)} AS face, {place[c]} AS label)" for face in faces(spec) for c in face.columns]
        labels.append(f"struct({literal(GRAND)} AS face, {literal(GRAND)} AS label)")
        cases.append(f"WHEN {literal(spec.name)} THEN array({', '.join(labels)})")
    kept = [c for c in keyed.columns if not c.startswith("key_")]
    return keyed.select(*kept, F.expr(f"inline(CASE table_name {' '.join(cases)} END)"))


def _domain_labels(spark: SparkSession, specs: list[TableSpec]) -> list[DataFrame]:
    """(table_name, face, label, expected) of every domain; a domain that many faces share is read once."""
    users: dict[int, tuple[Domain, list[str]]] = {}
    for spec in specs:
        for face in faces(spec):
            if face.domain is not None:
                place = f"struct({literal(spec.name)} AS table_name, {literal(face.name)} AS face)"
                users.setdefault(id(face.domain), (face.domain, []))[1].append(place)
    frames = []
    for domain, places in users.values():
        if isinstance(domain, DataFrame):
            labels = domain.select(ref(domain.columns[0]).cast("string").alias("label")).where(F.col("label").isNotNull())
        else:
            labels = spark.createDataFrame([(label,) for label in sorted(set(domain))], T.StructType().add("label", "string"))
        frames.append(labels.select("label", F.expr(f"inline(array({', '.join(places)}))"), F.lit(True).alias("expected")))
    return frames


def label_metrics(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    specs: list[TableSpec],
    reported: DataFrame | None = None,
    widths: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(table_name, face, label, counts, sums, expected, published total) of every observed, allowed or published label.

    ``widths`` maps a table to rows ``n_cells`` that its wide form holds.
    """
    here = [spec for spec in specs if can_stack(tables.get(spec.name), spec)]
    parts = [_faced(_by_key(tables, here), here)] if here else []
    parts += _domain_labels(spark, here)
    if reported is not None:
        moved = [(spec.name, axis, axis_face(spec, axis)) for spec in specs for axis in (COLUMN, ROW)]
        cases = " ".join(f"WHEN table_name = {literal(t)} AND axis = {literal(a)} THEN {literal(f)}" for t, a, f in moved)
        parts.append(
            reported.select(
                "table_name", F.expr(f"CASE {cases} ELSE axis END").alias("face"), F.col("entity").alias("label"),
                F.lit(1).alias("n_reported"), F.col("value").isNotNull().cast("int").alias("n_filled"), F.col("value").alias("reported"),
            )
        )
    for name, df in (widths or {}).items():
        parts.append(df.select(F.lit(name).alias("table_name"), F.lit(WIDE).alias("face"), F.lit(WIDE).alias("label"), F.col("n_cells").alias("n")))
    parts.append(spark.createDataFrame([], _NOTHING))
    stack = parts[0]
    for part in parts[1:]:
        stack = stack.unionByName(part, allowMissingColumns=True)
    return stack.groupBy("table_name", "face", "label").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in COUNTS],
        F.min("min_exact").alias("min_exact"),
        F.min("min_approximate").alias("min_approximate"),
        F.sum("exact").alias("exact"),
        F.sum("approximate").alias("approximate"),
        F.coalesce(F.bool_or("expected"), F.lit(False)).alias("expected"),
        F.coalesce(F.sum("n_reported"), F.lit(0)).alias("n_reported"),
        F.coalesce(F.sum("n_filled"), F.lit(0)).alias("n_filled"),
        F.sum("reported").alias("summed"),
        F.max("reported").alias("reported"),
    )


# Columns that a part may lack, so that all of them exist whatever is given.
_NOTHING = (
    "table_name string, face string, label string, n bigint, n_duplicates bigint, n_non_numeric bigint, n_negative bigint,"
    " n_infinite bigint, n_null bigint, min_exact decimal(20,0), min_approximate double, exact decimal(20,0), approximate double,"
    " expected boolean, n_reported int, n_filled int, reported decimal(20,0)"
)


def _cases(pairs: dict[tuple[str, str], str], otherwise: str) -> str:
    rows = " ".join(f"WHEN table_name = {literal(t)} AND face = {literal(f)} THEN {text}" for (t, f), text in pairs.items())
    return f"CASE {rows} ELSE {otherwise} END" if rows else otherwise


def face_metrics(
    labels: DataFrame, specs: list[TableSpec], tolerance: Tolerance = Tolerance(), kept: tuple[str, str] | None = None
) -> DataFrame:
    """(table_name, m): per table a map from face to its metrics, every face of every table included.

    ``kept`` names a spelling that should occur and one that should not. ``labels`` is read twice, see
    :func:`stacked_metrics`.
    """
    keys = ("table_name", "face")
    limited = F.expr(_cases({(s.name, f.name): str(f.domain is not None).lower() for s in specs for f in faces(s)}, "false"))
    pattern = F.expr(_cases({(s.name, s.code): f"label RLIKE {literal(s.code_pattern)}" for s in specs if s.code}, "true"))
    seen = F.col("n") > 0
    extra, absent = seen & ~F.col("expected") & limited, F.col("expected") & ~seen
    valid = F.coalesce(pattern & (F.col("expected") | ~limited), F.lit(False))
    total = seen | (F.col("n_reported") > 0)
    other = F.coalesce("approximate", F.lit(0.0))
    difference = F.when(F.col("exact").isNull(), F.abs(other - F.col("reported").cast("double"))).when(
        F.col("approximate").isNull(), F.abs(F.col("exact") - F.col("reported")).cast("double")
    ).otherwise(F.abs(F.col("exact").cast("double") + other - F.col("reported").cast("double")))
    within = F.coalesce(difference <= tolerance.absolute, F.lit(False))
    right, wrong = kept or (None, None)

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("long")

    sums = {
        **{name: F.col(name) for name in COUNTS},
        "n_bad_codes": F.when(valid, 0).otherwise(F.col("n")),
        "n_expected": flag(F.col("expected")),
        "n_extra": flag(extra),
        "n_absent": flag(absent),
        "n_totals": flag(total),
        "n_off": flag(total & ~within),
        "n_unpublished": flag(total & F.col("reported").isNull()),
        "n_reported": F.col("n_reported"),
        "n_filled": F.col("n_filled"),
        "n_kept": flag(seen & (F.col("label") == F.lit(right))),
        "n_corrected": flag(seen & (F.col("label") == F.lit(wrong))),
    }
    rows = labels.select(
        *keys, *[value.alias(name) for name, value in sums.items()], "min_exact", "min_approximate", "summed", "reported",
        F.when(total, difference).alias("worst"),
    )
    kind = F.when(extra, "extra").when(absent, "absent")
    order = Window.partitionBy(*keys, "kind").orderBy("example")
    examples = (
        labels.select(*keys, kind.alias("kind"), F.coalesce("label", F.lit("NULL")).alias("example"))
        .where(F.col("kind").isNotNull())
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= EXAMPLES)
        .drop("place")
    )
    names = [(s.name, f) for s in specs for f in (*[face.name for face in faces(s)], WIDE)]
    seeds = labels.sparkSession.createDataFrame(names, "table_name string, face string")
    stack = rows.unionByName(examples, allowMissingColumns=True).unionByName(seeds, allowMissingColumns=True)

    def first(which: str) -> Column:
        return F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == which, F.col("example")))), ", ").alias(f"{which}_examples")

    by_face = stack.groupBy(*keys).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        F.coalesce(F.min("min_exact").cast("string"), F.min("min_approximate").cast("string")).alias("min_negative"),
        F.sum("summed").alias("summed"),
        F.max("reported").alias("grand"),
        F.max("worst").alias("worst"),
        first("extra"),
        first("absent"),
    )
    metrics = F.struct(*[c for c in by_face.columns if c not in keys])
    return by_face.groupBy("table_name").agg(F.map_from_entries(F.collect_list(F.struct("face", metrics))).alias("m"))


def at(face: str, name: str) -> Sql:
    """SQL text of one metric of one face of :func:`face_metrics`."""
    return Sql(f"m[{literal(face)}].{name}")


def stacked_metrics(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    specs: list[TableSpec],
    reported: DataFrame | None = None,
    widths: dict[str, DataFrame] | None = None,
    tolerance: Tolerance = Tolerance(),
    kept: tuple[str, str] | None = None,
) -> DataFrame:
    """:func:`face_metrics` plus the columns that count checks read.

    The label rows are written once, because the counts and the named examples both read them; without that the cells
    would be grouped twice.
    """
    labels = materialize(label_metrics(spark, tables, specs, reported, widths))
    wanted = {s.name: " * ".join(["1L", *[at(name, "n_expected") for name in s.expected_from]]) for s in specs}
    codes = {s.name: at(s.code, "n_bad_codes") for s in specs if s.code}

    def by_table(texts: dict[str, str]) -> Column:
        cases = " ".join(f"WHEN {as_sql(name)} THEN {text}" for name, text in texts.items())
        return F.expr(f"CASE table_name {cases} END" if cases else "0L")

    return face_metrics(labels, specs, tolerance, kept).select(
        "table_name",
        "m",
        F.expr(at(GRAND, "n")).alias("n_rows"),
        *[F.expr(at(GRAND, name)).alias(name) for name in (*COUNTS[1:], "min_negative")],
        by_table(codes).alias("n_bad_codes"),
        by_table(wanted).alias("expected_rows"),
    )
