"""Stacked checks against the checks of each table by itself."""

import pytest
from pyspark.sql import functions as F

from crossfoot.config import TableSpec, Tolerance
from crossfoot.operators import checks, faults, stacked, totals
from crossfoot.operators.results import check_rows

ENTITIES, CODES = ["A", "B", "C"], ["10", "11"]
CELLS = TableSpec(
    "cells", ("code", "entity", "value"), ("code", "entity"), code="code", entities=("entity",),
    expected_from=("code", "entity"), expected_nulls=1, domains={"code": CODES, "entity": ENTITIES},
)
SQUARE = TableSpec(
    "square", ("origin", "destination", "value"), ("origin", "destination"), entities=("origin", "destination"),
    expected_from=("origin", "destination"), domains={"origin": ENTITIES, "destination": ENTITIES},
)
KEY = {"code": "10", "entity": "B"}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(c, e, float(i)) for i, (c, e) in enumerate((c, e) for c in CODES for e in ENTITIES)]
    rows[4] = ("11", "B", None)
    square = [(a, b, i) for i, (a, b) in enumerate((a, b) for a in ENTITIES for b in ENTITIES)]
    return {
        "cells": spark.createDataFrame(rows, "code string, entity string, value double"),
        "square": spark.createDataFrame(square, "origin string, destination string, value bigint"),
    }


def by_stack(spark, tables, specs):
    metrics = stacked.stacked_metrics(spark, tables, specs)
    found = []
    for number, spec in enumerate(specs, start=1):
        face = stacked.entity_face(spec)
        rows = checks.count_checks(spec, number) + [checks.membership_row(spec.name, stacked.at(face, "n_extra"), stacked.at(face, "extra_examples"))]
        found += check_rows(metrics.where(F.col("table_name") == spec.name), rows).collect()
    return sorted(map(str, found))


def by_table(spark, tables, specs):
    found = []
    for number, spec in enumerate(specs, start=1):
        df = tables[spec.name]
        found += checks.table_checks(spark, df, spec, number).collect()
        found += checks.membership_check(df, spec.name, list(spec.entities), spec.domains[spec.entities[0]]).collect()
    return sorted(map(str, found))


@pytest.mark.parametrize(
    "alter",
    [
        lambda df: df,
        lambda df: df.limit(0),
        lambda df: df.union(df),
        lambda df: faults.drop_record(df, KEY),
        lambda df: faults.replace_code(faults.replace_code(df, "code", "10", "999"), "entity", "B", "b"),
        lambda df: df.withColumn("entity", F.concat("entity", "code", F.lit("x"))),
        lambda df: df.withColumn("entity", F.lit(None).cast("string")),
        lambda df: df.withColumn("code", F.when(F.col("code") == "11", F.col("code"))),
        lambda df: faults.drop_entity(df, "entity", "A"),
        lambda df: faults.value_to_text(df, KEY, "CORRUPTED_TEXT"),
        lambda df: faults.value_to_text(df, KEY, "-Infinity"),
        lambda df: faults.shift_value(df, KEY, -50.0),
        lambda df: faults.shift_value(df, KEY, float("nan")),
        lambda df: df.withColumns({name: F.lit(7) for name in ("n", "face", "label", "m", "key_0", "exact", "table_name")}),
    ],
)
def test_stack_equals_each_table(spark, tables, alter):
    altered = {**tables, "cells": alter(tables["cells"])}
    assert by_stack(spark, altered, [CELLS, SQUARE]) == by_table(spark, altered, [CELLS, SQUARE])


def test_absent_labels_name_the_first_three(spark, tables):
    spec = TableSpec(**{**CELLS.__dict__, "domains": {"code": CODES, "entity": ["Z", "Y", "X", "W", *ENTITIES]}})
    m = stacked.stacked_metrics(spark, tables, [spec]).select("m.entity").first().entity
    assert (m.n_expected, m.n_absent, m.absent_examples, m.n_extra) == (7, 4, "W, X, Y", 0)


def test_totals_equal_the_plain_differences(spark, tables):
    reported = spark.createDataFrame(
        [("cells", "COLUMN", "A", 3.0), ("cells", "COLUMN", "B", 1.00005), ("cells", "COLUMN", "D", 5.0), ("cells", "ROW", "10", 4.0),
         ("cells", "ROW", "11", None), ("cells", "GRAND", "GRAND", 11.0)],
        "table_name string, axis string, entity string, value double",
    )
    cells = tables["cells"].select(F.lit("cells").alias("table_name"), "code", "entity", "value")
    computed = totals.computed_totals(cells, ["COLUMN", "ROW", "GRAND"])
    plain = {}
    for r in totals.total_differences(computed, reported, Tolerance()).collect():
        n, bad, absent, worst = plain.get(r.axis, (0, 0, 0, None))
        biggest = max((x for x in (worst, r.difference) if x is not None), default=None)
        plain[r.axis] = (n + 1, bad + (not r.within), absent + (r.reported is None), biggest)
    m = stacked.stacked_metrics(spark, tables, [CELLS, SQUARE], reported).where("table_name = 'cells'").first().m
    seen = {axis: m[stacked.axis_face(CELLS, axis)] for axis in plain}
    assert {axis: (f.n_totals, f.n_off, f.n_unpublished, f.worst) for axis, f in seen.items()} == plain
    assert seen["COLUMN"].summed == pytest.approx(9.00005) and seen["GRAND"].grand == 11.0


def test_text_in_one_table_leaves_decimals_of_another_exact(spark):
    wide = spark.createDataFrame([("10", "A", "123456789012345678.01"), ("11", "A", "0.02")], "code string, entity string, value string")
    exact = wide.withColumn("value", F.col("value").cast("decimal(30,2)"))
    other = TableSpec(**{**CELLS.__dict__, "name": "texts"})
    reported = spark.sql("SELECT 'cells' AS table_name, 'COLUMN' AS axis, 'A' AS entity, CAST('123456789012345678.03' AS DECIMAL(30,2)) AS value")
    labels = stacked.stacked_metrics(spark, {"cells": exact, "texts": wide}, [CELLS, other], reported)
    assert labels.where("table_name = 'cells'").first().m["entity"].worst == 0.0


def test_at_most_ten_exchanges(spark, tables):
    labels = stacked.label_metrics(spark, tables, [CELLS, SQUARE])
    plans = [labels, stacked.stacked_metrics(spark, tables, [CELLS, SQUARE])]
    assert sum(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in plans) <= 10
