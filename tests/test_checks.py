import pytest

from crossfoot.config import CrosstabSpec, TableSpec, Tolerance
from crossfoot.operators import checks, faults, totals

ENTITIES, CODES = ["A", "B", "C"], ["10", "11"]
SPEC = TableSpec(
    "cells",
    ("code", "entity", "value"),
    ("code", "entity"),
    code="code",
    entities=("entity",),
    expected_from=("code", "entity"),
    expected_nulls=1,
    domains={"code": CODES, "entity": ENTITIES},
)


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(c, e, float(i)) for i, (c, e) in enumerate((c, e) for c in CODES for e in ENTITIES)]
    rows[4] = ("11", "B", None)
    return spark.createDataFrame(rows, "code string, entity string, value double")


def run(spark, df, spec=SPEC):
    rows = checks.table_checks(spark, df, spec, 3).unionByName(checks.membership_check(df, spec.name, ["entity"], ENTITIES))
    return {r.check_id: r for r in rows.collect()}


def failing(results):
    return {name: r.affected_records for name, r in results.items() if r.status != "PASS"}


def test_clean_table_passes(spark, cells):
    results = run(spark, cells)
    assert set(results) == {"CMP-03", "UNQ-03", "DOM-01-cells", "DOM-03-cells", "NUM-01-cells", "NUM-02-cells", "NUM-03-cells", "NUM-05-cells"}
    assert failing(results) == {} and {r.severity for r in results.values()} == {"INFO"}


KEY = {"code": "10", "entity": "B"}


@pytest.mark.parametrize(
    "alter, expected",
    [
        (lambda df: faults.drop_record(df, KEY), {"CMP-03": 1}),
        (lambda df: faults.duplicate_record(df, KEY), {"CMP-03": 1, "UNQ-03": 2}),
        (lambda df: faults.replace_code(df, "code", "10", "999"), {"DOM-03-cells": 3}),
        (lambda df: faults.replace_code(df, "entity", "B", "b"), {"DOM-01-cells": 1}),
        (lambda df: faults.drop_entity(df, "entity", "A"), {"CMP-03": 2}),
        (lambda df: faults.value_to_text(df, KEY, "CORRUPTED_TEXT"), {"NUM-01-cells": 1}),
        (lambda df: faults.value_to_text(df, KEY, "3d"), {"NUM-01-cells": 1}),
        (lambda df: faults.value_to_text(df, KEY, " 7.5e2 "), {}),
        (lambda df: faults.value_to_text(df, KEY, "-Infinity"), {"NUM-02-cells": 1, "NUM-03-cells": 1}),
        (lambda df: faults.shift_value(df, KEY, -50.0), {"NUM-02-cells": 1}),
        (lambda df: faults.shift_value(df, KEY, float("inf")), {"NUM-03-cells": 1}),
        (lambda df: faults.shift_value(df, KEY, float("nan")), {"NUM-05-cells": 1}),
    ],
)
def test_one_fault_flips_the_expected_checks(spark, cells, alter, expected):
    assert failing(run(spark, alter(cells))) == expected


def test_null_labels_are_invalid(spark):
    df = spark.createDataFrame([(None, None, 1.0), ("10", "A", 2.0)], "code string, entity string, value double")
    results = run(spark, df)
    assert results["DOM-01-cells"].affected_records == 1 and results["DOM-03-cells"].affected_records == 1


def test_absent_table_and_column_do_not_raise(spark, cells):
    rows = checks.table_checks(spark, None, SPEC, 3).collect()
    assert [(r.check_id, r.status, r.observed) for r in rows] == [("CMP-03", "FAIL", "0")]
    assert rows[0].message.endswith("its other checks are SKIPPED.")
    rows = checks.table_checks(spark, cells.drop("value"), SPEC, 3).collect()
    assert len(rows) == 1 and rows[0].status == "FAIL" and "value" in rows[0].message


def test_domain_as_frame_equals_domain_as_list(spark, cells):
    framed = TableSpec(**{**SPEC.__dict__, "domains": {"code": spark.createDataFrame([(c,) for c in CODES], "code string"),
                                                        "entity": spark.createDataFrame([(e,) for e in ENTITIES], "entity string")}})
    broken = faults.replace_code(cells, "code", "10", "12")
    assert failing(run(spark, broken, framed)) == failing(run(spark, broken)) == {"DOM-03-cells": 3}


def test_schema_checks(spark, cells):
    other = TableSpec("other", ("x",), ("x",))
    rows = {r.check_id: r for r in checks.schema_checks(spark, {"cells": cells.withColumnRenamed("entity", "region")}, [SPEC, other]).collect()}
    assert failing(rows) == {"SCH-01": 1, "SCH-02-cells": 1, "SCH-03-cells": 1, "SCH-02-other": 0}
    assert rows["SCH-03-cells"].status == "WARNING"
    wrong = cells.withColumn("code", cells.code.cast("int"))
    assert checks.code_type_check(wrong, "code", "cells").first().affected_records == 6


def test_label_sets(spark, cells):
    rows = checks.label_set_check(cells, "CMP-06", "cells", ["entity"], ["A", "B", "D"], True, "ERROR").first()
    assert (rows.status, rows.observed, rows.affected_records) == ("FAIL", "1 missing, 1 unexpected", 2)
    one_way = checks.label_set_check(cells, "CMP-07", "cells", ["entity"], ["A", "B"], False, "CRITICAL").first()
    assert one_way.status == "PASS"


def test_label_preserved(spark):
    df = spark.createDataFrame([("CHATTISGARH",), ("GOA",)], "origin string")
    assert checks.label_preserved_check(df, "m", "origin", "CHATTISGARH", "CHHATTISGARH").first().status == "PASS"
    changed = faults.replace_code(df, "origin", "CHATTISGARH", "CHHATTISGARH")
    assert checks.label_preserved_check(changed, "m", "origin", "CHATTISGARH", "CHHATTISGARH").first().status == "FAIL"


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (4,)], "pk int")
    row = checks.orphan_summary(child, "fk", parent, "pk", "c").first()
    assert (row.n_rows, row.n_orphans, row.n_orphan_keys) == (4, 2, 2)


def test_structure(spark):
    spec = CrosstabSpec("m", ("destination",))
    wide = spark.createDataFrame([("A", 1.0, None), ("B", 2.0, 3.0)], "destination string, A double, B double")
    long = wide.unpivot(["destination"], ["A", "B"], "origin", "value")
    assert checks.reshape_check(wide, spec, long, "m").first().status == "PASS"
    assert checks.reshape_check(wide, spec, long.where("value is not null"), "m").first().affected_records == 1
    assert checks.column_count_check(wide, spec, 3).first().status == "PASS"
    assert checks.column_count_check(wide, spec, 4).first().status == "WARNING"


def published(spark, rows):
    return spark.createDataFrame(rows, "table_name string, axis string, entity string, value double")


def test_published_totals(spark):
    cells = spark.createDataFrame(
        [("t", "10", "A", 1.0), ("t", "10", "B", None), ("t", "11", "A", 2.0), ("t", "11", "C", 4.0)],
        "table_name string, code string, entity string, value double",
    )
    reported = published(spark, [("t", "COLUMN", "A", 3.00005), ("t", "COLUMN", "B", 0.0), ("t", "COLUMN", "D", 5.0), ("t", "ROW", "10", 1.0), ("t", "ROW", "11", None)])
    diff = totals.total_differences(totals.computed_totals(cells, ["COLUMN", "ROW"]), reported, Tolerance(absolute=1e-4))
    seen = {(r.axis, r.entity): (r.computed, r.reported, r.within) for r in diff.collect()}
    assert seen["COLUMN", "A"] == (3.0, 3.00005, True)
    assert seen["COLUMN", "B"] == (0.0, 0.0, True)
    assert seen["COLUMN", "C"] == (4.0, None, False)  # not published
    assert seen["COLUMN", "D"] == (0.0, 5.0, False)  # no cells
    assert seen["ROW", "11"] == (6.0, None, False)
    rows = {r.check_id: r for r in totals.total_checks(diff, {("t", "COLUMN"): "REC-V02", ("t", "ROW"): "REC-V04"}).collect()}
    assert rows["REC-V02"].affected_records == 2 and rows["REC-V04"].affected_records == 1


def test_cross_foot_tests_both_axes(spark):
    reported = published(spark, [("t", "COLUMN", "A", 3.0), ("t", "COLUMN", "B", 4.0), ("t", "ROW", "10", 6.5), ("t", "GRAND", "GRAND", 7.0), ("u", "COLUMN", "A", 1.0)])
    rows = {r.check_id: r.status for r in totals.cross_foot_checks(reported, {"t": "REC-V05"}).collect()}
    assert rows == {"REC-V05-COLUMN": "PASS", "REC-V05-ROW": "FAIL"}
    missing = published(spark, [("t", "COLUMN", "A", 3.0), ("t", "GRAND", "GRAND", None)])
    assert totals.cross_foot_checks(missing, {"t": "REC-V05"}).first().status == "FAIL"
