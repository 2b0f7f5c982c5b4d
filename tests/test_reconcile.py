import pytest

from crossfoot.config import Tolerance
from crossfoot.operators import faults, reconcile
from crossfoot.schemas import UNRESOLVED_TEXT


@pytest.fixture(scope="module")
def tables(spark):
    flows = [("A", "A", "10", 5.0), ("A", "B", "10", 2.0), ("B", "A", "11", 3.0), ("B", "B", "11", 7.0), ("OT", "OT", "10", 4.0), ("A", "OT", "11", 1.0)]
    df = spark.createDataFrame(flows, "origin string, destination string, code string, value double")
    crossing = df.where("origin <> destination")
    long = {
        "matrix": df.groupBy("origin", "destination").sum("value").withColumnRenamed("sum(value)", "value"),
        "summary": df.groupBy("code").sum("value").withColumnRenamed("sum(value)", "value"),
        "outward": crossing.selectExpr("code", "origin AS entity", "value"),
        "inward": crossing.selectExpr("code", "destination AS entity", "value"),
        "internal": df.where("origin = destination").selectExpr("code", "origin AS entity", "value"),
    }
    reported = spark.createDataFrame([("summary", "GRAND", "GRAND", 22.0), ("inward", "GRAND", "GRAND", 6.0)], "table_name string, axis string, entity string, value double")
    entities = spark.createDataFrame([("A",), ("B",), ("OT",), ("NONE",)], "entity string")
    return long, reported, entities


def status(df):
    return {(r.rule_code, r.dimension, r.entity): r.status for r in df.collect()}


def test_consistent_tables_agree(tables):
    long, reported, entities = tables
    rows = status(reconcile.reconcile_all(long, reported, entities, ("OT",)))
    assert len(rows) == 4 + 3 * 4 and set(rows.values()) == {"PASS"}


def test_single_rules_equal_the_whole_set(tables):
    long, reported, entities = tables
    parts = [
        reconcile.matrix_vs_national(long, reported), reconcile.outward_vs_inward_total(long, reported), reconcile.partition_of_total(long),
        reconcile.origin_marginals(long, entities), reconcile.destination_marginals(long, entities), reconcile.diagonal_vs_internal(long, entities, ("OT",)),
    ]
    whole = {tuple(r) for r in reconcile.reconcile_all(long, reported, entities, ("OT",)).collect()}
    assert {tuple(r) for part in parts for r in part.collect()} == whole


def test_an_altered_cell_warns_only_where_it_counts(tables):
    long, reported, entities = tables
    changed = {**long, "outward": faults.shift_value(long["outward"], {"code": "10", "entity": "A"}, 500.0)}
    rows = status(reconcile.reconcile_all(changed, reported, entities))
    warned = {key for key, value in rows.items() if value == "WARNING"}
    assert warned == {
        ("REC-DO02", "OUTWARD_INWARD_TOTAL", "NATIONAL"),
        ("REC-DO03", "OUTWARD_INTERNAL_PARTITION", "NATIONAL"),
        ("REC-DO04", "ORIGIN_MARGINAL", "A"),
    }
    assert "FAIL" not in rows.values()


def test_exception_entity(tables):
    long, _, entities = tables
    moved = {**long, "internal": faults.shift_value(long["internal"], {"code": "10", "entity": "OT"}, -1.5)}
    rows = {r.entity: r for r in reconcile.diagonal_vs_internal(moved, entities, ("OT",)).collect()}
    assert (rows["OT"].status, rows["OT"].severity, rows["OT"].message) == ("UNRESOLVED", "WARNING", UNRESOLVED_TEXT)
    assert rows["OT"].absolute_difference == 1.5 and rows["A"].status == "PASS"
    always = {r.entity: r.status for r in reconcile.diagonal_vs_internal(long, entities, ("OT",), exception_mode="always").collect()}
    assert always["OT"] == "UNRESOLVED" and always["A"] == "PASS"


def test_tolerances(tables):
    long, _, entities = tables
    changed = {**long, "outward": faults.shift_value(long["outward"], {"code": "10", "entity": "A"}, 0.005)}

    def of_a(tolerance):
        return status(reconcile.origin_marginals(changed, entities, tolerance))["REC-DO04", "ORIGIN_MARGINAL", "A"]

    assert of_a(Tolerance(1e-4, 1e-12)) == "WARNING"
    assert of_a(Tolerance(0.01, 1e-12)) == "PASS"
    assert of_a(Tolerance(1e-4, 1e-2)) == "PASS"


def test_zero_expected_and_missing_total(spark, tables):
    long, reported, entities = tables
    extra = spark.createDataFrame([("NONE", "NONE", 9.0)], "origin string, destination string, value double")
    grown = {**long, "matrix": long["matrix"].unionByName(extra)}
    rows = {r.entity: r for r in reconcile.diagonal_vs_internal(grown, entities).collect()}
    assert rows["NONE"].status == "WARNING" and rows["NONE"].relative_difference is None
    old = {r.entity: r for r in reconcile.diagonal_vs_internal(grown, entities, tolerance=Tolerance(zero_expected="pass")).collect()}
    assert old["NONE"].status == "PASS" and old["NONE"].relative_difference == 0.0
    none = reported.where("table_name <> 'summary'")
    assert reconcile.matrix_vs_national(long, none).first().status == "WARNING"
    assert reconcile.matrix_vs_national(long, none, fallback={"summary": 22.0}).first().status == "PASS"
