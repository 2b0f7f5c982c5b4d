import pytest
from pyspark.sql import functions as F

from crossfoot.operators import faults, reconcile
from crossfoot.plans import suite
from crossfoot.plans.flow import Published, published_snapshots
from crossfoot.plans.queries import CODE, CODE_PATTERN, ENTITY
from crossfoot.plans.run import run_reliability
from crossfoot.sources import publish as store


@pytest.fixture(scope="module")
def years(spark, sf_dir):
    return published_snapshots(spark, sf_dir, 1996, 1997)


def test_clean_run_promotes_and_can_be_repeated(spark, years, tmp_path):
    before, after = years
    base = str(tmp_path)
    for _ in range(2):
        outcome = run_reliability(spark, base, "clean", after, suite.table_specs(after, CODE_PATTERN), before, ENTITY)
        assert (outcome.decision, outcome.n_failures) == ("PROMOTE", 0)
    counts = {name: store.read_trusted(spark, base, name).count() for name in ("matrix", "summary", "outward", "inward", "internal")}
    assert counts == {"matrix": 625, "summary": 25, "outward": 625, "inward": 625, "internal": 625}
    validation = store.read_layer(spark, base, store.RESULTS, "validation")
    assert {r.suite for r in validation.select("suite").distinct().collect()} == {"schema", "quality"}
    assert store.read_layer(spark, base, store.RESULTS, "reconciliation").count() == 4 + 3 * 25
    assert store.read_layer(spark, base, store.RESULTS, "statistics").count() == 14 + 75 + 25 + 1
    assert store.read_layer(spark, base, store.RAW, "inward").count() == 25 * 26
    assert store.read_layer(spark, base, store.RAW, "metadata").count() == 5


def test_faulty_run_opens_one_incident_and_promotes_nothing(spark, years, tmp_path):
    _, after = years
    base = str(tmp_path)
    entity = next(e for e in after.labels if after.long()["outward"].where((F.col("entity") == e) & F.col("value").isNotNull()).count())
    cell = after.long()["outward"].where((F.col("entity") == entity) & F.col("value").isNotNull()).first()
    wide = {**after.wide, "outward": faults.shift_value(after.wide["outward"], {"code": cell.code}, 500.0, entity)}
    broken = Published(wide, after.entities, after.categories, after.labels)
    for _ in range(2):
        outcome = run_reliability(spark, base, "faulty", broken, suite.table_specs(after, CODE_PATTERN))
        assert outcome.decision == "INCIDENT" and outcome.n_failures == 1
    head, failed = store.incident_of_run(spark, base, outcome.run_id)
    assert [(r.check_id, r.severity) for r in head.collect()] == [("REC-V02", "CRITICAL")] and failed.count() == 1
    with pytest.raises(Exception):
        store.read_trusted(spark, base, "matrix").count()


def test_every_fault_is_detected(spark, years):
    before, _ = years
    specs = suite.table_specs(before, CODE_PATTERN)
    filled = before.long()["outward"].where("value IS NOT NULL").first()
    scenarios = suite.fault_scenarios(spark, before, specs, filled.code, filled.entity, years, amount=1e9)
    matrix = faults.detection_matrix(spark, scenarios)
    rows = {r.scenario_id[-1]: r for r in matrix.collect()}
    assert [k for k, r in sorted(rows.items()) if r.detected] == list("ABCDEFG")
    assert [k for k, r in sorted(rows.items()) if r.blocked] == list("ABCDEF")
    assert rows["D"].actual_detectors == "REC-DO02, REC-DO03, REC-DO04, REC-V02"
    assert rows["E"].actual_detectors == "CMP-03, REC-DO02" and rows["G"].advisory


def test_faults_leave_the_source_alone(spark, years):
    before, _ = years
    df = before.long()["internal"]
    faults.value_to_text(df, {"code": CODE, "entity": ENTITY}, "X").count()
    assert df.schema["value"].dataType.typeName() == "decimal" and df.count() == 625


def test_an_absent_table_fails_its_checks_and_stops_no_other(spark, years):
    before, _ = years
    long, wide = ({k: v for k, v in d.items() if k != "outward"} for d in (before.long(), before.wide))
    specs = suite.table_specs(before, CODE_PATTERN)
    rows = suite.validation_suite(spark, wide, long, before.totals(), specs, documented_columns={"outward": 27}).collect()
    of_table = {r.check_id: r.status for r in rows if r.table_name == "outward"}
    assert of_table["CMP-03"] == "FAIL" and of_table["REC-V02"] == "FAIL"
    assert {r.table_name for r in rows} >= {"matrix", "summary", "inward", "internal"}
    reconciled = reconcile.reconcile_all(long, before.totals(), before.entities)
    assert reconciled.count() == 4 + 3 * 25 and reconciled.where("status <> 'PASS'").count() > 0
