import pytest
from pyspark.sql import functions as F

from crossfoot.operators import gate, readside
from crossfoot.operators.results import with_run
from crossfoot.sources import publish as store

COLUMNS = "run_id string, check_id string, check_name string, table_name string, status string, severity string, expected string, observed string, difference double, affected_records long"


def results(spark, rows):
    return spark.createDataFrame([(run, check, check, "t", status, severity, "0", "1", diff, n) for run, check, status, severity, diff, n in rows], COLUMNS)


def test_blocking_filter(spark):
    df = results(spark, [("r", "a", "UNRESOLVED", "WARNING", 1.0, 1), ("r", "b", "STATISTICALLY_DIFFERENT", None, 1.0, 1), ("r", "c", "PASS", "INFO", 0.0, 0),
                         ("r", "d", "FAIL", "CRITICAL", 1.0, 1), ("r", "e", "FAIL", "WARNING", 1.0, 1)])
    assert [r.check_id for r in gate.blocking_failures(df).collect()] == ["d"]
    assert gate.gate_decision(df).first().decision == "INCIDENT"
    assert gate.gate_decision(df.where("status <> 'FAIL'")).first().decision == "PROMOTE"


def test_incident_aggregation(spark):
    df = results(spark, [("r", "DOM-01", "FAIL", "ERROR", 5.0, 5), ("r", "UNQ-01", "FAIL", "CRITICAL", 0.0, 2), ("q", "X", "FAIL", "WARNING", None, None)])
    failed = gate.normalized_failures(gate.failures(df))
    rows = {r.run_id: r for r in gate.aggregate_incidents(failed).collect()}
    r = rows["r"]
    assert (r.severity, r.check_id, r.affected_record_count, r.n_failures) == ("CRITICAL", "UNQ-01", 7, 2)
    assert (r.expected_value, r.observed_value, r.difference, r.status) == ("0", "1", 0.0, "OPEN")
    assert r.title == "Held back by UNQ-01, DOM-01"
    assert rows["q"].severity == "WARNING" and rows["q"].affected_record_count == 0
    assert gate.incident_failures(failed).count() == 3


def test_incident_of_a_run_without_failed_checks(spark, tmp_path):
    row = gate.incident_without_failures(spark, "r", "source unreadable", title="Source lost").first()
    assert (row.severity, row.check_id, row.n_failures, row.title, row.status) == ("ERROR", None, 0, "Source lost", "OPEN")
    assert "source unreadable" in row.description
    failed = gate.normalized_failures(results(spark, []))
    store.record_incidents(gate.incident_without_failures(spark, "r", "x"), gate.incident_failures(failed), str(tmp_path))
    assert [r.severity for r in store.read_incidents(spark, str(tmp_path)).collect()] == ["ERROR"]


def test_title_of_the_caller(spark):
    df = results(spark, [("r", "C", "FAIL", "ERROR", 1.0, 1)])
    assert gate.aggregate_incidents(gate.normalized_failures(df), title="Mine").first().title == "Mine"


def test_title_names_three_checks_and_counts_the_rest(spark):
    df = results(spark, [("r", f"C-{i % 5}", "FAIL", "ERROR", 1.0, 1) for i in range(20)])
    row = gate.aggregate_incidents(gate.normalized_failures(df)).first()
    assert row.title == "Held back by C-0, C-1, C-2 (+2 more)" and row.affected_record_count == 20


def test_mixed_suites(spark):
    rec = spark.createDataFrame([("r", "REC-DO01", "m, s", "NATIONAL", "FAIL", "CRITICAL", 1.0, 2.0, 1.0)],
                                "run_id string, rule_code string, source_tables string, entity string, status string, severity string, expected_value double, observed_value double, absolute_difference double")
    row = gate.normalized_failures(rec).first()
    assert (row.check_id, row.table_name, row.expected_value, row.difference) == ("REC-DO01", "m, s", "1.0", 1.0)


def test_run_id_is_deterministic():
    assert gate.deterministic_run_id("a") == gate.deterministic_run_id("a") != gate.deterministic_run_id("b")


def test_results_are_replaced_per_suite(spark, tmp_path):
    base = str(tmp_path)
    one = results(spark, [("r", "a", "PASS", "INFO", 0.0, 0), ("r", "b", "PASS", "INFO", 0.0, 0)]).drop("run_id")
    for _ in range(2):
        store.write_results(with_run(one, "r", "schema"), base, "validation", "r", "schema")
        store.write_results(with_run(one, "r", "quality"), base, "validation", "r", "quality")
    store.write_results(with_run(one, "2024-01", "quality"), base, "validation", "2024-01", "quality")
    rows = store.read_layer(spark, base, store.RESULTS, "validation")
    assert rows.count() == 6 and rows.where("run_id = 'r' AND suite = 'schema'").count() == 2
    store.write_results(with_run(one.limit(0), "r", "schema"), base, "validation", "r", "schema")
    assert store.read_layer(spark, base, store.RESULTS, "validation").where("run_id = 'r'").count() == 2


def test_only_completed_runs_are_trusted(spark, tmp_path):
    base = str(tmp_path)
    table = spark.createDataFrame([("A", 1.5), ("B", None)], "entity string, value double")
    for run in ("r1", "r2"):
        store.start_run(spark, base, run, "s", "/s")
        store.promote({"cells": table}, base, run)
    store.promote({"cells": table}, base, "r1")  # a retry leaves the same rows
    store.complete_run(spark, base, "r1", {"cells": 2}, {})
    rows = store.read_trusted(spark, base, "cells")
    assert rows.count() == 2 and {r.run_id for r in rows.collect()} == {"r1"}
    assert rows.schema["value"].dataType.simpleString() == "decimal(38,12)"
    store.promote({"large": table.withColumn("value", F.expr("1.25e12D"))}, base, "r1")
    assert float(store.read_trusted(spark, base, "large").first()["value"]) == 1.25e12
    store.fail_run(spark, base, "r2", "boom")
    store.record_run(spark, base, "r3", "s", "/s", {"cells": 1})
    states = {r.run_id: r.status for r in readside.run_states(store.read_events(spark, base)).collect()}
    assert states == {"r1": "COMPLETED", "r2": "FAILED", "r3": "COMPLETED"}
    assert readside.recent_runs(readside.run_states(store.read_events(spark, base)), 1).first().run_id == "r3"


def test_first_incident_of_a_run_stays(spark, tmp_path):
    base = str(tmp_path)

    def record(check):
        failed = gate.normalized_failures(results(spark, [("r", check, "FAIL", "ERROR", 1.0, 1)]))
        store.record_incidents(gate.aggregate_incidents(failed), gate.incident_failures(failed), base)

    record("first")
    record("second")
    head, failed = store.incident_of_run(spark, base, "r")
    assert [r.check_id for r in head.collect()] == ["first"] and [r.check_id for r in failed.collect()] == ["first"]
    incidents = store.read_incidents(spark, base)
    assert [r.outcome for r in gate.alert_outcomes(incidents, store.read_alerts(spark, base)).collect()] == ["READY"]
    assert [r.outcome for r in gate.alert_outcomes(incidents, store.read_alerts(spark, base), enabled=False).collect()] == ["SKIPPED_DISABLED"]
    store.record_alerts(incidents.select("incident_id", F.lit("FAILED").alias("outcome")), base)
    assert gate.pending_alerts(incidents, store.read_alerts(spark, base)).count() == 1
    store.record_alerts(incidents.select("incident_id", F.lit("SENT").alias("outcome")), base)
    assert gate.pending_alerts(incidents, store.read_alerts(spark, base)).count() == 0
    assert store.read_incidents(spark, base).first().alert_sent is True
    again = gate.alert_outcomes(store.read_incidents(spark, base), store.read_alerts(spark, base))
    assert [r.outcome for r in again.collect()] == ["SKIPPED_DUPLICATE"]


@pytest.mark.parametrize("wanted, expected", [({}, 3), ({"status": "ALL"}, 3), ({"status": "FAIL"}, 2), ({"status": "FAIL", "run_id": "q"}, 1), ({"run_id": None}, 3)])
def test_filters(spark, wanted, expected):
    df = results(spark, [("r", "a", "FAIL", "ERROR", 1.0, 1), ("q", "b", "FAIL", "ERROR", 1.0, 1), ("q", "c", "PASS", "INFO", 0.0, 0)])
    assert readside.filter_rows(df, **wanted).count() == expected
