"""Gate decision and incidents of runs. Inputs are result rows with a ``run_id``."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crossfoot.functions.cells import sentence
from crossfoot.functions.status import is_blocking, severity_rank
from crossfoot.schemas import CRITICAL, ERROR, FAIL, OPEN, WARNING


def deterministic_run_id(name: str, namespace: str = "run") -> str:
    """The same name always gives the same run id."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{namespace}/{name}"))


def failures(results: DataFrame, min_severity: str | None = None) -> DataFrame:
    """Result rows with status FAIL, of ``min_severity`` or worse if given."""
    failed = results.where(F.col("status") == FAIL)
    if min_severity is None:
        return failed
    return failed.where(severity_rank(F.col("severity")) <= severity_rank(F.lit(min_severity)))


def reconciliation_failures(results: DataFrame) -> DataFrame:
    """Reconciliation rows that stop a run: FAIL, or anything marked CRITICAL."""
    return results.where((F.col("status") == FAIL) | (F.col("severity") == CRITICAL))


def blocking_failures(results: DataFrame) -> DataFrame:
    """FAIL of severity CRITICAL or ERROR; warnings, open questions and statistical signals do not block."""
    return results.where(is_blocking(F.col("status"), F.col("severity")))


def gate_decision(results: DataFrame) -> DataFrame:
    """(run_id, n_results, n_failures, n_blocking, decision): any FAIL leads to an incident, else the run promotes."""
    failed = F.col("status") == FAIL
    counts = results.groupBy("run_id").agg(
        F.count("*").alias("n_results"),
        F.count_if(failed).alias("n_failures"),
        F.count_if(is_blocking(F.col("status"), F.col("severity"))).alias("n_blocking"),
    )
    return counts.withColumn("decision", F.when(F.col("n_failures") > 0, "INCIDENT").otherwise("PROMOTE"))


def _order() -> Column:
    """Most severe first, then by check, table and entity, so that ties resolve the same way every time."""
    return F.struct(severity_rank(F.col("severity")), "check_id", "table_name", "entity")


def normalized_failures(results: DataFrame) -> DataFrame:
    """Failures of any suite with one set of columns; absent columns are NULL."""

    def first(*names: str) -> Column:
        present = [F.col(n).cast("string") for n in names if n in results.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    def number(*names: str) -> Column:
        return first(*names).try_cast("double")

    return results.select(
        "run_id",
        first("check_id", "rule_code").alias("check_id"),
        first("check_name", "message").alias("check_name"),
        first("table_name", "source_tables").alias("table_name"),
        first("entity").alias("entity"),
        "status",
        "severity",
        first("expected", "expected_value").alias("expected_value"),
        first("observed", "observed_value").alias("observed_value"),
        number("difference", "absolute_difference").alias("difference"),
        number("affected_records").cast("long").alias("affected_records"),
    )


def incident_without_failures(
    spark: SparkSession, run_id: str, reason: str, incident_type: str = "DATA_INTEGRITY_FAILURE", title: str | None = None
) -> DataFrame:
    """The incident of a run that is held back although no check of it failed, for instance because it broke off.

    Severity ERROR, no check and no affected records; the columns are those of :func:`aggregate_incidents`.
    """
    row = (f"INC-{run_id}", run_id, ERROR, incident_type, 0, 0, title or "Held back without a failed check",
           f"Run {run_id} stopped: {reason}. Nothing was published.", OPEN)
    names = "incident_id string, run_id string, severity string, failure_type string, affected_record_count long, n_failures long, title string, description string, status string"
    empty = aggregate_incidents(normalized_failures(spark.createDataFrame([], "run_id string, check_id string, check_name string, table_name string, status string, severity string, expected string, observed string, difference double, affected_records long")))
    return empty.unionByName(spark.createDataFrame([row], names), allowMissingColumns=True)


def aggregate_incidents(failed: DataFrame, incident_type: str = "DATA_INTEGRITY_FAILURE", title: str | None = None) -> DataFrame:
    """One incident per run from the rows of :func:`normalized_failures`; ``title`` replaces the one that names checks.

    Severity, check and table come from the most severe failure; affected records add up over all failures. The
    failures themselves stay rows of their own, see :func:`incident_failures`: a run may have any number of them.

    The failures are read once and reduced to one row per run and check before anything else happens.
    """
    primary = F.struct("check_id", "check_name", "table_name", "severity", "expected_value", "observed_value", "difference")
    by_check = failed.groupBy("run_id", "check_id").agg(
        F.min_by(primary, _order()).alias("p"),
        F.min(_order()).alias("order"),
        F.min(severity_rank(F.col("severity"))).alias("rank"),
        F.count("*").alias("n"),
        F.sum("affected_records").alias("affected"),
    )
    ranked = Window.partitionBy("run_id").orderBy(F.col("check_id").isNull(), "rank", "check_id")
    leading = F.when((F.col("k") <= 3) & F.col("check_id").isNotNull(), F.struct("k", "check_id"))
    heads = by_check.withColumn("k", F.row_number().over(ranked)).groupBy("run_id").agg(
        F.min_by("p", "order").alias("p"),
        F.sum("n").alias("n_failures"),
        F.coalesce(F.sum("affected"), F.lit(0)).alias("affected_record_count"),
        F.count("check_id").alias("ids"),
        F.sort_array(F.collect_list(leading)).alias("leading"),
    )
    severity = F.upper(F.col("p.severity"))
    more = F.when(F.col("ids") > 3, sentence(" (+", F.col("ids") - 3, " more)")).otherwise("")
    names = F.array_join(F.transform("leading", lambda entry: entry["check_id"]), ", ")
    return heads.select(
        F.concat(F.lit("INC-"), "run_id").alias("incident_id"),
        "run_id",
        F.when(severity.isin(CRITICAL, ERROR), severity).otherwise(WARNING).alias("severity"),
        F.lit(incident_type).alias("failure_type"),
        F.col("p.table_name").alias("source_table"),
        F.col("p.check_id").alias("check_id"),
        F.col("p.check_name").alias("check_name"),
        F.col("p.expected_value").alias("expected_value"),
        F.col("p.observed_value").alias("observed_value"),
        F.col("p.difference").alias("difference"),
        "affected_record_count",
        "n_failures",
        (sentence("Held back by ", names, more) if title is None else F.lit(title)).alias("title"),
        sentence(
            F.col("n_failures"), " checks stop run ", F.col("run_id"), "; gravest: ", F.col("p.check_id"),
            " on ", F.coalesce("p.table_name", F.lit("source")), ". Nothing was published.",
        ).alias("description"),
        F.lit(OPEN).alias("status"),
    )


def incident_failures(failed: DataFrame) -> DataFrame:
    """All failures of every incident, one row each, keyed by incident."""
    return failed.select(F.concat(F.lit("INC-"), "run_id").alias("incident_id"), "*")


def pending_alerts(incidents: DataFrame, alert_events: DataFrame) -> DataFrame:
    """Incidents without an event SENT; the event log holds (incident_id, outcome)."""
    sent = alert_events.where(F.col("outcome") == "SENT").select("incident_id").distinct()
    return incidents.join(sent, "incident_id", "left_anti")


def alert_outcomes(incidents: DataFrame, alert_events: DataFrame, enabled: bool = True, force: bool = False) -> DataFrame:
    """(incident_id, outcome): what an alert round would do with each incident, before delivery.

    SKIPPED_DISABLED when alerts are off, SKIPPED_DUPLICATE when one was sent, else READY. The caller reports SENT or
    FAILED as a new event; the incident itself never changes.
    """
    sent = alert_events.where(F.col("outcome") == "SENT").select("incident_id").distinct().withColumn("_sent", F.lit(True))
    known = F.coalesce("_sent", F.lit(False))
    outcome = F.when(~F.lit(enabled), "SKIPPED_DISABLED").when(known & ~F.lit(force), "SKIPPED_DUPLICATE").otherwise("READY")
    return incidents.join(sent, "incident_id", "left").select("incident_id", outcome.alias("outcome"))


def alert_excerpt(failed: DataFrame, count: int = 5) -> DataFrame:
    """The first failures of each incident for an alert text, most severe first. The full list stays in the failures."""
    ranked = Window.partitionBy("incident_id").orderBy("_rank", "check_id", "table_name", "entity")
    rows = failed.withColumn("_rank", severity_rank(F.col("severity"))).withColumn("position", F.row_number().over(ranked))
    return rows.where(F.col("position") <= count).drop("_rank")
