"""One batch run from published tables to promotion or incident."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.config import StatsConfig, TableSpec, Tolerance
from crossfoot.operators import gate, profiling, snapshots
from crossfoot.operators.reshape import union_all
from crossfoot.operators.results import with_run
from crossfoot.plans.batch import Batch, Rules
from crossfoot.plans.flow import Published
from crossfoot.plans.suite import RULES, validation_suite
from crossfoot.runtime import materialize
from crossfoot.sources import publish as store
from crossfoot.sources.crosstab import stage_cells

SCHEMA_SUITE, QUALITY_SUITE = "schema", "quality"


@dataclass(frozen=True)
class RunOutcome:
    run_id: str
    decision: str
    n_failures: int


def run_reliability(
    spark: SparkSession,
    base: str,
    run_name: str,
    source: Published | Batch,
    specs: list[TableSpec],
    reference: Published | Batch | None = None,
    audited_entity: str | None = None,
    exceptions: tuple[str, ...] = (),
    tolerance: Tolerance = Tolerance(),
    config: StatsConfig = StatsConfig(),
    source_name: str = "source",
    source_path: str = "",
    rules: Rules | None = None,
    periods: tuple[str | None, str | None] = (None, None),
) -> RunOutcome:
    """Stage, profile, check, reconcile, compare with the reference snapshot, then promote or open an incident.

    Everything is written per run and replaced when the same run is repeated. Results are written before the gate
    reads them, so the decision and the stored rows cannot differ. Only the one-row decision reaches the driver, and the
    row counts of the tables, which are observed while they are written.

    ``periods`` name the reference and this source in statistical results; ``rules`` default to those of a :class:`Batch`, else to those of the derived tables.
    """
    rules = rules or getattr(source, "rules", RULES)
    batch = source if isinstance(source, Batch) else Batch(source.wide, source.entities, source.labels, rules)
    run_id = gate.deterministic_run_id(run_name)
    store.start_run(spark, base, run_id, source_name, source_path)
    try:
        long, reported = source.long(), source.totals()
        staged = {}
        for name, df in source.wide.items():
            spec = rules.crosstabs[name]
            numbered = df if spec.source_row in df.columns else df.withColumn(spec.source_row, F.lit(None).cast("long"))
            staged[name] = store.write_counted(stage_cells(numbered, spec), base, store.RAW, name, run_id)
        store.write_run(batch.metadata(), base, store.RAW, "metadata", run_id)
        profiles = union_all([profiling.table_profile(df, name) for name, df in long.items()])
        store.write_run(profiles, base, store.RESULTS, "profile", run_id)

        results = materialize(validation_suite(spark, source.wide, long, reported, specs, tolerance, rules=rules))
        is_schema = F.col("check_category") == "SCHEMA"
        for suite, rows in ((SCHEMA_SUITE, results.where(is_schema)), (QUALITY_SUITE, results.where(~is_schema))):
            store.write_results(with_run(rows, run_id, suite), base, "validation", run_id, suite)
        if rules.reconcile:
            reconciled = rules.reconcile(long, reported, source.entities, exceptions, tolerance)
            store.write_results(with_run(reconciled, run_id, "reconciliation"), base, "reconciliation", run_id, "reconciliation")
        if reference is not None:
            compared = snapshots.compare_snapshots(reference.long(), long, audited_entity or source.labels[0], config=config, periods=periods)
            store.write_results(with_run(compared, run_id, "statistics"), base, "statistics", run_id, "statistics")

        failed = _stored_failures(spark, base, run_id, bool(rules.reconcile))
        decision = failed.agg(F.count("*").alias("n")).first().n
        if decision:
            store.record_incidents(gate.aggregate_incidents(failed), gate.incident_failures(failed), base)
            store.fail_run(spark, base, run_id, f"{decision} failed checks")
            return RunOutcome(run_id, "INCIDENT", decision)
        counts = store.promote(long, base, run_id)
        store.complete_run(spark, base, run_id, counts, {"failures": 0, "staged_cells": staged})
        return RunOutcome(run_id, "PROMOTE", 0)
    except Exception as error:
        store.fail_run(spark, base, run_id, str(error))
        raise


def _stored_failures(spark: SparkSession, base: str, run_id: str, reconciled: bool) -> DataFrame:
    """Everything stored for the run that stops promotion."""
    own = F.col("run_id") == run_id
    validation = gate.normalized_failures(gate.failures(store.read_layer(spark, base, store.RESULTS, "validation").where(own)))
    if not reconciled:
        return validation
    rows = gate.reconciliation_failures(store.read_layer(spark, base, store.RESULTS, "reconciliation").where(own))
    return union_all([validation, gate.normalized_failures(rows)])
