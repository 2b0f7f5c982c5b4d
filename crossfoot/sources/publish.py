"""Storage of runs as Parquet folders: ``<base>/<layer>/<table>/run_id=<id>``.

Every write of a run replaces that run's folder, so a repeated run leaves the same rows. A run counts as published
once its COMPLETED event is written, which happens last; readers of trusted tables join with completed runs.
"""

from __future__ import annotations

import json
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.operators.readside import run_states
from crossfoot.runtime import materialize, ref
from crossfoot.schemas import COMPLETED, FAILED, RUN_EVENT, STARTED

RAW, TRUSTED, RESULTS = "raw", "trusted", "results"
_SCALE = 12


def table_path(base: str, layer: str, table: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{table}"


def _replace(df: DataFrame, folder: str) -> None:
    df.drop("run_id", "suite").write.mode("overwrite").parquet(folder)


def _partition(name: str, value: str) -> str:
    return f"{name}={quote(value, safe='-_.')}"


def write_run(df: DataFrame, base: str, layer: str, table: str, run_id: str) -> None:
    """Replaces one table of one run, also by nothing when there are no rows."""
    _replace(df, f"{table_path(base, layer, table)}/{_partition('run_id', run_id)}")


def write_counted(df: DataFrame, base: str, layer: str, table: str, run_id: str) -> int:
    """:func:`write_run` that also tells how many rows were written, observed by the tasks that write them."""
    seen = Observation()
    write_run(df.observe(seen, F.count(F.lit(1)).alias("n")), base, layer, table, run_id)
    return seen.get["n"]


def write_results(df: DataFrame, base: str, kind: str, run_id: str, suite: str) -> None:
    """Replaces the results of one suite of one run; other suites of the run stay."""
    _replace(df, f"{table_path(base, RESULTS, kind)}/{_partition('run_id', run_id)}/{_partition('suite', suite)}")


def read_layer(spark: SparkSession, base: str, layer: str, table: str) -> DataFrame:
    """One table over all runs; a filter on ``run_id`` reads only that run's files."""
    path = table_path(base, layer, table)
    rows = spark.read.option("basePath", path).parquet(path)
    keys = [c for c in ("run_id", "suite") if c in rows.columns]
    return rows.select(*[ref(c).cast("string").alias(c) if c in keys else ref(c) for c in rows.columns])


def promote(tables: dict[str, DataFrame], base: str, run_id: str, value: str = "value") -> dict[str, int]:
    """Writes the trusted tables of one run, amounts as decimals with the scale they come with (12 for doubles).

    The run's COMPLETED event makes them visible. Returns the rows written per table.
    """
    counts = {}
    for name, df in tables.items():
        kind = df.schema[value].dataType
        at_rest = T.DecimalType(38, kind.scale if isinstance(kind, T.DecimalType) else _SCALE)
        counts[name] = write_counted(df.withColumn(value, ref(value).cast(at_rest)), base, TRUSTED, name, run_id)
    return counts


def read_trusted(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rows of completed runs only."""
    done = run_states(read_events(spark, base)).where(F.col("status") == COMPLETED).select("run_id")
    return read_layer(spark, base, TRUSTED, table).join(done, "run_id", "left_semi")


# --- run log --------------------------------------------------------------------------------------------------------


def _append_event(spark: SparkSession, base: str, run_id: str, status: str, name=None, path=None, counts=None, summary=None) -> None:
    row = [(run_id, None, status, name, path, counts or {}, json.dumps(summary or {}, sort_keys=True))]
    event = spark.createDataFrame(row, RUN_EVENT).withColumn("event_ts", F.current_timestamp())
    event.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/runs")


def start_run(spark: SparkSession, base: str, run_id: str, source_name: str, source_path: str) -> None:
    _append_event(spark, base, run_id, STARTED, source_name, source_path)


def complete_run(spark: SparkSession, base: str, run_id: str, row_counts: dict[str, int], summary: dict) -> None:
    """The commit point of a run."""
    _append_event(spark, base, run_id, COMPLETED, counts=row_counts, summary=summary)


def fail_run(spark: SparkSession, base: str, run_id: str, error: str) -> None:
    _append_event(spark, base, run_id, FAILED, summary={"error": error})


def record_run(spark: SparkSession, base: str, run_id: str, source_name: str, source_path: str, row_counts: dict[str, int]) -> None:
    """A finished run in one call."""
    _append_event(spark, base, run_id, COMPLETED, source_name, source_path, row_counts)


def read_events(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(RUN_EVENT).parquet(f"{base.rstrip('/')}/runs")


# --- incidents ------------------------------------------------------------------------------------------------------

_ALERT = T.StructType().add("incident_id", "string").add("outcome", "string").add("event_ts", "timestamp")


def _stored(spark: SparkSession, path: str, empty: T.StructType | None) -> DataFrame | None:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(empty).parquet(path) if empty else spark.read.option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], empty) if empty else None


def record_incidents(incidents: DataFrame, failed: DataFrame, base: str) -> None:
    """Stores incidents of runs that have none yet; a run keeps its first incident and that incident's failures.

    Both tables have a folder per run that is written as a whole, the incidents last. A crash in between leaves failures
    without an incident, which the next attempt replaces.
    """
    spark = incidents.sparkSession
    heads, rows = f"{base.rstrip('/')}/incidents", f"{base.rstrip('/')}/incident_failures"
    known = _stored(spark, heads, None)
    fresh = incidents if known is None else incidents.join(known.select("run_id"), "run_id", "left_anti")
    fresh = materialize(fresh.withColumn("detected_at", F.current_timestamp()))
    for part, folder in ((failed.join(fresh.select("run_id"), "run_id", "left_semi"), rows), (fresh, heads)):
        by_run = part.withColumn("run", F.col("run_id"))  # the ids themselves stay in the files, as text
        by_run.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(folder)


def read_incidents(spark: SparkSession, base: str) -> DataFrame:
    """Incidents with ``alert_sent`` from the alert events."""
    incidents = spark.read.parquet(f"{base.rstrip('/')}/incidents").drop("run")
    sent = read_alerts(spark, base).where(F.col("outcome") == "SENT").select("incident_id").distinct()
    marked = incidents.join(sent.withColumn("_sent", F.lit(True)), "incident_id", "left")
    return marked.withColumn("alert_sent", F.coalesce("_sent", F.lit(False))).drop("_sent")


def incident_of_run(spark: SparkSession, base: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """The incident of one run and its failures."""
    head = read_incidents(spark, base).where(F.col("run_id") == run_id)
    failed = spark.read.parquet(f"{base.rstrip('/')}/incident_failures").where(F.col("run_id") == run_id).drop("run")
    return head, failed


def read_alerts(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base.rstrip('/')}/alerts"
    return _stored(spark, path, _ALERT)


def record_alerts(outcomes: DataFrame, base: str) -> None:
    """Appends (incident_id, outcome) events; SENT marks the incident as alerted."""
    stamped = outcomes.select("incident_id", "outcome", F.current_timestamp().alias("event_ts"))
    stamped.write.mode("append").parquet(f"{base.rstrip('/')}/alerts")
