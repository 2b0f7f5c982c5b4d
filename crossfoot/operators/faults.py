"""Controlled faults and the matrix of what detects them. An injector returns a new lazy frame; its input stays as is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.operators.reshape import union_all
from crossfoot.runtime import ref
from crossfoot.schemas import CRITICAL, DIFFERENT, ERROR, FAIL, UNRESOLVED, WARNING


def key_is(key: dict[str, str]) -> Column:
    """True for the rows with this key; never NULL."""
    matches = F.lit(True)
    for name, value in key.items():
        matches = matches & ref(name).eqNullSafe(F.lit(value))
    return matches


def drop_record(df: DataFrame, key: dict[str, str]) -> DataFrame:
    """A: the keyed record is missing."""
    return df.where(~key_is(key))


def duplicate_record(df: DataFrame, key: dict[str, str]) -> DataFrame:
    """B: the keyed record occurs twice."""
    copies = F.when(key_is(key), F.lit(2)).otherwise(F.lit(1))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def replace_code(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """C: a valid code becomes an invalid one."""
    return df.withColumn(column, F.when(ref(column) == old, new).otherwise(ref(column)))


def shift_value(df: DataFrame, key: dict[str, str], amount: float, value: str = "value") -> DataFrame:
    """D: one value is off by ``amount``; published totals stay."""
    stored = df.schema[value].dataType
    moved = (ref(value) + F.lit(amount).cast(stored)).cast(stored)
    return df.withColumn(value, F.when(key_is(key), moved).otherwise(ref(value)))


def drop_entity(df: DataFrame, column: str, entity: str) -> DataFrame:
    """E: one entity is missing altogether."""
    return df.where(~ref(column).eqNullSafe(F.lit(entity)))


def value_to_text(df: DataFrame, key: dict[str, str], text: str, value: str = "value") -> DataFrame:
    """F: one number turns into text; the column becomes text."""
    return df.withColumn(value, F.when(key_is(key), F.lit(text)).otherwise(ref(value).cast("string")))


def scale_values(df: DataFrame, factor: int, value: str = "value") -> DataFrame:
    """G: every value of a snapshot is multiplied."""
    return df.withColumn(value, ref(value) * F.lit(factor))


@dataclass(frozen=True)
class Scenario:
    """One fault: what is altered, which checks should notice, and how to run those checks.

    ``detect`` returns the check, reconciliation or statistical results of the altered tables.
    """

    scenario_id: str
    corruption_type: str
    target: str
    detectors: tuple[str, ...]
    detect: Callable[[], list[DataFrame]]
    advisory: bool = False


def scenario_catalogue(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    """(scenario_id, corruption_type, target, expected_detectors, advisory)."""
    rows = [(s.scenario_id, s.corruption_type, s.target, ", ".join(s.detectors), s.advisory) for s in scenarios]
    return spark.createDataFrame(
        rows, "scenario_id string, corruption_type string, target string, expected_detectors string, advisory boolean"
    )


def _signals(results: DataFrame, scenario: Scenario) -> DataFrame:
    """(scenario_id, detector, status, severity) whatever kind of result rows these are."""
    names = [c for c in ("check_id", "rule_code", "test_method") if c in results.columns]
    severity = F.col("severity") if "severity" in results.columns else F.lit(None).cast("string")
    return results.select(
        F.lit(scenario.scenario_id).alias("scenario_id"), F.col(names[0]).alias("detector"), "status", severity.alias("severity")
    ).where(F.col("detector").isin(*scenario.detectors))


def detection_matrix(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    """(scenario_id, corruption_type, target, expected_detectors, actual_detectors, evidence, detected, blocked).

    A scenario is blocked when a detector fails with severity CRITICAL or ERROR. Detector names per scenario are a
    fixed short list.
    """
    signals = union_all([_signals(results, s) for s in scenarios for results in s.detect()])
    fired = F.col("status").isin(FAIL, WARNING, UNRESOLVED, DIFFERENT)
    blocking = (F.col("status") == FAIL) & F.col("severity").isin(CRITICAL, ERROR)
    known = scenario_catalogue(spark, scenarios)
    texts = ["corruption_type", "target", "expected_detectors", "advisory"]
    return (
        known.unionByName(signals, allowMissingColumns=True)
        .groupBy("scenario_id")
        .agg(
            *[F.max(name).alias(name) for name in texts],
            F.array_join(F.sort_array(F.collect_set(F.when(fired, F.col("detector")))), ", ").alias("actual_detectors"),
            F.count_if(fired).alias("evidence"),
            F.coalesce(F.bool_or(blocking), F.lit(False)).alias("blocked"),
        )
        .select(
            "scenario_id",
            "corruption_type",
            "target",
            "expected_detectors",
            "actual_detectors",
            "evidence",
            (F.col("evidence") > 0).alias("detected"),
            "blocked",
            "advisory",
        )
    )


def detection_summary(matrix: DataFrame) -> DataFrame:
    """Totals over the detection matrix: scenarios, detected, missed, blocked, advisory, shares in percent."""
    return matrix.agg(
        F.count("*").alias("n_scenarios"),
        F.count_if("detected").alias("n_detected"),
        F.count_if(~F.col("detected")).alias("n_missed"),
        F.count_if("blocked").alias("n_blocked"),
        F.count_if(F.col("detected") & F.col("advisory")).alias("n_advisory"),
    ).select(
        "*",
        (F.try_divide(F.col("n_detected"), F.col("n_scenarios")) * 100.0).alias("detected_pct"),
        (F.try_divide(F.col("n_blocked"), F.col("n_scenarios")) * 100.0).alias("blocked_pct"),
    )


def isolation_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table_name, rows_before, rows_after, unchanged) of two ``(table_name, n_rows)`` frames."""
    both = union_all(
        [
            before.select("table_name", F.col("n_rows").alias("b"), F.lit(None).cast("long").alias("a")),
            after.select("table_name", F.lit(None).cast("long").alias("b"), F.col("n_rows").alias("a")),
        ]
    )
    met = both.groupBy("table_name").agg(F.max("b").alias("rows_before"), F.max("a").alias("rows_after"))
    return met.withColumn("unchanged", F.col("rows_before").eqNullSafe(F.col("rows_after")))
