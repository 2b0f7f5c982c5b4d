"""Vocabularies and result schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Statuses and severities of the result tables.
PASS, WARNING, FAIL, UNRESOLVED = "PASS", "WARNING", "FAIL", "UNRESOLVED"
INFO, ERROR, CRITICAL = "INFO", "ERROR", "CRITICAL"
NO_CHANGE = "NO_MATERIAL_STATISTICAL_CHANGE"
DIFFERENT = "STATISTICALLY_DIFFERENT"
INSUFFICIENT = "INSUFFICIENT_DATA"
NOT_APPLICABLE = "NOT_APPLICABLE"
STARTED, COMPLETED, FAILED = "STARTED", "COMPLETED", "FAILED"
OPEN, ACKNOWLEDGED, RESOLVED = "OPEN", "ACKNOWLEDGED", "RESOLVED"
CHECK_CATEGORIES = ("SCHEMA", "COMPLETENESS", "UNIQUENESS", "DOMAIN", "NUMERIC", "STRUCTURAL", "SOURCE_TOTAL")
UNRESOLVED_TEXT = "UNRESOLVED DATA/DEFINITION DIFFERENCE — REQUIRES FURTHER INVESTIGATION"

CHECK_RESULT = T.StructType(
    [
        T.StructField("check_id", T.StringType()),
        T.StructField("check_category", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("expected", T.StringType()),
        T.StructField("observed", T.StringType()),
        T.StructField("difference", T.DoubleType()),
        T.StructField("affected_records", T.LongType()),
        T.StructField("tolerance", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)

RECONCILIATION_RESULT = T.StructType(
    [
        T.StructField("rule_code", T.StringType()),
        T.StructField("source_tables", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("expected_value", T.DoubleType()),
        T.StructField("observed_value", T.DoubleType()),
        T.StructField("absolute_difference", T.DoubleType()),
        T.StructField("relative_difference", T.DoubleType()),
        T.StructField("absolute_tolerance", T.DoubleType()),
        T.StructField("relative_tolerance", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

STATISTICAL_RESULT = T.StructType(
    [
        T.StructField("dimension", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("test_method", T.StringType()),
        T.StructField("n_reference", T.LongType()),
        T.StructField("n_comparison", T.LongType()),
        T.StructField("statistic", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("alpha", T.DoubleType()),
        T.StructField("psi_value", T.DoubleType()),
        T.StructField("psi_threshold", T.DoubleType()),
        T.StructField("pct_change", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("interpretation", T.StringType()),
    ]
)

RUN_EVENT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("row_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("summary", T.StringType()),
    ]
)
