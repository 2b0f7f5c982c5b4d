"""Result rows, run events and incidents derived from the order tables, for the read side.

Every order is one check: does its printed total equal the sum of its lines. The year is the run, the priority the
check category, the status the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.operators import totals
from crossfoot.plans.flow import table
from crossfoot.schemas import CRITICAL, DIFFERENT, ERROR, FAIL, INFO, NO_CHANGE, NOT_APPLICABLE, PASS, UNRESOLVED, WARNING
from crossfoot.sources.crosstab import COLUMN

# Differences up to which an order passes, warns or fails as an error.
PASS_UP_TO, WARN_UP_TO, ERROR_UP_TO = 50_000, 100_000, 200_000


def order_line_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_key, n_lines, line_sum): one row per order that has lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_key"))
    return lines.agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("line_sum")
    )


def order_total_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed order totals against line sums, through the published-total operator."""
    orders = table(spark, sf_dir, "orders")
    name, axis = F.lit("orders").alias("table_name"), F.lit(COLUMN).alias("axis")
    reported = orders.select(name, axis, F.col("o_orderkey").cast("string").alias("entity"),
                             F.col("o_totalprice").cast("decimal(18,2)").alias("value"))
    cells = table(spark, sf_dir, "lineitem").select(
        name, F.lit(None).cast("string").alias("code"), F.col("l_orderkey").cast("string").alias("entity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"))
    return totals.total_differences(totals.computed_totals(cells, [COLUMN]), reported)


def order_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results of all orders, with ``run_id`` and ``entity``."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    joined = orders.join(order_line_sums(spark, sf_dir), F.col("o_orderkey") == F.col("order_key"), "left")
    observed = F.coalesce("line_sum", F.lit(0))
    gap = F.abs(observed - F.col("total")).cast("double")
    passed, warned = gap <= PASS_UP_TO, gap <= WARN_UP_TO
    return joined.select(
        F.concat(F.lit("run-"), F.year("o_orderdate").cast("string")).alias("run_id"),
        F.concat(F.lit("TOT-"), F.substring("o_orderpriority", 1, 1), F.lit("-"), F.col("o_orderstatus")).alias("check_id"),
        F.col("o_orderpriority").alias("check_category"),
        F.lit("Order total").alias("check_name"),
        F.concat(F.lit("orders_"), F.col("o_orderstatus")).alias("table_name"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("entity"),
        F.when(passed, PASS).when(warned, WARNING).otherwise(FAIL).alias("status"),
        F.when(passed, INFO).when(warned, WARNING).when(gap <= ERROR_UP_TO, ERROR).otherwise(CRITICAL).alias("severity"),
        F.col("total").cast("string").alias("expected"),
        observed.cast("decimal(18,2)").cast("string").alias("observed"),
        gap.alias("difference"),
        F.coalesce("n_lines", F.lit(0)).alias("affected_records"),
    )


def order_reconciliations(checked: DataFrame) -> DataFrame:
    """The same comparison as reconciliation rows: advisory, severe cases are open questions."""
    status = F.col("status")
    return checked.select(
        "run_id",
        F.concat(F.lit("REC-"), F.substring("check_category", 1, 1)).alias("rule_code"),
        F.col("table_name").alias("dimension"),
        "entity",
        F.when(F.col("severity") == CRITICAL, UNRESOLVED).when(status == PASS, PASS).otherwise(WARNING).alias("status"),
        "difference",
    )


def order_statistics(checked: DataFrame) -> DataFrame:
    """The same comparison as statistical rows: the share by which the line sum departs from the printed total."""
    share = F.try_divide(F.col("difference"), F.col("expected").cast("double")) * 100.0
    status = F.when(share.isNull(), NOT_APPLICABLE).when(share <= 25.0, NO_CHANGE).otherwise(DIFFERENT)
    return checked.select(
        "run_id",
        F.col("check_category").alias("dimension"),
        F.col("entity").alias("metric"),
        F.when(F.col("table_name") == "orders_F", "KS_TEST").when(F.col("table_name") == "orders_O", "PSI").otherwise("YOY_CHANGE").alias("test_method"),
        status.alias("status"),
        share.alias("pct_change"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run events from the event stream: a user is a run, a signup its start, a purchase its end, an error its failure."""
    kinds = {"signup": "STARTED", "purchase": "COMPLETED", "error": "FAILED"}
    pairs = F.create_map(*[F.lit(x) for entry in kinds.items() for x in entry])
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds))
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.element_at(pairs, F.col("event_type")).alias("status"),
    )


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert outcomes per customer, as if each customer were an incident: every order is an attempt, SENT if it was urgent
    and has status F."""
    orders = table(spark, sf_dir, "orders")
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    outcome = F.when(urgent, "SENT").otherwise("FAILED")
    return orders.select(
        F.concat(F.lit("INC-"), F.col("o_custkey").cast("string")).alias("incident_id"), outcome.alias("outcome")
    )


def customer_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per customer with a negative or low balance."""
    customers = table(spark, sf_dir, "customer")
    balance = F.col("c_acctbal")
    return customers.where(balance < 5000).select(
        F.concat(F.lit("INC-"), F.col("c_custkey").cast("string")).alias("incident_id"),
        F.concat(F.lit("run-"), F.col("c_nationkey").cast("string")).alias("run_id"),
        F.when(balance < 1000, CRITICAL).when(balance < 3000, ERROR).otherwise(WARNING).alias("severity"),
        F.when(F.col("c_mktsegment") == "BUILDING", "RESOLVED").otherwise("OPEN").alias("status"),
        F.col("c_mktsegment").alias("source_table"),
        F.col("c_custkey").alias("detected_at"),
    )
