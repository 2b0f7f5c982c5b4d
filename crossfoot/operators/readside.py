"""Queries over runs, results and incidents. Filters are plain column comparisons, so they reach the files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossfoot.functions.status import health
from crossfoot.operators.reshape import pivot_counts, union_all
from crossfoot.runtime import materialize, ref
from crossfoot.schemas import CRITICAL, DIFFERENT, FAIL, NO_CHANGE, OPEN, PASS, UNRESOLVED, WARNING
from crossfoot.sources.files import row_digest


def filter_rows(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows that match every given value; None and ``ALL`` do not filter."""
    for column, value in wanted.items():
        if value is not None and value != "ALL":
            df = df.where(ref(column) == value)
    return df


def validation_results(df: DataFrame, run_id=None, table_name=None, check_category=None, status=None) -> DataFrame:
    rows = filter_rows(df, run_id=run_id, table_name=table_name, check_category=check_category, status=status)
    return rows.orderBy("check_id", "table_name")


def reconciliation_results(df: DataFrame, run_id=None, rule_code=None, status=None) -> DataFrame:
    return filter_rows(df, run_id=run_id, rule_code=rule_code, status=status).orderBy("rule_code", "dimension", "entity")


def statistical_results(df: DataFrame, run_id=None, dimension=None, test_method=None, status=None) -> DataFrame:
    rows = filter_rows(df, run_id=run_id, dimension=dimension, test_method=test_method, status=status)
    return rows.orderBy("dimension", "test_method", "metric")


def incident_list(df: DataFrame, run_id=None, severity=None, status=None, source_table=None) -> DataFrame:
    """Newest incidents first."""
    rows = filter_rows(df, run_id=run_id, severity=severity, status=status, source_table=source_table)
    return rows.orderBy(F.desc("detected_at"), "incident_id")


# --- pages ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PageEnd:
    """Where a page stopped: order values and digest of its last row, and how many copies of that row were shown."""

    values: tuple
    digest: str
    copies: int


DIGEST = "row_digest"


def result_page(df: DataFrame, order: list[str], size: int, after: PageEnd | None = None) -> tuple[DataFrame, PageEnd | None]:
    """The next ``size`` rows in the order of ``order`` (NULL first), ties by row digest, and where that page stops.

    The order is total up to identical rows, which the mark counts, so pages neither overlap nor leave a gap, however
    many rows tie. Each page is a bounded top-k over the rows behind the mark, and the condition on the first order
    column reaches the files; earlier pages are never sorted again. Only the mark, taken from the page's own rows,
    reaches the driver. An exhausted list gives an empty page that stops where it began. The digest column
    (``row_digest``) stays in the page.
    """
    rows = df.withColumn(DIGEST, row_digest(df))
    names = [*order, DIGEST]
    key = F.struct(*[ref(name) for name in names])
    if after is None:
        page = rows.orderBy(*[ref(name) for name in names]).limit(size)
    else:
        types = [rows.schema[name].dataType for name in names]
        values = [F.lit(v).cast(t) for v, t in zip((*after.values, after.digest), types)]
        mark = F.struct(*[v.alias(name) for v, name in zip(values, names)])
        behind = rows if after.values[0] is None else rows.where(ref(order[0]) >= values[0])
        copies = max(behind.where(key.eqNullSafe(mark)).count() - after.copies, 0)
        again = behind.where(key.eqNullSafe(mark)).limit(min(copies, size))
        later = behind.where(key > mark).orderBy(*[ref(name) for name in names]).limit(size - min(copies, size))
        page = again.unionByName(later)
    page = materialize(page)
    last = page.groupBy(*[ref(name) for name in names]).agg(F.count("*").alias("_copies")).orderBy(*[ref(name).desc_nulls_last() for name in names]).first()
    if last is None:
        return page, after
    *values, digest, copies = last
    same = after is not None and (tuple(values), digest) == (after.values, after.digest)
    return page, PageEnd(tuple(values), digest, copies + (after.copies if same else 0))


# --- runs -----------------------------------------------------------------------------------------------------------


def run_states(events: DataFrame) -> DataFrame:
    """Latest state of every run from its events: run_id, status, created_at, completed_at, duration_seconds.

    A run counts as finished at its last COMPLETED or FAILED event.
    """
    finished = F.col("status").isin("COMPLETED", "FAILED")
    states = events.groupBy("run_id").agg(
        F.max_by("status", F.struct("event_ts", "status")).alias("status"),
        F.min("event_ts").alias("created_at"),
        F.max(F.when(finished, F.col("event_ts"))).alias("completed_at"),
    )
    seconds = (F.unix_micros("completed_at") - F.unix_micros("created_at")) / 1e6
    return states.withColumn("duration_seconds", F.round(seconds, 2))


def run_details(events: DataFrame) -> DataFrame:
    """:func:`run_states` with source_name, source_path, row_counts and summary.

    Source and counts come from the latest event that names any, the summary from the latest event.
    """
    at = F.struct("event_ts", "status")
    known = events.groupBy("run_id").agg(
        F.max_by("source_name", F.when(F.col("source_name").isNotNull(), at)).alias("source_name"),
        F.max_by("source_path", F.when(F.col("source_name").isNotNull(), at)).alias("source_path"),
        F.max_by("row_counts", F.when(F.size("row_counts") > 0, at)).alias("row_counts"),
        F.max_by("summary", at).alias("summary"),
    )
    return run_states(events).join(known, "run_id")


def recent_runs(states: DataFrame, count: int) -> DataFrame:
    """The most recent runs, newest first."""
    return states.orderBy(F.desc("created_at"), F.desc("run_id")).limit(count)


# --- summaries ------------------------------------------------------------------------------------------------------


def overview(validation: DataFrame, reconciliation: DataFrame, statistical: DataFrame, incidents: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row per run: checks passed and run, open reconciliations, shifted tests, open incidents, promoted rows.

    Each input is reduced to one row per run before the rows meet.
    """
    status = F.col("status")
    parts = {
        "checks_passed": (validation, F.count_if(status == PASS)),
        "checks_total": (validation, F.count("*")),
        "unresolved": (reconciliation, F.count_if(status == UNRESOLVED)),
        "shifted": (statistical, F.count_if(status == DIFFERENT)),
        "open_incidents": (incidents, F.count_if(status == OPEN)),
        "promoted_rows": (trusted, F.sum("n_rows")),
    }
    grouped = []
    for df in dict.fromkeys(frame for frame, _ in parts.values()):
        sums = {name: expr for name, (frame, expr) in parts.items() if frame is df}
        counts = df.groupBy("run_id").agg(*[expr.alias(name) for name, expr in sums.items()])
        grouped.append(counts.select("run_id", *[(F.col(n) if n in sums else F.lit(0)).cast("long").alias(n) for n in parts]))
    return union_all(grouped).groupBy("run_id").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in parts])


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 1)


def validation_metrics(df: DataFrame) -> DataFrame:
    """Checks in total, passed, failed and with warnings."""
    status = F.col("status")
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == FAIL).alias("failed"),
        F.count_if(status == WARNING).alias("warnings"),
    )


def reconciliation_metrics(df: DataFrame) -> DataFrame:
    status = F.col("status")
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == UNRESOLVED).alias("unresolved"),
        F.count_if(status == FAIL).alias("failed"),
    )


def statistical_metrics(df: DataFrame) -> DataFrame:
    status = F.col("status")
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(status == NO_CHANGE).alias("stable"),
        F.count_if(status == DIFFERENT).alias("shifted"),
        F.count_if(~status.isin(NO_CHANGE, DIFFERENT)).alias("other"),
    )


def incident_metrics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == OPEN).alias("open"),
        F.count_if(F.col("severity") == CRITICAL).alias("critical"),
        F.count_if(F.col("alert_sent")).alias("alerted"),
    )


def validation_summary(df: DataFrame) -> DataFrame:
    """Totals with percentages, affected tables and affected records of everything that did not pass."""
    status = F.col("status")
    hit = status.isin(FAIL, WARNING)
    sums = df.agg(
        F.count("*").alias("total"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == WARNING).alias("warnings"),
        F.count_if(status == FAIL).alias("failed"),
        F.count_distinct(F.when(hit, F.col("table_name"))).alias("affected_tables"),
        F.coalesce(F.sum(F.when(hit, F.col("affected_records"))), F.lit(0)).alias("affected_records"),
    )
    shares = [_share(F.col(c), F.col("total")).alias(f"{c}_pct") for c in ("passed", "warnings", "failed")]
    return sums.select("*", *shares)


def category_health(df: DataFrame) -> DataFrame:
    """(check_category, total, passed, warnings, failed, health)."""
    status = F.col("status")
    counts = df.groupBy("check_category").agg(
        F.count("*").alias("total"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == WARNING).alias("warnings"),
        F.count_if(status == FAIL).alias("failed"),
    )
    return counts.withColumn("health", health(F.col("failed"), F.col("warnings")))


def category_status(df: DataFrame) -> DataFrame:
    """Check categories × statuses, absent combinations 0."""
    return pivot_counts(df, "check_category", "status", [PASS, WARNING, FAIL])


def reconciliation_summary(df: DataFrame) -> DataFrame:
    """(rule_code, status, n)."""
    return df.groupBy("rule_code", "status").agg(F.count("*").alias("n"))


def statistical_summary(df: DataFrame) -> DataFrame:
    """(grouping, name, n, pct): counts by method and by status with their share of all rows."""
    both = F.array(
        F.struct(F.lit("METHOD").alias("grouping"), F.col("test_method").alias("name")),
        F.struct(F.lit("STATUS").alias("grouping"), F.col("status").alias("name")),
    )
    counts = df.select(F.inline(both)).groupBy("grouping", "name").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("grouping"))
    return counts.withColumn("pct", _share(F.col("n"), total))


def layer_counts(layers: dict[str, DataFrame], run_id: str | None = None) -> DataFrame:
    """(run_id, table_name, n_rows) over any number of tables that carry a run id."""
    frames = []
    for name, df in layers.items():
        rows = filter_rows(df, run_id=run_id)
        frames.append(rows.groupBy("run_id").agg(F.count("*").alias("n_rows")).select("run_id", F.lit(name).alias("table_name"), "n_rows"))
    return union_all(frames)
