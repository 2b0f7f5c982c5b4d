"""Schema, completeness, uniqueness, domain, numeric and structural checks of long tables.

Every function returns rows of the common result schema. The counts of one table come from one grouping by its key
followed by one global aggregate, whatever the number of checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfoot.config import CrosstabSpec, TableSpec
from crossfoot.functions.cells import is_infinite, is_non_numeric, numeric
from crossfoot.operators.reshape import union_all
from crossfoot.operators.results import Sql, as_sql, check, check_rows, text
from crossfoot.runtime import ref
from crossfoot.schemas import CHECK_RESULT, CRITICAL, ERROR, INFO, WARNING
from crossfoot.sources.crosstab import GRAND, body, entity_columns

Domain = DataFrame | list[str]


def label_set(spark: SparkSession, domain: Domain, name: str = "label") -> DataFrame:
    """One-column DataFrame of the distinct labels of a domain."""
    if isinstance(domain, DataFrame):
        return domain.select(ref(domain.columns[0]).alias(name)).where(F.col(name).isNotNull()).distinct()
    return spark.createDataFrame([(label,) for label in sorted(set(domain))], T.StructType().add(name, "string"))


def domain_size(domain: Domain) -> Column:
    if isinstance(domain, DataFrame):
        return domain.agg(F.count_distinct(ref(domain.columns[0]))).scalar()
    return F.lit(len(set(domain)))


def first_labels(labels: DataFrame, count: int = 3) -> Column:
    """The first labels in alphabetical order, joined by commas. Each task keeps ``count`` labels."""
    column = labels.columns[0]
    top = labels.select(ref(column).cast("string").alias("_l")).orderBy("_l").limit(count)
    return F.coalesce(top.agg(F.array_join(F.sort_array(F.collect_list("_l")), ", ")).scalar(), F.lit(""))


# --- schema ---------------------------------------------------------------------------------------------------------


def schema_checks(spark: SparkSession, tables: dict[str, DataFrame], specs: list[TableSpec]) -> DataFrame:
    """Tables present, required columns present, no undocumented columns, codes stored as text.

    Reads schemas on the driver; only the code check of a wrongly typed table counts rows.
    """
    missing = [spec.name for spec in specs if spec.name not in tables]
    one = spark.range(0, 1, 1, 1)
    rows = [
        check("SCH-01", "SCHEMA", "Expected tables present", "source", not missing, CRITICAL,
              ", ".join(spec.name for spec in specs), ", ".join(sorted(tables)), float(len(missing)), len(missing),
              f"All {len(specs)} expected tables are present.", f"Missing tables: {', '.join(missing)}.")
    ]
    counted = []
    for spec in specs:
        if spec.name not in tables:
            rows.append(
                check(f"SCH-02-{spec.name}", "SCHEMA", "Table exists", spec.name, False, CRITICAL,
                      ", ".join(spec.required), None, None, 0, "", f"Table {spec.name} is missing.")
            )
            continue
        columns = tables[spec.name].columns
        absent = [c for c in spec.required if c not in columns]
        extra = [c for c in columns if c not in spec.required]
        rows.append(
            check(f"SCH-02-{spec.name}", "SCHEMA", "Required columns present", spec.name, not absent, CRITICAL,
                  ", ".join(spec.required), ", ".join(columns), float(len(absent)), len(absent),
                  "All required columns are present.", f"Missing columns: {', '.join(absent)}.")
        )
        rows.append(
            check(f"SCH-03-{spec.name}", "SCHEMA", "No undocumented columns", spec.name, not extra, WARNING,
                  "", ", ".join(extra), float(len(extra)), len(extra), "No undocumented columns.",
                  f"Undocumented columns: {', '.join(extra)}.", status=WARNING)
        )
        if spec.code and spec.code in columns:
            stored = tables[spec.name].schema[spec.code].dataType
            if isinstance(stored, T.StringType):
                rows.append(code_type_row(spec.name, stored, Sql("0L")))
            else:
                counted.append(code_type_check(tables[spec.name], spec.code, spec.name))
    return union_all([check_rows(one, rows), *counted])


def code_type_row(table: str, stored: T.DataType, wrong: Sql) -> Sql:
    return check(f"SCH-04-{table}", "SCHEMA", "Code stored as text", table, Sql(f"{wrong} = 0"), ERROR, "string",
                 stored.simpleString(), wrong, wrong, "All codes are stored as text.",
                 text(wrong, " codes are not text."))


def code_type_check(df: DataFrame, code: str, table: str) -> DataFrame:
    """Codes are stored as text, so that leading zeros survive. Rows are counted only when the type is wrong."""
    stored = df.schema[code].dataType
    if isinstance(stored, T.StringType):
        metrics = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("wrong"))
    else:
        metrics = df.agg(F.count(ref(code)).alias("wrong"))
    return check_rows(metrics, [code_type_row(table, stored, Sql("wrong"))])


# --- counts of one table --------------------------------------------------------------------------------------------


def table_metrics(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: n_rows, n_duplicates, n_non_numeric, n_negative, min_negative, n_infinite, n_null, n_bad_codes.

    The first aggregate groups by the natural key and is combined before the shuffle, so a key that repeats many
    times travels as one row per task.
    """
    value = numeric(df, spec.value)
    raw_missing = ref(spec.value).isNull()
    if isinstance(df.schema[spec.value].dataType, (T.DoubleType, T.FloatType)):
        raw_missing = raw_missing | F.isnan(ref(spec.value))
    keyed = df.groupBy(*[ref(name) for name in spec.key]).agg(
        F.count("*").alias("n"),
        F.count_if(is_non_numeric(df, spec.value)).alias("n_non_numeric"),
        F.count_if(value < 0).alias("n_negative"),
        F.min(F.when(value < 0, value)).alias("min_negative"),
        F.count_if(is_infinite(value)).alias("n_infinite"),
        F.count_if(raw_missing).alias("n_null"),
    )
    sums = ("n", "n_duplicates", "n_non_numeric", "n_negative", "n_infinite", "n_null")
    per_code = [F.sum(name).alias(name) for name in sums] + [F.min("min_negative").alias("min_negative")]
    keyed = keyed.withColumn("n_duplicates", F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    bad_codes = F.lit(0).cast("long")
    if spec.code:
        if spec.code not in spec.key:
            raise ValueError(f"code column {spec.code!r} of {spec.name} must be part of its key")
        # Codes are looked up once each, not once per row: a code of a third of the rows is one row here.
        keyed, known = flag_members(keyed.groupBy(ref(spec.code)).agg(*per_code), spec.code, spec.domains.get(spec.code))
        valid = ref(spec.code).rlike(spec.code_pattern) & known
        bad_codes = F.coalesce(F.sum(F.when(~F.coalesce(valid, F.lit(False)), F.col("n"))), F.lit(0))

    def total(name: str, alias: str | None = None) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(alias or name)

    return keyed.agg(
        total("n", "n_rows"),
        total("n_duplicates"),
        total("n_non_numeric"),
        total("n_negative"),
        F.min("min_negative").alias("min_negative"),
        total("n_infinite"),
        total("n_null"),
        bad_codes.alias("n_bad_codes"),
    ).select(F.lit(spec.name).alias("table_name"), "*")


def flag_members(df: DataFrame, column: str, domain: Domain | None) -> tuple[DataFrame, Column]:
    """The frame and a boolean column: is ``column`` in the domain. Without a domain everything is."""
    if domain is None:
        return df, F.lit(True)
    if isinstance(domain, list):
        return df, F.coalesce(ref(column).isin(domain), F.lit(False))
    labels = label_set(df.sparkSession, domain, "_member").withColumn("_known", F.lit(True))
    joined = df.join(labels, ref(column) == F.col("_member"), "left").drop("_member")
    return joined, F.coalesce("_known", F.lit(False))


def expected_rows(spec: TableSpec) -> Column:
    """Product of the sizes of the domains that span the table."""
    product = F.lit(1).cast("long")
    for column in spec.expected_from:
        product = product * domain_size(spec.domains[column])
    return product


def count_checks(spec: TableSpec, number: int) -> list[Sql]:
    """Checks that read one row of :func:`table_metrics`."""
    table, n = spec.name, Sql("n_rows")
    rows = []
    if spec.expected_from:
        gap, wanted = Sql("abs(n_rows - expected_rows)"), Sql("expected_rows")
        rows.append(
            check(f"CMP-{number:02d}", "COMPLETENESS", "Record completeness", table, Sql("n_rows = expected_rows"), CRITICAL,
                  wanted, n, gap, gap, text("All ", n, " expected records are present."),
                  text("Expected ", wanted, " records, observed ", n, "."))
        )
    dup = Sql("n_duplicates")
    rows.append(
        check(f"UNQ-{number:02d}", "UNIQUENESS", "Natural key uniqueness", table, Sql("n_duplicates = 0"), CRITICAL,
              "0 duplicates", text(dup, " duplicates"), dup, dup, text("Key is unique across ", n, " rows."),
              text(dup, " rows share the key ", ", ".join(spec.key), "."))
    )
    if spec.code:
        bad = Sql("n_bad_codes")
        rows.append(
            check(f"DOM-03-{table}", "DOMAIN", "Code format", table, Sql("n_bad_codes = 0"), ERROR, spec.code_pattern,
                  text(bad, " invalid"), bad, bad, "All codes are valid.", text(bad, " rows carry an invalid code."))
        )
    non, neg, inf, null = (Sql(c) for c in ("n_non_numeric", "n_negative", "n_infinite", "n_null"))
    rows += [
        check(f"NUM-01-{table}", "NUMERIC", "Non-numeric values", table, Sql("n_non_numeric = 0"), ERROR,
              "number or NULL", text(non, " non-numeric"), non, non, "All values are numeric or NULL.",
              text(non, " values are not numeric.")),
        check(f"NUM-02-{table}", "NUMERIC", "Negative values", table, Sql("n_negative = 0"), ERROR, ">= 0",
              text(neg, " negative"), neg, neg, "No value is negative.",
              text(neg, " values are negative, lowest ", Sql("min_negative"), ".")),
        check(f"NUM-03-{table}", "NUMERIC", "Infinite values", table, Sql("n_infinite = 0"), CRITICAL, "0 infinite",
              text(inf, " infinite"), inf, inf, "No value is infinite.", text(inf, " values are infinite.")),
    ]
    if spec.expected_nulls is not None:
        off = Sql(f"abs(n_null - {spec.expected_nulls})")
        rows.append(
            check(f"NUM-05-{table}", "NUMERIC", "NULL count audit", table, Sql(f"n_null = {spec.expected_nulls}"), WARNING,
                  f"{spec.expected_nulls} NULLs", text(null, " NULLs"), off, off, "NULL count is as expected.",
                  text("Expected ", spec.expected_nulls, " NULLs, observed ", null, "."), status=WARNING)
        )
    return rows


def table_checks(spark: SparkSession, df: DataFrame | None, spec: TableSpec, number: int) -> DataFrame:
    """All count-based checks of one table.

    An absent table has 0 records and skips the rest; an absent column fails instead of raising.
    """
    if df is None:
        metrics = spark.range(1).select(F.lit(0).cast("long").alias("n_rows"), expected_rows(spec).alias("expected_rows"))
        if not spec.expected_from:
            return metrics_free(spark)
        rows = check_rows(metrics, count_checks(spec, number)[:1])
        return rows.withColumn("message", F.concat("message", F.lit(" The table is absent: its other checks are SKIPPED.")))
    absent = [c for c in dict.fromkeys((*spec.key, spec.value)) if c not in df.columns]
    if absent:
        row = check(f"UNQ-{number:02d}", "UNIQUENESS", "Columns needed by the checks", spec.name, False, CRITICAL,
                    ", ".join((*spec.key, spec.value)), ", ".join(df.columns), float(len(absent)), len(absent), "",
                    f"Column missing: {', '.join(absent)}.")
        return check_rows(spark.range(1), [row])
    metrics = table_metrics(df, spec)
    if spec.expected_from:
        metrics = metrics.withColumn("expected_rows", expected_rows(spec))
    return check_rows(metrics, count_checks(spec, number))


def metrics_free(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CHECK_RESULT)


# --- label sets -----------------------------------------------------------------------------------------------------


def observed_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct labels over one or more columns; NULL is one label."""
    return union_all([df.select(ref(c).cast("string").alias("label")).distinct() for c in columns]).distinct()


def unexpected_labels(df: DataFrame, columns: list[str], domain: Domain) -> DataFrame:
    """Distinct labels outside the domain, NULL included."""
    allowed = label_set(df.sparkSession, domain)
    return observed_labels(df, columns).join(allowed, "label", "left_anti")


def absent_labels(df: DataFrame, columns: list[str], domain: Domain) -> DataFrame:
    """Domain labels that do not occur."""
    return label_set(df.sparkSession, domain).join(observed_labels(df, columns), "label", "left_anti")


def membership_check(df: DataFrame, table: str, columns: list[str], domain: Domain) -> DataFrame:
    """DOM-01: labels outside the domain; counts distinct labels."""
    bad = unexpected_labels(df, columns, domain)
    metrics = bad.agg(F.count("*").alias("bad")).withColumn(
        "examples", first_labels(bad.select(F.coalesce("label", F.lit("NULL")).alias("label")))
    )
    return check_rows(metrics, [membership_row(table, Sql("bad"), Sql("examples"))])


def membership_row(table: str, n: Sql, examples: Sql) -> Sql:
    return check(f"DOM-01-{table}", "DOMAIN", "Domain membership", table, Sql(f"{n} = 0"), ERROR, "subset of the domain",
                 text(n, " invalid labels"), n, n, "All labels belong to the domain.",
                 text("Invalid labels: ", examples, "."))


def label_set_check(
    df: DataFrame, check_id: str, table: str, columns: list[str], domain: Domain, symmetric: bool, severity: str
) -> DataFrame:
    """Every domain label occurs and, if ``symmetric``, no other label does."""
    absent = absent_labels(df, columns, domain)
    metrics = absent.agg(F.count("*").alias("absent")).withColumn("absent_examples", first_labels(absent))
    if symmetric:
        extra = unexpected_labels(df, columns, domain)
        metrics = metrics.withColumn("extra", extra.agg(F.count("*")).scalar())
    else:
        metrics = metrics.withColumn("extra", F.lit(0).cast("long"))
    metrics = metrics.withColumn("expected", domain_size(domain))
    row = label_set_row(check_id, table, Sql("absent"), Sql("extra"), Sql("expected"), Sql("absent_examples"), severity)
    return check_rows(metrics, [row])


def label_set_row(check_id: str, table: str, absent: Sql, extra: Sql, expected: Sql, examples: Sql, severity: str) -> Sql:
    n = Sql(f"({absent} + {extra})")
    return check(check_id, "COMPLETENESS", "Label set completeness", table, Sql(f"{n} = 0"), severity,
                 text(expected, " labels"), text(absent, " missing, ", extra, " unexpected"),
                 n, n, "The label set is complete.", text("Missing labels: ", examples, "."))


def label_preserved_check(df: DataFrame, table: str, column: str, kept: str, corrected: str) -> DataFrame:
    """DOM-02: the source spelling occurs and the corrected spelling does not."""
    metrics = df.agg(
        F.coalesce(F.bool_or(ref(column) == kept), F.lit(False)).alias("has_kept"),
        F.coalesce(F.bool_or(ref(column) == corrected), F.lit(False)).alias("has_corrected"),
    )
    return check_rows(metrics, [label_preserved_row(table, kept, corrected, Sql("has_kept"), Sql("has_corrected"))])


def label_preserved_row(table: str, kept: str, corrected: str, has_kept: Sql, has_corrected: Sql) -> Sql:
    ok = Sql(f"({has_kept}) AND NOT ({has_corrected})")
    off = Sql(f"if({ok}, 0, 1)")
    seen = Sql(f"CASE WHEN {has_corrected} THEN {as_sql(corrected)} WHEN {has_kept} THEN {as_sql(kept)} ELSE 'neither' END")
    return check("DOM-02", "DOMAIN", "Source spelling preserved", table, ok, ERROR, kept, seen, off, off,
                 "The source spelling is preserved.", "The source spelling was changed or is missing.")


# --- structure ------------------------------------------------------------------------------------------------------


def reshape_check(wide: DataFrame, spec: CrosstabSpec, long: DataFrame, table: str) -> DataFrame:
    """STR-01: cells of the wide table = rows of the long table."""
    width = len(entity_columns(wide, spec))
    metrics = (
        body(wide, spec)
        .agg((F.count("*") * width).alias("cells"))
        .withColumn("rows", long.agg(F.count("*")).scalar())
    )
    return check_rows(metrics, [reshape_row(table, Sql("cells"), Sql("rows"))])


def reshape_row(table: str, cells: Sql, rows: Sql) -> Sql:
    gap = Sql(f"abs({cells} - {rows})")
    return check("STR-01", "STRUCTURAL", "Reshape conservation", table, Sql(f"{cells} = {rows}"), CRITICAL, cells, rows, gap,
                 gap, text(cells, " cells became ", rows, " rows."), text(cells, " cells, but ", rows, " rows."))


def summary_present_check(totals: DataFrame, table: str) -> DataFrame:
    """STR-02: the published grand total exists and is filled."""
    found = F.count_if((F.col("table_name") == table) & (F.col("axis") == GRAND) & F.col("value").isNotNull())
    return check_rows(totals.agg(found.alias("found")), [summary_present_row(table, Sql("found"))])


def summary_present_row(table: str, found: Sql) -> Sql:
    off = Sql(f"if({found} > 0, 0, 1)")
    return check(f"STR-02-{table}", "STRUCTURAL", "Published grand total present", table, Sql(f"{found} > 0"), ERROR,
                 "grand total", text(found, " found"), off, off, "The grand total is present.",
                 "The grand total is missing.")


def column_count_check(wide: DataFrame, spec: CrosstabSpec, expected: int) -> DataFrame:
    """STR-03: the table has exactly the documented number of columns."""
    actual = len([c for c in wide.columns if c not in (spec.row_role, spec.source_row)])
    ok = actual == expected
    return check_rows(
        wide.sparkSession.range(0, 1, 1, 1),
        [
            check(f"STR-03-{spec.name}", "STRUCTURAL", "Documented column count", spec.name, ok, INFO,
                  f"{expected} columns", f"{actual} columns", 0.0 if ok else 1.0, 0,
                  "The column count is as documented.", "The column count is not as documented.", status=WARNING)
        ],
    )


# --- constraints ----------------------------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by several rows, with their row count."""
    return df.groupBy(*[ref(c) for c in key]).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def orphan_summary(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """(constraint, n_rows, n_orphans, n_orphan_keys) of a reference from child to parent.

    The child is reduced to one row per key first, so a key that many rows share is joined once. NULL references
    nothing and is no orphan.
    """
    keys = child.where(ref(key).isNotNull()).groupBy(ref(key).alias("_key")).agg(F.count("*").alias("n"))
    parents = parent.select(ref(parent_key).alias("_key")).distinct().withColumn("_found", F.lit(True))
    orphan = F.col("_found").isNull()
    return keys.join(parents, "_key", "left").agg(
        F.lit(name).alias("constraint"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("n_orphans"),
        F.count_if(orphan).alias("n_orphan_keys"),
    )
