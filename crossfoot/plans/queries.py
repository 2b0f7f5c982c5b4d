"""Queries over the test tables, one per operator. Each takes (spark, sf_dir) and works on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crossfoot.config import StatsConfig, TableSpec, Tolerance
from crossfoot.functions.status import status_class
from crossfoot.operators import checks, distribution, faults, gate, profiling, readside, reconcile, reshape, snapshots, stacked, totals
from crossfoot.operators.ordered import ordinal_positions
from crossfoot.operators.reshape import union_all
from crossfoot.operators.results import check_rows
from crossfoot.plans import batch, derived, flow, run, suite
from crossfoot.plans.flow import CATEGORY_TABLES, SPECS, published, published_snapshots, table, unresolved_lines
from crossfoot.runtime import materialize, ref, shared_path
from crossfoot.sources import crosstab, files, layout, publish

Query = Callable[[SparkSession, str], DataFrame]

# Periods, entity and category that the queries single out.
REFERENCE_YEAR, COMPARISON_YEAR = 1996, 1997
ENTITY, CODE = "NATION_3", "Brand#12"
CODE_PATTERN = "^Brand#[0-9]{1,2}$"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
CHECK_COLUMNS = ("check_id", "table_name", "status", "severity", "expected", "observed", "difference", "affected_records")


def amount(name: str, digits: int = 2) -> Column:
    """A number as it is compared with other engines: double, rounded."""
    return F.round(F.col(name).cast("double"), digits).alias(name)


def _checks(df: DataFrame) -> DataFrame:
    return df.select(*CHECK_COLUMNS).withColumn("difference", amount("difference", 4))


def _reconciled(df: DataFrame) -> DataFrame:
    return df.select(
        "rule_code", "dimension", "entity", amount("expected_value"), amount("observed_value"),
        amount("absolute_difference"), amount("relative_difference", 9), "status", "severity",
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = published_snapshots(spark, sf_dir, REFERENCE_YEAR, COMPARISON_YEAR)
    return snapshots.comparable_dimensions(before.long(), after.long())


# --- reshape --------------------------------------------------------------------------------------------------------


def unpivot_matrix_nulls_kept(spark, sf_dir):
    return published(spark, sf_dir).long()["matrix"].select("origin", "destination", amount("value"))


def unpivot_category_entity(spark, sf_dir):
    return published(spark, sf_dir).long()["internal"].select("code", "description", "entity", amount("value"))


def flat_summary(spark, sf_dir):
    return published(spark, sf_dir).long()["summary"].select("code", "description", amount("value"))


def unified_fact(spark, sf_dir):
    long = published(spark, sf_dir).long()
    fact = reshape.unified_fact({name.upper(): long[name] for name in CATEGORY_TABLES})
    sums = fact.groupBy("movement_type", "entity").agg(
        F.count("*").alias("n_cells"), F.count("value").alias("n_filled"), F.sum("value").alias("value")
    )
    return sums.select("movement_type", "entity", "n_cells", "n_filled", amount("value"))


def densify_cells(spark, sf_dir):
    cube = flow.flow_cube(spark, sf_dir)
    own = cube.where(F.col("origin") == F.col("destination")).select("code", F.col("origin").alias("entity"), "value")
    labels = reshape.header_labels(flow.entity_dimension(spark, sf_dir), "entity")
    codes = flow.category_dimension(spark, sf_dir).select("code")
    return reshape.densify(own, codes, "code", "entity", labels).select("code", "entity", amount("value"))


def canonical_labels(spark, sf_dir):
    mapping = {"4-NOT SPECIFIED": "LOW", "5-LOW": "LOW", "1-URGENT": "HIGH", "2-HIGH": "HIGH"}
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("label"), reshape.canonical(F.col("o_orderpriority"), mapping).alias("canonical_label")
    )
    return orders.groupBy("label", "canonical_label").agg(F.count("*").alias("n"))


def canonical_labels_by_table(spark, sf_dir):
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    mapping = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("label"), F.col("r_name").alias("canonical_label")
    )
    buyers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_acctbal")
    mapped = reshape.canonical_by_table(buyers, "n_name", mapping, "canonical_label")
    sums = mapped.groupBy("canonical_label", "n_name").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"))
    return sums.select("canonical_label", "n_name", amount("balance"))


def reported_totals_long(spark, sf_dir):
    return published(spark, sf_dir).totals().select("table_name", "axis", "entity", amount("value"))


def pivot_category_status(spark, sf_dir):
    return readside.category_status(derived.order_checks(spark, sf_dir))


# --- sources --------------------------------------------------------------------------------------------------------


def _staged(spark, sf_dir) -> DataFrame:
    """Staged cells of the inward table; rows are numbered by code, as a publisher would sort them."""
    p = published(spark, sf_dir)
    wide = p.wide["inward"].where(F.col("row_role") == "BODY")
    numbered = ordinal_positions(wide.select("code"), [], ["code"], "source_row")
    return crosstab.stage_cells(wide.join(numbered, "code"), SPECS["inward"])


def staged_cells(spark, sf_dir):
    return _staged(spark, sf_dir).select(
        "table_name", "code", "entity", amount("value"), "is_summary", F.col("source_row").cast("long"), F.col("source_col").cast("long")
    )


def staged_metadata(spark, sf_dir):
    p = published(spark, sf_dir)
    rows = [crosstab.stage_metadata(p.wide[name], SPECS[name], "value" if name == "summary" else None) for name in SPECS]
    rows = [r.withColumn("reported_total", F.col("reported_total").cast("double")) for r in rows]
    total = F.aggregate(
        F.map_values(F.from_json("reported_entity_totals", "map<string,decimal(28,2)>")),
        F.lit(0).cast("decimal(38,2)"), lambda acc, v: (acc + v).cast("decimal(38,2)"))
    return union_all(rows).select(
        "table_name", "row_count", F.col("column_count").cast("long"), "null_cells_count", amount("reported_total"),
        total.cast("double").alias("reported_entity_sum"))


def file_fingerprint(spark, sf_dir):
    return files.file_fingerprints(spark, f"{sf_dir}/*.parquet").select("file_name", "size_bytes", "sha256")


def _printed(spark, wide: dict[str, DataFrame]) -> str:
    """The published tables as sheets in a fresh folder, one sub-folder each."""
    folder = shared_path(spark, "sheets")
    for name, df in wide.items():
        layout.write_sheet(df, SPECS[name], f"{folder}/{name}", f"Table {name}, all periods", ("blank cells: no movement",), margin=2)
    return folder


def _sheets(spark, sf_dir) -> dict[str, layout.Sheet]:
    """The published tables, printed and read again as raw sheets."""
    folder = _printed(spark, published(spark, sf_dir).wide)
    return {name: layout.read_sheet(spark, f"{folder}/{name}", SPECS[name]) for name in SPECS}


def sheet_layouts(spark, sf_dir):
    rows = [layout.sheet_metadata(sheet, SPECS[name], "value" if name == "summary" else None) for name, sheet in _sheets(spark, sf_dir).items()]
    return union_all([r.select("table_name", "title", "header_row", "data_start_row", "data_end_row", "footer_row", "first_col", "last_col") for r in rows])


def sheet_body(spark, sf_dir):
    cells = [crosstab.stage_cells(sheet.table, SPECS[name]).filter(~F.col("is_summary")).select(
        "table_name", F.col(SPECS[name].row_label).alias("row_label"), "entity", amount("value")) for name, sheet in _sheets(spark, sf_dir).items()]
    return union_all(cells)


def sheet_totals(spark, sf_dir):
    sheets = _sheets(spark, sf_dir)
    frames = [crosstab.reported_totals(sheets[name].table, SPECS[name], "value" if name == "summary" else None) for name in SPECS if name != "matrix"]
    return union_all(frames).select("table_name", "axis", "entity", amount("value"))


def files_unchanged(spark, sf_dir):
    """Two sheets printed before and after the first category's cells of one of them were doubled."""
    wide = {name: df for name, df in published(spark, sf_dir).wide.items() if name in ("inward", "outward")}
    first = wide["inward"].where(F.col("row_role") == "BODY").agg(F.min("code")).scalar()
    cells = {c: F.when(F.col("code") == first, ref(c) * 2).otherwise(ref(c)) for c in crosstab.entity_columns(wide["inward"], SPECS["inward"])}
    altered = {**wide, "inward": wide["inward"].withColumns(cells)}
    before, after = (files.folder_fingerprints(files.file_fingerprints(spark, f"{_printed(spark, tables)}/*", "part-*")) for tables in (wide, altered))
    return files.unchanged_files(before, after).select("file_name", "unchanged")


def flow_unresolved(spark, sf_dir):
    """Lines that no total can hold because a row they refer to is absent: large parts and indebted customers left out."""
    return unresolved_lines(spark, sf_dir, parts=F.col("p_size") <= 40, customers=F.col("c_acctbal") >= 0)


FINGERPRINTED = ("region", "nation", "benchmark", "labels", "conversations", "documents", "pages")


def content_fingerprint(spark, sf_dir):
    return union_all([files.content_fingerprint(table(spark, sf_dir, name), name) for name in FINGERPRINTED])


def content_unchanged(spark, sf_dir):
    """The tables as stored, against the tables with one quality label flipped: only that table has changed."""
    before = materialize(content_fingerprint(spark, sf_dir))
    labels = table(spark, sf_dir, "labels")
    first = labels.agg(F.min("doc_id")).scalar()
    altered = labels.withColumn("quality", F.when(F.col("doc_id") == first, 1 - F.col("quality")).otherwise(F.col("quality")))
    frames = [files.content_fingerprint(altered if name == "labels" else table(spark, sf_dir, name), name) for name in FINGERPRINTED]
    return files.unchanged_tables(before, union_all(frames))


# --- totals and reconciliation --------------------------------------------------------------------------------------


def _differences(spark, sf_dir, axis: str) -> DataFrame:
    p = published(spark, sf_dir)
    rows = suite.source_total_differences(p.long(), p.totals(), Tolerance()).where(F.col("axis") == axis)
    return rows.select("table_name", "axis", "entity", amount("computed"), amount("reported"), amount("difference"), "within")


def src_total_grand(spark, sf_dir):
    return _differences(spark, sf_dir, crosstab.GRAND)


def src_total_columns(spark, sf_dir):
    return _differences(spark, sf_dir, crosstab.COLUMN)


def src_total_rows(spark, sf_dir):
    return _differences(spark, sf_dir, crosstab.ROW)


def src_total_checks(spark, sf_dir):
    p = published(spark, sf_dir)
    return _checks(suite.source_total_checks(p.long(), p.totals(), Tolerance()).drop("expected", "observed").withColumns(
        {"expected": F.lit("totals"), "observed": F.lit("sums")}))


def cross_foot_both_axes(spark, sf_dir):
    return totals.cross_foot(published(spark, sf_dir).totals()).select(
        "table_name", "axis", amount("summed"), amount("grand"), amount("difference"), "within")


def _misprinted(p: flow.Published) -> dict[str, DataFrame]:
    """The wide tables with two printed totals off: one entity's outward total and the corner of the inward table."""
    footer = F.col("row_role") == crosstab.FOOTER
    off = {"outward": (ENTITY, 500), "inward": (flow.TOTAL, 7)}
    return {**p.wide, **{name: p.wide[name].withColumn(c, F.when(footer, ref(c) + by).otherwise(ref(c))) for name, (c, by) in off.items()}}


def _altered(spark, sf_dir) -> flow.Published:
    p = published(spark, sf_dir)
    return flow.Published(_misprinted(p), p.entities, p.categories, p.labels)


def src_totals_failing(spark, sf_dir):
    """The eight rules where two printed totals are wrong: three of them fail."""
    p = _altered(spark, sf_dir)
    return _checks(suite.source_total_checks(p.long(), p.totals(), Tolerance()).drop("expected", "observed").withColumns(
        {"expected": F.lit("totals"), "observed": F.lit("sums")}))


def cross_foot_failing(spark, sf_dir):
    return totals.cross_foot(_altered(spark, sf_dir).totals()).select(
        "table_name", "axis", amount("summed"), amount("grand"), amount("difference"), "within")


def _batch_runs(spark, sf_dir, faulty_only: bool = False) -> str:
    """Sheets of the tables, printed, read again and run: one clean run and one whose printed totals are off."""
    p, base = published(spark, sf_dir), shared_path(spark, "runs")
    entities, codes = materialize(p.entities), materialize(p.categories)
    specs = suite.table_specs(flow.Published({}, entities, codes, p.labels), CODE_PATTERN)
    for name, wide in (("clean", p.wide), ("faulty", _misprinted(p))):
        if name == "faulty" or not faulty_only:
            folder = _printed(spark, wide)
            loaded = batch.batch_of_sheets(spark, {t: f"{folder}/{t}" for t in SPECS}, suite.RULES, entities)
            run.run_reliability(spark, base, name, loaded, specs, source_name=name, source_path=folder)
    return base


RUN_NAMES = {gate.deterministic_run_id(name): name for name in ("clean", "faulty")}


def _run_name() -> Column:
    cases = [F.lit(x) for pair in RUN_NAMES.items() for x in pair]
    return F.create_map(*cases)[F.col("run_id")].alias("run_name")


def pipeline_results(spark, sf_dir):
    """Stored validation rows of both runs."""
    rows = publish.read_layer(spark, _batch_runs(spark, sf_dir), publish.RESULTS, "validation")
    return rows.select(_run_name(), "check_id", "check_category", "table_name", "status", "severity", amount("difference", 4), "affected_records")


def pipeline_decision(spark, sf_dir):
    """State of both runs with their source, the rows they published and the cells they staged."""
    base = _batch_runs(spark, sf_dir)
    states = readside.run_details(publish.read_events(spark, base))
    failed = gate.failures(publish.read_layer(spark, base, publish.RESULTS, "validation")).groupBy("run_id").agg(F.count("*").alias("n"))
    rows = states.join(failed, "run_id", "left")
    return rows.select(
        _run_name(), "source_name", "status", F.coalesce("n", F.lit(0)).alias("n_failures"),
        F.aggregate(F.map_values("row_counts"), F.lit(0).cast("long"), lambda a, v: a + v).alias("published_rows"),
        F.map_contains_key("row_counts", "matrix").alias("has_matrix"))


def pipeline_incident(spark, sf_dir):
    """The stored incident of the faulty run and its failures."""
    base = _batch_runs(spark, sf_dir, faulty_only=True)
    head, failed = publish.incident_of_run(spark, base, gate.deterministic_run_id("faulty"))
    leading = head.select("run_id", F.col("check_id").alias("leading_check"), F.col("severity").alias("incident_severity"), "n_failures", "affected_record_count")
    return failed.select("run_id", "check_id", "table_name").join(leading, "run_id").select(
        _run_name(), "check_id", "table_name", "leading_check", "incident_severity", "n_failures", "affected_record_count")


def order_total_vs_lines(spark, sf_dir):
    return derived.order_total_differences(spark, sf_dir).select(
        "entity", amount("computed"), amount("reported"), amount("difference"), "within")


def order_total_check(spark, sf_dir):
    rows = totals.total_checks(derived.order_total_differences(spark, sf_dir), {("orders", crosstab.COLUMN): "REC-ORD"})
    return _checks(rows)


def rec_do01_national(spark, sf_dir):
    p = published(spark, sf_dir)
    return _reconciled(reconcile.matrix_vs_national(p.long(), p.totals()))


def rec_do02_out_in(spark, sf_dir):
    p = published(spark, sf_dir)
    return _reconciled(reconcile.outward_vs_inward_total(p.long(), p.totals()))


def rec_do03_partition(spark, sf_dir):
    return _reconciled(reconcile.partition_of_total(published(spark, sf_dir).long()))


def rec_do04_origin_marginals(spark, sf_dir):
    p = published(spark, sf_dir)
    return _reconciled(reconcile.origin_marginals(p.long(), p.entities))


def rec_do05_dest_marginals(spark, sf_dir):
    p = published(spark, sf_dir)
    return _reconciled(reconcile.destination_marginals(p.long(), p.entities))


def rec_do06_diagonal_exceptions(spark, sf_dir):
    """Two diagonal cells are altered: the documented exception stays open, the other one warns."""
    p = published(spark, sf_dir)
    long = p.long()
    matrix = long["matrix"]
    for name in (ENTITY, "NATION_5"):
        matrix = faults.shift_value(matrix, {"origin": name, "destination": name}, 1_000_000.0)
    return _reconciled(reconcile.diagonal_vs_internal({**long, "matrix": matrix}, p.entities, (ENTITY,)))


def rec_all(spark, sf_dir):
    p = published(spark, sf_dir)
    return _reconciled(reconcile.reconcile_all(p.long(), p.totals(), p.entities, (ENTITY,)))


def rec_profile(spark, sf_dir):
    rows = reconcile.reconciliation_profile(published(spark, sf_dir).long())
    return rows.select(*[amount(c) for c in rows.columns])


# --- checks ---------------------------------------------------------------------------------------------------------


def _raw_specs(spark, sf_dir) -> list[tuple[DataFrame, TableSpec]]:
    """The source tables as they are, with their natural keys."""
    read = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "events", "customer", "part", "supplier")}
    brand = {"p_brand": flow.category_dimension(spark, sf_dir).select("code")}
    return [
        (read["lineitem"], TableSpec("lineitem", (), ("l_orderkey", "l_linenumber"), "l_extendedprice", expected_nulls=0)),
        (read["orders"], TableSpec("orders", (), ("o_orderkey",), "o_totalprice", expected_nulls=0)),
        (read["events"], TableSpec("events", (), ("event_id",), "value", expected_nulls=0)),
        (read["customer"], TableSpec("customer", (), ("c_custkey",), "c_acctbal", expected_nulls=0)),
        (read["supplier"], TableSpec("supplier", (), ("s_suppkey",), "s_acctbal", expected_nulls=3)),
        (read["part"], TableSpec("part", (), ("p_partkey", "p_brand"), "p_retailprice", code="p_brand",
                                 code_pattern="^Brand#[0-9]$", expected_nulls=0, domains=brand)),
    ]


def num_checks_fused(spark, sf_dir):
    """Uniqueness, code format and numeric checks of six source tables, one pass per table."""
    pairs = enumerate(_raw_specs(spark, sf_dir), start=1)
    return _checks(union_all([checks.table_checks(spark, df, spec, number) for number, (df, spec) in pairs]))


def num_text_cells(spark, sf_dir):
    """Numeric checks of text cells: numbers inside JSON, priorities that are no numbers, names."""
    events = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("value"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("value"))
    staged = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("value")
    )
    specs = [
        (events, TableSpec("events_props", (), ("event_id",))),
        (orders, TableSpec("orders_priority", (), ("o_orderkey",))),
        (staged, TableSpec("customer_staged", (), ("c_custkey",))),
    ]
    return _checks(union_all([checks.table_checks(spark, df, spec, number) for number, (df, spec) in enumerate(specs, 1)]))


def num_null_audit(spark, sf_dir):
    p = published(spark, sf_dir)
    specs = suite.table_specs(p, CODE_PATTERN, {"matrix": 0, "summary": 0, "outward": 5, "inward": 0, "internal": 100})
    long = p.long()
    rows = union_all([checks.table_checks(spark, long[s.name], s, n) for n, s in enumerate(specs, 1)])
    return _checks(rows.where(F.col("check_id").startswith("NUM-05")))


def unq_natural_key(spark, sf_dir):
    """Keys of lineitem that several rows share."""
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def sch_columns(spark, sf_dir):
    """Schema checks of the source tables; customer lacks a declared column and has undocumented ones."""
    tables = {name: table(spark, sf_dir, name) for name in ("nation", "region", "customer", "orders")}
    specs = [
        TableSpec("nation", ("n_nationkey", "n_name", "n_regionkey"), ("n_nationkey",), code="n_nationkey"),
        TableSpec("region", ("r_regionkey", "r_name"), ("r_regionkey",), code="r_name"),
        TableSpec("customer", ("c_custkey", "c_name", "c_nationkey", "c_phone"), ("c_custkey",), code="c_custkey"),
        TableSpec("orders", ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), ("o_orderkey",), code="o_orderstatus"),
        TableSpec("invoices", ("i_key",), ("i_key",)),
    ]
    return _checks(checks.schema_checks(spark, tables, specs))


def cmp_counts(spark, sf_dir):
    """Record completeness of all five tables and of the sparse internal cells, which are not complete."""
    p = published(spark, sf_dir)
    specs, long = suite.table_specs(p, CODE_PATTERN), p.long()
    sparse = long["internal"].where(F.col("value").isNotNull())
    rows = [checks.table_checks(spark, long[s.name], s, n) for n, s in enumerate(specs, 1)]
    rows.append(checks.table_checks(spark, sparse, specs[4], 9))
    return _checks(union_all(rows).where(F.col("check_id").startswith("CMP-")))


def cmp_missing_keys(spark, sf_dir):
    cube = flow.flow_cube(spark, sf_dir)
    own = cube.where(F.col("origin") == F.col("destination")).select("code", F.col("origin").alias("entity"))
    labels = reshape.header_labels(flow.entity_dimension(spark, sf_dir), "entity")
    return reshape.missing_cells(own, flow.category_dimension(spark, sf_dir), "code", "entity", labels)


def cmp_category_set(spark, sf_dir):
    """Brands of the parts that were shipped, against the brands that end in an even digit: both directions differ."""
    parts = table(spark, sf_dir, "part")
    brands = flow.category_dimension(spark, sf_dir).select("code").where(F.col("code").rlike("[02468]$"))
    shipped = parts.where(F.col("p_type") != "PROMO")
    return _checks(checks.label_set_check(shipped, "CMP-06", "part", ["p_brand"], brands, True, "ERROR"))


def cmp_entity_set(spark, sf_dir):
    """Nations with suppliers against all nations."""
    nations = flow.entity_dimension(spark, sf_dir)
    homes = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return _checks(checks.label_set_check(homes, "CMP-07", "supplier", ["n_name"], nations, False, "CRITICAL"))


def dom_membership(spark, sf_dir):
    cube = materialize(flow.flow_cube(spark, sf_dir).select("origin", "destination").distinct())
    allowed = [f"NATION_{i}" for i in range(20)]
    frames = [
        checks.membership_check(cube, "flow", ["origin", "destination"], flow.entity_dimension(spark, sf_dir)),
        checks.membership_check(cube, "flow_short", ["origin", "destination"], allowed),
        checks.membership_check(table(spark, sf_dir, "events"), "events", ["event_type"], ["view", "click"]),
    ]
    rows = union_all(frames)
    return rows.select(*CHECK_COLUMNS, "message").withColumn("difference", amount("difference", 4))


def num_negative_messages(spark, sf_dir):
    """The lowest of the negative balances, as the message of the check names it; both tables in one stacked pass."""
    specs = [TableSpec("customer", ("c_custkey", "c_acctbal"), ("c_custkey",), value="c_acctbal"),
             TableSpec("orders", ("o_orderkey", "o_totalprice"), ("o_orderkey",), value="o_totalprice")]
    tables = {s.name: table(spark, sf_dir, s.name).withColumn(s.value, F.col(s.value).cast("decimal(18,2)")) for s in specs}
    metrics = stacked.stacked_metrics(spark, tables, specs)
    frames = [check_rows(metrics.where(F.col("table_name") == spec.name), checks.count_checks(spec, n)) for n, spec in enumerate(specs, start=1)]
    return union_all(frames).where(F.col("check_id").startswith("NUM-02")).select("check_id", "message")


def dom_label_preserved(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    frames = [
        checks.label_preserved_check(events, "events", "event_type", "signup", "sign-up"),
        checks.label_preserved_check(events, "events_corrected", "event_type", "view", "click"),
        checks.label_preserved_check(events, "events_missing", "event_type", "Views", "Clicks"),
    ]
    return _checks(union_all(frames))


def dom_code_format(spark, sf_dir):
    return _checks(num_source_codes(spark, sf_dir))


def num_source_codes(spark, sf_dir):
    df, spec = _raw_specs(spark, sf_dir)[5]
    return checks.table_checks(spark, df, spec, 6).where(F.col("check_category") == "DOMAIN")


def str_reshape_conservation(spark, sf_dir):
    p = published(spark, sf_dir)
    long = p.long()
    frames = [checks.reshape_check(p.wide[name], SPECS[name], long[name], name) for name in ("matrix", "outward", "inward", "internal")]
    sparse = long["internal"].where(F.col("value") > 10_000)
    return _checks(union_all([*frames, checks.reshape_check(p.wide["internal"], SPECS["internal"], sparse, "internal_large")]))


def str_summary_present(spark, sf_dir):
    reported = published(spark, sf_dir).totals()
    return _checks(union_all([checks.summary_present_check(reported, name) for name in SPECS]))


def fk_orphans(spark, sf_dir):
    t = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "labels", "documents")}
    frames = [
        checks.orphan_summary(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey", "lineitem_order"),
        checks.orphan_summary(t["orders"], "o_orderkey", t["lineitem"], "l_orderkey", "order_lineitem"),
        checks.orphan_summary(t["customer"], "c_custkey", t["orders"], "o_custkey", "customer_order"),
        checks.orphan_summary(t["documents"], "doc_id", t["labels"], "doc_id", "document_label"),
    ]
    return union_all(frames)


def validation_suite_all(spark, sf_dir):
    p = published(spark, sf_dir)
    specs = suite.table_specs(p, CODE_PATTERN, {"matrix": 0, "summary": 0, "outward": 0, "inward": 0, "internal": 0})
    rows = suite.validation_suite(
        spark, p.wide, p.long(), p.totals(), specs, kept_label=(ENTITY, "NATION_THREE"), documented_columns={"outward": 2 + len(p.labels)}
    )
    return rows.select("check_id", "check_category", "table_name", "status", "severity", amount("difference", 4), "affected_records")


# --- snapshot statistics --------------------------------------------------------------------------------------------


def comparable_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("dimension", "code", "entity", amount("reference"), amount("comparison"))


def _yoy(spark, sf_dir, category: bool) -> DataFrame:
    rows = snapshots.year_over_year(_pairs(spark, sf_dir))
    mine = F.col("dimension") == f"{snapshots.CATEGORY_DIMENSION}_YOY"
    return rows.where(mine if category else ~mine).select("dimension", "metric", amount("statistic"), amount("pct_change", 6), "status")


def yoy_entity(spark, sf_dir):
    return _yoy(spark, sf_dir, False)


def yoy_category(spark, sf_dir):
    return _yoy(spark, sf_dir, True)


def yoy_macro(spark, sf_dir):
    rows = snapshots.macro_change(_pairs(spark, sf_dir))
    return rows.select("dimension", amount("reference"), amount("comparison"), amount("change"), amount("pct_change", 6))


def pair_snapshots_parts(spark, sf_dir):
    """Quantity per part in the two years, parts of either year kept."""
    lines = table(spark, sf_dir, "lineitem")

    def year(number: int) -> DataFrame:
        start, end = F.lit(f"{number}-01-01").cast("timestamp"), F.lit(f"{number + 1}-01-01").cast("timestamp")
        rows = lines.where((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
        return rows.groupBy(F.col("l_partkey").alias("part")).agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("value"))

    pairs = snapshots.pair_snapshots(year(REFERENCE_YEAR), year(COMPARISON_YEAR), ["part"])
    return pairs.select("part", amount("reference"), amount("comparison"))


def _ks_columns(df: DataFrame) -> DataFrame:
    return df.select("dimension", "n_reference", "n_comparison", amount("statistic", 9), amount("p_value", 6), "status")


def ks_by_dimension(spark, sf_dir):
    ordered = distribution.ordered_counts(snapshots.samples_of(_pairs(spark, sf_dir)))
    return _ks_columns(distribution.ks_test(ordered, method="series"))


def ks_exact_p(spark, sf_dir):
    ordered = distribution.ordered_counts(snapshots.samples_of(_pairs(spark, sf_dir)))
    return _ks_columns(distribution.ks_test(ordered))


def _psi_columns(df: DataFrame) -> DataFrame:
    return df.select("dimension", "n_reference", "n_comparison", amount("psi_value", 6), "psi_threshold", "status")


def psi_by_dimension(spark, sf_dir):
    ordered = distribution.ordered_counts(snapshots.samples_of(_pairs(spark, sf_dir)))
    return _psi_columns(distribution.psi_test(ordered, snapshots.suite_config()))


def _line_samples(spark, sf_dir) -> DataFrame:
    """Line prices of the two years by return flag, straight from lineitem."""
    first, last = F.lit(f"{REFERENCE_YEAR}-01-01").cast("timestamp"), F.lit(f"{COMPARISON_YEAR + 1}-01-01").cast("timestamp")
    lines = table(spark, sf_dir, "lineitem").where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last))
    side = F.when(F.year("l_shipdate") == REFERENCE_YEAR, distribution.REFERENCE).otherwise(distribution.COMPARISON)
    return lines.select(F.col("l_returnflag").alias("dimension"), side.alias("side"), F.col("l_extendedprice").alias("value"))


def ks_line_prices(spark, sf_dir):
    return _ks_columns(distribution.ks_test(distribution.ordered_counts(_line_samples(spark, sf_dir)), method="series"))


def psi_line_prices(spark, sf_dir):
    return _psi_columns(distribution.psi_test(distribution.ordered_counts(_line_samples(spark, sf_dir)), StatsConfig()))


def psi_bin_edges(spark, sf_dir):
    edges = distribution.quantile_edges(distribution.ordered_counts(_line_samples(spark, sf_dir)))
    return edges.select("dimension", F.posexplode("edges").alias("bin", "edge")).select("dimension", F.col("bin").cast("long"), amount("edge", 6))


def cross_period_exception_audit(spark, sf_dir):
    before, after = published_snapshots(spark, sf_dir, REFERENCE_YEAR, COMPARISON_YEAR)
    after_long = after.long()
    moved = faults.shift_value(after_long["matrix"], {"origin": ENTITY, "destination": ENTITY}, 1_000_000.0)
    rows = snapshots.exception_audit(before.long(), {**after_long, "matrix": moved}, ENTITY.lower())
    return rows.select("dimension", "metric", "test_method", amount("statistic"), "status")


def stat_suite_all(spark, sf_dir):
    before, after = published_snapshots(spark, sf_dir, REFERENCE_YEAR, COMPARISON_YEAR)
    rows = snapshots.compare_snapshots(before.long(), after.long(), ENTITY, method="series", periods=(str(REFERENCE_YEAR), str(COMPARISON_YEAR)))
    return rows.select(
        "reference_period", "comparison_period",
        "dimension", "metric", "test_method", "n_reference", "n_comparison", amount("statistic", 2), amount("p_value", 6),
        amount("psi_value", 6), amount("pct_change", 6), "status",
    )


# --- profiles -------------------------------------------------------------------------------------------------------


def table_profile(spark, sf_dir):
    rows = union_all([profiling.table_profile(table(spark, sf_dir, name), name) for name in TABLES])
    return rows.select("table_name", "n_rows", F.col("n_columns").cast("long"), "n_null")


def column_profile(spark, sf_dir):
    cells = [profiling.column_profile(df, name) for name, df in published(spark, sf_dir).wide.items()]
    return union_all(cells)


def cell_type_distribution(spark, sf_dir):
    return union_all([profiling.cell_type_distribution(table(spark, sf_dir, name), name) for name in TABLES])


def cell_bounding_box(spark, sf_dir):
    box = profiling.bounding_box(_staged(spark, sf_dir).where(F.col("entity") != "TOTAL"))
    return box.select("table_name", *[F.col(c).cast("long") for c in ("min_row", "max_row", "min_col", "max_col")])


def cell_empty_lines(spark, sf_dir):
    """Lines of the staged cells without a large value."""
    staged = _staged(spark, sf_dir).where(F.col("entity") != "TOTAL")
    large = staged.withColumn("value", F.when(F.col("value") > 1_500_000, F.col("value")))
    return profiling.empty_lines(large)


def snapshot_label_diff(spark, sf_dir):
    """Customers who ordered in only one of the two years."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    before, after = (orders.where(F.col("year") == y) for y in (REFERENCE_YEAR, COMPARISON_YEAR))
    return profiling.label_set_diff(before, after, "o_custkey")


def snapshot_attribute_diff(spark, sf_dir):
    """Per customer: most frequent values aside, which order attributes differ between the two years."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))

    def year(number: int) -> DataFrame:
        return orders.where(F.col("year") == number).groupBy("o_custkey").agg(
            F.max("o_orderpriority").alias("priority"), F.max("o_orderstatus").alias("status"), F.count("*").alias("n_orders")
        )

    return profiling.snapshot_diff(year(REFERENCE_YEAR), year(COMPARISON_YEAR), ["o_custkey"], ["priority", "status", "n_orders"])


def snapshot_changed_rows(spark, sf_dir):
    """Orders against a corrected copy: small prices rounded, the last day gone, the first day under new keys."""
    before = table(spark, sf_dir, "orders")
    first, last = (before.agg(f("o_orderdate")).scalar() for f in (F.min, F.max))
    after = before.where(F.col("o_orderdate") < last).withColumns({
        "o_orderkey": F.when(F.col("o_orderdate") == first, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")),
        "o_totalprice": F.when(F.col("o_totalprice") < 5_000, F.round("o_totalprice")).otherwise(F.col("o_totalprice")),
    })
    return profiling.changed_rows(before, after, ["o_orderkey"])


def label_positions(spark, sf_dir):
    """Entity labels of each category side by side by position; the sparse table has fewer of them."""
    long = published(spark, sf_dir).long()
    frames = {
        "outward": long["outward"].select("code", "entity").distinct(),
        "inward": long["inward"].select("code", "entity").distinct(),
        "sparse": long["internal"].where(F.col("value").isNotNull()).select("code", "entity").distinct(),
    }
    return profiling.label_positions(frames, "entity", ["entity"], within=["code"])


def snapshot_null_sparsity(spark, sf_dir):
    before, after = published_snapshots(spark, sf_dir, REFERENCE_YEAR, COMPARISON_YEAR)
    frames = []
    for year, p in ((REFERENCE_YEAR, before), (COMPARISON_YEAR, after)):
        frames += [df.select(F.lit(f"{name}_{year}").alias("table_name"), "value") for name, df in p.long().items()]
    return profiling.sparsity(union_all(frames)).select("table_name", "n_cells", "n_null", amount("null_share", 6))


# --- faults ---------------------------------------------------------------------------------------------------------


def _scenarios(spark, sf_dir) -> list[faults.Scenario]:
    """Scenarios over the two snapshots; the faulty run is the reference year."""
    before, after = published_snapshots(spark, sf_dir, REFERENCE_YEAR, COMPARISON_YEAR)
    specs = suite.table_specs(before, CODE_PATTERN)
    return suite.fault_scenarios(spark, before, specs, CODE, ENTITY, (before, after), method="series")


def _detection(spark, sf_dir, letter: str | None = None) -> DataFrame:
    chosen = [s for s in _scenarios(spark, sf_dir) if letter is None or s.scenario_id.endswith(letter)]
    return faults.detection_matrix(spark, chosen)


def fault_a_missing(spark, sf_dir):
    return _detection(spark, sf_dir, "A")


def fault_b_duplicate(spark, sf_dir):
    return _detection(spark, sf_dir, "B")


def fault_c_code(spark, sf_dir):
    return _detection(spark, sf_dir, "C")


def fault_d_altered(spark, sf_dir):
    return _detection(spark, sf_dir, "D")


def fault_e_entity(spark, sf_dir):
    return _detection(spark, sf_dir, "E")


def fault_f_text(spark, sf_dir):
    return _detection(spark, sf_dir, "F")


def fault_g_scale(spark, sf_dir):
    return _detection(spark, sf_dir, "G")


def detection_matrix(spark, sf_dir):
    return _detection(spark, sf_dir)


def detection_summary(spark, sf_dir):
    return faults.detection_summary(_detection(spark, sf_dir))


def fault_isolation(spark, sf_dir):
    """Row counts of the source tables before and after a fault was injected into a copy."""
    names = ("orders", "customer", "supplier")

    def counts(frames: dict[str, DataFrame]) -> DataFrame:
        return union_all([df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in frames.items()])

    clean = {name: table(spark, sf_dir, name) for name in names}
    faulty = {**clean, "supplier": faults.drop_record(clean["supplier"], {"s_suppkey": 1})}
    return faults.isolation_check(counts(clean), counts(faulty))


# --- gate, incidents, read side -------------------------------------------------------------------------------------


def gate_decision(spark, sf_dir):
    return gate.gate_decision(derived.order_checks(spark, sf_dir))


def failures_by_suite(spark, sf_dir):
    rows = gate.failures(derived.order_checks(spark, sf_dir), "CRITICAL")
    return rows.groupBy("run_id", "check_category").agg(F.count("*").alias("n"))


def blocking_failures(spark, sf_dir):
    return gate.blocking_failures(derived.order_checks(spark, sf_dir)).select(
        "run_id", "check_id", "entity", "severity", amount("difference"), "affected_records")


def _failed(spark, sf_dir) -> DataFrame:
    return gate.normalized_failures(gate.failures(derived.order_checks(spark, sf_dir)))


def incident_aggregate(spark, sf_dir):
    return gate.aggregate_incidents(_failed(spark, sf_dir)).withColumn("difference", amount("difference"))


def incident_failures(spark, sf_dir):
    return gate.incident_failures(_failed(spark, sf_dir)).select("incident_id", "check_id", "entity", "severity", amount("difference"))


def alert_excerpt(spark, sf_dir):
    rows = gate.alert_excerpt(gate.incident_failures(_failed(spark, sf_dir)))
    return rows.select("incident_id", F.col("position").cast("long"), "check_id", "entity", "severity")


def alerts_pending(spark, sf_dir):
    pending = gate.pending_alerts(derived.customer_incidents(spark, sf_dir), derived.alert_events(spark, sf_dir))
    return pending.select("incident_id", "run_id", "severity")


def alert_outcomes(spark, sf_dir):
    rows = gate.alert_outcomes(derived.customer_incidents(spark, sf_dir), derived.alert_events(spark, sf_dir))
    return rows.groupBy("outcome").agg(F.count("*").alias("n"))


def run_log_latest(spark, sf_dir):
    return readside.run_states(derived.run_events(spark, sf_dir)).select("run_id", "status")


def run_durations(spark, sf_dir):
    return readside.run_states(derived.run_events(spark, sf_dir)).select("run_id", "duration_seconds")


def runs_recent(spark, sf_dir):
    return readside.recent_runs(readside.run_states(derived.run_events(spark, sf_dir)), 5).select("run_id", "status")


def latest_run(spark, sf_dir):
    return readside.recent_runs(readside.run_states(derived.run_events(spark, sf_dir)), 1).select("run_id", "status", "duration_seconds")


def results_filtered(spark, sf_dir):
    rows = readside.validation_results(derived.order_checks(spark, sf_dir), "run-1997", "orders_F", "1-URGENT", "FAIL")
    return rows.select("check_id", "entity", "severity", amount("difference"))


def results_page(spark, sf_dir):
    """The first three pages of all order results, which are computed once; each is found behind the mark of the one before."""
    rows, order, size = materialize(derived.order_checks(spark, sf_dir)), ["check_id", "table_name", "entity"], 40
    pages, mark = [], None
    for number in (1, 2, 3):
        page, mark = readside.result_page(rows, order, size, mark)
        place = F.row_number().over(Window.partitionBy("page").orderBy(*order, readside.DIGEST))
        pages.append(page.withColumn("page", F.lit(number)).withColumn("place", place).select("page", "place", *order, amount("difference")))
    return union_all(pages)


def rec_results_filtered(spark, sf_dir):
    rows = readside.reconciliation_results(derived.order_reconciliations(derived.order_checks(spark, sf_dir)), "run-1996", "REC-2", "ALL")
    return rows.select("rule_code", "dimension", "entity", "status", amount("difference"))


def stat_results_filtered(spark, sf_dir):
    rows = readside.statistical_results(derived.order_statistics(derived.order_checks(spark, sf_dir)), None, "5-LOW", "PSI", "STATISTICALLY_DIFFERENT")
    return rows.select("run_id", "metric", amount("pct_change", 6))


def incidents_newest(spark, sf_dir):
    rows = readside.incident_list(derived.customer_incidents(spark, sf_dir), severity="CRITICAL", status="OPEN")
    return rows.select("incident_id", "run_id", "source_table", "detected_at")


def overview_kpis(spark, sf_dir):
    """All five inputs come from the same checks, which are computed once."""
    checked = materialize(derived.order_checks(spark, sf_dir))
    failed = gate.normalized_failures(gate.failures(checked))
    incidents = gate.aggregate_incidents(failed).select("run_id", "status")
    trusted = checked.where(F.col("status") == "PASS").groupBy("run_id").agg(F.sum("affected_records").alias("n_rows"))
    return readside.overview(
        checked, derived.order_reconciliations(checked), derived.order_statistics(checked), incidents, trusted
    )


def category_health(spark, sf_dir):
    return readside.category_health(derived.order_checks(spark, sf_dir))


def validation_summary(spark, sf_dir):
    return readside.validation_summary(derived.order_checks(spark, sf_dir))


def validation_metrics(spark, sf_dir):
    return readside.validation_metrics(derived.order_checks(spark, sf_dir))


def reconciliation_summary(spark, sf_dir):
    return readside.reconciliation_summary(derived.order_reconciliations(derived.order_checks(spark, sf_dir)))


def reconciliation_metrics(spark, sf_dir):
    return readside.reconciliation_metrics(derived.order_reconciliations(derived.order_checks(spark, sf_dir)))


def statistical_summary(spark, sf_dir):
    return readside.statistical_summary(derived.order_statistics(derived.order_checks(spark, sf_dir)))


def statistical_metrics(spark, sf_dir):
    return readside.statistical_metrics(derived.order_statistics(derived.order_checks(spark, sf_dir)))


def incident_metrics(spark, sf_dir):
    incidents = derived.customer_incidents(spark, sf_dir).withColumn("alert_sent", F.col("source_table") == "MACHINERY")
    return readside.incident_metrics(incidents)


def trusted_counts(spark, sf_dir):
    """Rows per trusted table and run."""
    lines = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("run-"), F.year("l_shipdate").cast("string")).alias("run_id"))
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("run-"), F.year("o_orderdate").cast("string")).alias("run_id"))
    return readside.layer_counts({"lineitem": lines, "orders": orders})


def lineage_counts(spark, sf_dir):
    """Rows of one run in every layer."""
    checked = materialize(derived.order_checks(spark, sf_dir).where(F.col("run_id") == "run-1998"))
    lines = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("run-"), F.year("l_shipdate").cast("string")).alias("run_id"))
    layers = {
        "raw_lineitem": lines,
        "validation_results": checked.select("run_id"),
        "reconciliation_results": derived.order_reconciliations(checked).select("run_id"),
        "trusted_orders": checked.where(F.col("status") == "PASS").select("run_id"),
    }
    return readside.layer_counts(layers, "run-1998")


def status_classes(spark, sf_dir):
    rows = derived.order_checks(spark, sf_dir).groupBy("status", "severity").agg(F.count("*").alias("n"))
    return rows.select("status", "severity", status_class(F.col("status")).alias("status_class"), status_class(F.col("severity")).alias("severity_class"), "n")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        unpivot_matrix_nulls_kept, unpivot_category_entity, flat_summary, unified_fact, densify_cells, canonical_labels,
        canonical_labels_by_table, reported_totals_long, pivot_category_status, staged_cells, staged_metadata,
        file_fingerprint, files_unchanged, src_total_grand, src_total_columns, src_total_rows, src_total_checks,
        cross_foot_both_axes, order_total_vs_lines, order_total_check, rec_do01_national, rec_do02_out_in,
        rec_do03_partition, rec_do04_origin_marginals, rec_do05_dest_marginals, rec_do06_diagonal_exceptions, rec_all,
        rec_profile, sch_columns, cmp_counts, cmp_missing_keys, cmp_category_set, cmp_entity_set, unq_natural_key,
        dom_membership, dom_label_preserved, dom_code_format, num_checks_fused, num_text_cells, num_null_audit,
        str_reshape_conservation, str_summary_present, fk_orphans, validation_suite_all, comparable_pairs, yoy_entity,
        yoy_category, yoy_macro, pair_snapshots_parts, ks_by_dimension, ks_exact_p, psi_by_dimension, ks_line_prices,
        psi_line_prices, psi_bin_edges, cross_period_exception_audit, stat_suite_all, table_profile, column_profile,
        cell_type_distribution, cell_bounding_box, cell_empty_lines, snapshot_label_diff, snapshot_attribute_diff,
        label_positions, snapshot_null_sparsity, fault_a_missing, fault_b_duplicate, fault_c_code, fault_d_altered,
        fault_e_entity, fault_f_text, fault_g_scale, detection_matrix, detection_summary, fault_isolation,
        gate_decision, failures_by_suite, blocking_failures, incident_aggregate, incident_failures, alert_excerpt,
        alerts_pending, alert_outcomes, run_log_latest, run_durations, runs_recent, latest_run, results_filtered,
        rec_results_filtered, stat_results_filtered, incidents_newest, overview_kpis, category_health,
        validation_summary, validation_metrics, reconciliation_summary, reconciliation_metrics, statistical_summary,
        statistical_metrics, incident_metrics, trusted_counts, lineage_counts, status_classes, content_fingerprint,
        content_unchanged, src_totals_failing, cross_foot_failing, pipeline_results, pipeline_decision, pipeline_incident,
        snapshot_changed_rows, results_page, num_negative_messages,
        sheet_layouts, sheet_body, sheet_totals, flow_unresolved,
    )
}
