"""Queries against their SQL on DuckDB, and the contract of the entry module.

The whole set runs with ``python tests/compare.py <folder>``.
"""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from crossfoot.operators.profiling import empty_lines
from crossfoot.plans.queries import QUERIES

CHOSEN = (
    "unpivot_matrix_nulls_kept", "densify_cells", "reported_totals_long", "src_total_columns", "cross_foot_both_axes",
    "order_total_vs_lines", "rec_do05_dest_marginals", "rec_do06_diagonal_exceptions", "cmp_missing_keys", "cmp_entity_set",
    "unq_natural_key", "dom_membership", "num_checks_fused", "num_text_cells", "fk_orphans", "ks_line_prices", "psi_line_prices",
    "psi_bin_edges", "yoy_entity", "table_profile", "cell_type_distribution", "snapshot_attribute_diff", "label_positions",
    "gate_decision", "incident_aggregate", "alert_excerpt", "run_durations", "overview_kpis", "statistical_summary",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, sf_dir, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_contract(spark, sf_dir):
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)
    assert set(QUERIES) - set(entry.oracle_sql()) <= {"file_fingerprint"}
    assert entry.entry(spark).count() == 25


def test_empty_lines(spark):
    cells = spark.createDataFrame([("t", 1, 1, "x"), ("t", 1, 2, " "), ("t", 2, 1, None), ("t", 2, 2, "")], "table_name string, source_row int, source_col int, value string")
    assert {(r.axis, r.line) for r in empty_lines(cells).collect()} == {("ROW", 2), ("COLUMN", 2)}
