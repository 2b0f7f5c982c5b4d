import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfoot.config import StatsConfig
from crossfoot.functions.amounts import change, change_note, change_pct, change_status
from crossfoot.functions.kolmogorov import _lattice, exact_tail
from crossfoot.operators import distribution, ordered, snapshots


def ks_by_hand(ref, comp):
    at = np.unique(np.concatenate([ref, comp]))
    left = np.searchsorted(np.sort(ref), at, "right") / len(ref)
    right = np.searchsorted(np.sort(comp), at, "right") / len(comp)
    return np.abs(left - right).max()


def psi_by_hand(ref, comp, bins):
    edges = np.unique(np.percentile(ref, np.linspace(0, 100, bins + 1)))
    edges[0] -= 1e-6
    edges[-1] += 1e-6
    e, a = (np.histogram(x, edges)[0] + 1e-4 for x in (ref, comp))
    e, a = e / e.sum(), a / a.sum()
    return float(((a - e) * np.log(a / e)).sum())


RNG = np.random.default_rng(42)
SAMPLES = {
    "identical": (np.arange(10.0, 61, 10), np.arange(10.0, 61, 10)),
    "shifted": (RNG.normal(100, 10, 100), RNG.normal(200, 10, 100)),
    "exponential": (RNG.exponential(10, 200), RNG.exponential(100, 200)),
    "empty_bins": (np.arange(1.0, 11), np.ones(10)),
    "ties": (RNG.integers(0, 9, 700).astype(float), RNG.integers(0, 11, 650).astype(float)),
    "hot_value": (np.where(RNG.random(3000) < 0.4, 0.0, RNG.normal(0, 1, 3000)), RNG.normal(0, 1, 2500)),
    "line": (np.linspace(10, 1000, 50), np.linspace(10, 1000, 50)),
    "small": (np.ones(2), np.ones(5)),
    "constant": (np.ones(20), np.ones(9)),
}


@pytest.fixture(scope="module")
def counted(spark):
    rows = [(d, side, float(v)) for d, pair in SAMPLES.items() for side, values in zip(("ref", "comp"), pair) for v in values]
    rows += [("ties", "ref", None), ("ties", "comp", float("nan"))]
    df = spark.createDataFrame(rows, "dimension string, side string, value double").repartition(7)
    return distribution.ordered_counts(df)


def test_ks_statistic_and_sizes(counted):
    rows = {r.dimension: r for r in distribution.ks_test(counted).collect()}
    for name, (ref, comp) in SAMPLES.items():
        assert (rows[name].n_reference, rows[name].n_comparison) == (len(ref), len(comp))
        if name == "small":
            assert rows[name].status == "INSUFFICIENT_DATA" and rows[name].statistic is None and rows[name].p_value is None
        else:
            assert rows[name].statistic == pytest.approx(ks_by_hand(ref, comp), abs=1e-12)
    assert rows["identical"].p_value == 1.0 and rows["identical"].status == "NO_MATERIAL_STATISTICAL_CHANGE"
    assert {r.p_method for r in rows.values()} == {"exact"}
    assert rows["shifted"].p_value < 0.05 and rows["shifted"].status == "STATISTICALLY_DIFFERENT"


def test_psi(counted):
    rows = {r.dimension: r for r in distribution.psi_test(counted).collect()}
    for name, (ref, comp) in SAMPLES.items():
        if name not in ("small", "constant"):
            assert rows[name].psi_value == pytest.approx(psi_by_hand(ref, comp, 10), abs=1e-9), name
    assert rows["small"].status == rows["constant"].status == "INSUFFICIENT_DATA"
    assert rows["small"].psi_value is None and rows["constant"].psi_value == 0.0
    assert rows["exponential"].status == "STATISTICALLY_DIFFERENT" and rows["line"].psi_value == pytest.approx(0, abs=1e-12)


def test_bins_by_name(counted):
    config = StatsConfig(bins={"ties": 4})
    rows = {r.dimension: r.psi_value for r in distribution.psi_test(counted, config).collect()}
    assert rows["ties"] == pytest.approx(psi_by_hand(*SAMPLES["ties"], 4), abs=1e-9)


@pytest.mark.parametrize(
    "n, m, bound, expected",
    [(33, 33, 6 * 33, 0.6543432846), (90, 90, 17 * 90, 0.0805166862), (33, 33, 24 * 33, 1.0254e-08), (2905, 2862, round(0.0404 * 2905 * 2862), 0.01739)],
)
def test_exact_p_published_values(n, m, bound, expected):
    assert exact_tail(n, m, bound) == pytest.approx(expected, rel=5e-5)


def test_exact_p_against_enumeration():
    from itertools import combinations

    n, m = 5, 4
    for bound in range(0, n * m + 1):
        hits = 0
        paths = list(combinations(range(n + m), n))
        for ups in paths:
            i = j = worst = 0
            for step in range(n + m):
                i, j = (i + 1, j) if step in ups else (i, j + 1)
                worst = max(worst, abs(i * m - j * n))
            hits += worst >= bound
        assert exact_tail(n, m, bound) == pytest.approx(hits / len(paths), abs=1e-12)
    assert _lattice(33, 33, 6 * 33) == pytest.approx(exact_tail(33, 33, 6 * 33), rel=1e-9)


def test_banded_walk_equals_the_walk_over_all_cells():
    """The band leaves out only cells that no surviving path visits; sizes with and without common divisors."""
    for n, m in ((1, 1), (1, 9), (7, 3), (12, 18), (40, 25), (64, 64)):
        for bound in sorted({1, 2, m, n, n * m // 7 + 1, n * m // 2, n * m - 1, n * m, n * m + 1}):
            inside = {(0, 0): 1.0}
            for _ in range(n + m):
                following = {}
                for (i, j), mass in inside.items():
                    for a, b, share in ((i + 1, j, n - i), (i, j + 1, m - j)):
                        if share and abs(a * m - b * n) < bound:
                            following[a, b] = following.get((a, b), 0.0) + mass * share / (n + m - i - j)
                inside = following
            assert _lattice(n, m, bound) == pytest.approx(1.0 - inside.get((n, m), 0.0), abs=1e-12), (n, m, bound)
    assert _lattice(3000, 3000, 100 * 3000) == pytest.approx(exact_tail(3000, 3000, 100 * 3000), rel=1e-9)


def test_series_p_is_close_to_exact_for_large_samples(spark):
    from crossfoot.functions.kolmogorov import series_p

    cases = [(3000, 2500, 0.03), (2000, 2000, 0.05), (4000, 3000, 0.02)]
    df = spark.createDataFrame(cases, "n long, m long, d double").select("*", series_p(F.col("d"), F.col("n"), F.col("m")).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(exact_tail(r.n, r.m, round(r.d * r.n * r.m)), rel=0.05)


def test_running_totals_over_slices(spark):
    """A third of all rows in one group, more slices than groups."""
    rows = [("hot", i, 1) for i in range(500)] + [(f"g{i % 50}", i, 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, o int, n long").repartition(9)
    got = {(r.g, r.o): (r.cum_n, r.total_n) for r in ordered.running_totals(df, ["g"], ["o"], ["n"]).running.collect()}
    totals, expected = {}, {}
    for g, o, n in sorted(rows):
        totals[g] = totals.get(g, 0) + n
        expected[g, o] = totals[g]
    assert got == {key: (value, totals[key[0]]) for key, value in expected.items()}


def test_ordinal_positions_without_group(spark):
    df = spark.createDataFrame([(x,) for x in "dacb"], "label string")
    assert {r.label: r.position for r in ordered.ordinal_positions(df, [], ["label"]).collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}


def test_change_metrics(spark):
    cases = [(100.0, 125.0), (200.0, 150.0), (0.0, 100.0), (None, 50.0), (50.0, None), (100.0, 126.0), (-100.0, -130.0), (float("nan"), 1.0), (1.0, float("nan"))]
    df = spark.createDataFrame(cases, "r double, c double")
    r, c = F.col("r"), F.col("c")
    pct = change_pct(r, c)
    rows = df.select(change(r, c).alias("a"), pct.alias("p"), change_note(r, c).alias("n"), change_status(pct, StatsConfig()).alias("s")).collect()
    assert [row.a for row in rows] == [25.0, -50.0, 100.0, None, None, 26.0, -30.0, None, None]
    assert [row.p for row in rows] == [25.0, -25.0, None, None, None, 26.0, 30.0, None, None]
    same, other, none = "NO_MATERIAL_STATISTICAL_CHANGE", "STATISTICALLY_DIFFERENT", "NOT_APPLICABLE"
    assert [row.s for row in rows] == [same, same, none, none, none, other, other, none, none]
    assert rows[2].n == "NOT_APPLICABLE: ZERO_DENOMINATOR" and rows[3].n == "NULL_VALUE_PRESENT"


def snapshot(spark, entity, factor):
    cells = spark.createDataFrame([("10", entity, 1.0 * factor), ("11", entity, None), ("10", "B", None), ("11", "B", None)], "code string, entity string, value double")
    summary = spark.createDataFrame([("10", 5.0 * factor), ("11", 0.0)], "code string, value double")
    matrix = spark.createDataFrame([(entity, entity, 1.0)], "origin string, destination string, value double")
    return {"summary": summary, "outward": cells, "inward": cells, "internal": cells, "matrix": matrix}


def test_comparable_dimensions_use_canonical_labels(spark):
    mapping = {"Other Territory": "OTHER TERRITORY"}
    pairs = snapshots.comparable_dimensions(snapshot(spark, "Other Territory", 1), snapshot(spark, "OTHER TERRITORY", 2), mapping)
    rows = {(r.dimension, r.code, r.entity): (r.reference, r.comparison) for r in pairs.collect()}
    assert len(rows) == 2 + 3 * (2 + 4)
    assert rows["ENTITY_INWARD", None, "OTHER TERRITORY"] == (1.0, 2.0)
    assert rows["ENTITY_INWARD", None, "B"] == (None, None)  # only NULL cells
    yoy = {(r.dimension, r.metric): r.status for r in snapshots.year_over_year(pairs).collect()}
    assert yoy["ENTITY_INWARD_YOY", "OTHER TERRITORY"] == "STATISTICALLY_DIFFERENT"
    assert yoy["ENTITY_INWARD_YOY", "B"] == "NOT_APPLICABLE" and yoy["CATEGORY_NATIONAL_YOY", "11"] == "NOT_APPLICABLE"


def test_exception_audit_finds_the_label_in_any_case(spark):
    row = snapshots.exception_audit(snapshot(spark, "Other Territory", 1), snapshot(spark, "OTHER TERRITORY", 3), "other territory").first()
    assert row.statistic == 2.0 and row.status == "STATISTICALLY_DIFFERENT"


def test_pair_snapshots_keeps_keys_of_both_sides(spark):
    a = spark.createDataFrame([("x", 1.0), (None, 2.0)], "k string, value double")
    b = spark.createDataFrame([("x", 3.0), ("y", 4.0)], "k string, value double")
    rows = {r.k: (r.reference, r.comparison) for r in snapshots.pair_snapshots(a, b, ["k"]).collect()}
    assert rows == {"x": (1.0, 3.0), None: (2.0, None), "y": (None, 4.0)}


def test_null_dimension_is_kept(spark):
    rows = [(None, side, float(v)) for side in ("ref", "comp") for v in range(6)]
    counted = distribution.ordered_counts(spark.createDataFrame(rows, "dimension string, side string, value double"))
    assert [(r.dimension, r.n_reference, r.statistic) for r in distribution.ks_test(counted).collect()] == [("", 6, 0.0)]
    assert distribution.psi_test(counted).first().psi_value == 0.0
