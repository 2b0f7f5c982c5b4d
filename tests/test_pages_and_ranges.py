"""Pages on a total order, and differences found through digests of key ranges, against plain Python."""

from collections import Counter

import pytest

from crossfoot.operators.profiling import changed_rows
from crossfoot.operators.readside import result_page
from crossfoot.plans import derived, queries

ROWS = [("b", 1, "x"), (None, 2, "x"), ("a", None, "y"), *[("a", 1, "same")] * 7, ("a", 1, "other"), (None, None, None), ("c", 3, "z"), ("b", 1, "w")]


@pytest.mark.parametrize("size", [1, 3, 4, 50])
def test_pages_leave_no_gap_and_do_not_overlap(spark, size):
    df = spark.createDataFrame(ROWS, "check_id string, n int, entity string").repartition(3)
    seen, mark = [], None
    for _ in range(len(ROWS) + 2):
        page, mark = result_page(df, ["check_id", "n"], size, mark)
        rows = [tuple(r)[:3] for r in page.collect()]
        seen += sorted(rows, key=lambda r: tuple((v is not None, v) for v in r[:2]))
        if not rows:
            break
    assert Counter(seen) == Counter(ROWS)
    assert [r[:2] for r in seen] == sorted((r[:2] for r in ROWS), key=lambda r: tuple((v is not None, v or 0) for v in r))


def test_results_are_computed_once_for_all_pages(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    rows = [(f"c{i % 2}", "t", str(i).zfill(4), float(i)) for i in range(130)]
    df = spark.createDataFrame(rows, "check_id string, table_name string, entity string, difference double")

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(derived, "order_checks", lambda spark, sf_dir: df.mapInArrow(counted, df.schema))
    found = queries.results_page(spark, "").orderBy("page", "place").collect()
    assert [(r.check_id, r.table_name, r.entity, r.difference) for r in found] == sorted(rows)[:120]
    assert made.value == len(rows)


def test_page_of_an_empty_table(spark):
    page, mark = result_page(spark.createDataFrame([], "check_id string"), ["check_id"], 5)
    assert page.count() == 0 and mark is None


SCHEMA = "id int, sign string, part double"  # names that the operator itself uses


@pytest.mark.parametrize("coarse, fine", [(1, 1), (4, 2), (4096, 256)])
def test_changed_rows_equal_plain_comparison(spark, coarse, fine):
    before = [(i, f"v{i}", float(i)) for i in range(60)] + [(None, "n", None), (7, "twice", 1.0), (7, "twice", 1.0), (8, "a", None)]
    after = [r for r in before if r[0] not in (3, 40)] + [(99, "new", 1.0), (7, "twice", 1.0), (None, None, "n" and None)]
    after = [(5, None, 5.0) if r == (5, "v5", 5.0) else r for r in after]
    wanted = {}
    for key in {r[0] for r in before + after}:
        a, b = (Counter(r for r in side if r[0] == key) for side in (before, after))
        if a != b:
            wanted[key] = ("ADDED" if not a else "REMOVED" if not b else "CHANGED", sum(a.values()), sum(b.values()))
    left, right = spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA).select("part", "id", "sign")
    found = {r.id: (r.change, r.rows_before, r.rows_after) for r in changed_rows(left, right, ["id"], coarse, fine).collect()}
    assert found == wanted and len(wanted) == 6
    assert changed_rows(left, left.repartition(3), ["id"], coarse, fine).count() == 0
    assert changed_rows(left, left.limit(0), ["id"], coarse, fine).count() == len({r[0] for r in before})


def test_changed_rows_refuse_other_columns(spark):
    with pytest.raises(ValueError):
        changed_rows(spark.range(1), spark.range(1).toDF("other"), ["id"])
