"""Batch runs over loaded sources with rules of their own."""

import pytest

from crossfoot.config import CrosstabSpec, TableSpec
from crossfoot.operators import readside
from crossfoot.plans.batch import Batch, LabelRule, Rules, batch_of_sheets, batch_of_source
from crossfoot.plans.run import run_reliability
from crossfoot.sources import publish as store
from crossfoot.sources.crosstab import MissingTablesError, load_source

SPECS = {"sales": CrosstabSpec("sales", ("item", "name"), total_column="ALL"), "stock": CrosstabSpec("stock", ("item", "name"))}
RULES = Rules(
    SPECS, flat={"stock": "pieces"}, total_ids={("sales", "COLUMN"): "T-1", ("sales", "ROW"): "T-2", ("stock", "GRAND"): "T-3"},
    cross_foot_ids={"sales": "T-4"}, label_rules=(LabelRule("L-1", "stock", "code", True, "ERROR"),), reshaped=("sales",),
)
ITEMS, SHOPS = ["01", "02"], ["East", "West"]
CHECKED = [
    TableSpec("sales", ("code", "description", "entity", "value"), ("code", "entity"), code="code", entities=("entity",),
              expected_from=("code", "entity"), domains={"code": ITEMS, "entity": SHOPS}),
    TableSpec("stock", ("code", "description", "value"), ("code",), code="code", expected_from=("code",), domains={"code": ITEMS}),
]
GOOD = {
    "sales": "item,name,East,West,ALL,row_role\n01,pens,1.5,,1.5,BODY\n02,ink,2,3,5,BODY\nTOTAL,,3.5,3,6.5,FOOTER\n",
    "stock": "item,name,pieces,row_role\n01,pens,10,BODY\n02,ink,20,BODY\nTOTAL,,30,FOOTER\n",
}


def run(spark, folder, name, texts):
    paths = {}
    for table, text in texts.items():
        paths[table] = str(folder / f"{name}-{table}.csv")
        (folder / f"{name}-{table}.csv").write_text(text)
    shops = spark.createDataFrame([(s,) for s in SHOPS], "entity string")
    loaded = batch_of_source(load_source(spark, paths, SPECS), RULES, shops)
    assert isinstance(loaded, Batch) and loaded.labels == SHOPS
    return run_reliability(spark, str(folder / "store"), name, loaded, CHECKED, source_name=name, source_path=paths["sales"])


def test_loaded_source_runs_by_its_own_rules(spark, tmp_path):
    base = str(tmp_path / "store")
    outcome = run(spark, tmp_path, "good", GOOD)
    assert (outcome.decision, outcome.n_failures) == ("PROMOTE", 0)
    ids = {r.check_id for r in store.read_layer(spark, base, store.RESULTS, "validation").collect()}
    assert {"T-1", "T-2", "T-3", "T-4-COLUMN", "T-4-ROW", "L-1", "STR-01", "STR-02-sales"} <= ids
    cells = {(r.item, r.entity): (r.source_row, r.source_col) for r in store.read_layer(spark, base, store.RAW, "sales").collect()}
    assert cells["02", "West"] == (2, 4) and len(cells) == 6
    assert store.read_trusted(spark, base, "sales").count() == 4
    run_row = readside.run_details(store.read_events(spark, base)).first()
    assert (run_row.status, run_row.source_name, run_row.row_counts) == ("COMPLETED", "good", {"sales": 4, "stock": 2})
    assert '"staged_cells": {"sales": 6, "stock": 2}' in run_row.summary

    wrong = {**GOOD, "sales": GOOD["sales"].replace("TOTAL,,3.5,3,6.5", "TOTAL,,4.5,3,6.5"), "stock": GOOD["stock"].replace("02,ink", "03,ink")}
    outcome = run(spark, tmp_path, "wrong", wrong)
    assert outcome.decision == "INCIDENT"
    _, failed = store.incident_of_run(spark, base, outcome.run_id)
    assert {r.check_id for r in failed.collect()} == {"T-1", "T-4-COLUMN", "L-1", "DOM-03-stock"}
    assert store.read_trusted(spark, base, "sales").count() == 4


def test_absent_sheet_stops_the_run_before_any_work(spark, tmp_path):
    with pytest.raises(MissingTablesError):
        batch_of_sheets(spark, {"sales": "nowhere"}, RULES, spark.createDataFrame([], "entity string"))
