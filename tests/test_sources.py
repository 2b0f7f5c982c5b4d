import hashlib

import pytest
from pyspark.sql import functions as F

from crossfoot.config import CrosstabSpec
from crossfoot.operators import profiling, reshape
from crossfoot.sources import crosstab, files

INWARD = CrosstabSpec("inward", ("code", "description"), total_column="TOTAL")
MATRIX = CrosstabSpec("matrix", ("destination",))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("source")
    (base / "inward.csv").write_text(
        'code,description,row_role, J & K ,O\'NEIL,a.b,TOTAL\n'
        '10 ,Cereals,BODY,1.5,,2,3.5\n'
        '11,"Milling, products",BODY,,4,text,4\n'
        'TOTAL,,FOOTER,1.5,4,2,7.5\n'
    )
    (base / "matrix.csv").write_text("destination,X,Y\nX,1,\nY,nan,3\n")
    return base


def test_crosstab_is_split_into_body_and_totals(spark, folder):
    df = crosstab.read_crosstab(spark, str(folder / "inward.csv"), INWARD)
    assert crosstab.entity_columns(df, INWARD) == ["J & K", "O'NEIL", "a.b"]
    assert crosstab.body(df, INWARD).count() == 2
    totals = {(r.axis, r.entity): r.value for r in crosstab.reported_totals(df, INWARD).collect()}
    assert totals == {
        ("COLUMN", "J & K"): 1.5, ("COLUMN", "O'NEIL"): 4.0, ("COLUMN", "a.b"): 2.0,
        ("ROW", "10"): 3.5, ("ROW", "11"): 4.0, ("GRAND", "GRAND"): 7.5,
    }


def test_unpivot_keeps_blanks_and_drops_totals(spark, folder):
    df = crosstab.read_crosstab(spark, str(folder / "inward.csv"), INWARD)
    cells = {(r.code, r.entity): r.value for r in reshape.unpivot_categories(df, INWARD).collect()}
    assert cells == {
        ("10", "J & K"): 1.5, ("10", "O'NEIL"): None, ("10", "a.b"): 2.0,
        ("11", "J & K"): None, ("11", "O'NEIL"): 4.0, ("11", "a.b"): None,
    }


def test_untyped_read_keeps_text_for_the_checks(spark, folder):
    df = crosstab.read_crosstab(spark, str(folder / "inward.csv"), INWARD, typed=False)
    cells = {(r.code, r.entity): r.value for r in reshape.unpivot_categories(df, INWARD).collect()}
    assert cells["11", "a.b"] == "text" and cells["10", "O'NEIL"] is None


def test_matrix_orientation(spark, folder):
    df = crosstab.read_crosstab(spark, str(folder / "matrix.csv"), MATRIX)
    cells = {(r.origin, r.destination): r.value for r in reshape.unpivot_matrix(df, MATRIX).collect()}
    assert cells == {("X", "X"): 1.0, ("Y", "X"): None, ("X", "Y"): None, ("Y", "Y"): 3.0}


def test_staged_cells_carry_their_place(spark, folder):
    df = crosstab.read_crosstab(spark, str(folder / "inward.csv"), INWARD)
    rows = {(r.source_row, r.source_col): (r.entity, r.value, r.is_summary) for r in crosstab.stage_cells(df, INWARD).collect()}
    assert len(rows) == 8
    assert rows[1, 3] == ("J & K", 1.5, False) and rows[2, 6] == ("TOTAL", 4.0, True)


def test_metadata(spark, folder):
    df = crosstab.read_crosstab(spark, str(folder / "inward.csv"), INWARD)
    row = crosstab.stage_metadata(df, INWARD).first()
    assert (row.row_count, row.column_count, row.null_cells_count, row.reported_total) == (2, 6, 3, 7.5)
    assert row.reported_entity_totals == '{"J & K":1.5,"O\'NEIL":4.0,"a.b":2.0}'


def test_load_source_and_missing_tables(spark, folder):
    paths = {"inward": str(folder / "inward.csv"), "matrix": str(folder / "matrix.csv")}
    source = crosstab.load_source(spark, paths, {"inward": INWARD, "matrix": MATRIX})
    assert source.tables["matrix"].count() == 2
    assert {r.source_file for r in source.provenance.collect()} == {"inward.csv", "matrix.csv"}
    assert crosstab.available_tables(spark, str(folder)) == ["inward", "matrix"]
    with pytest.raises(crosstab.MissingTablesError, match="summary"):
        crosstab.require_tables(["inward"], ["inward", "summary"])


def test_row_numbers_are_gapless_over_many_splits(spark, tmp_path):
    spark.range(0, 1000, 1, 7).select(F.col("id").cast("string").alias("destination")).write.csv(str(tmp_path / "t"), header=True)
    df = spark.read.csv(str(tmp_path / "t"), header=True)
    rows = sorted(r.source_row for r in crosstab.number_source_rows(df).collect())
    assert rows == list(range(1, 1001))


def test_row_numbers_follow_file_name_and_place(spark, tmp_path):
    (tmp_path / "t").mkdir()
    first, second = range(0, 20), range(20, 4000)  # the later file is the larger one, which Spark reads first
    for name, numbers in (("a.csv", first), ("b.csv", second)):
        (tmp_path / "t" / name).write_text("destination\n" + "".join(f"{i}\n" for i in numbers))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = spark.read.csv(str(tmp_path / "t"), header=True)
        rows = crosstab.number_source_rows(df).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 4000 and all(int(r.destination) + 1 == r.source_row for r in rows)


def test_a_label_mapped_twice_multiplies_nothing(spark):
    mapping = spark.createDataFrame([("a", "Z"), ("a ", "Y"), ("b", "B")], "label string, canonical_label string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "name string")
    rows = reshape.canonical_by_table(df, "name", mapping, "into").collect()
    assert sorted((str(r.name), r.into) for r in rows) == [("None", ""), ("a", "Y"), ("b", "B"), ("c", "c")]
    assert [(r.label, r.canonical_labels) for r in reshape.mapping_conflicts(mapping).collect()] == [("a", ["Y", "Z"])]


def test_nan_counts_as_missing_in_profiles(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "value double, name string")
    assert profiling.table_profile(df, "t").first().n_null == 3
    assert {r.column_name: r.n_null for r in profiling.column_profile(df, "t").collect()} == {"value": 2, "name": 1}
    assert profiling.sparsity(df.selectExpr("'t' AS table_name", "value")).first().n_null == 2


def test_fingerprints_notice_a_change(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "b.txt").write_text("two")
    before = spark.createDataFrame(files.file_fingerprints(spark, str(tmp_path)).collect())
    (tmp_path / "b.txt").write_text("2")
    rows = {r.file_name: r.unchanged for r in files.unchanged_files(before, files.file_fingerprints(spark, str(tmp_path))).collect()}
    assert rows == {"a.txt": True, "b.txt": False}


def test_fingerprints_hold_no_file_as_a_whole(spark, tmp_path):
    """Spark's limit for a file held in one cell is set below the files, as if they had more than 2 GB."""
    contents = {"a b %20 #c.txt": b"one", "mark.csv": b"\xef\xbb\xbfone\n", "named.gz": b"\x1f\x8bone", "long.bin": bytes(range(256)) * 9_000 + b"end"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "2")
    try:
        rows = {r.file_name: (r.size_bytes, r.sha256) for r in files.file_fingerprints(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert rows == {name: (len(content), hashlib.sha256(content).hexdigest()) for name, content in contents.items()}


def test_header_limit_and_case_lookup(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "label string")
    assert reshape.header_labels(df, "label") == ["a", "b"]
    assert reshape.resolve_column(df, " LABEL") == "label"
    with pytest.raises(ValueError):
        reshape.resolve_column(df, "other")


def test_densify_and_missing_cells(spark):
    cells = spark.createDataFrame([("r1", "a", 1.0), ("r1", "a", 2.0), ("r2", "b", 5.0), ("r2", "zz", 9.0)], "code string, entity string, value double")
    rows = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "code string")
    dense = {(r.code, r.entity): r.value for r in reshape.densify(cells, rows, "code", "entity", ["a", "b"]).collect()}
    assert dense == {("r1", "a"): 3.0, ("r1", "b"): None, ("r2", "a"): None, ("r2", "b"): 5.0, ("r3", "a"): None, ("r3", "b"): None}
    missing = {(r.code, r.entity) for r in reshape.missing_cells(cells, rows, "code", "entity", ["a", "b"]).collect()}
    assert missing == {("r1", "b"), ("r2", "a"), ("r3", "a"), ("r3", "b")}


def test_canonical_labels(spark):
    mapping = {"CHHATTISGARH": "CHATTISGARH", "Other Territory": "OTHER TERRITORY"}
    df = spark.createDataFrame([(" CHHATTISGARH ",), ("Other Territory",), ("GOA",), (None,)], "label string")
    expected = ["CHATTISGARH", "OTHER TERRITORY", "GOA", ""]
    assert [r.c for r in df.select(reshape.canonical(F.col("label"), mapping).alias("c")).collect()] == expected
    table = spark.createDataFrame(list(mapping.items()), "label string, canonical_label string")
    assert sorted(r.c for r in reshape.canonical_by_table(df, "label", table, "c").collect()) == sorted(expected)


def test_content_fingerprints_tell_cells_apart(spark):
    """Cells that hold what separates cells elsewhere, NULL and empty text, and rows whose order changes."""
    tables = [[("a\n=b", "c")], [("a", "b\n=c")], [("1:a", None)], [("1:a", "")], [("", "1:a")], [("-", None)], [(None, "-")], [("a", "c"), ("a", "c")], [("a", "c")], []]
    found = [files.content_fingerprint(spark.createDataFrame(rows, "x string, y string"), "t").first() for rows in tables]
    assert len({(r.n_rows, r.fingerprint) for r in found}) == len(tables)
    rows = [(str(i), str(i * i)) for i in range(50)]
    one, two = (files.content_fingerprint(spark.createDataFrame(r, "x string, y string").repartition(p), "t").first() for r, p in ((rows, 1), (rows[::-1], 4)))
    assert one == two


def test_folder_fingerprints_follow_their_files(spark, tmp_path):
    for folder, second in (("a", "y"), ("b", "y"), ("c", "z")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part-0").write_text("x")
        (tmp_path / folder / "part-1").write_text(second)
    found = {r.file_name: r.sha256 for r in files.folder_fingerprints(files.file_fingerprints(spark, f"{tmp_path}/*")).collect()}
    assert found["a"] == found["b"] != found["c"]
