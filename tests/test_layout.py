import pytest

from crossfoot.config import CrosstabSpec
from crossfoot.sources import crosstab, layout

SPEC = CrosstabSpec("inward", ("code", "description"), total_column="TOTAL")
FLAT = CrosstabSpec("summary", ("code", "description"))
MATRIX = CrosstabSpec("matrix", ("to",))


@pytest.fixture
def sheet(spark, tmp_path):
    def build(text, spec, **options):
        (tmp_path / "sheet.csv").write_text(text, encoding="utf-8")
        return layout.read_sheet(spark, str(tmp_path / "sheet.csv"), spec, **options)

    return build


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_parts_by_label(sheet):
    text = ',,\n,"Movement, 2024",,\n\n,Code, Description ,"A, B",C,TOTAL\n,10,"x, ""y""",1.5,,1.5\n,,,,,\n,11,z,2,3,5\n,Grand Total,,3.5,3,6.5\n\n,source: office,,,,\n'
    s = sheet(text, SPEC)
    at = s.layout
    assert (at.title, at.header_row, at.data_start_row, at.data_end_row, at.footer_row) == ("Movement, 2024", 4, 5, 7, 8)
    assert (at.first_col, at.last_col) == (2, 6)
    assert crosstab.entity_columns(s.table, SPEC) == ["A, B", "C"]
    assert rows(crosstab.body(s.table, SPEC), "source_row", "code", "description", "A, B", "C") == [(5, "10", 'x, "y"', 1.5, None), (7, "11", "z", 2.0, 3.0)]
    totals = {(r.axis, r.entity): r.value for r in crosstab.reported_totals(s.table, SPEC).collect()}
    assert totals == {("COLUMN", "A, B"): 3.5, ("COLUMN", "C"): 3.0, ("GRAND", "GRAND"): 6.5, ("ROW", "10"): 1.5, ("ROW", "11"): 5.0}
    meta = layout.sheet_metadata(s, SPEC).first()
    assert (meta.row_count, meta.null_cells_count, meta.reported_total, meta.title, meta.footer_row) == (2, 1, 6.5, "Movement, 2024", 8)


def test_totals_by_place(sheet):
    """No label says total: the last row with values has a blank label. A blank label further up is a faulty row."""
    s = sheet("code,description,value\n10,x,1\n,lost,2\n11,z,3\n,,6\n\nnote\n", FLAT)
    assert (s.layout.title, s.layout.header_row, s.layout.data_end_row, s.layout.footer_row) == (None, 1, 4, 5)
    assert rows(crosstab.body(s.table, FLAT), "source_row", "description", "value") == [(2, "x", 1.0), (3, "lost", 2.0), (4, "z", 3.0)]
    assert [r.value for r in layout.printed_total(s, FLAT, "value").collect()] == [6.0]


def test_table_without_totals_ends_at_a_blank_row(sheet):
    s = sheet("title\nTO,A,B\nA,,1\nB,2,\n\nnote 1\nnote 2,,\n", MATRIX)
    assert (s.layout.title, s.layout.data_start_row, s.layout.data_end_row, s.layout.footer_row) == ("title", 3, 4, None)
    assert rows(crosstab.body(s.table, MATRIX), "to", "A", "B") == [("A", None, 1.0), ("B", 2.0, None)]
    assert crosstab.footer(s.table, MATRIX).count() == 0


def test_a_row_called_total_in_the_middle_is_the_footer_only_with_values(sheet):
    s = sheet("code,description,v\n10,Totals by hand,\n11,b,4\nTOTAL,,4\n", FLAT)
    assert (s.layout.data_end_row, s.layout.footer_row) == (3, 4)


def test_other_separator_and_own_total_label(sheet):
    s = sheet("code;description;v\n10;a,b;1\nSumme;;1\n", FLAT, separator=";", total_label="(?i)^summe$")
    assert rows(crosstab.body(s.table, FLAT), "description", "v") == [("a,b", 1.0)] and s.layout.footer_row == 3


def test_text_cells_stay_text(sheet):
    s = sheet("code,description,v\n10,a,n/a\n11,b,2\n", FLAT, typed=False)
    assert rows(s.table, "v") == [("2",), ("n/a",)]


@pytest.mark.parametrize("text", ["", "\n\n", "a,b\n1,2\n", "description,code,v\n1,2,3\n"])
def test_no_header(sheet, text):
    with pytest.raises(layout.LayoutError, match="no row holds"):
        sheet(text, FLAT)


def test_doubled_column(sheet):
    with pytest.raises(layout.LayoutError, match="more than once"):
        sheet("code,description,v,v\n1,a,2,3\n", FLAT)


def test_header_alone(sheet):
    s = sheet("code,description,v\n", FLAT)
    assert (s.layout.data_start_row, s.layout.footer_row, s.table.count()) == (None, None, 0)


def test_printed_and_read_again(spark, tmp_path):
    """Over several files and blocks, with margins, notes and awkward names."""
    data = [(f"{i:03d}", 'd "q", e', float(i), None if i % 7 else 2.25, i + 0.5, "BODY") for i in range(200)] + [("Total", None, 1.0, 2.0, 3.0, "FOOTER")]
    df = spark.createDataFrame(data, "code string, description string, `A` double, `J & K, x` double, TOTAL double, row_role string")
    for margin in (0, 3):
        path = str(tmp_path / f"printed{margin}")
        layout.write_sheet(df.repartition(5), SPEC, path, "Title", ("note one", "note two"), margin)
        s = layout.read_sheet(spark, path, SPEC)
        assert (s.layout.title, s.layout.header_row, s.layout.data_start_row, s.layout.data_end_row, s.layout.footer_row) == ("Title", 3, 4, 203, 204)
        assert s.layout.first_col == margin + 1
        back = s.table.select("code", "description", "A", "`J & K, x`", "TOTAL", "row_role")
        assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, data))
        assert {r.code: r.source_row for r in s.table.collect() if r.row_role == "BODY"} == {f"{i:03d}": i + 4 for i in range(200)}
