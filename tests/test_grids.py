"""Tables and their parameters against values worked out by hand."""

from collections import namedtuple

import duckdb

from stratafold.functions.dialect import DUCK
from stratafold.plans import grids
from stratafold.plans.registry import with_


def run(parts, last, *tables, ref=""):
    """The steps of a plan from `tbl` on, over given tables: (title, rows)."""
    db = duckdb.connect()
    db.execute("CREATE TABLE in_tbl (doc_id BIGINT, page_index BIGINT, tab_no BIGINT, title VARCHAR, ref VARCHAR, grid VARCHAR[][])")
    for t, (title, rows) in enumerate(tables, 1):
        db.execute("INSERT INTO in_tbl VALUES (1, 0, ?, ?, ?, ?)", [t, title, ref, rows])
    steps = [*parts]
    later = {k: parts[k] for k in steps[steps.index("tbl") + 1 :]}
    said = db.execute(with_({"tbl": "SELECT * FROM in_tbl"} | later, last))
    Row = namedtuple("Row", [c[0] for c in said.description])
    return [Row(*r) for r in said.fetchall()]


GRADED = grids.graded(DUCK, grids.titled(DUCK))


def parameters(*tables):
    rows = run(grids.table_parameters(DUCK), "SELECT tab_no, place, name, clean_value, comparator, unit, cond, source_item FROM gpar ORDER BY tab_no, place", *tables)
    return [(r.name, r.clean_value, r.comparator, r.unit, r.cond, r.source_item) for r in rows]


def test_model_columns():
    table = ("Sizes", [["Property", "unit", "AB-100", "AB-200", "AB-100"], ["Width", "mm", "12", "see text", "13"], ["Mass", "kg", "≤ 5 kg", "5 - 7", ""]])
    models = run(GRADED | {"m": DUCK.rows("gt", "models", "m")}, "SELECT m.label AS model, m.i AS col_idx FROM m ORDER BY 2", table)
    assert [(m.model, m.col_idx) for m in models] == [("AB-100", 2), ("AB-200", 3)]
    assert run(GRADED, "SELECT unit_col FROM gt", table)[0].unit_col == 1
    labels = run(GRADED | {"r": DUCK.rows("gt", "rows", "r")}, "SELECT r.i AS row_idx, r.label AS label FROM r ORDER BY 1", table)
    # the label is the first cell that is no model column, no unit column and no value
    assert [(x.row_idx, x.label) for x in labels] == [(1, "Width"), (2, "Mass")]
    got = run(grids.candidates(DUCK), "SELECT name, value, cond, unit_hint FROM gc WHERE kind = 1 ORDER BY seq", table)
    assert [tuple(x) for x in got] == [("宽度", "12", "AB-100", "mm"), ("Mass", "≤ 5 kg", "AB-100", "kg"), ("Mass", "5 - 7", "AB-200", "kg")]


def test_models_of_the_second_row():
    table = ("Types", [["Type", "Form A", "Form B"], ["Model", "CD-300", "CD-400"], ["Length", "100", "120"]])
    got = run(grids.candidates(DUCK), "SELECT name, value, cond FROM gc WHERE kind = 1 ORDER BY seq", table)
    assert [tuple(x) for x in got] == [("长度", "100", "CD-300"), ("长度", "120", "CD-400")]


def test_matrix():
    table = ("Pressures", [["Nominal", "Pressure", "mm", ""], ["first", "16 bar", "7", "8"], ["", "5", "6", "7"], ["second", "x", "2019-05-01", "9"]])
    got = run(grids.candidates(DUCK), "SELECT name, value, said_cond FROM gc WHERE kind = 2 ORDER BY seq", table)
    # unit columns, columns without a header and rows without a first cell are left out
    assert [tuple(x) for x in got] == [("压力", "16 bar", "Nominal=first")]


def test_key_and_value():
    table = ("Data", [["Property", "Value", "Remark"], ["Colour", "7", "dry", "indoor", "wet"], ["12", "13", ""], ["Shape", "round", ""], ["Angle", "a", "10 - 16", "10 - 16", "18"]])
    got = run(grids.candidates(DUCK), "SELECT name, value, cond FROM gc WHERE kind = 3 ORDER BY seq", table)
    assert [tuple(x) for x in got] == [("Colour", "7", "dry / indoor"), ("角度", "10 - 16", "a / 18")]


def test_last_value_wins_in_the_place_of_the_first():
    table = ("Data", [["Property", "Value"], ["Pressure", "5 bar"], ["Colour", "9"], ["Druck", "5 bar"]])
    got = run(grids.table_parameters(DUCK), "SELECT name, clean_value, cond, source_item FROM gpar WHERE cond = '' ORDER BY place", table)
    assert [(x.name, x.clean_value, x.source_item) for x in got] == [("压力", "5 bar", "Druck"), ("Colour", "9", "Colour")]


def test_large_tables_keep_their_order():
    """A table of 1,200 rows, of 1,100 columns, and 120 tables on a page: places never run into each other."""
    tall = ("Tall", [["Property", "Value"], *([f"Weight {i}", f"{i} kg"] for i in range(1200)), ["Weight 0", "0 kg"]])
    got = [x.source_item for x in run(grids.table_parameters(DUCK), "SELECT source_item FROM gpar WHERE cond = '' ORDER BY place", tall)]
    assert len(got) == 1200 and got[:3] == ["Weight 0", "Weight 1", "Weight 2"]
    wide = ("Wide", [["Nominal", *(f"Weight {i}" for i in range(1100))], ["first", *("5 kg" for _ in range(1100))], ["second", *("6 kg" for _ in range(1100))]])
    got = run(grids.candidates(DUCK), "SELECT row_idx, col_idx FROM gc WHERE kind = 2 ORDER BY seq", wide)
    assert [tuple(x) for x in got] == [(r, c) for r in (1, 2) for c in range(1, 1101)]
    many = [(f"T{i}", [["Property", "Value"], ["Weight", f"{i} kg"]]) for i in range(120)]
    got = run(grids.titled(DUCK) | grids.largest(DUCK), "SELECT place, tab_no FROM big ORDER BY place", *many)
    assert [tuple(x) for x in got] == [(i, i) for i in range(1, 121)]


def test_sections_tell_tables_apart_and_name_their_parameters():
    table = ("Data", [["Property", "Value"], ["Pressure", "5 bar"]])
    got = run(grids.table_parameters(DUCK), "SELECT section_ref, table_title FROM gpar", table, ref="2 Pressures")
    assert {tuple(x) for x in got} == {("2 Pressures", "Data")}


def test_ranges_comparisons_and_units():
    got = parameters(("Data", [["Property", "Value"], ["Pressure", "5,5 to 10 bar"], ["Tolerance", "≤ 0,3 mm"], ["Date", "2019-05-01"], ["Code", "DIN 123"]]))
    kv = [x for x in got if x[5] in ("Pressure", "Tolerance", "Date", "Code")]
    assert ("压力", "5.5~10", "范围", "bar", "", "Pressure") in kv and ("公差", "0.3", "≤", "mm", "", "Tolerance") in kv
    assert not any(x[5] in ("Date", "Code") for x in kv)
