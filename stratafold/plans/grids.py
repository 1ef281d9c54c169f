"""Page tables and their numeric parameters, and recognised boxes with their cells.

A page is a row with its lines and its tables as nested arrays, as decoders give them; a table stays one row until its
parameters are laid out. They come from its model columns, its matrix and its key-value rows, in that order; of equal ones
the last wins in the place of the first, and over all tables and lines the first wins.
"""

from __future__ import annotations

import re

from stratafold.functions import lines as L
from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Parser, Rx
from stratafold.plans.corpora import TEMPLATES as LINES
from stratafold.plans.corpora import doc_lines, spec_lines
from stratafold.plans.parameters import made, name_of, text_candidates, value_like
from stratafold.plans.registry import query, with_
from stratafold.plans.text_layer import ocr_evaluated, tally

#: Unit tokens; marks whose neighbours are looked at; limits of a fragmented page in thousandths; fewest filled
#: cells of a recognised table; tolerance around a cell and its least value; vertical gap that breaks a line of a cell.
UNIT_TOKEN = Rx("(?:unit|einheit|单位|mm|cm|m|μm|µm|um|bar|psi|°C|℃|K|%|A/m|N/mm2|N/mm²|kN/m2|kg|g|°)", True)
MARKS = "[。，；：！？]"
FRAGMENTED = {"single_m": 180, "dup_m": 180, "punct_m": 320}
FILLED_LEAST, TOLERANCE, TOLERANCE_LEAST, LINE_GAP = 4, 0.25, 8, 8
#: Rows of the tables of a part, cells divided by bars: model columns, a matrix, key and value, models in the second row, and
#: a recognised grid of uneven rows.
TEMPLATES = (
    ("'Kenngröße|unit|AB-100|AB-200'", "concat('Width|mm|', p_size, '|14')", "'Weight|kg|1,5|see text'", "'| | |'", "'Pressure|bar|5 - 10|≤ 16 bar'", "'Width|mm|11|14'"),
    ("'DN|Width|Pressure|mm|Kenngröße'", "concat(p_size, '|5|16 bar|x|2019-05-01')", "'20|7 - 9|≤ 25 bar||12 / 13'", "'|3|4|5|6'", "''"),
    ("'Property|Value|Remark'", "concat('Weight|', p_size, ' kg|dry')", "'Operating pressure|10 - 16|max load|indoor|wet'", "concat('Brand|', p_brand, '|')", "'12|13|'", "'Temperature|warm|-20 ~ 80 °C'"),
    ("'Type|Form A|Form B'", "'Model|CD-300|CD-400'", "concat('Length|', p_size, '|120')", "'DIN 123|100|120'", "'Radius|≥ 5|r'"),
)
RECOGNISED = ("'A|B| |'", "'Width|12'", "concat('Length|', p_size, ' mm||')", "' | '")


def regular(d: Dialect, grid: str) -> str:
    """A recognised grid as a regular one: nothing below two rows; short rows padded, columns that are empty in all rows cut
    from the end."""
    filled = d.most(f"flatten({d.each(grid, lambda r, _: d.each(r, lambda c, i: f"CASE WHEN {c} <> '' THEN {i} + 1 ELSE 0 END", 'c', 'i'), 'r', 'k')})")
    padded = d.each("g.grid", lambda r, _: d.each(d.upto("g.width"), lambda n, _: f"coalesce({d.get(r, n)}, '')", "n", "j"), "r", "k")
    one = d.array([d.struct(grid=grid, width=f"greatest(1, {filled})")])
    return f"CASE WHEN {d.size(grid)} >= 2 THEN {d.get(d.each(one, lambda g, _: padded, 'g', 'h'), '0')} END"


def clean(d: Dialect, grid: str) -> str:
    """A grid with normalised cells, without rows that hold nothing."""
    cells = d.each(grid, lambda r, _: d.each(r, lambda c, _: d.norm(f"coalesce({c}, '')"), "c", "j"), "r", "k")
    return d.kept(cells, lambda r, _: d.any_kept(r, lambda c, _: f"{c} <> ''", "c", "j"), "r", "k")


def spec_pages(d: Dialect, dealt: str = "") -> str:
    """doc_id, page_index, lines, tables: a page for each part, with its lines and its tables as nested arrays; rows without
    content go, recognised grids are made regular and stand after native ones."""
    rows = lambda r: d.array([d.split_cells(x) for x in r])
    raw = f"SELECT {d.div('p_partkey', '50')} AS doc_id, p_partkey % 50 AS page_index, {d.array(LINES)} AS lines, CASE p_partkey % 4 {' '.join(f'WHEN {i} THEN {rows(t)}' for i, t in enumerate(TEMPLATES))} END AS native, CASE WHEN p_partkey % 5 = 2 THEN {rows(RECOGNISED)} END AS said FROM (SELECT {dealt}*, p_partkey AS k FROM part) p"
    return f"SELECT doc_id, page_index, lines, tables FROM ({d.pin(f'({raw}) r', tables=page_tables(d, 'native', 'said'))}) q"


def page_tables(d: Dialect, native: str, recognised: str) -> str:
    """The tables of a page: a native grid and a recognised one, either of which may be null."""
    both = d.array([clean(d, native), clean(d, regular(d, recognised))])
    return d.kept(both, lambda t, _: f"{t} IS NOT NULL AND {d.size(t)} > 0", "t", "n")


def page_titles(d: Dialect) -> str:
    """Captions of a page's lines, in order, and the first that says something."""
    return d.kept("lines", lambda x, _: f"({d.match(x, Parser.TABLE_CAPTION_RE)} OR {d.search(x, Parser.GENERIC_SHORT_HEADING_RE)} OR {d.full(x, Rx(r'(?:Form|Shape)\s+[A-Z0-9]+', True))})", "x", "n")


def titled(d: Dialect, pages: str | None = None, ref: str = "''") -> dict[str, str]:
    """`tbl`: the tables of pages(doc_id, page_index, lines, tables) with number and title. A title is the page's caption of
    the table's rank, if it says something, else the first that does, else the place. `ref` is the section of a page."""
    dull = lambda x: d.full(x, Parser.LOW_SIGNAL_TABLE_TITLE_RE)
    return {
        "tpg": pages or spec_pages(d),
        "pc": f"SELECT doc_id, page_index, tables, {ref} AS page_ref, {page_titles(d)} AS captions FROM tpg WHERE {d.size('tables')} > 0",
        "pf": f"SELECT doc_id, page_index, tables, page_ref, {d.each('captions', lambda x, _: f"CASE WHEN {dull(x)} THEN '' ELSE {x} END", 'x', 'n')} AS captions FROM pc",
        "pt": d.rows("pf", "tables", "grid", "tab_at", "doc_id, page_index, page_ref, captions, tab_at, grid"),
        "tbl": f"""SELECT doc_id, page_index, CAST(tab_at + 1 AS BIGINT) AS tab_no, page_ref AS ref, concat('第', page_index + 1, '页_表', tab_at + 1) AS table_no, grid,
          coalesce(nullif({d.get('captions', 'tab_at')}, ''), {d.first_kept('captions', lambda x, _: f"{x} <> ''", 'x', 'n')}, concat('第', page_index + 1, '页表', tab_at + 1)) AS title FROM pt""",
    }


@query
def s03_s04_page_tables(d):
    return with_(
        titled(d) | {"r": d.rows("tbl", "grid", "cells", "row_at", "doc_id, page_index, tab_no, row_at, cells"), "c": d.rows("r", "cells", "cell", "col_idx", "doc_id, page_index, tab_no, row_at, col_idx, cell")},
        "SELECT doc_id, page_index, tab_no, CAST(row_at AS BIGINT) AS row_idx, col_idx, cell FROM c",
    )


def _size(d: Dialect) -> str:
    return d.size("flatten(grid)")


@query
def f22_x01_t08_tables(d):
    return with_(titled(d), f"SELECT doc_id, page_index, tab_no, table_no, title, {d.size('grid')} AS n_rows, {_size(d)} AS n_cells, {d.any_kept('flatten(grid)', lambda c, _: f"{c} <> ''", 'c', 'n')} AS valid FROM tbl")


@query
def x02_headers_and_bodies(d):
    rows = d.rows("tbl", "grid", "cells", "row_at", "doc_id, page_index, tab_no, row_at, cells")
    return with_(titled(d) | {"r": rows}, f"SELECT doc_id, page_index, tab_no, CAST(row_at AS BIGINT) AS row_idx, CASE WHEN row_at = 0 THEN 'header' ELSE 'body' END AS part, {d.joined('cells', ' | ')} AS cells FROM r")


def largest(d: Dialect, rows: str = "tbl") -> dict[str, str]:
    """`big`: of the tables of one section, title and header (its first six cells) the largest, the first one of equals;
    `place` numbers them by the place of the first."""
    key = "PARTITION BY doc_id, ref, title, header"
    return {
        "th": f"SELECT *, {d.joined(d.head(d.get('grid', '0'), 6), '|')} AS header, {_size(d)} AS n_cells FROM {rows}",
        "tk": f"SELECT *, row_number() OVER ({key} ORDER BY n_cells DESC, page_index, tab_no) AS nth, first_value(page_index) OVER ({key} ORDER BY page_index, tab_no) AS first_page, first_value(tab_no) OVER ({key} ORDER BY page_index, tab_no) AS first_tab FROM th",
        "big": "SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_page, first_tab) AS BIGINT) AS place FROM tk WHERE nth = 1",
    }


@query
def d04_largest_tables(d):
    return with_(titled(d) | largest(d), "SELECT doc_id, place, page_index, tab_no, title, header, n_cells FROM big")


def _models(d: Dialect, cells: str, x: str) -> str:
    """Model columns of a row of cells(i, c): index and label, each label at its first place."""
    found = d.kept(d.each(cells, lambda c, _: d.struct(i=f"{c}.i", label=d.extract(f"{c}.c", Parser.MODEL_RE)), f"{x}a", f"{x}b"), lambda m, _: f"{m}.label <> ''", f"{x}c", f"{x}d")
    one = d.array([d.struct(m=found)])
    first = lambda g, _: d.kept(f"{g}.m", lambda a, _: d.size(d.kept(f"{g}.m", lambda b, _: f"{b}.label = {a}.label AND {b}.i < {a}.i", f"{x}h", f"{x}j")) + " = 0", f"{x}f", f"{x}g")
    return d.get(d.each(one, first, f"{x}e", f"{x}k"), "0")


def graded(d: Dialect, tables: dict[str, str]) -> dict[str, str]:
    """`gt`: tables with their marked cells: headers(i, c, unit), rows(i, cells(i, c, v)), model columns and unit column.
    Nothing is exploded: a table stays one row."""
    cell = lambda c, i: d.struct(i=i, c=c)
    marked = lambda c, i: d.struct(i=i, c=c, v=value_like(d, c))
    return tables | {
        "g1": f"SELECT *, {d.each(d.get('grid', '0'), lambda c, i: d.struct(i=i, c=c, unit=d.full(c, UNIT_TOKEN)), 'c', 'i')} AS headers, {d.each(d.rest('grid'), lambda r, k: d.struct(i=f'{k} + 1', cells=d.each(r, marked, 'c', 'i')), 'r', 'k')} AS body FROM tbl",
        "g2": d.pin("g1", m0=_models(d, "headers", "p"), m1=f"coalesce({_models(d, d.get('body', '0') + '.cells', 'q')}, {d.none_of(_models(d, 'headers', 'u'))})", m2=f"coalesce({_models(d, d.get('body', '1') + '.cells', 's')}, {d.none_of(_models(d, 'headers', 't'))})"),
        "g3": f"SELECT *, CASE WHEN {d.size('m0')} > 0 THEN m0 WHEN {d.size('m1')} > 0 THEN m1 ELSE m2 END AS models, coalesce({d.first_kept('headers', lambda h, _: f'{h}.unit', 'h', 'n')}.i, -1) AS unit_col FROM g2",
        "gt": f"SELECT *, {d.each('body', lambda r, _: d.struct(i=f'{r}.i', cells=f'{r}.cells', label=_label(d, r)), 'r', 'n')} AS rows FROM g3",
    }


def _label(d: Dialect, row: str) -> str:
    """The first cell of a row that is no value and lies in no model or unit column; null if there is none."""
    free = lambda c, _: f"{c}.c <> '' AND NOT {c}.v AND {c}.i <> unit_col AND NOT {d.any_kept('models', lambda m, _: f'{m}.i = {c}.i', 'm', 'l')}"
    return d.first_kept(f"{row}.cells", free, "c", "k") + ".c"


def candidates(d: Dialect, tables: dict[str, str] | None = None) -> dict[str, str]:
    """`gc`: parameter candidates of all tables: of model columns (kind 1), of the matrix (2), of key and value (3). They are
    gathered within the table's row and laid out once, seq being their place."""
    at = lambda r, i: d.get(f"{r}.cells", i)
    cell = lambda kind, r, col, label, value, v, cond, hint: d.struct(kind=kind, row_at=f"{r}.i", col_at=col, label=label, value=value, v=v, cond=cond, hint=hint)
    ok = lambda z, _: f"coalesce({z}.v, false) AND coalesce({z}.label, '') <> ''"
    of_models = d.each("rows", lambda r, _: d.kept(d.each("models", lambda m, _: cell("1", r, f"{m}.i", f"{r}.label", f"{at(r, f'{m}.i')}.c", f"{at(r, f'{m}.i')}.v", f"{m}.label", f"coalesce({at(r, 'unit_col')}.c, '')"), "m", "l"), ok, "z", "y"), "r", "n")
    head0 = d.get("headers", "0") + ".c"
    said = lambda r: f"CASE WHEN {head0} <> '' THEN concat({head0}, '=', {at(r, '0')}.c) ELSE {at(r, '0')}.c END"
    of_matrix = d.each("rows", lambda r, _: d.kept(d.each("headers", lambda h, _: cell("2", r, f"{h}.i", f"{h}.c", f"{at(r, f'{h}.i')}.c", f"({at(r, f'{h}.i')}.v AND {h}.i > 0 AND NOT {h}.unit AND {at(r, '0')}.c <> '')", said(r), "''"), "h", "l"), ok, "z", "y"), "r", "n")
    taken = lambda r: d.struct(r=r, v=d.first_kept(f"{r}.cells", lambda c, _: f"{c}.i > 0 AND {c}.v", "c", "k"))
    others = lambda g: d.joined(d.head(d.each(d.kept(f"{g}.r.cells", lambda c, _: f"{c}.i > 0 AND {c}.c <> '' AND {c}.i <> {g}.v.i AND {c}.c <> {g}.v.c AND length({c}.c) <= 40", "c", "k"), lambda c, _: f"{c}.c", "c", "k"), 2), " / ")
    first = lambda g: d.get(f"{g}.r.cells", "0")
    of_pairs = d.kept(d.each(d.each("rows", lambda r, _: taken(r), "r", "n"), lambda g, _: cell("3", f"{g}.r", "0", f"{first(g)}.c", f"{g}.v.c", f"({g}.v.v AND NOT {first(g)}.v)", others(g), "''"), "g", "n"), ok, "z", "y")
    laid = d.rows("gl", "found", "f", "seq", "doc_id, page_index, tab_no, title, ref, around, seq, f")
    canon = name_of(d, "label", "CASE WHEN kind = 3 THEN around ELSE title END", always=True)
    return graded(d, tables or titled(d)) | {
        "ga": f"SELECT *, concat(title, ' ', {d.joined(d.each('headers', lambda h, _: f'{h}.c', 'h', 'n'), ' ')}) AS around FROM gt",
        # pinned, as Spark would work it out a second time to skip tables without a candidate
        "gl": d.pin("ga", found=d.chained(f"flatten({of_models})", f"flatten({of_matrix})", of_pairs)),
        "g5": laid,
        "g6": "SELECT doc_id, page_index, tab_no, title, ref, around, CAST(seq AS BIGINT) AS seq, f.kind AS kind, CAST(f.row_at AS BIGINT) AS row_idx, f.col_at AS col_idx, f.label AS label, f.value AS value, f.cond AS said_cond, f.hint AS said_hint FROM g5",
        "g7": d.pin("g6", name=canon),
        "gc": f"SELECT doc_id, page_index, tab_no, kind, row_idx, col_idx, seq, name, value, said_cond, CASE WHEN kind = 2 AND said_cond = name THEN '' ELSE said_cond END AS cond, CASE WHEN ref <> '' THEN ref ELSE title END AS section_ref, title AS table_title, label AS source_item, CASE WHEN kind = 3 THEN {d.extract('around', Parser.UNIT_TOKEN_RE)} ELSE said_hint END AS unit_hint FROM g7",
    }


def table_parameters(d: Dialect, tables: dict[str, str] | None = None) -> dict[str, str]:
    """`gpar`: parameters of the tables; of equal ones of a table the last, in the place of the first."""
    key = "doc_id, page_index, tab_no, name, clean_value, cond, section_ref, table_title"
    return candidates(d, tables) | {"gx": "SELECT *, concat(cond, ' ', source_item, ' ', section_ref) AS context FROM gc"} | made(d, "gx", "doc_id, page_index, tab_no, seq, cond, section_ref, table_title, source_item", "unit_hint") | {
        "g9": f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY seq DESC) AS from_last, min(seq) OVER (PARTITION BY {key}) AS place FROM params",
        "gpar": "SELECT * FROM g9 WHERE from_last = 1",
    }


@query
def x05_model_columns(d):
    return with_(graded(d, titled(d)) | {"m": d.rows("gt", "models", "m", "", "doc_id, page_index, tab_no, m")}, "SELECT doc_id, page_index, tab_no, m.label AS model, CAST(m.i AS INT) AS col_idx FROM m")


@query
def x05b_models_of_rows(d):
    """Model columns of the header and of the first two rows of the body."""
    rows = d.rows("g2", d.array(["m0", "m1", "m2"]), "ms", "row_at", "doc_id, page_index, tab_no, row_at, ms")
    return with_(graded(d, titled(d)) | {"r": rows, "m": d.rows("r", "ms", "m", "", "doc_id, page_index, tab_no, row_at, m")}, "SELECT doc_id, page_index, tab_no, CAST(row_at AS BIGINT) AS row_idx, m.label AS model, CAST(m.i AS INT) AS col_idx FROM m")


@query
def x09_f19_unit_columns(d):
    return with_(graded(d, titled(d)), "SELECT doc_id, page_index, tab_no, CAST(unit_col AS INT) AS unit_col FROM gt WHERE unit_col >= 0")


@query
def x10_row_labels(d):
    return with_(graded(d, titled(d)) | {"r": d.rows("gt", "rows", "r", "", "doc_id, page_index, tab_no, r")}, "SELECT doc_id, page_index, tab_no, CAST(r.i AS BIGINT) AS row_idx, r.label AS label FROM r WHERE r.label IS NOT NULL")


@query
def x06_model_table_candidates(d):
    return with_(candidates(d), "SELECT doc_id, page_index, tab_no, row_idx, CAST(col_idx AS INT) AS col_idx, seq, name, value, cond, source_item, unit_hint FROM gc WHERE kind = 1")


@query
def x07_matrix_candidates(d):
    return with_(candidates(d), "SELECT doc_id, page_index, tab_no, row_idx, CAST(col_idx AS INT) AS col_idx, seq, name, value, said_cond, source_item FROM gc WHERE kind = 2")


@query
def x08_key_value_candidates(d):
    return with_(candidates(d), "SELECT doc_id, page_index, tab_no, row_idx, seq, name, value, cond, source_item, unit_hint FROM gc WHERE kind = 3")


@query
def x04_d05_table_parameters(d):
    return with_(table_parameters(d), "SELECT doc_id, page_index, tab_no, place, name, clean_value, lower_bound, upper_bound, comparator, unit, cond, section_ref, table_title, source_item FROM gpar")


def renamed(parts: dict[str, str], to: str) -> dict[str, str]:
    """Steps under new names, so that two chains with the same names fit into one plan."""
    swap = re.compile(r"\b(FROM|JOIN) (" + "|".join(parts) + r")\b")
    return {f"{to}{k}": swap.sub(lambda m: f"{m[1]} {to}{m[2]}", v) for k, v in parts.items()}


@query
def d06_w09_all_parameters(d):
    """Parameters of tables, then of lines: the first of each (name, value, condition, section, table), numbered through."""
    lines = renamed(text_candidates(d) | made(d, "cand", "doc_id, page_index, line_no"), "t_")
    order = "origin, page_index, tab_no, place"
    return with_(
        table_parameters(d) | lines | {
            "merged_all": "SELECT doc_id, 0 AS origin, page_index, tab_no, place, name, clean_value, unit, comparator, cond, section_ref, table_title FROM gpar UNION ALL SELECT doc_id, 1, page_index, 0, line_no, name, clean_value, unit, comparator, '', '', '' FROM t_params",
            "k": f"SELECT *, row_number() OVER (PARTITION BY doc_id, name, clean_value, cond, section_ref, table_title ORDER BY {order}) AS nth FROM merged_all",
        },
        f"SELECT doc_id, name, clean_value, unit, comparator, cond, section_ref, table_title, concat('param-', row_number() OVER (PARTITION BY doc_id ORDER BY {order})) AS param_id FROM k WHERE nth = 1",
    )


@query
def x03_table_standards(d):
    """All standard codes in titles and rows of tables."""
    said = d.rows("tbl", d.chained(d.array(["title"]), d.each("grid", lambda r, _: d.joined(r, " "), "r", "n")), "txt", "row_at", "doc_id, page_index, tab_no, row_at, txt")
    codes = d.rows("said", d.extract_all("txt", Parser.STANDARD_RE, 1), "code", "n", "doc_id, page_index, code")
    return with_(titled(d) | {"said": said, "codes": codes}, "SELECT doc_id, code, min(page_index) AS page_index, count(*) AS n FROM codes GROUP BY doc_id, code")


@query
def w04_page_sections(d):
    """Where no section was found, a page is one: its first forty lines that are no piece of a table."""
    return with_(
        {"l": spec_lines(d), "f": d.pin("l", piece=L.table_fragment(d, "line")), "b": "SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line_no) AS nth FROM f WHERE NOT piece AND line <> ''"},
        f"SELECT doc_id, concat('U', page_index + 1) AS no, CASE WHEN page_index = 0 THEN '概述' ELSE concat('页面', page_index + 1, '内容') END AS title, {d.sha256(d.join_in_order('line', 'line_no', where='nth <= 40'))} AS body_sha, least(40, count(*)) AS n_lines FROM b GROUP BY doc_id, page_index",
    )


@query
def f16_fragmented_pages(d):
    """Recognised pages in pieces: injected, and full of single signs, repeated lines or marks, or marginal."""
    many = " OR ".join(f"{k} >= {v}" for k, v in FRAGMENTED.items())
    return with_({"l": doc_lines(d), "o": ocr_evaluated(d, "l")}, f"SELECT doc_id, grade, grade <> '拒绝' AND ({many} OR grade = '边缘' OR fragmented) AS in_pieces FROM o")


@query
def a08b_isolated_marks(d):
    """Ideographic marks without a letter, digit or ideograph within two signs on either side, in thousandths."""
    x = "t"
    around = "concat(substr(t, greatest(1, i - 2), least(2, i - 1)), ' ', substr(t, i + 1, 2))"
    mark, alone = f"substr({x}, i, 1)", d.search(around, Rx("[一-鿿A-Za-z0-9]"))
    places = f"filter(sequence(1, length({x})), i -> {d.search(mark, Rx(MARKS))} AND NOT {alone})" if d.name == "spark" else f"[i FOR i IN range(1, length({x}) + 1) IF {d.search(mark, Rx(MARKS))} AND NOT {alone}]"
    texts = "SELECT p_partkey, concat(CASE p_partkey % 5 WHEN 0 THEN '法兰。' WHEN 1 THEN ' 。 ，' WHEN 2 THEN '； ；a' WHEN 3 THEN '。' ELSE p_name END, CASE p_partkey % 3 WHEN 0 THEN '  ！' WHEN 1 THEN '，b' ELSE '' END) AS t FROM part"
    return with_({"x": texts}, f"SELECT p_partkey, {d.count(x, Rx(MARKS))} AS marks, {d.size(places)} AS alone FROM x")


@query
def a08h_c03_accepted_texts(d):
    """Texts of the pages whose recognition is taken over: trimmed lines, blank ones left out."""
    return with_({"l": doc_lines(d), "o": ocr_evaluated(d, "l")}, f"SELECT doc_id, {d.sha256('t')} AS text_sha, n_lines FROM o WHERE grade <> '拒绝' AND t <> ''")


@query
def a08i_page_evaluations(d):
    return with_({"l": doc_lines(d), "o": ocr_evaluated(d, "l")}, f"SELECT doc_id, {d.record(grade='grade', inject='grade <> ' + d.lit('拒绝'), chars='content_chars', single='single_m', repeated='dup_m')} AS evaluation FROM o")


@query
def f17_front_matter(d):
    return with_({"l": doc_lines(d)}, f"SELECT doc_id, {tally(d.search('line', Parser.FRONT_MATTER_CUE_RE))} AS cues, {tally(d.search('line', Parser.FRONT_MATTER_SECTION_RE))} AS sections FROM l GROUP BY doc_id")


def boxes(d: Dialect) -> dict[str, str]:
    """Recognised lines and cells of made-up pages: boxes as four numbers or as polygons, in whole points."""
    base = "SELECT p_partkey AS page_id, p_size AS s, p_name FROM part"
    grid = d.rows(f"({base}) b", d.series(6), "n", "", "page_id, s, p_name, n")
    x, y = "((n - 1) % 3) * 100", f"{d.div('(n - 1)', '3')} * 40"
    return {
        "gb": grid,
        "cb": f"SELECT page_id, n AS cell_no, CASE WHEN n % 2 = 0 THEN {d.array([f'{x}', f'{y} + 30', f'{x} + 90', f'{y}'])} ELSE {d.array([f'{x}', f'{y}', f'{x} + 90', f'{y}', f'{x} + 90', f'{y} + 30', f'{x}', f'{y} + 30'])} END AS box FROM gb WHERE NOT (page_id % 7 = 1 AND n = 6)",
        "lb": f"SELECT page_id, n AS line_no, CASE WHEN (page_id + n) % 9 = 0 THEN '  ' ELSE concat(p_name, ' ', n) END AS txt, {d.array([f'{x} + s', f'{y} + page_id % 11', f'{x} + s + 40', f'{y} + page_id % 11 + 14'])} AS box FROM gb",
    }


def rect(d: Dialect, x: str) -> dict[str, str]:
    """Least and greatest of a box's odd and even numbers."""
    pick = lambda r: f"filter({x}, (v, i) -> i % 2 = {r})" if d.name == "spark" else f"[{x}[i] FOR i IN range(1, len({x}) + 1) IF (i - 1) % 2 = {r}]"
    low, high = ("array_min({0})", "array_max({0})") if d.name == "spark" else ("list_min({0})", "list_max({0})")
    return {"x1": low.format(pick(0)), "y1": low.format(pick(1)), "x2": high.format(pick(0)), "y2": high.format(pick(1))}


def placed_boxes(d: Dialect) -> dict[str, str]:
    """`hit`: the cell of each line: the one around its centre that it overlaps most, else the one it overlaps most, else
    the nearest, if the centre is within its tolerance."""
    shown = lambda cols: ", ".join(f"{v} AS {k}" for k, v in cols.items())
    over = "greatest(0, least(c.x2, l.x2) - greatest(c.x1, l.x1)) * greatest(0, least(c.y2, l.y2) - greatest(c.y1, l.y1))"
    tol = lambda a, b: f"greatest({TOLERANCE_LEAST}, {TOLERANCE} * (c.{b} - c.{a}))"
    # centres are kept doubled, so that all numbers are whole
    inside = "2 * c.x1 <= l.cx AND l.cx <= 2 * c.x2 AND 2 * c.y1 <= l.cy AND l.cy <= 2 * c.y2"
    near = f"2 * (c.x1 - {tol('x1', 'x2')}) <= l.cx AND l.cx <= 2 * (c.x2 + {tol('x1', 'x2')}) AND 2 * (c.y1 - {tol('y1', 'y2')}) <= l.cy AND l.cy <= 2 * (c.y2 + {tol('y1', 'y2')})"
    distance = "(c.x1 + c.x2 - l.cx) * (c.x1 + c.x2 - l.cx) + (c.y1 + c.y2 - l.cy) * (c.y1 + c.y2 - l.cy)"
    return boxes(d) | {
        "cr": f"SELECT page_id, cell_no, {shown(rect(d, 'box'))} FROM cb",
        "lr0": f"SELECT page_id, line_no, trim(txt) AS txt, {shown(rect(d, 'box'))} FROM lb",
        "lr": "SELECT *, x1 + x2 AS cx, y1 + y2 AS cy FROM lr0 WHERE txt <> ''",
        "pair": f"SELECT l.page_id, l.line_no, l.txt, l.cx, l.cy, c.cell_no, c.y1 + c.y2 AS cell_cy, c.x1 + c.x2 AS cell_cx, {over} AS area, CASE WHEN {inside} THEN 0 WHEN {over} > 0 THEN 1 ELSE 2 END AS kind, {distance} AS distance, {near} AS near FROM lr l JOIN cr c ON l.page_id = c.page_id",
        "rank": "SELECT *, row_number() OVER (PARTITION BY page_id, line_no ORDER BY kind, CASE WHEN kind = 2 THEN distance ELSE -area END, cell_cy, cell_cx) AS nth FROM pair",
        "hit": "SELECT * FROM rank WHERE nth = 1 AND (kind < 2 OR near)",
    }


@query
def o01_rectangles(d):
    return with_(placed_boxes(d), "SELECT page_id, cell_no, CAST(x1 AS BIGINT) AS x1, CAST(y1 AS BIGINT) AS y1, CAST(x2 AS BIGINT) AS x2, CAST(y2 AS BIGINT) AS y2 FROM cr")


@query
def o03_text_lines(d):
    """Recognised lines with text, in reading order of their centres."""
    return with_(placed_boxes(d), "SELECT page_id, line_no, txt, CAST(row_number() OVER (PARTITION BY page_id ORDER BY cy, cx, line_no) AS BIGINT) AS place FROM lr")


@query
def j10_o02_lines_of_cells(d):
    return with_(placed_boxes(d), "SELECT page_id, line_no, cell_no, CAST(area AS BIGINT) AS area FROM hit")


@query
def o05_meaningful_grids(d):
    """Pages whose recognised grid has enough filled cells to be a table."""
    return with_(placed_boxes(d), f"SELECT page_id, count(DISTINCT cell_no) AS n_filled, count(DISTINCT cell_no) >= {FILLED_LEAST} AS meaningful FROM hit GROUP BY page_id")


@query
def o08_line_confidences(d):
    """Lines of a page by falling confidence."""
    return with_(placed_boxes(d) | {"c": "SELECT page_id, line_no, txt, 100 - (line_no * 37 + page_id) % 60 AS confidence_pct FROM lr"}, "SELECT page_id, line_no, txt, confidence_pct, CAST(row_number() OVER (PARTITION BY page_id ORDER BY confidence_pct DESC, line_no) AS BIGINT) AS place FROM c")
