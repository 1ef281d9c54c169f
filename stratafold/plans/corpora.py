"""Input relations of the registered queries as SQL: lines of the given documents and pages, and a derived corpus of
specification pages with headings, captions, parameters, requirements, standard codes and noise lines."""

from __future__ import annotations

from stratafold.functions.dialect import Dialect


def doc_lines(d: Dialect) -> str:
    """doc_id, source, line_no, line: normalised lines of documents that are not blank."""
    raw = d.rows("(SELECT doc_id, source, text FROM documents WHERE text IS NOT NULL) x", d.split("text", "\n"), "raw", "line_no", "doc_id, source, line_no, raw")
    return f"SELECT doc_id, source, line_no, line FROM (SELECT doc_id, source, line_no, {d.norm('raw')} AS line FROM ({raw}) r) n WHERE line <> ''"


def doc_arrays(d: Dialect) -> str:
    """doc_id, source, lines: the same lines as an array, of documents that have one. Nothing is exploded."""
    return f"SELECT doc_id, source, lines FROM (SELECT doc_id, source, {d.mapped(d.split('text', chr(10)), 'x', d.norm('x'), 'y <> ' + d.lit(''))} AS lines FROM documents WHERE text IS NOT NULL) a WHERE {d.size('lines')} > 0"


#: Line templates of a specification page; k is the part key, and every piece is a whole number or a text column.
TEMPLATES = (
    "'ACME STANDARD PART FILE'",
    "concat(p_size, '.', k % 7 + 1, ' ', p_type)",
    "CASE WHEN k % 11 = 0 THEN concat('Part ', k % 5 + 1, ': General data') ELSE 'Scope' END",
    "concat('Table ', k % 9 + 1, ': Dimensions of ', p_name)",
    "concat('Width: ', p_size, ' mm')",
    "concat('Operating pressure: ', p_size, ' to ', p_size + 20, ' bar')",
    "concat('Tolerance <= 0.', k % 9 + 1, ' mm')",
    "'The part shall be stored dry and must not be bent.'",
    "'Inspection test of the surface by visual check'",
    "concat('See DIN EN ', 1000 + k % 300, '-', 1 + p_size % 4, ' and GB/T ', 100 + k % 50, '-', 60 + p_size % 40)",
    "concat('Page ', k % 40 + 1, ' of 40')",
    "concat(k % 6 + 1, ' General ........ ', k % 30 + 1)",
    "concat(p_brand, ' type AB-', 1000 + k, ' series')",
    "'and further information'",
    "concat('The ', p_name, ' is delivered in boxes, see the ordering data for the quantities and the colours in stock')",
    "'Revision history'",
    "CASE WHEN k % 5 = 0 THEN '3' ELSE 'ICS 23.040' END",
    "CASE WHEN k % 5 = 0 THEN 'Materials' ELSE 'www.example.com free copy' END",
    "concat('Weight ', p_size, ' kg, length ', p_size * 10, ' mm')",
    "'It is recommended that users should keep the marking'",
    "'Field of application: lifting gear, CE and ATEX marked'",
)


def spec_lines(d: Dialect) -> str:
    """doc_id, page_index, line_no, line: a line of each template for each part; fifty parts make a document."""
    made = "(SELECT p_partkey AS k, p_name, p_brand, p_type, p_size FROM part) p"
    rows = d.rows(made, d.array(TEMPLATES), "line", "line_no")
    return f"SELECT {d.div('k', '50')} AS doc_id, k % 50 AS page_index, line_no + 1 AS line_no, line FROM ({rows}) b"


def spec_cells(d: Dialect) -> str:
    """doc_id, page_index, row_idx, label, unit, value, text: a small key-value table for each part."""
    base = d.rows("(SELECT p_partkey AS k, p_name, p_size, p_brand FROM part) p", d.series(4), "row_idx")
    label = "CASE row_idx WHEN 1 THEN 'Width' WHEN 2 THEN 'Working pressure' WHEN 3 THEN 'Brand' ELSE 'Dimension' END"
    unit = "CASE row_idx WHEN 1 THEN 'mm' WHEN 2 THEN 'bar' ELSE '' END"
    value = "CASE row_idx WHEN 1 THEN concat(p_size, '') WHEN 2 THEN concat(p_size, ' - ', p_size + 10) WHEN 3 THEN p_brand ELSE concat(p_size, ' x ', p_size + 5) END"
    return f"SELECT {d.div('k', '50')} AS doc_id, k % 50 AS page_index, row_idx, {label} AS label, {unit} AS unit, {value} AS value FROM ({base}) b"
