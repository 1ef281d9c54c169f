"""The structure tree against values worked out by hand."""

from stratafold.plans.document import to_shared
from stratafold.plans.state import empty
from stratafold.plans.tree import structure_tree

SECTIONS = [("1", "Scope"), ("3", "Materials"), ("3.2.1", "Steel"), ("3.2.1.4", "Grades"), ("U1", "Notes"), ("10.1", "Tests"), ("3", "Again"), ("3.5", "Brass"), ("1.2.3.4.5", "Deep")]


def test_tree_with_missing_levels(spark):
    sec = spark.createDataFrame([("a", i + 1, no, t) for i, (no, t) in enumerate(SECTIONS)] + [("b", 1, "3.2", "Other")], "doc_id string, ord long, no string, title string")
    records = lambda *refs: spark.createDataFrame([("a", r) for r in refs], "doc_id string, section_ref string")
    frames = {k: empty(spark, k, "string") for k in ("std", "tab")} | {"sec": sec, "par": records("3.2.1 Steel", "3.2.1 Steel", "3.2.1.4 Grades", "3 Materials", "", "10.1 Tests"), "rul": records("3.5 Brass", "U1 Notes"), "ins": records("1.2.3.4.5 Deep")}
    got = {(r.doc_id, r.ord): (r.parent_no, r.depth, r.path, r.n_nodes, r.n_par, r.n_rul, r.n_ins) for r in structure_tree(spark, frames, to_shared).collect()}
    assert got == {
        ("a", 1): ("", 0, "1", 2, 0, 0, 1),
        ("a", 2): ("", 0, "3", 4, 4, 1, 0),  # 3.2 has no section: 3.2.1 hangs below 3
        ("a", 3): ("3", 1, "3 > 3.2.1", 2, 3, 0, 0),
        ("a", 4): ("3.2.1", 2, "3 > 3.2.1 > 3.2.1.4", 1, 1, 0, 0),
        ("a", 5): ("", 0, "U1", 1, 0, 1, 0),
        ("a", 6): ("", 0, "10.1", 1, 1, 0, 0),
        ("a", 7): ("", 0, "3", 1, 0, 0, 0),  # the first section of a number is the ancestor
        ("a", 8): ("3", 1, "3 > 3.5", 1, 0, 1, 0),
        ("a", 9): ("1", 1, "1 > 1.2.3.4.5", 1, 0, 0, 1),
        ("b", 1): ("", 0, "3.2", 1, 0, 0, 0),
    }


def test_no_sections(spark):
    frames = {k: empty(spark, k, "string") for k in ("sec", "par", "rul", "std", "tab", "ins")}
    assert structure_tree(spark, frames, to_shared).count() == 0
