"""The structure tree: sections under their nearest existing ancestor, with path, depth and sums over subtrees.

The ancestors of a section are the sections whose number is a proper prefix of its own, the parent the longest of them, also
where levels between are missing. So one join of prefixes with numbers gives every section all its ancestors; nothing is
followed step by step, and a section costs as many rows as its number has parts. DuckDB's oracle climbs from parent to parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratafold.functions.dialect import DUCK, REGISTERED, SPARK, Dialect
from stratafold.functions.patterns import Parser
from stratafold.plans.document import to_shared
from stratafold.plans.registry import run_sql, with_
from stratafold.plans.steps import Keep, Steps
from stratafold.plans.structure import sections

#: Kinds of records that are summed up.
KINDS = ("par", "rul", "std", "tab", "ins")


def _ancestors(d: Dialect) -> dict[str, str]:
    """`anc`: (doc_id, ord, anc_ord, anc_no, far): every ancestor of every section, far being the length of its number."""
    if d.name == "spark":
        parts = "split(no, '[.]')"
        prefixes = f"CASE WHEN no LIKE '%.%' THEN transform(sequence(1, size({parts}) - 1), k -> array_join(slice({parts}, 1, k), '.')) ELSE CAST(array() AS ARRAY<STRING>) END"
        return {
            "pre": d.rows(f"(SELECT doc_id, ord, {prefixes} AS prefixes FROM tn) p", "prefixes", "prefix", "", "doc_id, ord, prefix"),
            "anc": "SELECT p.doc_id, p.ord, f.ord AS anc_ord, f.no AS anc_no, length(f.no) AS far FROM pre p JOIN tn1 f ON p.doc_id = f.doc_id AND p.prefix = f.no",
        }
    return {
        "climb": "SELECT doc_id, ord, no AS cur FROM tn UNION ALL SELECT doc_id, ord, regexp_replace(cur, '[.][^.]*$', '') FROM climb WHERE cur LIKE '%.%'",
        "near": "SELECT c.doc_id, c.ord, arg_max(f.ord, length(f.no)) AS up FROM climb c JOIN tn t ON c.doc_id = t.doc_id AND c.ord = t.ord AND c.cur <> t.no JOIN tn1 f ON c.doc_id = f.doc_id AND c.cur = f.no GROUP BY c.doc_id, c.ord",
        "walk": "SELECT doc_id, ord, up FROM near UNION ALL SELECT w.doc_id, w.ord, n.up FROM walk w JOIN near n ON w.doc_id = n.doc_id AND w.up = n.ord",
        "anc": "SELECT w.doc_id, w.ord, w.up AS anc_ord, t.no AS anc_no, length(t.no) AS far FROM walk w JOIN tn t ON w.doc_id = t.doc_id AND w.up = t.ord",
    }


def tree(d: Dialect, nodes: str, facts: str) -> dict[str, str]:
    """`tree` from nodes(doc_id, ord, no, title, ref) and facts(doc_id, ref, kind, n), a row for each reference and kind. Of
    sections with one number the first is the ancestor, and of those with one reference the first has the facts."""
    sums = ", ".join(f"CAST(coalesce(sum(CASE WHEN kind = '{k}' THEN n END), 0) AS BIGINT) AS n_{k}" for k in KINDS)
    return {
        "tn": nodes,
        "tf": facts,
        "tn1": "SELECT doc_id, ord, no FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, no ORDER BY ord) AS k FROM tn) x WHERE k = 1",
        **_ancestors(d),
        "tup": f"SELECT doc_id, ord, {d.list_in_order('anc_no', 'far')} AS above FROM anc GROUP BY doc_id, ord",
        "trf": "SELECT doc_id, ord, ref FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, ref ORDER BY ord) AS k FROM tn) x WHERE k = 1",
        "own": "SELECT r.doc_id, r.ord, f.kind, f.n FROM tf f JOIN trf r ON f.doc_id = r.doc_id AND f.ref = r.ref",
        "node": "SELECT doc_id, ord, 'node' AS kind, 1 AS n FROM tn UNION ALL SELECT doc_id, ord, kind, n FROM own",
        "lift": "SELECT doc_id, ord, kind, n FROM node UNION ALL SELECT a.doc_id, a.anc_ord, x.kind, x.n FROM node x JOIN anc a ON x.doc_id = a.doc_id AND x.ord = a.ord",
        "roll": f"SELECT doc_id, ord, CAST(sum(CASE WHEN kind = 'node' THEN n ELSE 0 END) AS BIGINT) AS n_nodes, {sums} FROM lift GROUP BY doc_id, ord",
        "tree": f"SELECT t.doc_id, t.ord, t.no, t.title, CASE WHEN u.above IS NULL THEN '' ELSE {d.get('u.above', d.size('u.above') + ' - 1')} END AS parent_no, CASE WHEN u.above IS NULL THEN 0 ELSE {d.size('u.above')} END AS depth, CASE WHEN u.above IS NULL THEN t.no ELSE concat({d.joined('u.above', ' > ')}, ' > ', t.no) END AS path, r.n_nodes, {', '.join(f'r.n_{k}' for k in KINDS)} FROM tn t LEFT JOIN tup u ON t.doc_id = u.doc_id AND t.ord = u.ord JOIN roll r ON t.doc_id = r.doc_id AND t.ord = r.ord",
    }


def _catalogue(d: Dialect) -> dict[str, str]:
    """The tree of the catalogue's sections, with standard codes, rules, inspections and captions as facts."""
    tests = {"std": d.search("line", Parser.STANDARD_RE), "rul": f"block_type = '正文' AND {d.first_of('line', Parser.RULE_PATTERNS)} <> ''", "ins": d.search("line", Parser.INSPECTION_HINT_RE), "tab": d.match("line", Parser.TABLE_CAPTION_RE)}
    said = " UNION ALL ".join(f"SELECT doc_id, sec_ord, '{k}' AS kind FROM s6 WHERE sec_ord > 0 AND {test}" for k, test in tests.items())
    facts = "SELECT h.doc_id, concat(h.sec_no, ' ', h.title) AS ref, s.kind, count(*) AS n FROM said s JOIN heads h ON s.doc_id = h.doc_id AND s.sec_ord = h.sec_ord GROUP BY h.doc_id, concat(h.sec_no, ' ', h.title), s.kind"
    return sections(d) | {"said": said} | tree(d, "SELECT doc_id, sec_ord AS ord, sec_no AS no, title, concat(sec_no, ' ', title) AS ref FROM heads", facts)


def x16_structure_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of the catalogue's sections, with sums over subtrees."""
    lines = sections(REGISTERED)
    steps = Steps(spark, _catalogue(REGISTERED), to_shared)
    steps.add("s6", to_shared(run_sql(spark, sf_dir, with_({k: v for k, v in lines.items() if k != "heads"}, "SELECT * FROM s6")).drop("once")))
    for name in ("heads", "anc", "own"):
        steps.keep(name)
    return steps.frame("tree")


TREES = {"x16_structure_tree": x16_structure_tree}


def tree_sql() -> dict[str, str]:
    return {"x16_structure_tree": with_(_catalogue(DUCK), "SELECT * FROM tree").replace("WITH", "WITH RECURSIVE", 1)}


def structure_tree(spark: SparkSession, frames: dict[str, DataFrame], keep: Keep) -> DataFrame:
    """The tree of parsed documents (the frames of document.parse): doc_id, ord, no, title, parent_no, depth, path, n_nodes and
    the number of parameters, rules, standards, tables and inspections in the subtree. Records without a section do not count."""
    steps = Steps(spark, {}, keep)
    for name in ("sec", *KINDS):
        steps.add(f"r_{name}", frames[name])
    facts = " UNION ALL ".join(f"SELECT doc_id, section_ref AS ref, '{k}' AS kind, count(*) AS n FROM r_{k} GROUP BY doc_id, section_ref" for k in KINDS)
    steps.steps |= tree(SPARK, "SELECT doc_id, ord, no, title, concat(no, ' ', title) AS ref FROM r_sec", facts)
    steps.keep("anc")
    return steps.frame("tree")
