"""Chains of section merges, contracted at once.

Merges go from the last section back. When a section's turn comes, all before it are still there, and of those after it only
the ones that never merge: so 'previous' always means the section just before, and 'next' the next one that stays. A run of
'previous' therefore ends at the section that opens it, and that one stays, or goes on to the next that stays, or, where none
does, to the last that stayed before. All of this are windows over the sections of a document; bodies are one ordered
aggregate, as the parts of a section always stand in the order of their sections.
"""

from __future__ import annotations

from stratafold.functions.dialect import Dialect


def contracted(d: Dialect, rows: str) -> dict[str, str]:
    """`zm` from rows(doc_id, sec_ord, sec_no, title, body, direction, keep_title): every section with its body, or with
    the section it ended up in. keep_title makes a merged section's title a line of its own; of equal lines the first stays.
    A document none of whose sections stays ends in its first one."""
    way = "coalesce(direction, '')"
    w = "PARTITION BY doc_id ORDER BY sec_ord"
    back, on = f"{w} ROWS UNBOUNDED PRECEDING", f"{w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    lines = d.rows("zr", d.split("coalesce(body, '')", "\n"), "line", "pos", "doc_id, sec_ord, root, pos, line")
    return {
        "zs": rows,
        "z1": f"SELECT *, {way} = '' AS stays, row_number() OVER ({w}) AS nth FROM zs",
        "z2": f"SELECT *, {d.last_seen(f'CASE WHEN nth = 1 OR {way} <> {d.lit("previous")} THEN sec_ord END', back)} AS head, max(CASE WHEN stays THEN sec_ord END) OVER ({back}) AS last_stay, min(CASE WHEN stays THEN sec_ord END) OVER ({on}) AS next_stay, min(sec_ord) OVER (PARTITION BY doc_id) AS first_ord FROM z1",
        "zr": "SELECT *, CASE WHEN stays THEN sec_ord WHEN last_stay = head THEN head ELSE coalesce(next_stay, last_stay, first_ord) END AS root FROM z2",
        "zl": f"SELECT doc_id, root, sec_ord, pos, line FROM ({lines}) l WHERE line <> '' UNION ALL SELECT doc_id, root, sec_ord, -1 AS pos, title AS line FROM zr WHERE root <> sec_ord AND keep_title AND coalesce(title, '') <> ''",
        "zf": f"SELECT doc_id, root, line, min({d.struct(s='sec_ord', p='pos')}) AS place FROM zl GROUP BY doc_id, root, line",
        "zb": f"SELECT doc_id, root, {d.join_in_order('line', 'place')} AS body FROM zf GROUP BY doc_id, root",
        "zm": f"SELECT {d.apart('b')}r.doc_id, r.sec_ord, r.sec_no, r.title, CASE WHEN r.root = r.sec_ord THEN coalesce(b.body, '') END AS body, CASE WHEN r.root <> r.sec_ord THEN r.root END AS merged_into FROM zr r LEFT JOIN zb b ON r.doc_id = b.doc_id AND r.sec_ord = b.root",
    }
