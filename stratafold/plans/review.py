"""Queries that judge and render: suspicion reasons, deductions, scores, redlines, problems, actions, Markdown, tags."""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.lines import any_of
from stratafold.functions.patterns import Refine, Rx, Tags
from stratafold.plans.corpora import doc_lines, spec_cells, spec_lines
from stratafold.plans.registry import query, with_
from stratafold.plans.structure import sections

#: Reason codes of suspicious headings and blocks with the test that raises them; those that settle the case.
HEADING_REASONS = ("generic_page_word", "month_year_only", "number_only", "ics_code", "dimension_code", "copyright_notice", "metadata_marker", "trailing_hyphen", "leading_conjunction", "split_token_line", "unit_only", "short_token", "letter_range", "value_fragment", "sentence_verb_fragment", "sentence_fragment", "lowercase_fragment", "too_short_for_heading")
BLOCK_REASONS = ("generic_page_word", "month_year_only", "number_fragment", "ics_code", "copyright_notice", "metadata_marker", "trailing_hyphen", "leading_conjunction", "unit_only", "short_token", "letter_range", "value_fragment", "sentence_verb_fragment", "matrix_token", "dimension_code", "number_matrix", "very_short_fragment")
SOFT_REASONS = ("sentence_fragment", "lowercase_fragment", "too_short_for_heading")


def reason_tests(d: Dialect, x: str, body: str = "''", synthetic: str = "true") -> dict[str, str]:
    """Every reason code with its test of a text x; `body` and `synthetic` belong to headings only."""
    few = d.words(x)
    return {
        "generic_page_word": d.full(x, Refine.PAGE_NOISE_RE),
        "month_year_only": d.full(x, Refine.MONTH_YEAR_RE),
        "number_only": d.full(x, Refine.PURE_NUMBER_RE),
        "number_fragment": d.full(x, Refine.PURE_NUMBER_RE),
        "ics_code": d.full(x, Refine.ICS_RE),
        "dimension_code": d.full(x, Refine.DIMENSION_CODE_RE),
        "copyright_notice": d.search(x, Refine.COPYRIGHT_RE),
        "metadata_marker": d.match(x, Refine.NOISE_MARKER_RE),
        "trailing_hyphen": d.ends(x, "-", "/"),
        "leading_conjunction": d.match(x, Refine.LEADING_CONJUNCTION_RE),
        "split_token_line": d.full(x, Refine.SPLIT_TOKEN_RE),
        "unit_only": d.full(x, Refine.UNIT_FRAGMENT_RE),
        "short_token": d.full(x, Refine.SHORT_TOKEN_RE),
        "letter_range": d.full(x, Refine.LETTER_RANGE_RE),
        "value_fragment": d.full(x, Refine.VALUE_FRAGMENT_RE),
        "sentence_verb_fragment": f"({d.search(x, Refine.SENTENCE_VERB_RE)} AND {few} >= 3)",
        "matrix_token": d.full(x, Refine.MATRIX_FRAGMENT_RE),
        "number_matrix": d.full(x, Refine.REPEATED_NUMBER_FRAGMENT_RE),
        "very_short_fragment": f"(length({x}) <= 3)",
        "sentence_fragment": f"({d.ends(x, '.')} AND {few} <= 6)",
        "lowercase_fragment": f"({d.match(x, Refine.TRAILING_FRAGMENT_RE)} AND {few} <= 5 AND length({body}) < 160)",
        "too_short_for_heading": f"({few} <= 2 AND length({x}) <= 6 AND length({body}) < 80 AND NOT {synthetic})",
    }


def reason_columns(d: Dialect, codes, **how) -> dict[str, str]:
    tests = reason_tests(d, "line", **how)
    return {f"r_{c}": f"({tests[c]})" for c in codes}


def score_of(codes) -> str:
    return "CAST(" + " + ".join(f"CASE WHEN r_{c} THEN 1 ELSE 0 END" for c in codes) + " AS BIGINT)"


@query
def g04_suspicious_blocks(d):
    return with_(
        {"spec": spec_lines(d), "r": d.pin("spec", **reason_columns(d, BLOCK_REASONS))},
        f"SELECT * FROM (SELECT doc_id, page_index, line_no, line, {score_of(BLOCK_REASONS)} AS score FROM r) s WHERE score > 0",
    )


@query
def g05_hard_headings(d):
    hard = [c for c in HEADING_REASONS if c not in SOFT_REASONS]
    return with_(
        {"spec": spec_lines(d), "r": d.pin("spec", **reason_columns(d, HEADING_REASONS))},
        f"SELECT doc_id, page_index, line_no, {score_of(HEADING_REASONS)} AS score, {any_of([f'r_{c}' for c in hard])} AS hard FROM r WHERE {any_of([f'r_{c}' for c in HEADING_REASONS])}",
    )


@query
def t01_top_suspicious(d):
    """The five most suspicious lines of a document: most reasons first, then place."""
    return with_(
        {"spec": spec_lines(d), "r": d.pin("spec", **reason_columns(d, HEADING_REASONS)), "s": f"SELECT doc_id, page_index, line_no, line, {score_of(HEADING_REASONS)} AS score FROM r", "k": "SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, page_index, line_no) AS BIGINT) AS place FROM s WHERE score > 0"},
        "SELECT doc_id, place, page_index, line_no, score FROM k WHERE place <= 5",
    )


@query
def m01_markdown(d):
    """Markdown of sections: a heading two levels below its own, at most six, then its body lines in order."""
    body = f"SELECT doc_id, sec_ord, line, min({d.struct(p='page_index', l='line_no')}) AS place FROM s6 WHERE sec_ord > 0 AND (block_type IN ('正文', '标准引用') OR (is_head AND NOT opens)) GROUP BY doc_id, sec_ord, line"
    return with_(
        sections(d)
        | {
            "lines": f"SELECT doc_id, {d.struct(s='sec_ord', b='0', p=d.struct(p='page_index', l='0'))} AS place, concat(repeat('#', CAST(least(greatest(level, 1) + 2, 6) AS INT)), ' ', CASE WHEN sec_no LIKE 'U%' THEN title ELSE concat(sec_no, ' ', title) END) AS text FROM heads"
            + f" UNION ALL SELECT doc_id, {d.struct(s='sec_ord', b='1', p='place')}, line FROM ({body}) b"
        },
        f"SELECT doc_id, count(*) AS n_lines, {d.sha256(d.join_in_order('text', 'place'))} AS md_sha FROM lines GROUP BY doc_id",
    )


@query
def m01_table_rows(d):
    """Table rows in Markdown, padded to the header's three columns."""
    return f"SELECT doc_id, page_index, row_idx, concat('| ', label, ' | ', value, ' | ', unit, ' |') AS md FROM ({spec_cells(d)}) k"


@query
def m17_parameter_tags(d):
    tag = d.first_of("line", Tags.PARAMETER_TAG_PATTERNS)
    return with_({"t": f"SELECT doc_id, {tag} AS tag FROM ({spec_lines(d)}) l"}, "SELECT DISTINCT doc_id, tag FROM t WHERE tag <> ''")


@query
def f31_symbol_heavy(d):
    bare = d.replace_all("line", Rx("[^A-Za-z0-9À-ɏ一-鿿]"), "")
    return f"SELECT doc_id, line_no FROM ({doc_lines(d)}) l WHERE length({bare}) < 0.45 * length(line)"
