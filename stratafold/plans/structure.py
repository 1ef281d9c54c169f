"""Queries that turn lines into structure: line classes, split headings, sections, page-to-section pointers, products."""

from __future__ import annotations

from stratafold.functions import lines as L
from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Parser, Rx
from stratafold.plans.corpora import spec_cells, spec_lines
from stratafold.plans.registry import query, with_

#: Prefixes of standard families, longest first; labels of document types and inspection methods.
FAMILIES = ("DIN EN ISO", "DIN ISO", "DIN EN", "DIN", "EN", "ISO", "SN", "SEW", "DVS", "AD", "TRbF", "GB", "CB", "CH", "JB", "YB", "HG", "QC", "LY", "BB", "MT", "SH", "SY", "DL", "JJG", "JJF")
#: Pages whose lines one task sorts: about 50,000 lines of 2 kB with all their marks.
PAGES_OF_TASK = 2500
TITLE = "trim(regexp_replace({x}, '[:：]+$', ''))"


#: What the line rules ask of a page and a document, and what it is where only lines are given. in_*: the line, its heading
#: text and its title equal a cell of the page's tables, as they stand (a) or merged with the line below (b).
CONTEXT = {"language": "'en'", "ocr_used": "false", "in_pieces": "false", "in_next": "false", **{f"in_{k}_{v}": "false" for k in ("line", "cand", "title") for v in "ab"}}


def given(lines: str | None) -> dict[str, str]:
    """The context by column name, or as constants."""
    return CONTEXT if lines is None else {k: k for k in CONTEXT}


def tagged(d: Dialect, x: str, to: str, rows: str, in_cell: str = "false", asked: str = "true") -> str:
    """Add the shared tests of column x under the prefix `to`, in two tiers; `asked` tells for which rows they are looked at."""
    one = d.pin(rows, **{f"{to}_meta": d.only(asked, L.metadata_line(d, x)), f"{to}_dense": d.only(asked, L.spec_dense(d, x))})
    two = d.pin(f"({one}) o", **{f"{to}_fragment": d.only(asked, L.heading_fragment(d, x, f"{to}_meta", f"{to}_dense"))})
    return d.pin(f"({two}) o", **{f"{to}_table": d.only(f"{asked} AND NOT {to}_fragment", L.table_fragment(d, x, in_cell))})


def merged_lines(d: Dialect, lines: str | None = None) -> str:
    """Lines after a number that stands alone took the title below it. In a run of numbers that could all merge, every
    second one does, as a line that was taken cannot take the next."""
    order = "PARTITION BY doc_id, page_index ORDER BY line_no"
    c = given(lines)
    alone = {"alone": d.full("line", Parser.SPLIT_HEADING_NUMBER_RE)} if d.name == "spark" else {}
    kept = "" if lines is None else ", language, ocr_used, in_pieces" + "".join(f", CASE WHEN merges THEN in_{k}_b ELSE in_{k}_a END AS in_{k}" for k in ("line", "cand", "title"))
    return with_(
        {
            "ctx": f"SELECT *, lag(line) OVER ({order}) AS prev, lead(line) OVER ({order}) AS next1, lead(line, 2) OVER ({order}) AS next2 FROM spec",
            "nxt": d.pin("ctx", title=f"coalesce({TITLE.format(x='next1')}, '')", **alone),
            "tag": tagged(d, "title", "t", "nxt", c["in_next"], "alone AND length(title) BETWEEN 1 AND 100"),
            "can": f"""SELECT *, {d.full('line', Parser.SPLIT_HEADING_NUMBER_RE)} AND title <> '' AND length(title) <= 100 AND NOT t_fragment AND NOT t_table AND NOT {L.standard_line(d, 'title')}
              AND NOT {d.full('title', Parser.PAGE_HEADER_NOISE_RE)} AND NOT {d.full('title', Parser.DOC_VERSION_RE)} AND NOT {d.full('title', Parser.FOOTNOTE_CONTINUE_RE)}
              AND {d.words('title')} <= {L.MAX_HEADING_WORDS + 2} AS m FROM tag""",
            "runs": f"SELECT *, sum(CASE WHEN m THEN 0 ELSE 1 END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS run FROM can",
            "place": "SELECT *, CASE WHEN m THEN row_number() OVER (PARTITION BY doc_id, page_index, run, m ORDER BY line_no) ELSE 0 END AS k FROM runs",
            "take": f"SELECT *, m AND k % 2 = 1 AS merges, coalesce(lag(CASE WHEN m AND k % 2 = 1 THEN 1 ELSE 0 END) OVER ({order}), 0) = 1 AS taken FROM place",
        },
        f"SELECT doc_id, page_index, line_no, {L.without_prefix(d, "CASE WHEN merges THEN concat(line, ' ', title) ELSE line END")} AS line, coalesce(prev, '') AS prev, coalesce(CASE WHEN merges THEN next2 ELSE next1 END, '') AS next_line, merges{kept} FROM take WHERE NOT taken",
    )


def blocks(d: Dialect, lines: str | None = None) -> dict[str, str]:
    """Classified lines, as named steps: skip rules, part heading, heading, standard, revision, caption, fragment, body.
    `lines` has doc_id, page_index, line_no, line and the columns of CONTEXT."""
    pages = ("part" if lines is None else "cpg", PAGES_OF_TASK)
    c = {k: v for k, v in CONTEXT.items()} | {f"in_{k}": "false" for k in ("line", "cand", "title")} if lines is None else {k: k for k in ("language", "ocr_used", "in_pieces", "in_line", "in_cand", "in_title")}
    pieces = f"(({c['ocr_used']} AND {L.ocr_fragment_heading(d, 'candidate')}) OR ({c['in_pieces']} AND {L.in_pieces_heading(d, 'candidate')}))" if lines else "false"
    bad_piece = f"(({c['in_pieces']} AND {d.full('number', Rx('[0-9]+'))} AND length(number) >= 2 AND left(number, 1) <> '0' AND length(replace(num_title, ' ', '')) <= 4) OR ({c['ocr_used']} AND {L.ocr_fragment_heading(d, 'num_title')}))" if lines else "false"
    return {
        "spec": f"SELECT {d.dealt(*pages, 'doc_id', 'page_index')}* FROM ({lines or spec_lines(d)}) x" if d.name == "spark" else lines or spec_lines(d),
        "merged": merged_lines(d, lines),
        "cand": d.pin("merged", candidate=TITLE.format(x="line"), number=d.extract("line", Parser.NUMBERED_HEADING_RE, 1), num_title=TITLE.format(x=d.extract("line", Parser.NUMBERED_HEADING_RE, 2))),
        # a longer candidate is barred whatever it is, and without a number nobody asks for the title after it
        "c1": tagged(d, "candidate", "c", "cand", c["in_cand"], "length(candidate) BETWEEN 1 AND 100"),
        "c2": tagged(d, "num_title", "n", "c1", c["in_title"], "number <> '' AND length(candidate) <= 100 AND NOT c_fragment AND NOT c_table"),
        "c3": d.pin("c2", skip=L.skipped(d, "line"), barred=f"({L.heading_barred(d, 'candidate')} OR c_table OR c_fragment OR c_meta OR c_dense)"),
        "c3p": d.pin("c3", pieces=d.only("NOT barred", pieces), bad_piece=d.only("NOT barred AND number <> ''", bad_piece)) if lines else "SELECT *, false AS pieces, false AS bad_piece FROM c3",
        "c4": d.pin("c3p", bad_number=d.only("NOT barred AND number <> ''", f"({L.number_noise(d, 'number', 'num_title')} OR {d.words('num_title')} > {L.MAX_HEADING_WORDS} OR n_table OR n_fragment OR n_meta OR n_dense OR bad_piece)")),
        "c5": f"""SELECT *, CASE WHEN barred OR pieces THEN false WHEN number <> '' THEN num_title <> '' AND NOT bad_number
            WHEN {d.full('candidate', Rx(r'(?:Form|Shape)\s+[A-Z0-9]+', True))} THEN true
            WHEN {d.match('candidate', Parser.TABLE_CAPTION_RE)} OR {d.match('candidate', Parser.FIGURE_CAPTION_RE)} THEN false
            WHEN {d.search('candidate', Parser.GENERIC_SHORT_HEADING_RE)} THEN true
            WHEN {d.ends('line', ':', '：')} AND {d.words('candidate')} <= {L.MAX_HEADING_WORDS} THEN true
            WHEN {d.words('candidate')} BETWEEN 1 AND 6 AND length(next_line) > length(candidate) + 12 AND NOT {d.ends('prev', '.', ';', ':', '：')} THEN true
            ELSE {c['language']} IN ('en', 'de') AND candidate = upper(candidate) AND candidate <> lower(candidate) AND {d.words('candidate')} <= 8 END AS heading FROM c4""",
        "blocks": f"""SELECT doc_id, page_index, line_no, line, number, num_title, CASE WHEN {L.part_heading(d, 'line')} THEN '部分标题' WHEN heading THEN '标题'
            WHEN {L.standard_line(d, 'line')} THEN '标准引用' WHEN {d.search('line', Parser.REVISION_RE)} THEN '修订记录' WHEN {L.caption(d, 'line')} THEN '图示说明'
            WHEN {L.table_fragment(d, 'line', c['in_line'])} THEN '表格碎片' ELSE '正文' END AS block_type FROM c5 WHERE NOT skip""",
    }


def sections(d: Dialect, lines: str | None = None) -> dict[str, str]:
    """Blocks with their section. A heading opens a section unless the open one takes it in: a reference section takes in
    all unnumbered headings until the next numbered one, a revision section those that read like sentences."""
    order = "PARTITION BY doc_id ORDER BY page_index, line_no"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    soft = f"({d.ends('title', ',')} OR {d.search('title', Parser.SENTENCE_VERB_RE)} OR {d.words('title')} >= 3)"
    dealt = d.dealt("part" if lines is None else "cpg", PAGES_OF_TASK, "doc_id")
    return blocks(d, lines) | {
        "s1": f"SELECT {dealt}*, block_type = '标题' AS is_head, number <> '' AND block_type = '标题' AS is_num, CASE WHEN number <> '' THEN num_title ELSE {TITLE.format(x='line')} END AS title FROM blocks",
        "s2": f"SELECT *, is_head AND {d.full('title', Parser.REFERENCE_SECTION_TITLE_RE)} AS is_ref, is_head AND {d.full('title', Parser.REVISION_SECTION_TITLE_RE)} AS is_rev, {d.only('is_head', soft)} AS soft, sum(CASE WHEN is_num THEN 1 ELSE 0 END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS num_no FROM s1",
        "s3": f"SELECT *, coalesce(max(CASE WHEN is_ref THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, num_no ORDER BY page_index, line_no {before}), 0) = 1 AND NOT is_num AS in_ref, coalesce({d.last_seen('CASE WHEN is_head AND (is_num OR NOT soft) THEN CASE WHEN is_rev THEN 1 ELSE 0 END END', f'{order} {before}')}, 0) = 1 AS in_rev FROM s2",
        "s4": f"SELECT *, is_head AND (is_num OR NOT (in_ref OR (in_rev AND soft))) AS opens, sum(CASE WHEN is_head THEN 1 ELSE 0 END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS heads, block_type IN ('正文', '标准引用', '图示说明', '修订记录') AS content, coalesce({d.last_seen("CASE WHEN block_type = '部分标题' THEN line END", order + ' ROWS UNBOUNDED PRECEDING')}, '') AS part FROM s3",
        "s5": f"SELECT *, content AND heads = 0 AND row_number() OVER (PARTITION BY doc_id, content, heads ORDER BY page_index, line_no) = 1 AS leads FROM s4",
        "s6": f"SELECT *, {d.once}CAST(sum(CASE WHEN opens OR leads THEN 1 ELSE 0 END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sec_ord, CAST(sum(CASE WHEN (opens AND NOT is_num) OR leads THEN 1 ELSE 0 END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS syn_no FROM s5",
        "heads": "SELECT doc_id, sec_ord, CASE WHEN leads THEN concat('U', syn_no) WHEN is_num THEN number ELSE concat('U', syn_no) END AS sec_no, CASE WHEN leads THEN '概述' ELSE title END AS title, CASE WHEN is_num THEN length(number) - length(replace(number, '.', '')) + 1 ELSE 1 END AS level, part, page_index FROM s6 WHERE opens OR leads",
    }


@query
def f03_line_classes(d):
    return with_(blocks(d), "SELECT doc_id, page_index, line_no, block_type FROM blocks")


@query
def f03_class_counts(d):
    return with_(blocks(d), "SELECT doc_id, block_type, count(*) AS n_blocks FROM blocks GROUP BY doc_id, block_type")


@query
def f04_f13_line_flags(d):
    parts = {"part": L.part_heading, "toc": L.toc_line, "metadata": L.metadata_line, "dense": L.spec_dense, "ocr_fragment": L.ocr_fragment_heading, "standard": L.standard_line, "caption": L.caption, "table_fragment": L.table_fragment, "skipped": L.skipped}
    return f"SELECT doc_id, page_index, line_no, {', '.join(f'{f(d, "line")} AS is_{k}' for k, f in parts.items())} FROM ({spec_lines(d)}) l"


@query
def f07_heading_fragments(d):
    return with_({"spec": spec_lines(d), "t": tagged(d, "line", "x", "spec")}, "SELECT doc_id, page_index, line_no, line FROM t WHERE x_fragment")


@query
def f14_cells_of_page(d):
    """Lines that equal a cell of a table on their page."""
    return with_(
        {"l": spec_lines(d), "k": spec_cells(d), "cells": "SELECT DISTINCT doc_id, page_index, cell FROM (SELECT doc_id, page_index, concat(label, ': ', value, CASE WHEN unit = '' THEN '' ELSE concat(' ', unit) END) AS cell FROM k UNION ALL SELECT doc_id, page_index, value FROM k) c WHERE cell <> ''"},
        f"SELECT {d.apart('c')}l.doc_id, l.page_index, line_no, line FROM l JOIN cells c ON l.doc_id = c.doc_id AND l.page_index = c.page_index AND l.line = c.cell WHERE length(line) <= 120",
    )


@query
def w01_w02_split_headings(d):
    return with_({"spec": spec_lines(d), "merged": merged_lines(d)}, "SELECT doc_id, page_index, line_no, line FROM merged WHERE merges")


@query
def w03_sections(d):
    return with_(
        sections(d),
        "SELECT doc_id, sec_ord, sec_no, title, CAST(level AS BIGINT) AS level, CASE WHEN level > 1 THEN regexp_replace(sec_no, '[.][0-9]+$', '') ELSE '' END AS parent_no, part, page_index FROM heads",
    )


@query
def w03_section_bodies(d):
    """Body lines of sections: each line once, in the order of its first place."""
    return with_(
        sections(d)
        | {
            "body": f"SELECT doc_id, sec_ord, line, min({d.struct(p='page_index', l='line_no')}) AS place FROM s6 WHERE sec_ord > 0 AND (block_type IN ('正文', '标准引用') OR (is_head AND NOT opens)) GROUP BY doc_id, sec_ord, line"
        },
        f"SELECT doc_id, sec_ord, count(*) AS n_lines, {d.sha256(d.join_in_order('line', 'place'))} AS body_sha FROM body GROUP BY doc_id, sec_ord",
    )


@query
def d03_section_cleanup(d):
    """Sections by number and title, first one kept."""
    return with_(sections(d) | {"r": "SELECT *, row_number() OVER (PARTITION BY doc_id, sec_no, title ORDER BY sec_ord) AS k FROM heads"}, "SELECT doc_id, sec_no, title, sec_ord FROM r WHERE k = 1")


@query
def x16_nodes(d):
    return with_(
        sections(d) | {"r": "SELECT *, row_number() OVER (PARTITION BY doc_id, sec_no, title ORDER BY sec_ord) AS k FROM heads"},
        "SELECT doc_id, concat('section:', sec_no, ' ', title) AS node_id, concat('section:', sec_no) AS node_id_by_number, CAST(level AS BIGINT) AS level, CASE WHEN level > 1 THEN concat('section:', regexp_replace(sec_no, '[.][0-9]+$', '')) ELSE '' END AS parent_id FROM r WHERE k = 1",
    )


@query
def a09_section_pages(d):
    return with_(sections(d), "SELECT doc_id, sec_ord, CAST(count(DISTINCT page_index) AS BIGINT) AS n_pages, min(page_index) AS first_page, max(page_index) AS last_page FROM s6 WHERE sec_ord > 0 GROUP BY doc_id, sec_ord")


@query
def j05_first_section_of_page(d):
    """The first section whose title occurs in the page's text, else the first section of the document."""
    return with_(
        sections(d)
        | {
            "first": "SELECT doc_id, sec_ord, sec_no, title FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, title ORDER BY sec_ord) AS k FROM heads) h WHERE k = 1",
            "page": f"SELECT doc_id, page_index, {d.join_in_order('line', 'line_no')} AS t FROM spec GROUP BY doc_id, page_index",
            "hit": f"SELECT {d.apart('f')}p.doc_id, p.page_index, min(CASE WHEN contains(p.t, f.title) THEN f.sec_ord END) AS sec_ord, min(f.sec_ord) AS fallback FROM page p JOIN first f ON p.doc_id = f.doc_id GROUP BY p.doc_id, p.page_index",
        },
        "SELECT doc_id, page_index, coalesce(sec_ord, fallback) AS sec_ord FROM hit",
    )


@query
def x03_standards(d):
    """Standard codes of all lines, first place of each code in a document, with family."""
    family = "CASE " + " ".join(f"WHEN code LIKE '{p}%' THEN '{p}'" for p in FAMILIES) + " ELSE '其他' END"
    codes = d.rows("spec", d.extract_all("line", Parser.STANDARD_RE, 1), "code", "n", "doc_id, page_index, line_no, n, code")
    return with_(
        {"spec": spec_lines(d), "c": codes, "r": "SELECT *, row_number() OVER (PARTITION BY doc_id, code ORDER BY page_index, line_no, n) AS k FROM c"},
        f"SELECT doc_id, code, {family} AS family, page_index, line_no FROM r WHERE k = 1",
    )


@query
def m19_standard_tags(d):
    family = "CASE " + " ".join(f"WHEN code LIKE '{p}%' THEN '{p}'" for p in FAMILIES) + " ELSE '其他' END"
    codes = d.rows("spec", d.extract_all("line", Parser.STANDARD_RE, 1), "code", "n", "doc_id, code")
    return with_({"spec": spec_lines(d), "c": codes}, f"SELECT doc_id, {family} AS tag, count(*) AS n_refs FROM c GROUP BY 1, 2")


@query
def x15_products(d):
    """Lines of the catalogue with a product hint or a model token, first place of each display name."""
    model = d.extract("line", Parser.MODEL_RE)
    return with_(
        {
            "spec": spec_lines(d),
            "p": f"SELECT *, {model} AS model FROM spec WHERE {d.search('line', Parser.PRODUCT_HINT_RE)} OR {d.search('line', Parser.MODEL_RE)}",
            "r": "SELECT *, CASE WHEN model <> '' THEN model ELSE line END AS display FROM p",
            "k": "SELECT *, row_number() OVER (PARTITION BY doc_id, display ORDER BY page_index, line_no) AS k FROM r",
        },
        "SELECT doc_id, display, model, page_index, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_index, line_no) AS BIGINT) AS product_no FROM k WHERE k = 1",
    )


@query
def x14b_inspection_methods(d):
    return f"SELECT doc_id, page_index, line_no, {L.inspection_method(d, 'line')} AS method FROM ({spec_lines(d)}) l WHERE {d.search('line', Parser.INSPECTION_HINT_RE)}"


@query
def t12_scope(d):
    """The first line with an application hint, clipped."""
    return with_(
        {"spec": spec_lines(d), "r": f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_index, line_no) AS k FROM spec WHERE {d.search('line', Parser.APPLICATION_HINT_RE)}"},
        "SELECT doc_id, left(line, 240) AS scope, page_index FROM r WHERE k = 1",
    )
