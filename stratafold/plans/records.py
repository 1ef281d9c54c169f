"""Queries over extracted records: joins of sections with tables, parameters and standards, metadata, dedupes, summaries,
model tables, trace entries and repairs."""

from __future__ import annotations

from stratafold.functions import lines as L
from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Local, Markdown, Parser, Refine, Rx
from stratafold.plans.corpora import doc_arrays, doc_lines, spec_lines
from stratafold.plans.parameters import made, text_candidates, value_like
from stratafold.plans.registry import query, with_
from stratafold.plans.review import HEADING_REASONS, SOFT_REASONS, reason_columns
from stratafold.plans.structure import blocks, sections
from stratafold.plans.text_layer import array_metrics, ocr_evaluated, profiled, tally

#: Labels of document types; process words; date shapes of the version date, in order.
TYPE_LABELS = {"standard": "标准/规范文档", "product_catalog": "产品样本/规格资料", "manual": "技术手册", "report": "报告文档", "unknown": "技术资料"}
TYPE_TAGS = {"standard": ("标准规范", "标准/规范文档"), "product_catalog": ("产品样本", "产品/规格资料"), "manual": ("技术手册", "说明文档"), "report": ("报告文档", "检验/证书"), "unknown": ("未知文档", "技术资料")}
PROCESS_WORDS = (("inspection", "检验"), ("packaging", "包装"), ("焊接", "焊接"), ("检验", "检验"), ("包装", "包装"), ("运输", "运输"))
VERSION_DATES = (
    Rx(r"\b\d{4}-\d{2}\b"),
    Rx(r"\b\d{4}/\d{2}\b"),
    Rx(r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}\b", True),
    Rx(r"\b(?:Januar|Februar|März|Maerz|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\s+\d{4}\b", True),
)


def tables(d: Dialect) -> dict[str, str]:
    """Tables of the catalogue: one per page, titled by the page's caption, in the section open at that line. Spark finds the
    caption, and the title of that section (head), by windows over the lines as they are dealt out: no rows are joined, and
    the lines have one reader less."""
    if d.name == "spark":
        order = "PARTITION BY doc_id ORDER BY page_index, line_no ROWS UNBOUNDED PRECEDING"
        head = d.struct(title="CASE WHEN leads THEN '概述' ELSE title END")
        caption = f"min(CASE WHEN {d.match('line', Parser.TABLE_CAPTION_RE)} THEN line_no END) OVER (PARTITION BY doc_id, page_index)"
        return sections(d) | {
            "cap": f"SELECT *, {d.last_seen(f'CASE WHEN opens OR leads THEN {head} END', order)}.title AS head, {caption} AS caption_no FROM s6",
            "tbl": "SELECT doc_id, page_index, line AS title, sec_ord, concat('第', page_index + 1, '页_表1') AS table_no, head FROM cap WHERE line_no = caption_no AND doc_id IS NOT NULL",
        }
    return sections(d) | {
        "cap": f"SELECT doc_id, page_index, min(line_no) AS line_no FROM s6 WHERE {d.match('line', Parser.TABLE_CAPTION_RE)} GROUP BY doc_id, page_index",
        "tbl": "SELECT s.doc_id, s.page_index, s.line AS title, s.sec_ord, concat('第', s.page_index + 1, '页_表1') AS table_no FROM s6 s JOIN cap c ON s.doc_id = c.doc_id AND s.page_index = c.page_index AND s.line_no = c.line_no",
    }


@query
def j01_tables_of_sections(d):
    """Every section with the number of its tables; sections without one stay."""
    return with_(tables(d) | {"n": "SELECT doc_id, sec_ord, count(*) AS n_tables FROM tbl GROUP BY doc_id, sec_ord"}, f"SELECT {d.apart('n')}h.doc_id, h.sec_ord, h.sec_no, coalesce(n_tables, 0) AS n_tables FROM heads h LEFT JOIN n ON h.doc_id = n.doc_id AND h.sec_ord = n.sec_ord")


@query
def j02_section_facts(d):
    """Sections with their parameters and standards, each side summed up before it is joined."""
    value = value_like(d, "tail")
    return with_(
        sections(d)
        | {
            "pl": d.pin("s6", tail=f"CASE WHEN {d.colon('line')} > 0 THEN {d.norm('substr(line, ' + d.colon('line') + ' + 1)')} ELSE '' END"),
            "pn": f"SELECT doc_id, sec_ord, count(*) AS n_params FROM pl WHERE {value} GROUP BY doc_id, sec_ord",
            "sn": f"SELECT doc_id, sec_ord, count(*) AS n_standards, min({d.extract('line', Parser.STANDARD_RE, 1)}) AS first_code FROM s6 WHERE {d.search('line', Parser.STANDARD_RE)} GROUP BY doc_id, sec_ord",
        },
        f"SELECT {d.apart('pn', 'sn')}h.doc_id, h.sec_ord, coalesce(n_params, 0) AS n_params, coalesce(n_standards, 0) AS n_standards, coalesce(first_code, '') AS first_code FROM heads h LEFT JOIN pn ON h.doc_id = pn.doc_id AND h.sec_ord = pn.sec_ord LEFT JOIN sn ON h.doc_id = sn.doc_id AND h.sec_ord = sn.sec_ord",
    )


@query
def j06_j07_backfill(d):
    """Blocks without a section get the document's first one."""
    return with_(sections(d) | {"first": "SELECT doc_id, min(sec_ord) AS first_ord FROM heads GROUP BY doc_id"}, f"SELECT s.doc_id, s.page_index, s.line_no, CASE WHEN s.sec_ord = 0 THEN first_ord ELSE s.sec_ord END AS sec_ord FROM s6 s JOIN first f ON s.doc_id = f.doc_id WHERE block_type <> '部分标题'")


@query
def j08_pruned_sections(d):
    """Synthetic sections without a body whose title is a table's title and which hold no table."""
    return with_(
        tables(d)
        | {"body": "SELECT DISTINCT doc_id, sec_ord FROM s6 WHERE block_type IN ('正文', '标准引用')", "titles": "SELECT DISTINCT doc_id, lower(title) AS title FROM tbl", "used": "SELECT DISTINCT doc_id, sec_ord FROM tbl"},
        f"""SELECT {d.apart('b', 'u', 't')}h.doc_id, h.sec_ord, h.sec_no FROM heads h LEFT JOIN body b ON h.doc_id = b.doc_id AND h.sec_ord = b.sec_ord LEFT JOIN used u ON h.doc_id = u.doc_id AND h.sec_ord = u.sec_ord
        LEFT JOIN titles t ON h.doc_id = t.doc_id AND lower(h.title) = t.title WHERE NOT (h.sec_no LIKE 'U%' AND b.sec_ord IS NULL AND t.title IS NOT NULL AND u.sec_ord IS NULL)""",
    )


@query
def j09_renamed_sections(d):
    """Children of renamed sections follow: synthetic sections take the number of their document and place."""
    return with_(
        sections(d) | {"ren": "SELECT doc_id, concat(sec_no, ' ', title) AS old_ref, concat('D', doc_id, '.', sec_ord) AS new_ref, sec_ord FROM heads WHERE sec_no LIKE 'U%'"},
        f"SELECT {d.apart('h', 'r')}s.doc_id, s.page_index, s.line_no, coalesce(r.new_ref, concat(h.sec_no, ' ', h.title)) AS section_ref FROM s6 s JOIN heads h ON s.doc_id = h.doc_id AND s.sec_ord = h.sec_ord LEFT JOIN ren r ON h.doc_id = r.doc_id AND h.sec_ord = r.sec_ord",
    )


@query
def j11_page_records(d):
    """Pages with the evaluation of their text as recognised text."""
    lines = f"SELECT {d.struct(d='doc_id', p='page_index')} AS doc_id, line_no, line FROM l"
    return with_(
        {"l": spec_lines(d), "p": "SELECT doc_id, page_index, count(*) AS n_lines FROM l GROUP BY doc_id, page_index", "k": lines, "ev": ocr_evaluated(d, "k")},
        f"SELECT {d.apart('e')}p.doc_id, p.page_index, p.n_lines, e.doc_id IS NOT NULL AS ocr_run, coalesce(e.grade, '') AS grade, coalesce(e.grade, '拒绝') <> '拒绝' AS injected, coalesce(e.content_chars, 0) AS content_chars FROM p LEFT JOIN ev e ON p.doc_id = e.doc_id.d AND p.page_index = e.doc_id.p",
    )


@query
def t06_t11_metadata(d):
    """Title, standard code and version date from the first twelve lines of the first two pages."""
    version = "CASE " + " ".join(f"WHEN {d.search('line', p)} THEN {d.extract('line', p)}" for p in VERSION_DATES) + " ELSE '' END"
    title_ok = f"length(line) >= 3 AND NOT {d.full('line', Parser.STANDARD_RE)} AND NOT {d.match('line', Parser.NUMBERED_HEADING_RE)} AND NOT {d.match('line', Parser.GENERIC_NOISE_HEADING_RE)} AND NOT {d.full('line', Rx(r'\w+\s+\d{4}'))}"
    return with_(
        {
            "l": spec_lines(d),
            "f": f"SELECT doc_id, {d.struct(p='page_index', l='line_no')} AS place, line FROM l WHERE page_index < 2 AND line_no <= 12",
            "g": d.pin("f", title_ok=f"({title_ok})", code=d.extract("line", Parser.STANDARD_RE, 1), version=version),
        },
        f"SELECT doc_id, {d.first_by('line', 'place', 'title_ok')} AS title, coalesce({d.first_by('code', 'place', d.lit('') + ' <> code')}, '') AS code, coalesce({d.first_by('version', 'place', d.lit('') + ' <> version')}, '') AS version FROM g GROUP BY doc_id",
    )


@query
def t05_limits_before_dedupe(d):
    """First 120 parameters of a document, then first of each name and value."""
    return with_(
        text_candidates(d)
        | made(d, "cand", "doc_id, page_index, line_no")
        | {"o": "SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_index, line_no) AS BIGINT) AS ord FROM params", "u": "SELECT *, row_number() OVER (PARTITION BY doc_id, name, clean_value ORDER BY ord) AS k FROM o WHERE ord <= 120"},
        "SELECT doc_id, name, clean_value, unit, ord FROM u WHERE k = 1",
    )


@query
def x18_x19_labels(d):
    label = "CASE doc_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_LABELS.items()) + " END"
    tag = "CASE doc_type " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in TYPE_TAGS.items()) + " END"
    return with_({"p": profiled(d, array_metrics(d, doc_arrays(d), hints=True))}, f"SELECT doc_id, {label} AS label, {tag} AS tag, CASE WHEN needs_ocr THEN '疑似扫描件' ELSE '' END AS scan_tag FROM p")


@query
def d10_standard_dedupe(d):
    """Standards by code and section, first place kept."""
    codes = d.rows("s6", d.extract_all("line", Parser.STANDARD_RE, 1), "code", "n", "doc_id, sec_ord, page_index, line_no, n, code")
    return with_(sections(d) | {"c": codes, "r": "SELECT *, row_number() OVER (PARTITION BY doc_id, code, sec_ord ORDER BY page_index, line_no, n) AS k FROM c WHERE code <> ''"}, "SELECT doc_id, code, sec_ord, page_index FROM r WHERE k = 1")


@query
def g02_local_cleanup(d):
    """What the cleanup does to blocks: hard table fragments go, weak titles become body text."""
    hard = " OR ".join(f"r_{c}" for c in HEADING_REASONS if c not in SOFT_REASONS)
    soft = " OR ".join(f"r_{c}" for c in SOFT_REASONS)
    return with_(
        blocks(d) | {"r": d.pin("blocks", **reason_columns(d, HEADING_REASONS, synthetic="true"))},
        f"SELECT doc_id, block_type, CASE WHEN block_type = '表格碎片' AND ({hard}) THEN 'deleted' WHEN block_type = '标题' AND ({soft}) THEN 'to_body' ELSE 'kept' END AS action, count(*) AS n FROM r GROUP BY 1, 2, 3",
    )


@query
def w06_merge_directions(d):
    """Suspicious sections with the way they merge: the first into the next, long ones into the next, others into the one
    before."""
    hard = " OR ".join(f"r_{c}" for c in HEADING_REASONS if c not in SOFT_REASONS)
    return with_(
        sections(d)
        | {
            "n": "SELECT doc_id, sec_ord, count(DISTINCT line) AS n_body FROM s6 WHERE block_type IN ('正文', '标准引用') GROUP BY doc_id, sec_ord",
            "t": f"SELECT {d.apart('n')}h.doc_id, h.sec_ord, h.title AS line, coalesce(n_body, 0) AS n_body, max(h.sec_ord) OVER (PARTITION BY h.doc_id) AS last_ord FROM heads h LEFT JOIN n ON h.doc_id = n.doc_id AND h.sec_ord = n.sec_ord",
            "r": d.pin("t", **reason_columns(d, HEADING_REASONS)),
        },
        f"SELECT doc_id, sec_ord, CASE WHEN sec_ord = 1 THEN 'next' WHEN n_body > 4 AND sec_ord < last_ord THEN 'next' ELSE 'previous' END AS direction FROM r WHERE {hard}",
    )


@query
def c06_heading_prefixes(d):
    """Lines without the date or number that recognition puts before some headings."""
    made_up = "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN concat('01.02.03 Shape ', substr('ABCDEF', p_partkey % 6 + 1, 1)) WHEN 1 THEN concat(100 + p_partkey % 900, ' Admissible length deviation') ELSE p_name END AS line FROM part"
    one, two = (d.extract("line", p, 1) for p in (Parser.DATE_PREFIX_HEADING_RE, Parser.NUMERIC_PREFIX_HEADING_RE))
    return f"SELECT p_partkey, CASE WHEN {one} <> '' THEN {one} WHEN {two} <> '' THEN {two} ELSE line END AS line FROM ({made_up}) m"


@query
def c13_md_body_lines(d):
    """Lines that are neither headings nor table rows of a Markdown text."""
    return f"SELECT doc_id, count(*) AS n_lines, {tally('length(line) <= 18')} AS n_short FROM ({doc_lines(d)}) l WHERE left(line, 1) NOT IN ('#', '|') GROUP BY doc_id"


@query
def f24_f25_rendered_titles(d):
    """Titles of tables that get a heading: not synthetic, not of low signal, not the section's, once in a section."""
    bad = f"{d.full('title', Markdown.SYNTHETIC_TABLE_TITLE_RE)} OR {d.full('title', Markdown.LOW_SIGNAL_TABLE_TITLE_RE)} OR {d.full('title', Markdown.COMMA_FRAGMENT_TABLE_TITLE_RE)}"
    rest = "SELECT doc_id, sec_ord, title FROM k WHERE k = 1 AND lower(title) <> lower(head)" if d.name == "spark" else "SELECT k.doc_id, k.sec_ord, k.title FROM k JOIN heads h ON k.doc_id = h.doc_id AND k.sec_ord = h.sec_ord WHERE k = 1 AND lower(k.title) <> lower(h.title)"
    return with_(tables(d) | {"k": f"SELECT *, row_number() OVER (PARTITION BY doc_id, sec_ord, lower(title) ORDER BY page_index) AS k FROM tbl WHERE NOT ({bad})"}, rest)


@query
def f32_preserved_tokens(d):
    return with_({"l": spec_lines(d), "w": d.rows("l", d.split("line", " "), "word", "n", "doc_id, word")}, f"SELECT doc_id, word, count(*) AS n FROM w WHERE length(word) <= 8 AND {d.full('word', Local.TECH_TOKEN_RE)} GROUP BY doc_id, word")


@query
def refine_line_noise(d):
    return with_({"l": doc_lines(d)}, f"SELECT doc_id, {tally(d.full('line', Refine.PURE_NUMBER_RE))} AS numbers, {tally(d.search('line', Refine.COPYRIGHT_RE))} AS notices, {tally(L.uneven_brackets('line'))} AS brackets FROM l GROUP BY doc_id")
