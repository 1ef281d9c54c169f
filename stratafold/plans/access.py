"""Records as readers see them: plain records, normalised entries, filled and deduplicated records, structure nodes, the
trace map, and what the pipeline keeps of a document's state."""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Rx
from stratafold.plans.checks import failure_reasons, mismatch_parts, reviewed, scored
from stratafold.plans.checks import facts as review_facts
from stratafold.plans.parameters import unit_of
from stratafold.plans.records import TYPE_LABELS
from stratafold.plans.registry import query, with_
from stratafold.plans.state import relations, whole
from stratafold.plans.summaries import entries, first_wins, tag_rows
from stratafold.plans.text_layer import tally

#: Most sections and tables and least confidence of a document that is processed; its kind where it is not
#: known; texts of the quarantine; reason where nothing else names one.
MOST_SECTIONS, MOST_TABLES, LEAST_CONFIDENCE_PCT, UNKNOWN = 500, 50, 50, "unknown"
QUARANTINE_TAG, SCAN_TAG, QUARANTINE_REASON = "来源隔离", "疑似扫描件", "文件名与正文标准号不一致，已隔离常规摘要流程"
WHOLE_DOCUMENT = "文档"

#: Names of parameters by pattern; the reason of a mismatch between a file name and its text.
NORMAL_NAMES = (
    (Rx(r"\b(weight|gewicht)\b", True), "重量"),
    (Rx(r"\b(length|länge|laenge)\b", True), "长度"),
    (Rx(r"\b(width|breite)\b", True), "宽度"),
    (Rx(r"\b(height|höhe|hoehe)\b", True), "高度"),
    (Rx(r"\b(pressure|druck)\b", True), "压力"),
    (Rx(r"\b(temperature|temperatur)\b", True), "温度"),
    (Rx(r"\b(tolerance|abweichung)\b", True), "公差"),
    (Rx(r"\b(roughness|ra|rz)\b", True), "粗糙度"),
    (Rx(r"\b(radius|halbmesser)\b", True), "半径"),
    (Rx(r"\b(thickness|wanddicke|wall thickness)\b", True), "厚度"),
)
MISMATCH = ("文件名预期标准号为 ", "，但正文/标题/引用标准更明显地指向 ", "，疑似源文件串档或文本层错配。")

#: Fields of the records, by the columns that hold them.
RECORDS = {
    "metadata": ("doc", {"文件名称": "file_name", "文件类型": "'pdf'", "文档标题": "title", "文档类型": "doc_type", "标准编号": "std_code", "版本日期": "version", "适用范围": "scope"}),
    "section": ("sec", {"章节编号": "no", "章节标题": "title", "章节层级": "level", "父章节编号": "parent_no", "章节清洗文本": "body", "所属部分": "part"}),
    "table": ("tab", {"表格编号": "table_no", "表格标题": "title", "所属章节": "section_ref", "表头列数": "n_cols", "数据行数": "n_rows"}),
    "parameter": ("par", {"参数名称": "name", "参数值清洗值": "value", "参数单位": "unit", "参数范围下限": "lower", "参数范围上限": "upper", "比较符号": "comparator", "适用条件": "cond", "所属章节": "section_ref", "来源表格": "table_no", "来源子项": "source_item", "参数ID": "param_id"}),
    "rule": ("rul", {"规则类型": "rule_type", "规则内容": "content", "适用条件": "cond", "所属章节": "section_ref", "规则ID": "rule_id"}),
    "inspection": ("ins", {"检验对象": "object", "检验方法": "method", "检验要求": "requirement", "证书类型": "certificate", "所属章节": "section_ref"}),
    "standard": ("std", {"标准编号": "code", "标准名称": "title", "标准类型": "kind", "所属章节": "section_ref", "标准族": "family"}),
    "block": ("blk", {"块类型": "kind", "标题": "title", "内容": "content", "所属部分": "part", "所属章节": "section_ref", "来源页码": "page_no"}),
    "profile": ("doc", {"文档类型": "doc_type", "是否需要OCR": "needs_ocr", "文本行数": "line_count", "每页平均字符数": "chars_per_page", "置信度": "confidence_pct / 100.0"}),
}


def _record_query(name: str, kind: str, as_json: bool) -> None:
    table, fields = RECORDS[kind]
    key = "doc_id" if table == "doc" else "doc_id, ord"

    def build(d, given=None):
        shown = f"{d.record(**fields)} AS record" if as_json else ", ".join(f"{c} AS c{i}" for i, c in enumerate(fields.values()))
        return with_(relations(d, given, table), f"SELECT {key}, {shown} FROM {table}")

    build.__name__ = name
    build.__doc__ = f"The {kind} record " + ("as one JSON object." if as_json else "as columns in their fixed order.")
    query(build)


for _name, _kind, _json in (
    ("r01_metadata_record", "metadata", True), ("r05_section_record", "section", True), ("r07_table_record", "table", True), ("r08_table_values", "table", False), ("r09_parameter_record", "parameter", True), ("r10_rule_record", "rule", True),
    ("r11_inspection_record", "inspection", True), ("r12_standard_record", "standard", True), ("r13_block_record", "block", True), ("r14_section_values", "section", False), ("r15_block_values", "block", False), ("r16_standard_values", "standard", False),
    ("r17_parameter_values", "parameter", False), ("r18_rule_values", "rule", False), ("r19_inspection_values", "inspection", False), ("r20_metadata_values", "metadata", False),
):
    _record_query(_name, _kind, _json)


@query
def r02_r04_metadata_fields(d, given=None):
    return with_(relations(d, given, "doc"), "SELECT doc_id, title, file_name, doc_type FROM doc")


@query
def r06_section_refs(d, given=None):
    return with_(entries(d, given, "sec"), "SELECT doc_id, ord, ref FROM e_sec")


@query
def r21_profile_record(d, given=None):
    """The profile as columns; confidence is in hundredths."""
    return with_(relations(d, given, "doc"), "SELECT doc_id, doc_type, needs_ocr, line_count, chars_per_page, confidence_pct FROM doc")


@query
def r22_section_entries(d, given=None):
    return with_(entries(d, given, "sec"), "SELECT doc_id, ord, no, title, heading, level, parent_no, body, part FROM e_sec")


@query
def r23_parameter_entries(d, given=None):
    return with_(entries(d, given, "par"), "SELECT doc_id, ord, param_id, name, value, lower, upper, comparator, unit, cond, section_name, table_no, source_item FROM e_par")


@query
def r24_rule_entries(d, given=None):
    return with_(entries(d, given, "rul"), "SELECT doc_id, ord, rule_id, rule_type, content, cond, section_name FROM e_rul")


@query
def r25_standard_entries(d, given=None):
    return with_(entries(d, given, "std"), "SELECT doc_id, ord, code, title, family, section_name FROM e_std")


@query
def r26_product_entries(d, given=None):
    return with_(entries(d, given, "prd"), "SELECT doc_id, ord, product_id, name, model, series, display FROM e_prd")


def normalised(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """Records of all kinds, normalised, deduplicated by their keys and filled: n_sec, n_par, n_rul, n_std, n_prd. Ids are
    counted over what is kept; an anchor is the first product that the condition names, else the section, else the whole
    document."""
    n = d.norm
    title = d.norm(f"trim({d.lit(':：')} FROM {n('title')})" if d.name == "spark" else f"trim({n('title')}, {d.lit(':：')})")
    lines = d.rows("sec", d.split("body", "\n"), "raw", "i", "doc_id, ord, i, raw")
    section = f"CASE WHEN {n('section_ref')} = '' THEN '{WHOLE_DOCUMENT}' ELSE {n('section_ref')} END"
    display = f"CASE WHEN anchor <> '' THEN {n('anchor')} WHEN {n('model')} <> '' THEN {n('model')} ELSE {n('name')} END"
    return relations(d, given, "doc", "sec", "par", "rul", "std", "prd") | {
        "bl0": f"SELECT doc_id, ord, i, {n('raw')} AS line FROM ({lines}) l",
        "bl1": "SELECT doc_id, ord, line, min(i) AS i FROM bl0 WHERE line <> '' GROUP BY doc_id, ord, line",
        "bl": f"SELECT doc_id, ord, {d.join_in_order('line', 'i')} AS clean_body FROM bl1 GROUP BY doc_id, ord",
        "sec0": f"SELECT s.doc_id, s.ord, no, {title} AS title, level, parent_no, {n('part')} AS part, coalesce(clean_body, '') AS body FROM sec s LEFT JOIN bl ON s.doc_id = bl.doc_id AND s.ord = bl.ord",
        # an empty section does not stand in the way of a later one with its key
        "sec1": "SELECT * FROM sec0 WHERE title <> '' OR body <> ''",
        "n_sec": first_wins("sec1", "no, title"),
        "prd0": f"SELECT doc_id, ord, product_id, {n('name')} AS name, {n('model')} AS model, series, {display} AS display FROM prd",
        "prd1": "SELECT * FROM prd0 WHERE display <> ''",
        "n_prd": first_wins("prd1", "display"),
        "par0": f"SELECT doc_id, ord, param_id, {d.first_of(n('name'), NORMAL_NAMES, n('name'))} AS name, value, {unit_of(d, 'unit')} AS unit, {n('cond')} AS cond, {n('section_ref')} AS section_ref, {n('table_no')} AS table_no, {n('source_item')} AS source_item, anchor FROM par",
        "par2": first_wins("par0", "name, value, cond, section_ref"),
        "hit": "SELECT p.doc_id, p.ord, min(q.place) AS product_place FROM par2 p JOIN n_prd q ON p.doc_id = q.doc_id AND contains(p.cond, q.display) WHERE p.cond <> '' GROUP BY p.doc_id, p.ord",
        "n_par": f"SELECT p.doc_id, p.place, CASE WHEN p.param_id <> '' THEN p.param_id ELSE concat('param-', p.place) END AS param_id, p.name, p.value, p.unit, p.cond, p.section_ref, CASE WHEN p.anchor <> '' THEN {n('p.anchor')} WHEN q.display IS NOT NULL THEN q.display ELSE {section.replace('section_ref', 'p.section_ref')} END AS anchor, CASE WHEN p.anchor = '' AND q.display IS NOT NULL THEN 'product' ELSE 'section' END AS anchor_kind, CASE WHEN p.source_item <> '' THEN p.source_item ELSE p.name END AS excerpt, CAST(75 AS BIGINT) AS confidence_pct FROM par2 p LEFT JOIN hit h ON p.doc_id = h.doc_id AND p.ord = h.ord LEFT JOIN n_prd q ON h.doc_id = q.doc_id AND h.product_place = q.place",
        "rul0": f"SELECT doc_id, ord, rule_id, {n('rule_type')} AS rule_type, {n('content')} AS content, cond, {n('section_ref')} AS section_ref, anchor FROM rul",
        "rul1": first_wins("rul0", "rule_type, content, section_ref"),
        "n_rul": f"SELECT doc_id, place, CASE WHEN rule_id <> '' THEN rule_id ELSE concat('rule-', place) END AS rule_id, rule_type, content, section_ref, CASE WHEN anchor <> '' THEN anchor ELSE {section} END AS anchor, left(content, 160) AS excerpt FROM rul1",
        "std0": f"SELECT doc_id, ord, {n('code')} AS code, {n('title')} AS title, kind, family, {n('section_ref')} AS section_ref, anchor FROM std WHERE {n('code')} <> ''",
        "std1": first_wins("std0", "code, section_ref"),
        "n_std": f"SELECT doc_id, place, code, title, CASE WHEN family <> '' THEN family ELSE kind END AS family, section_ref, CASE WHEN anchor <> '' THEN anchor ELSE {section} END AS anchor, CASE WHEN title <> '' THEN left(title, 160) ELSE code END AS excerpt FROM std1",
        "n_node": "SELECT doc_id, 0 AS kind_no, place, concat('section:', no) AS node_id, trim(concat(no, ' ', title)) AS title, level, CASE WHEN parent_no <> '' THEN concat('section:', parent_no) ELSE '' END AS parent_id FROM n_sec UNION ALL SELECT doc_id, 1, place, concat('product:', product_id), display, 1, '' FROM n_prd",
    }


@query
def n01_normalised_document(d, given=None):
    """Sizes of a document's normalised records and its Chinese type label."""
    per = lambda t: f"(SELECT doc_id, count(*) AS n FROM {t} GROUP BY doc_id)"
    label = "CASE doc_type " + " ".join(f"WHEN {d.lit(k)} THEN {d.lit(v)}" for k, v in TYPE_LABELS.items()) + " ELSE '技术资料' END"
    kinds = ("n_sec", "n_par", "n_rul", "n_std", "n_prd", "n_node")
    return with_(normalised(d, given), f"SELECT doc.doc_id, {label} AS type_label, " + ", ".join(f"coalesce(x{i}.n, 0) AS {k}" for i, k in enumerate(kinds)) + " FROM doc " + " ".join(f"LEFT JOIN {per(k)} x{i} ON doc.doc_id = x{i}.doc_id" for i, k in enumerate(kinds)))


@query
def d07_normalised_sections(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, no, title, body FROM n_sec")


@query
def d08_n05_normalised_parameters(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, param_id, name, value, unit, cond, section_ref, anchor, anchor_kind, excerpt, confidence_pct FROM n_par")


@query
def j03_parameter_anchors(d, given=None):
    """The first product that a condition names, whatever anchor the parameter has; products are those of its document."""
    return with_(normalised(d, given), "SELECT p.doc_id, p.place, q.product_id, q.display FROM par2 p JOIN hit h ON p.doc_id = h.doc_id AND p.ord = h.ord JOIN n_prd q ON h.doc_id = q.doc_id AND h.product_place = q.place")


@query
def d09_n06_normalised_rules(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, rule_id, rule_type, content, section_ref, anchor, excerpt FROM n_rul")


@query
def d10_n07_normalised_standards(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, code, title, family, section_ref, anchor, excerpt FROM n_std")


@query
def d11_normalised_products(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, product_id, name, model, display FROM n_prd")


@query
def x16b_nodes(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, node_id, title, CAST(level AS BIGINT) AS level, parent_id FROM n_node")


@query
def d15_first_titles_of_codes(d, given=None):
    """The first title that is not empty for every code of a document."""
    return with_(entries(d, given, "std") | {"t": "SELECT * FROM e_std WHERE code <> '' AND title <> ''", "k": first_wins("t", "code")}, "SELECT doc_id, code, title FROM k")


@query
def d01_distinct_in_order(d, given=None):
    """Tags of a document in order, equal and empty ones once and never."""
    return with_(relations(d, given, "tag") | {"t": "SELECT doc_id, ord, tag FROM tag WHERE tag <> ''", "k": first_wins("t", "tag")}, "SELECT doc_id, place, tag FROM k")


def traced(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """Pages of every section, from its blocks."""
    n = d.norm("section_ref")
    return entries(d, given, "sec", "tab", "par", "rul", "std") | relations(d, given, "blk") | {
        "pages0": f"SELECT DISTINCT doc_id, {n} AS ref, page_no FROM blk WHERE {n} <> '' AND page_no <> 0",
        "spag": f"SELECT doc_id, ref, {d.joined(d.list_in_order('concat(page_no, {0})'.format(d.lit('')), 'page_no'), ',')} AS pages FROM pages0 GROUP BY doc_id, ref",
    }


@query
def k04_section_traces(d, given=None):
    return with_(traced(d, given), "SELECT s.doc_id, s.ord, s.ref, coalesce(pages, '') AS pages FROM e_sec s LEFT JOIN spag p ON s.doc_id = p.doc_id AND s.ref = p.ref")


@query
def k05_k06_table_traces(d, given=None):
    """A table's page from its number, else the pages of its section."""
    page = d.extract("table_no", r"第([0-9]+)页", 1)
    return with_(traced(d, given), f"SELECT t.doc_id, t.ord, table_no, title, section_ref, CASE WHEN {page} <> '' THEN {page} ELSE coalesce(pages, '') END AS pages, n_cols, n_rows FROM e_tab t LEFT JOIN spag p ON t.doc_id = p.doc_id AND t.section_ref = p.ref")


@query
def k07_parameter_traces(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, param_id, name, anchor, excerpt FROM n_par")


@query
def k08_rule_traces(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, rule_id, rule_type, anchor, excerpt FROM n_rul")


@query
def k09_standard_traces(d, given=None):
    return with_(normalised(d, given), "SELECT doc_id, place, code, family, anchor, excerpt FROM n_std")


@query
def k03_profile_json(d, given=None):
    meta, profile = RECORDS["metadata"][1], {k: v for k, v in RECORDS["profile"][1].items() if k != "置信度"}
    both = d.record(**{"元数据": f"named_struct({', '.join(f'{d.lit(k)}, {v}' for k, v in meta.items())})", "文档画像": f"named_struct({', '.join(f'{d.lit(k)}, {v}' for k, v in profile.items())})"}) if d.name == "spark" else f"CAST(json_object('元数据', json_object({', '.join(f'{d.lit(k)}, {v}' for k, v in meta.items())}), '文档画像', json_object({', '.join(f'{d.lit(k)}, {v}' for k, v in profile.items())})) AS VARCHAR)"
    return with_(relations(d, given, "doc"), f"SELECT doc_id, {both} AS json FROM doc")


def guarded(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """Documents with the reason why they are not processed, or ''. The guard stands before all structure work."""
    n = lambda t: f"(SELECT doc_id, count(*) AS n FROM {t} GROUP BY doc_id)"
    return relations(d, given, "doc", "sec", "tab") | {
        "grd": f"SELECT doc.*, coalesce(s.n, 0) AS n_sections, coalesce(t.n, 0) AS n_tables, CASE WHEN doc_type <> 'error' AND (confidence_pct < {LEAST_CONFIDENCE_PCT} OR doc_type = '{UNKNOWN}') THEN 'domain' WHEN coalesce(s.n, 0) > {MOST_SECTIONS} THEN 'sections' WHEN coalesce(t.n, 0) > {MOST_TABLES} THEN 'tables' ELSE '' END AS refused FROM doc LEFT JOIN {n('sec')} s ON doc.doc_id = s.doc_id LEFT JOIN {n('tab')} t ON doc.doc_id = t.doc_id"
    }


@query
def p01_guarded_documents(d, given=None):
    return with_(guarded(d, given), "SELECT doc_id, refused, n_sections, n_tables FROM grd")


@query
def p01_next_step(d, given=None):
    """What the loop does next with a document: refuse it, end with it, or repair it and review it again."""
    return with_(scored(d, given) | {k: v for k, v in guarded(d, given).items() if k == "grd"}, "SELECT g.doc_id, CASE WHEN refused <> '' THEN 'refused' WHEN score >= 85 AND NOT redline THEN 'passed' ELSE 'repair' END AS next_step FROM grd g JOIN total t ON g.doc_id = t.doc_id")


@query
def p06_rejected_results(d, given=None):
    """The result of a refused document: no score, a redline, one round, and the reason as its summary."""
    why = f"CASE refused WHEN 'domain' THEN concat('文档超出处理领域(类型=', doc_type, ', 置信度=0.', lpad(concat(confidence_pct, ''), 2, '0'), ')') WHEN 'sections' THEN concat('章节数超限(', n_sections, '>{MOST_SECTIONS})') ELSE concat('表格数超限(', n_tables, '>{MOST_TABLES})') END"
    return with_(guarded(d, given), f"SELECT doc_id, {why} AS reason, concat('文档跳过全量处理。原因=', {why}) AS summary, doc_type AS type_tag, CAST(0 AS BIGINT) AS score, true AS redline, CAST(1 AS BIGINT) AS rounds FROM grd WHERE refused <> ''")


def quarantined(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    return review_facts(d, given) | mismatch_parts(d) | {"quar": f"SELECT doc_id, concat({d.lit(MISMATCH[0])}, expected, {d.lit(MISMATCH[1])}, conflict, {d.lit(MISMATCH[2])}) AS why FROM mism WHERE agrees = 0 AND conflict IS NOT NULL"}


@query
def p03_quarantine(d, given=None):
    """Documents whose summary and tags are replaced, with the reason; '' for all others."""
    return with_(quarantined(d, given), "SELECT doc.doc_id, coalesce(why, '') AS reason FROM doc LEFT JOIN quar q ON doc.doc_id = q.doc_id")


@query
def p04_quarantined_summary(d, given=None):
    name = "CASE WHEN title <> '' THEN title WHEN file_name <> '' THEN file_name ELSE '当前文档' END"
    return with_(quarantined(d, whole(d, given)), f"SELECT doc.doc_id, concat('《', {name}, '》已触发来源隔离：', why) AS summary, {d.lit(QUARANTINE_REASON)} AS llm_reason FROM doc JOIN quar q ON doc.doc_id = q.doc_id")


@query
def p05_quarantined_tags(d, given=None):
    kind = "CASE WHEN raw_type <> '' THEN raw_type ELSE doc_type END"
    tags = d.array([kind, d.lit(QUARANTINE_TAG), f"CASE WHEN needs_ocr THEN {d.lit(SCAN_TAG)} ELSE '' END"])
    return with_(quarantined(d, whole(d, given)) | {"t": d.rows("(SELECT doc.* FROM doc JOIN quar ON doc.doc_id = quar.doc_id) x", tags, "tag", "i", "doc_id, i, tag")}, "SELECT doc_id, CAST(i AS BIGINT) AS place, tag FROM t WHERE tag <> ''")


def snapshot(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """`snap`: the state of a document as canonical JSON, keys in order, ', ' and ': ' between."""
    per = lambda cols, t: f"(SELECT doc_id, {cols} FROM {t} GROUP BY doc_id)"
    first = lambda x: f"concat('[', {d.joined(d.head(d.list_in_order(d.quoted(x), 'ord'), 5), ', ')}, ']')"
    sources = {
        "s": per(f"count(*) AS n_sec, {first('trim(concat(no, {0}, title))'.format(d.lit(' ')))} AS sec_x", "sec"),
        "t": per("count(*) AS n_tab", "tab"),
        "p": per(f"count(*) AS n_par, {first('name')} AS par_x", "par"),
        "r": per("count(*) AS n_rul", "rul"),
        "i": per("count(*) AS n_ins", "ins"),
        "c": per(f"count(*) AS n_std, {first('code')} AS std_x", "std"),
        "m": per("sum(length(line)) + count(*) - 1 AS md_chars", "md"),
        "o": per(f"{tally('ocr_run')} AS tried, {tally('ocr_run AND ocr_injected')} AS injected, concat('[', {d.joined(d.head(d.list_in_order('concat(page_no, {0})'.format(d.lit('')), 'page_no', 'ocr_run AND ocr_injected'), 20), ', ')}, ']') AS pages, CAST(sum(CASE WHEN ocr_run AND ocr_injected THEN length(text) ELSE 0 END) AS BIGINT) AS ocr_chars", "pg"),
        "g": f"(SELECT doc_id, concat('{{', {d.joined(d.list_in_order('concat({0}, {1}, n)'.format(d.quoted('list'), d.lit(': ')), 'list'), ', ')}, '}}') AS tag_n FROM (SELECT doc_id, list, count(*) AS n FROM tag GROUP BY doc_id, list) l GROUP BY doc_id)",
    }
    number = lambda x: f"concat(coalesce({x}, 0), '')"
    fields = {
        "章节数量": number("n_sec"), "表格数量": number("n_tab"), "数值型参数数量": number("n_par"), "规则数量": number("n_rul"), "检验记录数量": number("n_ins"), "引用标准数量": number("n_std"),
        "章节示例": "coalesce(sec_x, '[]')", "参数示例": "coalesce(par_x, '[]')", "标准示例": "coalesce(std_x, '[]')", "原文解析长度": number("md_chars"), "全文摘要长度": "concat(length(full_summary), '')",
        "OCR尝试页数": number("tried"), "OCR注入页数": number("injected"), "OCR注入页索引": "coalesce(pages, '[]')", "OCR有效字符数": number("ocr_chars"), "标签数量统计": "coalesce(tag_n, '{}')",
    }
    text = ", ', ', ".join(f"{d.lit(chr(34) + k + chr(34) + ': ')}, {fields[k]}" for k in sorted(fields))
    joins = " ".join(f"LEFT JOIN {q} {a} ON doc.doc_id = {a}.doc_id" for a, q in sources.items())
    return relations(d, given, "doc", "sec", "tab", "par", "rul", "ins", "std", "md", "pg", "tag") | {"snap": f"SELECT doc.doc_id, concat('{{', {text}, '}}') AS state FROM doc {joins}"}


@query
def a16_state_snapshot(d, given=None):
    return with_(snapshot(d, given), "SELECT doc_id, state FROM snap")


@query
def a17_state_fingerprint(d, given=None):
    """SHA-1 of the canonical state."""
    return with_(snapshot(d, given), "SELECT doc_id, sha1(state) AS fingerprint FROM snap")


@query
def t09_failure_reasons(d, given=None):
    """Why a document did not pass, in order: its redlines, else its gravest problems, else its score."""
    return with_(failure_reasons(d, given), "SELECT doc_id, CAST(place AS BIGINT) AS place, reason FROM why")


@query
def a10_ocr_process_summary(d, given=None):
    """Recognition summed up over the rounds in which it ran; engine and resolution are those of the last one."""
    last = lambda x: f"{d.at(d.list_in_order(x, '-round_no', 'ocr_run'), 1)}"
    total = lambda x: f"CAST(sum(CASE WHEN ocr_run THEN {x} ELSE 0 END) AS BIGINT)"
    return with_(
        relations(d, given, "rnd") | {"r": f"SELECT doc_id, {tally('ocr_run')} AS calls, coalesce({last('engine')}, '') AS engine, coalesce({last('dpi')}, 0) AS dpi, " + ", ".join(f"{total(c)} AS {c}" for c in ("target", "recognised", "passed", "marginal", "rejected", "injected", "millis")) + f", {d.joined(d.list_in_order('failure', 'round_no', 'ocr_run AND failure <> {0}'.format(d.lit(''))), '; ')} AS failures FROM rnd GROUP BY doc_id"},
        "SELECT *, recognised < target AS partly, CAST(floor(1000.0 * recognised / greatest(1, target) + 0.5) AS BIGINT) AS done_permille FROM r",
    )


@query
def d13_all_issues(d, given=None):
    """Issues of the source review with those of the skeleton, the metadata and the tables added, each once."""
    return with_(reviewed(d, given), "SELECT DISTINCT doc_id, issue, reason FROM iss WHERE review = 'source'")


@query
def u03_tag_payload_sizes(d, given=None):
    """What a model is shown to refine tags: at most 25 titles, 40 parameter names, 30 codes and 20 products."""
    per = lambda t, most, a: f"(SELECT doc_id, least({most}, count(*)) AS n FROM {t} GROUP BY doc_id) {a}"
    parts = (("sec", 25, "a"), ("par", 40, "b"), ("std", 30, "c"), ("prd", 20, "e"))
    return with_(
        tag_rows(d, given) | {"nt": "SELECT doc_id, count(*) AS n FROM tags GROUP BY doc_id"},
        "SELECT doc.doc_id, coalesce(nt.n, 0) AS n_tags, " + ", ".join(f"coalesce({a}.n, 0) AS n_{t}" for t, _, a in parts) + " FROM doc LEFT JOIN nt ON doc.doc_id = nt.doc_id " + " ".join(f"LEFT JOIN {per(t, m, a)} ON doc.doc_id = {a}.doc_id" for t, m, a in parts),
    )
