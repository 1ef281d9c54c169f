"""The review: every check emits issue rows, which are rolled up into deductions, scores, redlines and a problem list.

Facts are gathered once per document, each relation in one aggregate; the checks are conditions over that one row.
"""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.lines import any_of
from stratafold.functions.patterns import Guard, Review, Rx
from stratafold.plans.parameters import canonical
from stratafold.plans.registry import query, with_
from stratafold.plans.state import relations, whole
from stratafold.plans.text_layer import gate, metrics, tally, watermark

#: Issues with problem id, dimension, points, action, whether they block, module and outputs they affect.
PROBLEMS = (
    ("正文主链缺失", "doc_chain_missing", "base", 10, "重跑parser", False, "parser", "document,markdown,summary,tags"),
    ("markdown内容过少", "markdown_too_short", "base", 8, "重建markdown", False, "md_builder", "markdown"),
    ("表格视图缺失", "table_view_missing", "base", 5, "重建markdown", False, "md_builder", "markdown"),
    ("自动表标题残留", "auto_table_title_left", "base", 4, "重建markdown", False, "md_builder", "markdown"),
    ("LLM自述无内容", "llm_stub_summary", "factual", 10, "重建summary", True, "summarizer", "summary,review"),
    ("参数摘要为空", "param_summary_empty", "factual", 8, "重建summary", False, "summarizer", "summary"),
    ("文件名与正文不一致", "metadata_mismatch", "factual", 10, "重跑parser", True, "parser", "document,markdown,summary,tags,review"),
    ("核心表格缺失", "table_core_missing", "factual", 8, "重跑parser", True, "parser", "document,markdown,summary,review"),
    ("参数标签存在噪音", "noisy_parameter_tags", "factual", 7, "清洗标签噪音", False, "fixer", "tags"),
    ("标签存在句子污染", "sentence_tag_pollution", "factual", 7, "重建tags", False, "tagger", "tags,review"),
    ("标准引用标签为空", "standard_tag_empty", "factual", 4, "重建tags", False, "tagger", "tags"),
    ("参数标签为空", "param_tag_empty", "factual", 4, "重建tags", False, "tagger", "tags"),
    ("产品型号标签为空", "product_model_tag_empty", "factual", 4, "重建tags", False, "tagger", "tags"),
    ("章节摘要为空", "chapter_summary_empty", "factual", 6, "重建summary", False, "summarizer", "summary"),
    ("摘要疑似模板回退", "summary_template_fallback", "factual", 6, "重建summary", True, "summarizer", "summary,review"),
    ("摘要模板回退（已记录原因）", "summary_fallback_explained", "factual", 6, "重建summary", False, "summarizer", "summary,review"),
    ("结构未建立", "structure_missing", "consistency", 5, "重跑parser", False, "parser", "document,markdown,summary,tags"),
    ("表格未消费", "table_to_param_missing", "consistency", 8, "重跑parser", False, "parser", "document,summary,tags"),
    ("标准实体缺失", "standard_entity_missing", "consistency", 4, "重跑parser", False, "parser", "document,tags,trace_map"),
    ("结构主线缺失", "structured_backbone_missing", "consistency", 5, "重跑parser", False, "parser", "document,markdown,summary,tags"),
    ("疑似扫描件", "scan_like", "consistency", 6, "标记需OCR", True, "ocr", "document,markdown,summary,tags"),
    ("OCR覆盖不足", "ocr_coverage_weak", "consistency", 5, "标记需OCR", True, "ocr", "document,markdown,summary,review"),
    ("OCR标题噪音明显", "ocr_heading_noise", "consistency", 6, "重跑parser", True, "parser", "document,markdown,review"),
    ("OCR标题噪音轻度", "ocr_heading_noise_minor", "consistency", 5, "观察", False, "parser", "document,markdown,review"),
    ("OCR参数污染明显", "ocr_parameter_pollution", "consistency", 6, "重跑parser", True, "parser", "document,summary,tags,review"),
    ("表格未转化为参数", "table_to_param_missing", "", 0, "重跑parser", False, "parser", "document,summary,tags"),
    ("关键标签缺失", "missing_critical_tags", "", 0, "重建tags", False, "tagger", "tags"),
)
#: Level, target and kind of the problems of a review; actions in the order in which they are carried out; the
#: issue that is of the least level, and the one that compares names; what stands for no action and for no other reason.
LISTED = {"markdown": ("S", "原文解析.md", "结构缺失"), "summary": ("A", "summary.json", "摘要缺失"), "tags": ("B", "tags.json", "标签缺失"), "source": ("S", "结构化结果", "来源异常"), "ocr": ("A", "OCR专项检查", "输出质量风险")}
ACTIONS = ("标记需OCR", "重跑parser", "重建markdown", "重建summary", "重建tags", "清洗标签噪音")
MINOR, MISMATCH, NO_ACTION, NO_PASS = "OCR标题噪音轻度", "文件名与正文不一致", "无可用自动修正", "总分未达通过线"
#: Full marks of the dimensions; names of the redlines by issue and the reviews whose issues count; cap and
#: pass mark; points for more than so many pseudo-headings.
FULL_MARKS = {"base": 35, "factual": 40, "consistency": 25}
REDLINES = {"正文主链缺失": ("正文主链缺失", "markdown", "source"), "表格未消费": ("表格存在但数值型参数为空", "source"), "疑似扫描件": ("文本层不足需要OCR", "source")}
REDLINE_CAP, PASS_MARK, PSEUDO_MOST, PSEUDO_POINTS = 74, 85, 5, 3
#: Reasons for which a rule-based summary counts as explained.
BENIGN = ("配置关闭LLM摘要生成", "LLM不可用", "结构化原料不足", "LLM摘要生成失败", "文件名与正文标准号不一致", "构建摘要时出错", "构建标签时出错")
INFO_BLOCK = "文件基础信息"
STATE = ("doc", "sec", "par", "std", "rul", "prd", "tab", "pg", "md", "tag", "chap")


def suspicious_heading(d: Dialect, raw: str, bare: str) -> str:
    """A recognised heading that is noise: `raw` has its hashes, `bare` is its normalised text. The first test that
    applies decides."""
    digits = d.count(bare, Rx("[0-9²³¹]"))
    compact = f"replace({bare}, ' ', '')"
    numbered = d.match(bare, Rx(r"\d+(?:\.\d+)*\s+\S+"))
    return f"""CASE WHEN {bare} = '' THEN false WHEN {d.full(bare, Rx(r'\d+(?:\.\d+)*\s+[一-鿿A-Za-z][^。；;]{0,24}'))} THEN false WHEN {d.full(raw, Review.SUSPICIOUS_OCR_HEADING_RE)} THEN true
      WHEN {d.match(bare, Rx(r'\d{2,}(?:[.,]\d+)?\s+\S+'))} THEN true WHEN length({bare}) <= 24 AND {digits} >= 3 AND NOT {numbered} THEN true
      WHEN length({compact}) >= 14 AND {d.count(compact, Rx('[0-9²³¹]'))} >= 4 AND length({bare}) - length({compact}) <= 1 THEN true WHEN {d.ends(bare, '。', '；', ';')} AND NOT {d.match(bare, Rx(r'\d+(?:\.\d+)*\s+'))} THEN true ELSE false END"""


def template_summary(d: Dialect, x: str) -> str:
    return f"({x} = '' OR {d.search(x, Review.TEMPLATE_SUMMARY_RE)} OR (contains({x}, 'OCR') AND length({x}) <= 80))"


def count_only_summary(d: Dialect, x: str) -> str:
    """Nothing is left of a summary once its counting phrases are taken out."""
    left = x
    for p in ("《[^》]+》", "当前识别为[^。；;]*[。；;]?", r"已建立\s*\d+[^。；;]*[。；;]?", r"已抽取\s*\d+[^。；;]*[。；;]?", r"已识别\s*\d+[^。；;]*[。；;]?", "^[。；;，, ]+|[。；;，, ]+$"):
        left = d.replace_all(left, Rx(p))
    return f"({x} = '' OR ({d.search(x, Review.COUNT_ONLY_SUMMARY_SIGNAL_RE)} AND {d.norm(left)} = ''))"


def low_signal_chapter(d: Dialect, title: str, summary: str) -> str:
    return f"(({title} = '' AND {summary} = '') OR {d.full(title, Review.GENERIC_CHAPTER_TITLE_RE)} OR {d.search(summary, Review.LOW_SIGNAL_CHAPTER_SUMMARY_RE)})"


def joined_by_connector(d: Dialect, x: str) -> str:
    """At least four words, one of which joins others."""
    bare = f"concat(' ', lower(replace(replace({x}, '/', ' '), '-', ' ')), ' ')"
    return f"({d.words(d.norm(bare))} >= 4 AND {any_of([f'contains({bare}, {d.lit(f" {w} ")})' for w in ('for', 'and', 'und', 'mit')])})"


def suspicious_parameter_tag(d: Dialect, x: str) -> str:
    connector = Rx("(?:^|[^A-Za-zÀ-ÿ])(?:for|and|und|mit|als|f[uü]r|verwendet|geeignet|nach|ohne)(?:$|[^A-Za-zÀ-ÿ])", True)
    return f"({x} <> '' AND ({d.search(x, Review.SUSPICIOUS_PARAM_TAG_RE)} OR {joined_by_connector(d, x)} OR ({d.count(x, Rx('[A-Za-zÀ-ÿ]+'))} >= 3 AND {d.search(x, connector)})))"


def sentence_like_tag(d: Dialect, x: str) -> str:
    many = f"{d.words(d.norm(f'replace({x}, {d.lit("/")}, {d.lit(" ")})'))} >= 4"
    return f"(length({x}) >= 18 AND ({d.search(x, Review.LONG_SENTENCE_TAG_RE)} OR {many} OR {d.search(x, Rx(r'\b(?:MPa|bar|psi|mm|cm|m|kg|℃|°C)\b', True))}))"


def suspicious_parameter(d: Dialect, name: str, value: str, merged: str) -> str:
    whole = [d.search(merged, p) for p in (Review.METADATA_PARAM_RE, Review.FRONT_MATTER_PARAM_RE, Review.FRONT_MATTER_VALUE_RE, Review.DATE_LIKE_RE)]
    return f"({merged} <> '' AND {any_of([*whole, d.search(name, Review.STANDARD_CODE_RE), d.search(value, Review.STANDARD_CODE_RE)])})"


def benign(d: Dialect, x: str) -> str:
    return any_of([f"left({x}, {len(p)}) = {d.lit(p)}" for p in BENIGN])


def merged_parameters(d: Dialect) -> str:
    parts = [d.norm(c) for c in ("name", "value", "source_item")]
    return f"SELECT doc_id, ord, {parts[0]} AS name, {parts[1]} AS value, {d.norm(f'concat({parts[0]}, {d.lit(" ")}, {parts[1]}, {d.lit(" ")}, {parts[2]})')} AS merged FROM par"


def markdown_parts(d: Dialect) -> dict[str, str]:
    """Lines of Markdown with what they are; the block of file information, from its line to the next heading, is marked."""
    head = "left(ltrim(line), 1) = '#'"
    bare = d.norm(d.replace_all("line", Rx(r"^\s*#+")))
    return {
        "md1": d.pin("md", is_head=f"({head})", stripped="trim(line)", bare=bare),
        "md2": f"SELECT *, CASE WHEN bare = {d.lit(INFO_BLOCK)} THEN 1 ELSE 0 END AS opens, sum(CASE WHEN is_head OR bare = {d.lit(INFO_BLOCK)} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS block_no FROM md1",
        "md3": "SELECT *, max(opens) OVER (PARTITION BY doc_id, block_no) = 1 AS is_info FROM md2",
        "mdl": "SELECT *, is_head AND " + suspicious_heading(d, "stripped", "bare") + f" AS odd, is_head AND ({d.full('stripped', Review.SHORT_HEADING_RE)} OR {d.full('stripped', Review.SENTENCE_HEADING_RE)}) AS pseudo, is_head AND {d.full('stripped', Review.SYNTHETIC_TABLE_TITLE_RE)} AS synthetic FROM md3",
    }


def facts(d: Dialect, given: dict[str, str] | None = None) -> dict[str, str]:
    """One row per document with all that the checks ask for."""
    per = lambda cols, table: f"SELECT doc_id, {cols} FROM {table} GROUP BY doc_id"
    in_list = lambda name: f"list = {d.lit(name)}"
    body = d.count("body", Review.TABLE_DRIVEN_BODY_RE)
    parts = relations(d, given, *STATE) | markdown_parts(d)
    parts |= {
        "f_md": per(f"count(*) AS md_lines, {tally('is_head')} AS headings, {tally('stripped <> {0} AND NOT is_head'.format(d.lit('')))} AS content, {tally(f'left(line, 2) = {d.lit("| ")}')} AS rows_shown, {tally('pseudo')} AS pseudo, {tally('synthetic')} AS synthetic, {tally('odd')} AS odd_headings, {tally(f'stripped <> {d.lit("")}')} AS md_filled, {tally(f'NOT is_info AND bare <> {d.lit("")} AND NOT is_head AND left(ltrim(line), 1) <> {d.lit("|")}')} AS body_lines, left({d.join_in_order('line', 'line_no', where='NOT is_info')}, 5000) AS body", "mdl"),
        "f_sec": per("count(*) AS n_sec", "sec"),
        "f_parm": per(f"count(DISTINCT CASE WHEN {suspicious_parameter(d, 'name', 'value', 'merged')} THEN merged END) AS odd_parameters, count(*) AS n_par", f"({merged_parameters(d)}) p"),
        "f_std": per("count(*) AS n_std", "std"),
        "f_rul": per("count(*) AS n_rul", "rul"),
        "f_prd": per("count(*) AS n_prd", "prd"),
        "f_tab": per("count(*) AS n_tab", "tab"),
        "tags1": d.pin("tag", t=d.norm("tag")),
        "f_tag": per(
            f"{tally(in_list('标准引用标签'))} AS std_tags, {tally(in_list('参数标签'))} AS par_tags, {tally(in_list('产品型号标签'))} AS model_tags, {tally(in_list('参数标签') + ' AND ' + suspicious_parameter_tag(d, 't'))} AS noisy_tags, count(DISTINCT CASE WHEN {sentence_like_tag(d, 't')} THEN t END) AS sentence_tags, {tally(in_list('文档主题标签') + f' AND length(t) > 30 AND {d.search("t", Rx("为[^，、。]+[，、]"))}')} AS long_topics",
            "tags1",
        ),
        "chap1": d.pin("chap", ct=d.norm("title"), cs=d.norm("summary")),
        "f_chap": per(f"count(*) AS n_chap, {tally(low_signal_chapter(d, 'ct', 'cs'))} AS low_chap", "chap1"),
        "pl0": d.rows("pg", d.split("text", "\n"), "raw", "i", "doc_id, page_no, ocr_run, i, raw"),
        "pl": f"SELECT doc_id, {d.struct(p='page_no', i='i')} AS line_no, ocr_run, line FROM (SELECT doc_id, page_no, ocr_run, i, {d.norm('raw')} AS line FROM pl0) x WHERE line <> ''",
        "f_pl": per(f"{tally(f'ocr_run AND {d.search("line", Review.STANDARD_CODE_RE)}')} AS ocr_codes, {tally(d.search('line', Review.STANDARD_CODE_RE))} AS raw_codes, {tally(f'ocr_run AND {d.search("line", Review.OCR_TABLE_CAPTION_RE)}')} AS captions, {tally(f'ocr_run AND ({d.search("line", Review.OCR_TABLE_SIGNAL_RE)} OR {d.search("line", Review.TABLE_DRIVEN_BODY_RE)})')} AS table_signals", "pl"),
        "f_pg": per(f"count(*) AS n_pages, {tally('ocr_run')} AS tried, {tally('ocr_run AND ocr_injected')} AS injected", "pg"),
        "gate0": f"SELECT m.*, p.n_pages AS pages FROM ({metrics(d, 'pl')}) m JOIN f_pg p ON m.doc_id = p.doc_id",
        "gate1": f"SELECT *, {watermark(d)} AS watermark FROM gate0",
        # a document without a line has too few characters
        "f_gate": f"SELECT doc_id, {any_of([f'({v})' for v in gate().values()])} AS text_is_weak FROM gate1",
    }
    count = lambda *names: ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
    names = ("f_md", "f_sec", "f_parm", "f_std", "f_rul", "f_prd", "f_tab", "f_tag", "f_chap", "f_pl", "f_pg", "f_gate")
    joins = " ".join(f"LEFT JOIN {n} ON doc.doc_id = {n}.doc_id" for n in names)
    counted = count("md_lines", "headings", "content", "rows_shown", "pseudo", "synthetic", "odd_headings", "md_filled", "body_lines", "n_sec", "odd_parameters", "n_par", "n_std", "n_rul", "n_prd", "n_tab", "std_tags", "par_tags", "model_tags", "noisy_tags", "sentence_tags", "long_topics", "n_chap", "low_chap", "ocr_codes", "raw_codes", "captions", "table_signals", "n_pages", "tried", "injected")
    reason = "CASE WHEN llm_reason <> '' THEN llm_reason ELSE log_reason END"
    parts["f0"] = f"SELECT doc.*, {d.norm('full_summary')} AS summary, {reason} AS reason, coalesce(body, '') AS body, coalesce(text_is_weak, true) AS text_is_weak, {counted} FROM doc {joins}"
    distinct_body = d.size(d.distinct(d.extract_all("body", Review.TABLE_DRIVEN_BODY_RE)))
    low = "(n_chap > 0 AND low_chap >= greatest(2, floor(n_chap / 2.0)))"
    parts["facts"] = (
        f"SELECT *, {template_summary(d, 'summary')} AS is_template, {count_only_summary(d, 'summary')} AS only_counts, {low} AS low_chapters, {benign(d, 'reason')} AS explained, {body} AS body_signals, {distinct_body} AS distinct_signals,"
        f" {d.search(f'concat(file_name, {d.lit(" ")}, title)', Review.TABLE_DRIVEN_TITLE_RE)} AS table_driven, {d.match('summary', Review.LLM_STUB_RE)} AND summary <> '' AS is_stub, tried > 0 AND injected < 0.5 * tried AS weak_cover,"
        f" line_count >= greatest(80, n_pages * 20) AND n_sec >= 2 AND md_lines >= 12 AS recovered FROM f0"
    )
    return parts


def emitted(d: Dialect, review: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    """Issue rows (doc_id, review, issue, reason) of a document's row: one for each rule (issue, reason, condition) that applies."""
    cases = d.array([f"CASE WHEN {cond} THEN {d.lit(issue + '|' + reason)} ELSE '' END" for issue, reason, cond in rules])
    rows = d.rows(table, cases, "found", "", "doc_id, found")
    part = lambda i: d.at(d.pattern_split("found", "|"), i)
    return f"SELECT doc_id, {d.lit(review)} AS review, {part(1)} AS issue, {part(2)} AS reason FROM ({rows}) x WHERE found <> ''"


MARKDOWN_RULES = [
    ("正文主链缺失", "no_sections", "n_sec = 0"),
    ("markdown内容过少", "few_lines", "headings <= 2 OR content <= 3"),
    ("表格视图缺失", "no_table_rows", "n_tab > 0 AND rows_shown = 0"),
    ("自动表标题残留", "synthetic_titles", "synthetic > 0"),
]
SUMMARY_RULES = [
    ("章节摘要为空", "no_chapters", "n_sec > 0 AND n_chap = 0"),
    ("章节摘要为空", "low_signal_chapters", "NOT (n_sec > 0 AND n_chap = 0) AND low_chapters"),
    ("摘要模板回退（已记录原因）", "explained", "llm_backend = '' AND is_template AND explained"),
    ("摘要疑似模板回退", "unexplained", "llm_backend = '' AND is_template AND NOT explained"),
    ("摘要疑似模板回退", "only_counts", "NOT (llm_backend = '' AND is_template) AND only_counts AND (n_chap = 0 OR low_chapters)"),
]
FACT_RULES = [("参数摘要为空", "parameters_not_summarised", "n_par > 0 AND n_num = 0")]
STUB_RULES = [("LLM自述无内容", "stub", "llm_called AND is_stub")]
TAG_RULES = [
    ("标准引用标签为空", "no_standard_tag", "n_std > 0 AND std_tags = 0"),
    ("参数标签为空", "no_parameter_tag", "n_par > 0 AND par_tags = 0"),
    ("产品型号标签为空", "no_model_tag", "n_prd > 0 AND model_tags = 0"),
    ("参数标签存在噪音", "noisy", "noisy_tags > 0"),
    ("标签存在句子污染", "sentences", "sentence_tags > 0"),
    ("标签存在句子污染", "long_topics", "long_topics > 0"),
]
SCAN = (
    ("profile", "needs_ocr AND tried = 0"),
    ("text_layer", "text_is_weak AND tried = 0 AND NOT recovered"),
    ("weak_cover", "weak_cover AND NOT recovered"),
    ("few_characters", "chars_per_page < 20 AND tried = 0"),
)
SOURCE_RULES = [
    *[("疑似扫描件", name, " AND ".join([f"NOT ({c})" for _, c in SCAN[:i]] + [f"({cond})"])) for i, (name, cond) in enumerate(SCAN)],
    ("结构未建立", "no_structure", "line_count > 0 AND n_sec = 0 AND n_tab = 0"),
    ("表格未消费", "no_parameters", "n_tab > 0 AND n_par = 0"),
    ("标准实体缺失", "no_standards", "n_std = 0 AND raw_codes > 0"),
    ("结构主线缺失", "no_nodes", "line_count > 0 AND n_sec + n_prd = 0"),
]
SKELETON_RULES = [("正文主链缺失", "empty_skeleton", "n_sec <= 1 AND n_par = 0 AND n_std = 0 AND md_filled < 15")]
TABLE_RULES = [("核心表格缺失", "table_driven", "n_tab = 0 AND table_driven AND distinct_signals >= 2")]
OCR_RULES = [
    ("OCR覆盖不足", "soft_timeout", "weak_cover AND ocr_partial AND ocr_target > 0"),
    ("OCR覆盖不足", "weak_cover", "weak_cover AND NOT (ocr_partial AND ocr_target > 0)"),
    ("OCR标题噪音轻度", "few", "tried > 0 AND odd_headings BETWEEN 2 AND 4"),
    ("OCR标题噪音明显", "many", "tried > 0 AND odd_headings >= 5"),
    ("OCR参数污染明显", "polluted", "tried > 0 AND odd_parameters >= greatest(2, floor(n_par / 3.0))"),
    ("标准实体缺失", "no_standards", "tried > 0 AND n_std = 0 AND ocr_codes > 0"),
    ("核心表格缺失", "table_driven", "tried > 0 AND n_tab = 0 AND captions > 0 AND (table_signals >= 2 OR body_signals >= 2)"),
    ("表格未消费", "no_parameters", "tried > 0 AND n_tab > 0 AND n_par = 0"),
    ("结构主线缺失", "no_nodes", "tried > 0 AND (n_sec <= 1 OR n_sec + n_prd <= 1) AND body_lines < 4 AND n_par + n_std + n_rul + n_tab < 2"),
]


def mismatch_parts(d: Dialect) -> dict[str, str]:
    """Codes expected by a file name against codes of the body, title and standards: the first conflict where none agrees."""
    found = lambda x: d.extract_all(x, Guard.STANDARD_CODE_TOKEN_RE, 0)
    return {
        "want": f"SELECT DISTINCT doc_id, {canonical(d, 'token')} AS code FROM ({d.rows('doc', found(d.norm('file_name')), 'token', '', 'doc_id, token')}) w",
        "sec3": f"SELECT doc_id, concat({d.norm('title')}, ' ', {d.norm('left(body, 240)')}) AS txt FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS k FROM sec) s WHERE k <= 3",
        "said": f"""SELECT doc_id, {d.norm('title')} AS txt FROM doc UNION ALL SELECT doc_id, txt FROM sec3 UNION ALL SELECT doc_id, left(body, 4000) AS txt FROM f_md""",
        "code0": f"SELECT doc_id, {canonical(d, 'token')} AS code FROM ({d.rows('said', found(d.norm('txt')), 'token', '', 'doc_id, token')}) c UNION ALL SELECT doc_id, {canonical(d, d.norm('code'))} AS code FROM std",
        "codes": "SELECT DISTINCT doc_id, code FROM code0 WHERE code <> ''",
        "mism": """SELECT w.doc_id, min(w.code) AS expected, min(CASE WHEN o.code IS NULL THEN c.code END) AS conflict, max(CASE WHEN o.code IS NOT NULL THEN 1 ELSE 0 END) AS agrees
          FROM want w JOIN codes c ON w.doc_id = c.doc_id LEFT JOIN want o ON c.doc_id = o.doc_id AND c.code = o.code WHERE w.code <> '' GROUP BY w.doc_id""",
    }


def reviewed(d: Dialect, given: dict[str, str] | None = None) -> dict[str, str]:
    """Issue facts `iss` and, beside the facts, the number of numeric items of the summary (here: of documents whose
    summary covers chapters)."""
    parts = facts(d, given) | mismatch_parts(d)
    parts["seen"] = f"SELECT *, {d.once}CASE WHEN n_chap > 0 THEN n_par ELSE 0 END AS n_num FROM facts"
    rows = [emitted(d, r, "seen", rules) for r, rules in (("markdown", MARKDOWN_RULES), ("summary", SUMMARY_RULES + FACT_RULES + STUB_RULES), ("tags", TAG_RULES), ("source", SOURCE_RULES + SKELETON_RULES + TABLE_RULES), ("ocr", OCR_RULES))]
    rows.append(f"SELECT doc_id, 'source' AS review, {d.lit('文件名与正文不一致')} AS issue, concat(expected, ' / ', conflict) AS reason FROM mism WHERE agrees = 0 AND conflict IS NOT NULL")
    parts["iss"] = " UNION ALL ".join(rows)
    return parts


def problems(d: Dialect) -> str:
    rows = ", ".join(f"({d.lit(i)}, {d.lit(p)}, {d.lit(dim)}, {pts}, {d.lit(act)}, {str(blk).lower()}, {d.lit(mod)}, {d.lit(out)})" for i, p, dim, pts, act, blk, mod, out in PROBLEMS)
    return f"SELECT * FROM (VALUES {rows}) AS v(issue, problem_id, dimension, points, action, blocking, module, outputs)"


def scored(d: Dialect, given: dict[str, str] | None = None) -> dict[str, str]:
    part = lambda k, more="0": f"greatest(0, {FULL_MARKS[k]} - {more} - coalesce(sum(CASE WHEN dimension = '{k}' THEN points END), 0))"
    crossed = " OR ".join(f"(issue = {d.lit(i)} AND review IN ({', '.join(d.lit(r) for r in names[1:])}))" for i, names in REDLINES.items())
    level = "CASE WHEN review IN ('markdown', 'source') THEN 0 WHEN review = 'summary' OR (review = 'ocr' AND i.issue <> {0}) THEN 1 ELSE 2 END".format(d.lit("OCR标题噪音轻度"))
    parts = reviewed(d, given)
    return parts | {
        "prob": problems(d),
        "ded": "SELECT DISTINCT i.doc_id, dimension, i.issue, i.reason, points FROM iss i JOIN prob p ON i.issue = p.issue WHERE dimension <> ''",
        "red": f"SELECT DISTINCT doc_id, issue FROM iss WHERE {crossed}",
        "dims0": "SELECT doc_id, dimension, sum(points) AS points FROM ded GROUP BY doc_id, dimension",
        "redn": "SELECT doc_id, count(*) AS n_red FROM red GROUP BY doc_id",
        "dims": f"SELECT s.doc_id, {part('base', f'max(CASE WHEN pseudo > {PSEUDO_MOST} THEN {PSEUDO_POINTS} ELSE 0 END)')} AS base, {part('factual')} AS factual, {part('consistency')} AS consistency FROM seen s LEFT JOIN dims0 m ON s.doc_id = m.doc_id GROUP BY s.doc_id",
        "total": f"SELECT d.doc_id, CAST(base AS BIGINT) AS base, CAST(factual AS BIGINT) AS factual, CAST(consistency AS BIGINT) AS consistency, n_red IS NOT NULL AS redline, CAST(CASE WHEN n_red IS NOT NULL THEN least({REDLINE_CAP}, base + factual + consistency) ELSE base + factual + consistency END AS BIGINT) AS score FROM dims d LEFT JOIN redn r ON d.doc_id = r.doc_id",
        "lev": f"SELECT i.doc_id, problem_id, action, blocking, module, min({level}) AS level FROM iss i JOIN prob p ON i.issue = p.issue GROUP BY i.doc_id, problem_id, action, blocking, module",
    }


def _rule_query(rules, d, given=None):
    parts = facts(d, given) | {"seen": "SELECT *, CASE WHEN n_chap > 0 THEN n_par ELSE 0 END AS n_num FROM facts"}
    return with_(parts, f"SELECT doc_id, issue, reason FROM ({emitted(d, 'x', 'seen', rules)}) e")


@query
def v01_markdown_review(d, given=None):
    return _rule_query(MARKDOWN_RULES, d, given)


@query
def v02_summary_structure(d, given=None):
    return _rule_query(SUMMARY_RULES, d, given)


@query
def v03_summary_facts(d, given=None):
    return _rule_query(FACT_RULES, d, whole(d, given))


@query
def v04_tag_review(d, given=None):
    return _rule_query(TAG_RULES, d, whole(d, given))


@query
def v05_ocr_quality(d, given=None):
    return _rule_query(OCR_RULES, d, whole(d, given))


@query
def v05_ocr_metrics(d, given=None):
    return with_(facts(d, given), "SELECT doc_id, tried, injected, CAST(floor(1000.0 * injected / greatest(1, tried) + 0.5) AS BIGINT) AS cover_permille, odd_headings, odd_parameters FROM facts")


@query
def v06_skeleton(d, given=None):
    return _rule_query(SKELETON_RULES, d, given)


@query
def v07_stub_summary(d, given=None):
    return _rule_query(STUB_RULES, d, given)


@query
def v08_metadata_mismatch(d, given=None):
    return with_(facts(d, whole(d, given)) | mismatch_parts(d), "SELECT doc_id, expected, conflict FROM mism WHERE agrees = 0 AND conflict IS NOT NULL")


@query
def v09_table_criticality(d, given=None):
    return _rule_query(TABLE_RULES, d, given)


@query
def v10_source_review(d, given=None):
    return _rule_query(SOURCE_RULES, d, whole(d, given))


@query
def v11_redlines(d, given=None):
    names = " ".join(f"WHEN {d.lit(i)} THEN {d.lit(n[0])}" for i, n in REDLINES.items())
    return with_(scored(d, whole(d, given)), f"SELECT doc_id, CASE issue {names} END AS redline, CAST({REDLINE_CAP} AS BIGINT) AS cap FROM red")


@query
def v12_v13_problem_lookup(d):
    return problems(d).replace("SELECT *", "SELECT issue, problem_id, action, blocking, module, outputs", 1)


@query
def v14_suspicious_headings(d, given=None):
    return with_(relations(d, given, "md") | markdown_parts(d), "SELECT doc_id, line_no, bare FROM mdl WHERE odd")


@query
def v15_ocr_lines(d, given=None):
    return with_(relations(d, given, "pg") | {"r": d.rows("pg", d.split("text", "\n"), "raw", "i", "doc_id, page_no, ocr_run, i, raw")}, f"SELECT doc_id, page_no, i, line FROM (SELECT doc_id, page_no, i, {d.norm('raw')} AS line FROM r WHERE ocr_run) x WHERE line <> ''")


@query
def v16_table_driven_ocr(d, given=None):
    return with_(facts(d, given), "SELECT doc_id, captions > 0 AND (table_signals >= 2 OR body_signals >= 2) AS table_driven FROM facts")


@query
def v17_weak_backbone(d, given=None):
    return with_(facts(d, whole(d, given)), "SELECT doc_id, (n_sec <= 1 OR n_sec + n_prd <= 1) AND body_lines < 4 AND n_par + n_std + n_rul + n_tab < 2 AS weak FROM facts")


@query
def v18_suspicious_parameters(d, given=None):
    return with_(relations(d, whole(d, given), "par") | {"m": merged_parameters(d)}, f"SELECT doc_id, merged, min(ord) AS first_ord FROM m WHERE {suspicious_parameter(d, 'name', 'value', 'merged')} GROUP BY doc_id, merged")


@query
def v19_sentence_like_tags(d, given=None):
    return with_(relations(d, given, "tag") | {"t": f"SELECT doc_id, {d.norm('tag')} AS tag FROM tag"}, f"SELECT DISTINCT doc_id, tag FROM t WHERE {sentence_like_tag(d, 'tag')}")


@query
def v20_v21_summary_tests(d, given=None):
    return with_(relations(d, given, "doc") | {"s": f"SELECT doc_id, {d.norm('full_summary')} AS s FROM doc"}, f"SELECT doc_id, {template_summary(d, 's')} AS is_template, {count_only_summary(d, 's')} AS only_counts FROM s")


@query
def v22_low_signal_chapters(d, given=None):
    return with_(relations(d, given, "chap") | {"c": f"SELECT doc_id, ord, {d.norm('title')} AS title, {d.norm('summary')} AS summary FROM chap"}, f"SELECT doc_id, ord FROM c WHERE {low_signal_chapter(d, 'title', 'summary')}")


@query
def v23_suspicious_parameter_tags(d, given=None):
    return with_(relations(d, given, "tag") | {"t": f"SELECT doc_id, ord, {d.norm('tag')} AS tag FROM tag WHERE list = {d.lit('参数标签')}"}, f"SELECT doc_id, ord, tag, {suspicious_parameter_tag(d, 'tag')} AS suspicious FROM t")


@query
def f33_benign_reasons(d, given=None):
    return with_(relations(d, given, "doc") | {"r": "SELECT doc_id, CASE WHEN llm_reason <> '' THEN llm_reason ELSE log_reason END AS reason FROM doc"}, f"SELECT doc_id, reason, {benign(d, 'reason')} AS benign FROM r")


@query
def d12_merged_issues(d, given=None):
    """Issues of all reviews, equal ones of a review once."""
    return with_(reviewed(d, whole(d, given)), "SELECT DISTINCT doc_id, review, issue, reason FROM iss")


@query
def a14_deduction_rollup(d, given=None):
    return with_(scored(d, whole(d, given)), "SELECT doc_id, dimension, CAST(sum(points) AS BIGINT) AS points, count(*) AS n_issues FROM ded GROUP BY doc_id, dimension")


@query
def a15_scores(d, given=None):
    return with_(scored(d, whole(d, given)), f"SELECT doc_id, base, factual, consistency, redline, score, score >= {PASS_MARK} AND NOT redline AS passed FROM total")


def listed(d: Dialect, given: dict[str, str] | None = None) -> dict[str, str]:
    """`plist`: the problem list of a document: of each problem the gravest finding, the first one of equals; problems are
    sorted by level and then by the place of their first finding."""
    ruled = {"markdown": MARKDOWN_RULES, "summary": SUMMARY_RULES + FACT_RULES + STUB_RULES, "tags": TAG_RULES, "source": SOURCE_RULES + SKELETON_RULES + TABLE_RULES + [(MISMATCH, "", "")], "ocr": [r for r in OCR_RULES if r[0] != MINOR] + [r for r in OCR_RULES if r[0] == MINOR]}
    places = dict.fromkeys((review, rule[0]) for review in ruled for rule in ruled[review])
    ranks = ", ".join(f"({d.lit(review)}, {d.lit(issue)}, {i}, {('SAB'.index(LISTED[review][0]) if issue != MINOR else 2)}, {d.lit(LISTED[review][1])}, {d.lit(LISTED[review][2])})" for i, (review, issue) in enumerate(places))
    return scored(d, given) | {
        "rk": f"SELECT * FROM (VALUES {ranks}) AS v(review, issue, rank, level, target, kind)",
        "pb0": "SELECT i.doc_id, coalesce(p.problem_id, i.issue) AS problem_id, i.issue, i.reason, k.rank, k.level, k.target, k.kind, coalesce(p.module, '') AS module, coalesce(p.action, '') AS action, coalesce(p.blocking, false) AS blocking, coalesce(p.outputs, '') AS outputs FROM iss i JOIN rk k ON i.review = k.review AND i.issue = k.issue LEFT JOIN prob p ON i.issue = p.issue",
        "pb1": "SELECT *, row_number() OVER (PARTITION BY doc_id, problem_id ORDER BY level, rank, reason) AS k, min(rank) OVER (PARTITION BY doc_id, problem_id) AS first_rank FROM pb0",
        "plist": "SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY level, first_rank) AS BIGINT) AS place FROM pb1 WHERE k = 1",
    }


@query
def t03_problem_list(d, given=None):
    """Problems of a document in order, one row for each id with its gravest level: S, A or B."""
    return with_(listed(d, given), "SELECT doc_id, place, problem_id, CASE level WHEN 0 THEN 'S' WHEN 1 THEN 'A' ELSE 'B' END AS level, target, kind, issue AS position, reason, module, action, blocking, outputs FROM plist")


@query
def t04_fix_actions(d, given=None):
    """What is to be done about a document: each action of a module once, with the first problem that asks for it; by level,
    then in the order in which actions are carried out."""
    order = "CASE action " + " ".join(f"WHEN {d.lit(a)} THEN {i}" for i, a in enumerate(ACTIONS)) + " ELSE 99 END"
    return with_(
        listed(d, given) | {"a": f"SELECT *, row_number() OVER (PARTITION BY doc_id, action, module ORDER BY place) AS nth FROM plist WHERE action <> '' AND action <> {d.lit(NO_ACTION)}"},
        f"SELECT doc_id, action, module, issue AS reason, CASE level WHEN 0 THEN 'S' WHEN 1 THEN 'A' ELSE 'B' END AS level, blocking OR action = {d.lit(ACTIONS[0])} AS blocking, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY level, {order}, place) AS BIGINT) AS place FROM a WHERE nth = 1",
    )


def failure_reasons(d: Dialect, given: dict[str, str] | None = None) -> dict[str, str]:
    """`why`: why a document did not pass, in order: the names of its redlines, else its gravest problems, else its score."""
    names = " ".join(f"WHEN {d.lit(i)} THEN {d.lit(n[0])}" for i, n in REDLINES.items())
    turn = " ".join(f"WHEN {d.lit(i)} THEN {k}" for k, i in enumerate(REDLINES))
    return listed(d, given) | {
        "no_pass": f"SELECT doc_id FROM total WHERE score < {PASS_MARK} OR redline",
        "why0": f"SELECT n.doc_id, 0 AS origin, CASE issue {turn} END AS place, CASE issue {names} END AS reason FROM no_pass n JOIN red r ON n.doc_id = r.doc_id UNION ALL SELECT n.doc_id, 1, p.place, p.issue FROM no_pass n JOIN plist p ON n.doc_id = p.doc_id WHERE p.level = 0 UNION ALL SELECT doc_id, 2, 0, {d.lit(NO_PASS)} FROM no_pass",
        "why": "SELECT doc_id, place, reason FROM (SELECT *, min(origin) OVER (PARTITION BY doc_id) AS first FROM why0) w WHERE origin = first",
    }


@query
def a11_top_failure_reasons(d, given=None):
    """The three most frequent reasons of the documents that did not pass; of equals the one that comes first."""
    first = d.struct(d="doc_id", p="CAST(place AS BIGINT)")
    return with_(
        failure_reasons(d, given) | {"n": f"SELECT reason, count(*) AS n_docs, min({first}) AS first FROM why GROUP BY reason", "k": "SELECT *, row_number() OVER (ORDER BY n_docs DESC, first) AS nth FROM n"},
        "SELECT reason, n_docs, CAST(nth AS BIGINT) AS place FROM k WHERE nth <= 3",
    )


@query
def x21_x22_actions(d):
    """The action and module of an issue of an older problem list, which names issues only."""
    older = {"OCR参数污染明显": ("清洗标签噪音", "fixer"), "LLM自述无内容": ("", ""), "文件名与正文不一致": ("", ""), "核心表格缺失": ("", ""), "摘要模板回退（已记录原因）": ("", ""), "OCR标题噪音轻度": ("", "")}
    rows = ", ".join(f"({d.lit(i)}, {d.lit(older.get(i, (a, m))[0])}, {d.lit(older.get(i, (a, m))[1])})" for i, _, _, _, a, _, m, _ in PROBLEMS)
    return f"SELECT * FROM (VALUES {rows.replace(d.lit('重跑parser') + ', ' + d.lit('ocr'), d.lit('重跑parser') + ', ' + d.lit('parser'))}) AS v(issue, action, module)"


@query
def x23_cleaned_parameter_tags(d, given=None):
    return with_(relations(d, given, "tag"), f"SELECT doc_id, ord, tag FROM tag WHERE list = {d.lit('参数标签')} AND NOT {d.search('tag', Review.SUSPICIOUS_PARAM_TAG_RE)}")


@query
def c12_c13_body_lines(d, given=None):
    """Body lines of Markdown: neither headings nor table rows, outside the block of file information."""
    return with_(relations(d, given, "md") | markdown_parts(d), f"SELECT doc_id, line_no, bare FROM mdl WHERE NOT is_info AND NOT is_head AND bare <> '' AND left(ltrim(line), 1) <> {d.lit('|')}")
