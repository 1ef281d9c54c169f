"""Rule-based summaries and tags of documents, and the localisation they share.

Every text is localised once, however many records name it: the distinct texts are looked up in the phrase table, and
records join them. Lists keep their first occurrence; their limits are those of the summary and the tags.
"""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Local, Markdown, Rx, Tags
from stratafold.plans.checks import joined_by_connector
from stratafold.plans.records import TYPE_LABELS, TYPE_TAGS
from stratafold.plans.registry import query, with_
from stratafold.plans.state import relations

#: Process words with their tags; section titles that are no topics; names of the tag lists, of which the last
#: three stay empty; limits of the lists; reasons of a rule-based summary in the order in which they are tried.
PROCESS_WORDS = (("铸造", "铸造"), ("锻造", "锻造"), ("切削加工", "切削加工"), ("装配", "装配"), ("焊接", "焊接"), ("防腐", "防腐"), ("标记", "标记"), ("包装", "包装"), ("检验", "检验"), ("inspection", "检验"), ("packaging", "包装"))
NO_TOPICS = ("基本规定", "应用范围和目的", "范围", "scope", "application", "anwendungsbereich")
LISTS = ("文档类型标签", "文档主题标签", "工艺流程标签", "参数标签", "检验标签", "标准引用标签", "产品系列标签", "产品型号标签", "应用标签", "认证标签", "缺陷标签", "焊缝类型标签", "区域标签")
LIMITS = {"文档主题标签": 20, "参数标签": 30, "应用标签": 15}
NO_LLM, UNAVAILABLE, NO_MATERIAL, FAILED = "配置关闭LLM摘要生成", "LLM不可用：缺少可用的 OpenAI SDK 或 LLM_API_KEY", "结构化原料不足，跳过LLM摘要生成", "LLM摘要生成失败，已回退到规则摘要"


def symbol_heavy(d: Dialect, x: str) -> str:
    signal = d.replace_all(x, Rx("[^0-9A-Za-zÀ-ɏ一-鿿]"))
    return f"({x} = '' OR {d.search(x, Local.SYMBOL_NOISE_RE)} OR length({signal}) < 0.45 * length({x}))"


def localised(d: Dialect, texts: str) -> dict[str, str]:
    """The relation `loc` of the distinct texts of a query with one column txt: whether it is kept as it stands, whether it
    has an ideograph or too many symbols, and its phrase."""
    return {
        "loc0": f"SELECT DISTINCT txt FROM ({texts}) t WHERE txt IS NOT NULL AND txt <> ''",
        "loc1": d.pin("loc0", cjk=d.search("txt", Local.CJK_RE), short=f"(length(txt) <= 8 AND NOT contains(txt, ' ') AND {d.full('txt', Local.TECH_TOKEN_RE)})", heavy=symbol_heavy(d, "txt")),
        "loc": f"SELECT txt, cjk, heavy, cjk OR short AS kept, CASE WHEN cjk THEN txt ELSE {d.first_of('txt', Local.TRANSLATION_PATTERNS)} END AS phrase FROM loc1",
    }


def shown(d: Dialect, x: str, loc: str, prefix: str) -> str:
    """A text for display or a source field, from its row of `loc`."""
    return f"CASE WHEN {x} = '' THEN '' WHEN {loc}.kept THEN {x} WHEN {loc}.phrase <> '' AND {loc}.phrase <> {x} THEN concat({loc}.phrase, '（原文：', {x}, '）') ELSE concat({d.lit(prefix)}, '（原文：', {x}, '）') END"


def conditional(x: str, loc: str) -> str:
    return f"CASE WHEN {x} = '' THEN '' WHEN {loc}.kept THEN {x} WHEN {loc}.phrase <> '' AND {loc}.phrase <> {x} THEN concat({loc}.phrase, '条件（原文：', {x}, '）') ELSE concat('原文条件：', {x}) END"


def tagged(x: str, loc: str) -> str:
    return f"CASE WHEN {x} = '' OR {loc}.heavy THEN '' WHEN {loc}.cjk THEN {x} WHEN {loc}.phrase <> {x} THEN {loc}.phrase ELSE '' END"


def foreign(d: Dialect, x: str) -> str:
    return f"({x} <> '' AND NOT {d.search(x, Local.CJK_RE)} AND {d.search(x, Local.LATIN_RE)})"


def clipped(d: Dialect, x: str, n: int) -> str:
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE concat(rtrim(left({x}, {n})), '...') END"


def first_wins(table: str, keys: str, first: int | None = None) -> str:
    """Rows of a relation with ord: of its first `first` rows per document, the first of each key; place counts them."""
    head = f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS row_no FROM {table}"
    kept = f"SELECT *, row_number() OVER (PARTITION BY doc_id, {keys} ORDER BY ord) AS nth FROM ({head}) h" + (f" WHERE row_no <= {first}" if first else "")
    return f"SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS place FROM ({kept}) k WHERE nth = 1"


def entries(d: Dialect, given: dict[str, str] | None, *names: str) -> dict[str, str]:
    """Relations with normalised fields: e_sec, e_par, e_std, e_rul, e_prd, e_tab as far as they are named."""
    n = d.norm
    made = {
        "sec": f"SELECT doc_id, ord, {n('no')} AS no, {n('title')} AS title, level, {n('parent_no')} AS parent_no, body, {n('part')} AS part, {n(f'CASE WHEN left(no, 1) = {d.lit("U")} THEN title ELSE concat(no, {d.lit(" ")}, title) END')} AS heading, {n(f'concat(no, {d.lit(" ")}, title)')} AS ref FROM sec",
        "par": f"SELECT doc_id, ord, param_id, {n('name')} AS name, {n('value')} AS value, {n('unit')} AS unit, {n('lower')} AS lower, {n('upper')} AS upper, {n('comparator')} AS comparator, {n('cond')} AS cond, {n(f'CASE WHEN anchor <> {d.lit("")} THEN anchor ELSE section_ref END')} AS section_name, {n('table_no')} AS table_no, {n('source_item')} AS source_item FROM par",
        "std": f"SELECT doc_id, ord, {n('code')} AS code, {n('title')} AS title, {n(f'CASE WHEN family <> {d.lit("")} THEN family ELSE kind END')} AS family, {n(f'CASE WHEN anchor <> {d.lit("")} THEN anchor ELSE section_ref END')} AS section_name FROM std",
        "rul": f"SELECT doc_id, ord, rule_id, {n('rule_type')} AS rule_type, {n('content')} AS content, {n('cond')} AS cond, {n(f'CASE WHEN anchor <> {d.lit("")} THEN anchor ELSE section_ref END')} AS section_name FROM rul",
        "prd": f"SELECT doc_id, ord, product_id, {n('name')} AS name, {n('model')} AS model, {n('series')} AS series, {n(f'CASE WHEN anchor <> {d.lit("")} THEN anchor WHEN model <> {d.lit("")} THEN model WHEN name <> {d.lit("")} THEN name ELSE series END')} AS display FROM prd",
        "tab": f"SELECT doc_id, ord, table_no, {n('title')} AS title, {n('section_ref')} AS section_ref, n_cols, n_rows FROM tab",
    }
    return relations(d, given, *names) | {f"e_{k}": made[k] for k in names if k in made}


def value_display(d: Dialect) -> str:
    return "CASE WHEN value <> '' THEN value WHEN lower <> '' AND upper <> '' THEN concat(lower, ' ~ ', upper) WHEN comparator <> '' AND upper <> '' THEN concat(comparator, ' ', upper) WHEN lower <> '' THEN lower ELSE upper END"


def numeric(d: Dialect) -> dict[str, str]:
    """Items of the numeric summary, from e_par and loc."""
    look = lambda x, a: f"LEFT JOIN loc {a} ON p.{x} = {a}.txt"
    return {
        "num0": first_wins("e_par", "name, value, cond", 120),
        "num": f"SELECT p.doc_id, p.place, {shown(d, 'p.name', 'a', '参数项')} AS name, {value_display(d)} AS shown_value, p.value, CASE WHEN unit = '' THEN '未注明' ELSE unit END AS unit, {conditional('p.cond', 'b')} AS cond, {shown(d, 'p.section_name', 'c', '章节主题')} AS section_name, {shown(d, 'p.table_no', 'e', '来源表格')} AS source_table, {shown(d, 'p.source_item', 'f', '原文字段')} AS source_item FROM num0 p {look('name', 'a')} {look('cond', 'b')} {look('section_name', 'c')} {look('table_no', 'e')} {look('source_item', 'f')}",
    }


def ruled(d: Dialect) -> dict[str, str]:
    look = lambda x, a: f"LEFT JOIN loc {a} ON p.{x} = {a}.txt"
    kind = f"CASE WHEN p.rule_type = '' THEN '规则要求' ELSE {shown(d, 'p.rule_type', 'a', '规则项')} END"
    return {
        "rsum0": first_wins("e_rul", "rule_type, content, section_name", 100),
        "rsum1": f"SELECT p.doc_id, p.place, {kind} AS rule_type, p.content, {conditional('p.cond', 'b')} AS cond, {shown(d, 'p.section_name', 'c', '章节主题')} AS section_name FROM rsum0 p {look('rule_type', 'a')} {look('cond', 'b')} {look('section_name', 'c')}",
        "rsum": f"SELECT doc_id, place, rule_type, CASE WHEN {foreign(d, 'content')} THEN concat('已识别到与', rule_type, '相关的原文规则，当前细节仍以原文为准。') ELSE content END AS content, cond, section_name FROM rsum1",
    }


def chaptered(d: Dialect) -> dict[str, str]:
    """Summary of each of the first sixty sections: its body if that is Chinese, else its facts, else a note."""
    body = d.norm("body")
    few = lambda x, n, where="true": d.joined(d.head(d.list_in_order(x, "ord", where), n), "; ")
    return {
        "cp0": "SELECT *, row_number() OVER (PARTITION BY doc_id, section_name ORDER BY ord) AS nth FROM e_par WHERE section_name <> ''",
        "cp": f"SELECT doc_id, section_name, count(*) AS n_params, {few('concat(name, {0}, value)'.format(d.lit('=')), 4, 'nth <= 4 AND value <> ' + d.lit(''))} AS previews FROM cp0 GROUP BY doc_id, section_name",
        "cs": f"SELECT doc_id, section_name, {d.joined(d.head(d.list_in_order('code', 'ord'), 3), ', ')} AS codes FROM e_std WHERE section_name <> '' GROUP BY doc_id, section_name",
        "c0": f"SELECT * FROM (SELECT *, {body} AS flat, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS place FROM e_sec) s WHERE place <= 60",
        "c1": f"SELECT s.doc_id, s.place, s.ref, CASE WHEN l.phrase = '' AND NOT l.kept THEN heading ELSE {shown(d, 's.heading', 'l', '章节主题')} END AS title, {clipped(d, 'flat', 220)} AS flat FROM c0 s LEFT JOIN loc l ON s.heading = l.txt",
        "c2": f"""SELECT c.doc_id, c.place, c.title, c.flat, n_params, concat(CASE WHEN n_params IS NULL THEN '' WHEN previews <> '' THEN concat('已提取', n_params, '项参数（', previews, '）') ELSE concat('已提取', n_params, '项参数') END,
          CASE WHEN n_params IS NOT NULL AND codes IS NOT NULL THEN '；' ELSE '' END, CASE WHEN codes IS NULL THEN '' ELSE concat('引用标准：', codes) END) AS facts
          FROM c1 c LEFT JOIN cp ON c.doc_id = cp.doc_id AND c.ref = cp.section_name LEFT JOIN cs ON c.doc_id = cs.doc_id AND c.ref = cs.section_name""",
        "chs": f"SELECT doc_id, place, title, CASE WHEN flat <> '' AND NOT {foreign(d, 'flat')} THEN flat WHEN facts <> '' THEN concat('本章节围绕', title, '，', facts, '。') WHEN flat = '' THEN concat('当前仅稳定识别到', title, '，正文仍然较少。') ELSE concat('本章节主要围绕', title, '展开，已识别到原文正文，当前细节仍以原文为准。') END AS summary FROM c2",
    }


def standards_summed(d: Dialect) -> dict[str, str]:
    return {
        "ssum0": f"SELECT *, CASE WHEN title <> '' THEN title ELSE family END AS named FROM ({first_wins('e_std', 'code, section_name', 120)}) s",
        "ssum": f"SELECT p.doc_id, p.place, p.code, {shown(d, 'p.named', 'a', '标准标题')} AS overview, {shown(d, 'p.section_name', 'b', '章节主题')} AS section_name FROM ssum0 p LEFT JOIN loc a ON p.named = a.txt LEFT JOIN loc b ON p.section_name = b.txt",
    }


def texts_of(*columns: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {c} AS txt FROM {t}" for t, c in columns)


PARAMETER_TEXTS = (("e_par", "name"), ("e_par", "cond"), ("e_par", "section_name"), ("e_par", "table_no"), ("e_par", "source_item"))
RULE_TEXTS = (("e_rul", "rule_type"), ("e_rul", "cond"), ("e_rul", "section_name"))
STANDARD_TEXTS = (("e_std", "title"), ("e_std", "family"), ("e_std", "section_name"))


@query
def n10_n12_localised_texts(d, given=None):
    """Every parameter text as a source field, a condition, a heading and a tag."""
    names = "SELECT name AS txt FROM e_par UNION ALL SELECT cond AS txt FROM e_par UNION ALL SELECT heading AS txt FROM e_sec"
    return with_(
        entries(d, given, "par", "sec") | localised(d, names),
        f"SELECT txt, {shown(d, 'loc.txt', 'loc', '原文字段')} AS source_text, {conditional('loc.txt', 'loc')} AS condition_text, {shown(d, 'loc.txt', 'loc', '章节主题')} AS heading_text, {tagged('loc.txt', 'loc')} AS tag_text FROM loc",
    )


def fallbacks(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """(kind, txt): distinct texts that localisation could not leave as they stand, by what they were needed for."""
    kinds = {"显示": "SELECT heading AS txt FROM e_sec UNION ALL SELECT section_name AS txt FROM e_par", "来源": "SELECT name AS txt FROM e_par UNION ALL SELECT source_item AS txt FROM e_par", "条件": "SELECT cond AS txt FROM e_par", "标签": "SELECT title AS txt FROM e_sec"}
    every = " UNION ALL ".join(f"SELECT {d.lit(k)} AS kind, txt FROM ({q}) x" for k, q in kinds.items())
    return entries(d, given, "par", "sec") | {"need": every} | localised(d, "SELECT txt FROM need") | {
        "fall": f"SELECT DISTINCT n.kind, n.txt FROM need n JOIN loc ON n.txt = loc.txt WHERE CASE WHEN kind = {d.lit('标签')} THEN NOT cjk AND NOT heavy AND phrase <> '' AND phrase <> loc.txt ELSE NOT kept END"
    }


@query
def n13_fallback_detail(d, given=None):
    """Fallbacks by kind; a kind without any counts zero."""
    kinds = ", ".join(f"({d.lit(k)})" for k in ("显示", "来源", "条件", "标签"))
    return with_(fallbacks(d, given) | {"kinds": f"SELECT * FROM (VALUES {kinds}) AS v(kind)"}, "SELECT k.kind, count(f.txt) AS n_texts FROM kinds k LEFT JOIN fall f ON k.kind = f.kind GROUP BY k.kind")


@query
def n13_fallback_total(d, given=None):
    return with_(fallbacks(d, given), "SELECT count(*) AS n_texts FROM fall")


@query
def m05_chapter_summaries(d, given=None):
    return with_(entries(d, given, "sec", "par", "std") | localised(d, "SELECT heading AS txt FROM e_sec") | chaptered(d), "SELECT doc_id, place, title, summary FROM chs")


@query
def m06_m11_m12_numeric_summary(d, given=None):
    return with_(
        entries(d, given, "par") | localised(d, texts_of(*PARAMETER_TEXTS)) | numeric(d),
        "SELECT doc_id, place, name, shown_value, unit, cond, section_name, source_table, source_item, CASE WHEN cond <> '' THEN concat(name, '在', cond, '条件下取值为', value, '。') ELSE concat(name, '取值为', value, '。') END AS overview FROM num",
    )


@query
def m07_rule_summary(d, given=None):
    return with_(entries(d, given, "rul") | localised(d, texts_of(*RULE_TEXTS)) | ruled(d), "SELECT doc_id, place, rule_type, content, cond, section_name FROM rsum")


def required(d: Dialect) -> dict[str, str]:
    """Requirements: the first sixty rules, or notes on the first twenty sections of a document without a rule."""
    return {
        "note0": f"SELECT s.*, {clipped(d, 'flat', 180)} AS note FROM (SELECT *, {d.norm('body')} AS flat, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS place FROM e_sec) s LEFT JOIN (SELECT DISTINCT doc_id AS ruled_id FROM rsum) r ON s.doc_id = r.ruled_id WHERE ruled_id IS NULL AND place <= 20 AND flat <> ''",
        "req": f"SELECT doc_id, place, rule_type, content, cond, section_name FROM rsum WHERE place <= 60 UNION ALL SELECT n.doc_id, CAST(row_number() OVER (PARTITION BY n.doc_id ORDER BY n.place) AS BIGINT) AS place, '章节说明' AS rule_type, CASE WHEN {foreign(d, 'note')} THEN '本章节已识别到原文说明，当前细节仍以原文为准。' ELSE note END AS content, '' AS cond, {shown(d, 'n.heading', 'l', '章节主题')} AS section_name FROM note0 n LEFT JOIN loc l ON n.heading = l.txt",
    }


@query
def m08_requirement_summary(d, given=None):
    return with_(entries(d, given, "rul", "sec") | localised(d, texts_of(*RULE_TEXTS, ("e_sec", "heading"))) | ruled(d) | required(d), "SELECT doc_id, place, rule_type, content, cond, section_name FROM req")


@query
def m09_standard_summary(d, given=None):
    return with_(entries(d, given, "std") | localised(d, texts_of(*STANDARD_TEXTS)) | standards_summed(d), "SELECT doc_id, place, code, overview, section_name FROM ssum")


@query
def m10_product_summary(d, given=None):
    """The first forty products of a document."""
    both = "SELECT *, CASE WHEN name <> '' THEN name WHEN display <> '' THEN display ELSE series END AS n1, CASE WHEN display <> '' THEN display WHEN name <> '' THEN name ELSE series END AS n2, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS place FROM e_prd"
    return with_(
        entries(d, given, "prd") | {"p0": both} | localised(d, "SELECT n1 AS txt FROM p0 UNION ALL SELECT n2 AS txt FROM p0"),
        f"SELECT p.doc_id, place, {shown(d, 'p.n1', 'a', '产品项')} AS name, p.model, {shown(d, 'p.n2', 'b', '产品说明')} AS overview FROM p0 p LEFT JOIN loc a ON p.n1 = a.txt LEFT JOIN loc b ON p.n2 = b.txt WHERE place <= 40",
    )


def summarised(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """`wholes`: the sentence of a document and the sizes of its summary's parts."""
    few = lambda x, n, by, where="true": d.joined(d.list_in_order(x, "place", f"place <= {n} AND {where}"), by)
    per = lambda cols, t: f"SELECT doc_id, {cols} FROM {t} GROUP BY doc_id"
    label = "CASE doc_type " + " ".join(f"WHEN {d.lit(k)} THEN {d.lit(v)}" for k, v in TYPE_LABELS.items()) + " ELSE '技术资料' END"
    parts = entries(d, given, "doc", "sec", "par", "std", "rul", "prd", "tab") | localised(d, texts_of(*PARAMETER_TEXTS, *RULE_TEXTS, *STANDARD_TEXTS, ("e_sec", "heading")))
    return parts | chaptered(d) | numeric(d) | ruled(d) | required(d) | standards_summed(d) | {
        "q1": per(f"count(*) AS n_chap, {few('title', 8, ' 、')} AS titles", "chs"),
        "q2": per(f"count(*) AS n_num, {few('concat(name, {0}, shown_value)'.format(d.lit('=')), 6, ', ', 'shown_value <> ' + d.lit(''))} AS previews", "num"),
        "q3": per(f"count(*) AS n_std, {few('code', 6, ', ')} AS codes", "ssum"),
        "q4": per("count(*) AS n_tab", "tab"),
        "q5": per("count(*) AS n_req", "req"),
        "q6": per("count(*) AS n_rul", "rsum"),
        "wholes": f"""SELECT doc.doc_id, coalesce(n_chap, 0) AS n_chap, coalesce(n_num, 0) AS n_num, coalesce(n_std, 0) AS n_std, coalesce(n_rul, 0) AS n_rul, coalesce(n_req, 0) AS n_req,
          CASE WHEN needs_ocr AND line_count = 0 THEN concat('《', CASE WHEN title <> '' THEN title ELSE file_name END, '》文本层极弱，当前更像扫描件或图片型 PDF，建议先进行 OCR 后再做稳定抽取。')
          ELSE concat('《', CASE WHEN title <> '' THEN title ELSE file_name END, '》是一份', {label}, '，', CASE WHEN n_chap > 0 THEN concat('已建立 ', n_chap, ' 个正文章节摘要（包括：', titles, '）。') WHEN n_tab > 0 THEN concat('当前尚未稳定建立章节链，但已抽取 ', n_tab, ' 张表格。') ELSE '' END,
            CASE WHEN n_num > 0 AND previews <> '' THEN concat('已抽取 ', n_num, ' 条数值型参数（如 ', previews, ' 等）。') WHEN n_num > 0 THEN concat('已抽取 ', n_num, ' 条数值型参数。') ELSE '' END,
            CASE WHEN n_std > 0 THEN concat('已识别 ', n_std, ' 条引用标准（包括 ', codes, ' 等）。') ELSE '' END, CASE WHEN needs_ocr THEN '文档文本层偏弱，后续结果需要关注 OCR 补强。' ELSE '' END) END AS sentence
          FROM doc LEFT JOIN q1 ON doc.doc_id = q1.doc_id LEFT JOIN q2 ON doc.doc_id = q2.doc_id LEFT JOIN q3 ON doc.doc_id = q3.doc_id LEFT JOIN q4 ON doc.doc_id = q4.doc_id LEFT JOIN q5 ON doc.doc_id = q5.doc_id LEFT JOIN q6 ON doc.doc_id = q6.doc_id""",
    }


@query
def m04_full_summary(d, given=None):
    return with_(summarised(d, given), "SELECT doc_id, sentence FROM wholes")


@query
def m03_rule_based_summary(d, given=None):
    """The parts of a rule-based summary; products belong to catalogues only."""
    return with_(
        summarised(d, given) | {"np": "SELECT doc_id, count(*) AS n_products FROM prd GROUP BY doc_id"},
        f"SELECT f.doc_id, {d.sha256('sentence')} AS sentence_sha, n_chap, n_num, n_rul, n_req, n_std, CASE WHEN doc_type = 'product_catalog' THEN least(40, coalesce(n_products, 0)) ELSE 0 END AS n_products FROM wholes f JOIN doc ON f.doc_id = doc.doc_id LEFT JOIN np ON f.doc_id = np.doc_id",
    )


def material(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """Documents with a section, parameter, rule, standard or table: enough to ask a model for a summary."""
    every = " UNION ".join(f"SELECT doc_id FROM {t}" for t in ("sec", "par", "rul", "std", "tab"))
    return relations(d, given, "doc", "sec", "par", "rul", "std", "tab") | {"mat": f"SELECT DISTINCT doc_id FROM ({every}) m"}


@query
def f28_enough_material(d, given=None):
    return with_(material(d, given), "SELECT doc.doc_id, mat.doc_id IS NOT NULL AS enough FROM doc LEFT JOIN mat ON doc.doc_id = mat.doc_id")


@query
def m02_summary_dispatch(d, given=None):
    """Why a summary is rule-based, or that a model writes it."""
    return with_(
        material(d, given),
        f"SELECT doc.doc_id, CASE WHEN NOT use_llm THEN {d.lit(NO_LLM)} WHEN NOT llm_available THEN {d.lit(UNAVAILABLE)} WHEN mat.doc_id IS NULL THEN {d.lit(NO_MATERIAL)} WHEN llm_failed THEN {d.lit(FAILED)} ELSE '' END AS reason, use_llm AND llm_available AND mat.doc_id IS NOT NULL AND NOT llm_failed AS by_model FROM doc LEFT JOIN mat ON doc.doc_id = mat.doc_id",
    )


def keep_topic(d: Dialect, x: str) -> str:
    return f"(NOT {symbol_heavy(d, x)} AND NOT {d.one_of(f'lower({x})', NO_TOPICS)} AND NOT {d.full(x, Rx(r'(?:SN|DIN|ISO|EN)\s*\d+(?:[-/]\d+)?', True))} AND length({x}) BETWEEN 2 AND 60)"


def keep_parameter_tag(d: Dialect, x: str) -> str:
    tokens = d.norm(f"replace(replace({x}, '/', ' '), '-', ' ')")
    dimensions = Rx(r"(?:DN|d\d+\)?|l\d+|s\d*|b|h|w)(?: (?:DN|d\d+\)?|l\d+|s\d*|b|h|w))*", True)
    return f"({x} <> '' AND length({x}) <= 40 AND NOT {d.search(x, Tags.NUMBER_HEAVY_RE)} AND NOT {d.full(x, Tags.LOW_SIGNAL_PARAMETER_RE)} AND NOT ({d.search(x, Tags.ABBREV_HEAVY_RE)} AND {d.words(x)} >= 3) AND NOT {d.full(tokens, dimensions)} AND NOT {joined_by_connector(d, x)})"


def parameter_tag(d: Dialect, x: str) -> str:
    """The group of a parameter name, or the name without brackets and closing signs."""
    bare = d.replace_all(d.replace_all(x, Rx("[()]+")), Rx("^[ /:;,.-]+|[ /:;,.-]+$"))
    return d.first_of(x, Tags.PARAMETER_TAG_PATTERNS, bare)


@query
def f26_m25_topics(d, given=None):
    """Section and table titles as topics: '' where a title is none."""
    titles = "SELECT title AS txt FROM e_sec UNION ALL SELECT title AS txt FROM e_tab"
    return with_(entries(d, given, "sec", "tab") | localised(d, titles), f"SELECT txt, {keep_topic(d, 'txt')} AS kept, CASE WHEN {keep_topic(d, 'txt')} THEN {tagged('loc.txt', 'loc')} ELSE '' END AS topic FROM loc")


@query
def f27_m26_parameter_tag_names(d, given=None):
    return with_(entries(d, given, "par") | {"n": f"SELECT DISTINCT name, {parameter_tag(d, 'name')} AS tag FROM e_par"}, f"SELECT name, tag, {keep_parameter_tag(d, 'tag')} AS kept FROM n")


def pooled(d: Dialect) -> dict[str, str]:
    """`pool`: titles of sections and tables and the first ten body lines of each section, in order."""
    lines = d.rows("e_sec", d.split("body", "\n"), "raw", "i", "doc_id, ord, i, raw")
    said = f"SELECT doc_id, 0 AS origin, ord, -1 AS i, title AS txt FROM e_sec UNION ALL SELECT doc_id, 0, ord, i, {d.norm('raw')} FROM ({lines}) l WHERE i < 10 UNION ALL SELECT doc_id, 1, ord, 0, title FROM e_tab"
    return {"pool": f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY origin, ord, i) AS place, txt FROM ({said}) p WHERE txt <> ''"}


@query
def m24_text_pool(d, given=None):
    return with_(entries(d, given, "sec", "tab") | pooled(d), "SELECT doc_id, CAST(place AS BIGINT) AS place, txt FROM pool")


def tag_rows(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """`tags`: (doc_id, list, place, tag) of all lists, every tag of a list once, at its first place."""
    parts = entries(d, given, "doc", "sec", "par", "std", "prd", "tab", "ins") | pooled(d)
    parts |= {
        "hint": f"SELECT doc_id, place, {d.norm(d.extract('txt', Tags.APPLICATION_HINT_RE, 1))} AS txt FROM pool WHERE {d.search('txt', Tags.APPLICATION_HINT_RE)}",
        "e_ins": f"SELECT doc_id, ord, {d.norm('method')} AS method FROM ins",
        "raws": f"SELECT doc_id, {d.norm('raw_type')} AS raw_type FROM doc",
    }
    parts |= localised(d, texts_of(("e_sec", "title"), ("e_tab", "title"), ("hint", "txt"), ("e_ins", "method"), ("raws", "raw_type")))
    kind = lambda i: "CASE doc_type " + " ".join(f"WHEN {d.lit(k)} THEN {d.lit(v[i])}" for k, v in TYPE_TAGS.items()) + f" ELSE {d.lit(TYPE_TAGS['unknown'][i])} END"
    process = d.array([f"CASE WHEN contains(txt, {d.lit(w)}) THEN {d.lit(t)} ELSE '' END" for w, t in PROCESS_WORDS])
    family = f"CASE WHEN {d.match('code', Tags.STANDARD_FAMILY_RE)} THEN upper({d.extract('code', Tags.STANDARD_FAMILY_RE, 1)}) ELSE family END"
    series = d.replace_all(d.replace_all("series", Tags.SERIES_NOISE_RE), Rx("^[ /-]+|[ /-]+$"))
    named = f"CASE WHEN loc.phrase <> '' OR loc.cjk THEN {tagged('h.txt', 'loc')} ELSE '' END"
    rows = {
        0: f"SELECT doc_id, 0 AS place, {kind(0)} AS tag FROM doc UNION ALL SELECT doc_id, 1, {kind(1)} FROM doc UNION ALL SELECT doc_id, 2, '疑似扫描件' FROM doc WHERE needs_ocr UNION ALL SELECT r.doc_id, 3, {tagged('r.raw_type', 'loc')} FROM raws r JOIN loc ON r.raw_type = loc.txt",
        1: " UNION ALL ".join(f"SELECT s.doc_id, {base} + nth AS place, CASE WHEN {keep_topic(d, 's.title')} THEN {tagged('s.title', 'loc')} ELSE '' END AS tag FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS nth FROM {t}) s JOIN loc ON s.title = loc.txt WHERE nth <= {most}" for t, most, base in (("e_sec", 30, 0), ("e_tab", 20, 100))),
        2: f"SELECT doc_id, i AS place, tag FROM ({d.rows(f'(SELECT doc_id, lower({d.join_in_order("txt", "place")}) AS txt FROM pool GROUP BY doc_id) w', process, 'tag', 'i', 'doc_id, i, tag')}) x",
        3: f"SELECT doc_id, ord AS place, CASE WHEN {keep_parameter_tag(d, 'tag')} THEN tag ELSE '' END AS tag FROM (SELECT doc_id, ord, {parameter_tag(d, 'name')} AS tag FROM e_par) n",
        4: f"SELECT i.doc_id, ord AS place, CASE WHEN length({tagged('i.method', 'loc')}) <= 40 THEN {tagged('i.method', 'loc')} ELSE '' END AS tag FROM (SELECT * FROM e_ins WHERE method <> '') i JOIN loc ON i.method = loc.txt",
        5: f"SELECT doc_id, ord AS place, {family} AS tag FROM e_std",
        6: f"SELECT doc_id, ord AS place, {series} AS tag FROM e_prd",
        7: "SELECT doc_id, ord AS place, model AS tag FROM e_prd",
        8: f"SELECT h.doc_id, place, CASE WHEN length({named}) BETWEEN 2 AND 60 THEN {named} ELSE '' END AS tag FROM hint h JOIN loc ON h.txt = loc.txt",
        9: f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place, i) AS place, upper(found) AS tag FROM ({d.rows('pool', d.extract_all('txt', Tags.CERTIFICATION_RE, 0), 'found', 'i', 'doc_id, place, i, found')}) c",
    }
    every = " UNION ALL ".join(f"SELECT {i} AS list_no, {d.lit(LISTS[i])} AS list, doc_id, CAST(place AS BIGINT) AS place, tag FROM ({q}) q{i}" for i, q in rows.items())
    limits = "CASE list " + " ".join(f"WHEN {d.lit(k)} THEN {v}" for k, v in LIMITS.items()) + " ELSE 1000000000 END"
    return parts | {
        "tag0": f"SELECT list_no, list, doc_id, tag, min(place) AS place FROM ({every}) e WHERE tag <> '' GROUP BY list_no, list, doc_id, tag",
        "tag1": "SELECT list_no, list, doc_id, tag, CAST(row_number() OVER (PARTITION BY doc_id, list_no ORDER BY place) AS BIGINT) AS place FROM tag0",
        "tags": f"SELECT * FROM tag1 WHERE place <= {limits}",
    }


@query
def m13_all_tags(d, given=None):
    return with_(tag_rows(d, given), "SELECT doc_id, list, place, tag FROM tags")


def _list_query(name: str, i: int) -> None:
    def build(d, given=None):
        return with_(tag_rows(d, given), f"SELECT doc_id, place, tag FROM tags WHERE list_no = {i}")

    build.__name__, build.__doc__ = name, f"The tags of one list: {LISTS[i]}."
    query(build)


for _i, _name in enumerate(("m14_type_tags", "m15_topic_tags", "m16_process_tags", "m17_parameter_tag_list", "m18_inspection_tags", "m19_standard_tag_list", "m20_series_tags", "m21_model_tags", "m22_application_tags", "m23_certification_tags")):
    _list_query(_name, _i)


def rendered(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """`out`: the parts of a document's Markdown in order: title and file information, parts when they change, headings two
    levels below their own, bodies, tables under their sections, standards. A part that ends in a line break is followed by
    a blank line."""
    n = d.norm
    lines = d.rows("sec", d.split("body", "\n"), "raw", "i", "doc_id, ord, i, raw")
    dull = " OR ".join(d.full("title", p) for p in (Markdown.SYNTHETIC_TABLE_TITLE_RE, Markdown.LOW_SIGNAL_TABLE_TITLE_RE, Markdown.COMMA_FRAGMENT_TABLE_TITLE_RE))
    label = "CASE doc_type " + " ".join(f"WHEN {d.lit(k)} THEN {d.lit(v)}" for k, v in TYPE_LABELS.items()) + " ELSE '技术资料' END"
    brk = d.lit("\n")
    part_before = "last_value(CASE WHEN part <> '' THEN part END) IGNORE NULLS OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" if d.name == "spark" else "last_value(CASE WHEN part <> '' THEN part END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    info = " , ".join(f"{d.lit('- ' + k + '：')}, {v}, {brk}" for k, v in {"文件名称": "file_name", "文档类型": label, "标准编号": "std_code", "版本日期": "version", "适用范围": "scope"}.items())
    return entries(d, given, "doc", "sec", "tab", "std") | relations(d, given, "cel") | {
        "mb0": f"SELECT doc_id, ord, i, {n('raw')} AS line FROM ({lines}) l",
        "mb": f"SELECT doc_id, ord, {d.join_in_order('line', 'i')} AS clean FROM mb0 WHERE line <> '' GROUP BY doc_id, ord",
        "mt0": "SELECT t.doc_id, s.ord AS sec_ord, t.ord, t.title FROM e_tab t JOIN e_sec s ON t.doc_id = s.doc_id AND t.section_ref = s.ref AND t.section_ref <> ''",
        "mt": f"SELECT *, title <> '' AND NOT ({dull}) AND row_number() OVER (PARTITION BY doc_id, sec_ord, lower(title) ORDER BY ord) = 1 AS named FROM mt0",
        "ms0": f"SELECT s.doc_id, s.ord, s.no, s.title, s.heading, s.part, coalesce({part_before}, '') AS part_before, least(greatest(level, 1) + 2, 6) AS depth FROM e_sec s",
        "ms1": "SELECT m.*, coalesce(clean, '') AS clean, t.sec_ord IS NOT NULL AS same_table FROM ms0 m LEFT JOIN mb ON m.doc_id = mb.doc_id AND m.ord = mb.ord LEFT JOIN (SELECT DISTINCT doc_id AS tab_doc, sec_ord, lower(title) AS low FROM mt WHERE title <> '') t ON m.doc_id = t.tab_doc AND m.ord = t.sec_ord AND lower(m.title) = t.low",
        "ms": "SELECT *, left(no, 1) = 'U' AND clean = '' AND same_table AS hidden FROM ms1",
        "mc0": f"SELECT doc_id, ord, row_idx, {d.list_in_order('cell', 'col_idx')} AS row_cells FROM cel GROUP BY doc_id, ord, row_idx",
        "mc1": f"SELECT *, max(CASE WHEN row_idx = 0 THEN {d.size('row_cells')} END) OVER (PARTITION BY doc_id, ord) AS width FROM mc0",
        "mc2": f"SELECT doc_id, ord, row_idx, width, concat('| ', {d.joined('slice(row_cells, 1, CAST(width AS INT))' if d.name == 'spark' else 'row_cells[1:width]', ' | ')}, repeat(' | ', CAST(greatest(0, width - {d.size('row_cells')}) AS INT)), ' |') AS txt FROM mc1 WHERE width > 0",
        "mc": f"SELECT doc_id, ord, {d.join_in_order('txt', 'row_idx')} AS grid FROM (SELECT doc_id, ord, row_idx * 2 AS row_idx, txt FROM mc2 UNION ALL SELECT doc_id, ord, 1, concat('| ', repeat('--- | ', CAST(width - 1 AS INT)), '--- |') FROM mc2 WHERE row_idx = 0) g GROUP BY doc_id, ord",
        "out": f"""SELECT doc_id, 0 AS k1, 0 AS k2, concat('# ', CASE WHEN title <> '' THEN title ELSE file_name END, {brk}, {brk}, '## 文件基础信息', {brk}, {info}) AS txt FROM doc
          UNION ALL SELECT doc_id, ord, 1, concat('## ', part, {brk}) FROM ms WHERE part <> '' AND part <> part_before
          UNION ALL SELECT doc_id, ord, 2, concat(repeat('#', CAST(depth AS INT)), ' ', heading, {brk}) FROM ms WHERE NOT hidden
          UNION ALL SELECT doc_id, ord, 3, concat(clean, {brk}) FROM ms WHERE clean <> ''
          UNION ALL SELECT t.doc_id, t.sec_ord, 10 + 2 * t.ord, concat(repeat('#', CAST(least(m.depth + 1, 6) AS INT)), ' ', t.title, {brk}) FROM mt t JOIN ms m ON t.doc_id = m.doc_id AND t.sec_ord = m.ord WHERE t.named AND (m.hidden OR lower(t.title) <> lower(m.title))
          UNION ALL SELECT t.doc_id, t.sec_ord, 11 + 2 * t.ord, concat(grid, {brk}) FROM mt t JOIN mc ON t.doc_id = mc.doc_id AND t.ord = mc.ord
          UNION ALL SELECT DISTINCT doc_id, 1000000000, 0, concat('## 引用标准', {brk}) FROM e_std WHERE code <> ''
          UNION ALL SELECT doc_id, 1000000000, place, CASE WHEN title = '' OR title = code THEN concat('- ', code) ELSE concat('- ', code, '：', title) END FROM ({first_wins('(SELECT * FROM e_std WHERE code <> {0}) z'.format(d.lit('')), 'code')}) c""",
    }


@query
def m01_document_markdown(d, given=None):
    """The Markdown of a document."""
    text = d.join_in_order("txt", "nth")
    return with_(rendered(d, given) | {"seq": "SELECT doc_id, txt, row_number() OVER (PARTITION BY doc_id ORDER BY k1, k2) AS nth FROM out"}, f"SELECT doc_id, concat({d.replace_all(text, Rx('^[' + chr(92) + 's]+|[' + chr(92) + 's]+$'))}, {d.lit(chr(10))}) AS markdown FROM seq GROUP BY doc_id")


@query
def c04_clean_bodies(d, given=None):
    return with_(rendered(d, given), "SELECT doc_id, ord, clean FROM mb")


@query
def f24_table_headings(d, given=None):
    return with_(rendered(d, given), "SELECT doc_id, sec_ord, ord, title, named FROM mt")


@query
def f25_hidden_section_headings(d, given=None):
    return with_(rendered(d, given), "SELECT doc_id, ord, no, title, hidden FROM ms")
