"""Relations of structured documents, as the review, summary, tag, record and export plans take them.

A plan names these relations and nothing else, so it runs over any source of them: `state` derives them from the given star
schema (customers are documents; their orders carry parameters, standards, rules, inspections, products and tables), and
tests hand in rows of their own. An absent value is an empty text.
"""

from __future__ import annotations

from stratafold.functions.dialect import Dialect

#: Derived documents whose Markdown, at most 22 lines each, and whose facts one task sorts.
DOCUMENTS_OF_TASK = 10_000
#: Orders of whose parameters one task holds the distinct ones.
ORDERS_OF_TASK = 100_000
#: Columns of every relation, in order.
COLUMNS = {
    "doc": "doc_id, title, file_name, doc_type, raw_type, std_code, version, scope, needs_ocr, line_count, chars_per_page, llm_backend, llm_reason, log_reason, llm_called, quarantined, quarantine_reason, full_summary, ocr_partial, ocr_done, ocr_target, use_llm, llm_available, llm_failed, confidence_pct",
    "sec": "doc_id, ord, no, title, level, parent_no, body, part",
    "par": "doc_id, ord, param_id, name, value, unit, lower, upper, comparator, cond, section_ref, anchor, table_no, source_item",
    "std": "doc_id, ord, code, title, kind, family, section_ref, anchor",
    "rul": "doc_id, ord, rule_id, rule_type, content, cond, section_ref, anchor",
    "ins": "doc_id, ord, object, method, requirement, certificate, section_ref",
    "prd": "doc_id, ord, product_id, name, model, series, anchor",
    "tab": "doc_id, ord, table_no, title, section_ref, n_cols, n_rows",
    "pg": "doc_id, page_no, text, ocr_run, ocr_injected",
    "md": "doc_id, line_no, line",
    "tag": "doc_id, list, ord, tag",
    "chap": "doc_id, ord, title, summary",
    "cel": "doc_id, ord, row_idx, col_idx, cell",
    "blk": "doc_id, ord, kind, title, content, part, section_ref, page_no",
    "rnd": "doc_id, round_no, ocr_run, engine, dpi, target, recognised, passed, marginal, rejected, injected, millis, failure",
}


#: Columns that are no text.
KINDS = {
    "long": "doc_id ord row_idx col_idx level line_count chars_per_page ocr_done ocr_target confidence_pct n_cols n_rows page_no line_no round_no dpi target recognised passed marginal rejected injected millis".split(),
    "boolean": "needs_ocr llm_called quarantined ocr_partial use_llm llm_available llm_failed ocr_run ocr_injected".split(),
}


def schema(relation: str, doc_id: str = "long") -> str:
    """Schema of a relation; doc_id may be of another type."""
    kind = {c: k for k, columns in KINDS.items() for c in columns} | {"doc_id": doc_id}
    return ", ".join(f"{c} {kind.get(c, 'string')}" for c in COLUMNS[relation].split(", "))


def empty(spark, relation: str, doc_id: str = "long"):
    return spark.createDataFrame([], schema(relation, doc_id))


def pick(d: Dialect, key: str, *values: str) -> str:
    """One of the values (SQL expressions) by the remainder of a whole number."""
    n = len(values)
    return f"CASE ({key}) % {n} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1])) + f" ELSE {values[-1]} END"


def texts(d: Dialect, key: str, *values: str) -> str:
    return pick(d, key, *map(d.lit, values))


_MARKDOWN = (
    "# Type sheet", "## 文件基础信息", "- name: 公称压力", "## 1 Scope", "公称压力 and 温度 of the flange", "| a | b |", "### 第3页表1", "### AB", "### It is used.", "表 2 连接尺寸", "### 12345 XZ",
    "### 2019 12 34", "line of text", "GB/T 101-1999 对照表", "#### 断裂。", "### 99,5 mm", "### CD", "### EF", "### As given;", "### It is old.", "### 450 bar 77", "closing line",
)
_TAGS = (
    ("参数标签", "压力"), ("参数标签", "a b c"), ("参数标签", "1. 2. 3."), ("参数标签", "length for valves and pipes"), ("文档主题标签", "本标准规定为船舶管路法兰所选用的垫片和填料的基本要求、检验方法和包装以及标志等内容"),
    ("标准引用标签", "DIN"), ("产品型号标签", "AB-100"), ("检验标签", "Operating pressure of 20 bar, tested"), ("认证标签", "CE"), ("文档主题标签", "密封面"),
)


def state(d: Dialect, every: bool = False) -> dict[str, str]:
    """All relations over the given tables. Every order is a record of one kind: a parameter, standard, rule, inspection, table
    or product; if `every`, it is a record of every kind."""
    k, o, both = "c_custkey", "o_orderkey", "o_orderkey + o_custkey"
    per = lambda n: d.rows("(SELECT c_custkey FROM customer) c", d.series(n), "n")
    of_order = lambda cols, where, dealt="": f"SELECT {dealt}o_custkey AS doc_id, o_orderkey AS ord, {cols} FROM orders" + (f" WHERE {where}" if not every else "")
    marked = lambda values, value, index: d.rows("(SELECT c_custkey FROM customer) c", d.array([d.lit(v) for v in values]), value, index)
    return {
        "doc": f"""SELECT {d.dealt('customer', DOCUMENTS_OF_TASK, 'doc_id')}{k} AS doc_id, {pick(d, k, d.lit('法兰连接尺寸 选用'), d.lit('Seal ring catalogue'), f"concat('GB/T ', 100 + {k} % 40, '-1999 垫片')", d.lit(''), d.lit('管法兰用填料'), f"concat('Type sheet ', {k})")} AS title,
          {pick(d, k + ' + 1', f"concat('CB_T ', 100 + {k} % 40, '-1999.pdf')", f"concat('sheet-', {k}, '.pdf')", f"concat('GB ', 100 + {k} % 40, '-1999.pdf')", "''")} AS file_name,
          {texts(d, k, 'standard', 'product_catalog', 'manual', 'report', 'unknown')} AS doc_type, {texts(d, k, '标准', 'Inspection report', '')} AS raw_type, {texts(d, k, 'DIN EN 10025-2', '')} AS std_code, {texts(d, k, '2019-05', '', 'May 2001')} AS version, {texts(d, k, '', '适用于法兰。')} AS scope,
          {k} % 7 = 0 AS needs_ocr, CAST(({k} % 9) * 20 AS BIGINT) AS line_count, CAST(({k} % 11) * 8 AS BIGINT) AS chars_per_page, {texts(d, k, 'responses', '', '', '')} AS llm_backend,
          {texts(d, k, '配置关闭LLM摘要生成', '', 'timeout', 'LLM不可用：缺少密钥', '')} AS llm_reason, {texts(d, k, '结构化原料不足，跳过LLM摘要生成', '', '')} AS log_reason, {k} % 6 <> 5 AS llm_called, {k} % 13 = 0 AS quarantined, {texts(d, k, '文件名与正文标准号不一致', '')} AS quarantine_reason,
          {texts(d, k, '《A》当前识别为标准。已建立 5 个章节。', '文本层极弱，建议先进行 OCR 后再做稳定抽取。', '本文件规定了法兰密封面的要求和试验方法。', '', '已抽取 3 条参数。已识别 2 条标准。', '文档可提取内容极少。', 'OCR 结果待补', '已抽取 3 条参数，应按要求试验。')} AS full_summary,
          {k} % 10 = 0 AS ocr_partial, CAST({k} % 3 AS BIGINT) AS ocr_done, CAST({k} % 4 AS BIGINT) AS ocr_target, {k} % 2 = 0 AS use_llm, {k} % 4 = 0 AS llm_available, {k} % 8 = 0 AS llm_failed, CAST(35 + {k} % 60 AS BIGINT) AS confidence_pct FROM customer""",
        "sec": f"""SELECT {k} AS doc_id, n AS ord, CASE WHEN ({k} + n) % 5 = 0 THEN concat('U', n) ELSE concat(n, '') END AS no, {texts(d, f'{k} + n', '范围', 'Scope', '密封面要求', 'Page 3', 'Materials and design', 'DN', 'Test requirements: 20 bar', '附录 A', 'Geltungsbereich und Zweck', '范围：')} AS title,
          1 + n % 3 AS level, CASE WHEN n % 3 = 0 THEN '' ELSE concat(n - n % 3, '') END AS parent_no, {texts(d, f'{k} + 2 * n', '', '本标准适用于法兰密封面。' + chr(10) + '范围见表 1。', 'This part shall be tested at 20 bar.' + chr(10) + 'It is used for pipes.', '应按 GB/T 101-1999 检验。', 'Weight and length.' + chr(10) + 'Weight and length.' + chr(10) + 'Application: pumps, CE and ATEX marked', '焊接与包装：见用途: 船舶管路')} AS body, {texts(d, k, '', 'Part 1')} AS part FROM ({per(6)}) s WHERE n <= {k} % 7""",
        "par": of_order(
            f"""{pick(d, o, "''", f"concat('P', {o})")} AS param_id, {texts(d, o, 'Width', 'operating pressure', '重量', '发布日期', 'Nenngröße', 'GB 100-1999', 'd1', 'length for valves and pipes', 'Weight (kg)', '温度', 'Brand name -')} AS name, {texts(d, f'{o} + {o} % 5', '12', '5 ~ 10', '', '2019-05-01', '≤ 3', 'GB 150-1998', '012345', ' 7  8 ')} AS value,
            {texts(d, o, 'mm', 'bar', 'UM', '', '°C', 'N/mm²')} AS unit, {texts(d, o, '', '5')} AS lower, {texts(d, o, '', '10', '')} AS upper, {texts(d, o, '', '≤', '')} AS comparator, {texts(d, o, '', 'for AB-100 valves', '温度 20', 'dry')} AS cond, {texts(d, o, '1 Scope', '2 密封面要求', '', '4 Materials and design')} AS section_ref,
            {texts(d, o, '', '2 密封面要求', '')} AS anchor, {texts(d, o, '', '第2页_表1', 'Table 2')} AS table_no, {texts(d, o, 'Width', 'Weight', 'd1', '前言', '')} AS source_item""",
            f"{o} % 7 < 2",
            d.dealt("orders", ORDERS_OF_TASK, "doc_id"),
        ),
        "std": of_order(f"{texts(d, o, 'DIN EN 10025-2', 'GB/T 101-1999', 'ISO 9001', 'XX 12', ' ', 'GB 101-1999')} AS code, {texts(d, o, 'Hot rolled products', '垫片', '')} AS title, {texts(d, o, 'DIN', 'GB', '其他标准')} AS kind, {texts(d, o, '', 'GB')} AS family, {texts(d, o, '1 Scope', '', '2 密封面要求')} AS section_ref, {texts(d, o, '', '文档')} AS anchor", f"{o} % 7 = 2"),
        "rul": of_order(f"{pick(d, o, chr(39) * 2, 'concat(' + d.lit('R') + f', {o})')} AS rule_id, {texts(d, both, '检验', 'packaging', 'Welding', '')} AS rule_type, {texts(d, both, '应进行水压试验。', 'Parts shall be packed dry.', '焊接应符合要求。')} AS content, {texts(d, both, '', 'dry', '低温')} AS cond, {texts(d, both, '1 Scope', '2 密封面要求', '')} AS section_ref, {texts(d, both, '', '', '附录 A')} AS anchor", f"{o} % 7 = 3"),
        "ins": of_order(f"{texts(d, o, '表面', 'weld')} AS object, {texts(d, o, '外观检查', 'visual inspection', 'measured with a gauge', 'Ω⋅Ω', '')} AS method, {texts(d, o, '应无裂纹。', '')} AS requirement, {texts(d, o, '', '3.1')} AS certificate, '1 Scope' AS section_ref", f"{o} % 7 = 4"),
        "prd": of_order(f"concat('product-', {o}) AS product_id, {texts(d, both, 'Seal ring', '', '垫片')} AS name, {texts(d, both, 'AB-100', ' CD-200 ', '')} AS model, {texts(d, both, 'AB series catalog', '产品样本 CD', '', 'Brochure - EF/')} AS series, {texts(d, both, '', 'AB-100 Seal ring', '')} AS anchor", f"{o} % 7 = 6"),
        "tab": of_order(f"concat('第', {o} % 9 + 1, '页_表1') AS table_no, {texts(d, o, 'Dimensions', '第3页表1', '表 1 连接尺寸', 'Table 2: Weight,', 'References', 'scope')} AS title, {texts(d, o, '1 Scope', '2 密封面要求', '')} AS section_ref, CAST(2 + {o} % 3 AS BIGINT) AS n_cols, CAST({o} % 4 AS BIGINT) AS n_rows", f"{o} % 7 = 5"),
        "cel": f"SELECT doc_id, ord, {d.div('(n - 1)', '3')} AS row_idx, (n - 1) % 3 AS col_idx, {texts(d, 'ord + n', 'Width', '20', '', '≤ 5', 'mm', '公称压力')} AS cell FROM ({d.rows('(SELECT o_custkey AS doc_id, o_orderkey AS ord FROM orders' + (' WHERE o_orderkey % 7 = 5' if not every else '') + ') t', d.series(12), 'n', '', 'doc_id, ord, n')}) c WHERE n <= 4 + ord % 9",
        "pg": f"SELECT {k} AS doc_id, n AS page_no, {texts(d, f'{k} + n', '表 1 连接尺寸' + chr(10) + '公称压力 PN 16' + chr(10) + '温度', 'www.bzfxw.com 免费下载', 'DIN EN 10025 general' + chr(10) + '1 Scope' + chr(10) + 'Width 20 mm', '', 'Table 2' + chr(10) + 'Operating pressure' + chr(10) + 'Weight')} AS text, ({k} + n) % 3 = 0 AS ocr_run, ({k} + n) % 6 = 0 AS ocr_injected FROM ({per(4)}) p WHERE n <= 1 + {k} % 4",
        "md": f"SELECT {d.dealt('customer', DOCUMENTS_OF_TASK, 'doc_id')}{k} AS doc_id, i AS line_no, line FROM ({marked(_MARKDOWN, 'line', 'i')}) m WHERE i < {k} % {len(_MARKDOWN) + 3} AND (i + {k}) % 9 <> 4",
        "tag": f"SELECT {k} AS doc_id, {texts(d, 'i', *(a for a, _ in _TAGS))} AS list, i AS ord, tag FROM ({marked([t for _, t in _TAGS], 'tag', 'i')}) t WHERE ({k} + i * i) % 4 = 1",
        "blk": f"SELECT {k} AS doc_id, n AS ord, {texts(d, f'{k} + n', '正文', '表格标题', '标准引用', '标题', '表格碎片')} AS kind, {texts(d, f'{k} + n', '', '表 1 连接尺寸', 'DN 50', '', 'and more', 'A-B', '')} AS title, {texts(d, f'{k} + n', '应按要求检验。', '', 'see DIN EN 10025', 'mm', '12 13 14', 'it is used.')} AS content, {texts(d, k, '', 'Part 1')} AS part, {texts(d, f'{k} + n', '1 Scope', '2 密封面要求', '', '附录 A')} AS section_ref, ({k} + n) % 5 AS page_no FROM ({per(12)}) b",
        "rnd": f"SELECT {k} AS doc_id, n AS round_no, ({k} + n) % 3 <> 0 AS ocr_run, {texts(d, k, 'grid', 'matrix')} AS engine, 220 + 80 * ({k} % 2) AS dpi, CAST({k} % 9 AS BIGINT) AS target, CAST({k} % 9 - CASE WHEN {k} % 9 > n AND {k} % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS recognised, CAST(n AS BIGINT) AS passed, CAST(1 AS BIGINT) AS marginal, CAST({k} % 2 AS BIGINT) AS rejected, CAST({k} % 4 AS BIGINT) AS injected, CAST(1500 * n + {k} % 7 AS BIGINT) AS millis, {texts(d, f'{k} + n', '', 'soft timeout', '')} AS failure FROM ({per(3)}) r WHERE n <= 1 + {k} % 3",
        "chap": f"SELECT {k} AS doc_id, n AS ord, {texts(d, f'{k} + n', '章节主题', '范围', 'Page 3', '密封面', '')} AS title, {texts(d, f'{k} + 3 * n', '正文仍然较少。', '当前仅稳定识别到范围。', '本章规定要求。', '')} AS summary FROM ({per(6)}) s WHERE n <= {k} % 7 AND {k} % 4 <> 1",
    }


def whole(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """The relations given, or those of the tables with all orders in each of them."""
    return given if given is not None else state(d, every=True)


def relations(d: Dialect, given: dict[str, str] | None, *names: str) -> dict[str, str]:
    """The named relations, from `given` or from the tables."""
    made = given if given is not None else state(d)
    return {n: made[n] for n in names}
