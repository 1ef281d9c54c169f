"""The review, summaries and records against expected values worked out by hand from the rules.

Plans are written once for both engines, so most cases run on DuckDB, which plans them faster; some run on Spark too."""

import hashlib
import json
from collections import namedtuple

import duckdb
import pytest

from stratafold.functions.dialect import DUCK
from stratafold.plans import checks
from stratafold.plans.registry import BUILDERS, run_over
from stratafold.plans.state import COLUMNS, KINDS, schema

BLANK = {"string": "", "long": 0, "boolean": False}
KIND = {c: k for k, columns in KINDS.items() for c in columns}
DUCK_TYPE = {"string": "VARCHAR", "long": "BIGINT", "boolean": "BOOLEAN", "int": "INT"}


def rows(relation, *given):
    """Rows of a relation: what is not given is empty, zero or false."""
    return [tuple({"doc_id": 1, "ord": i, "line_no": i}.get(c, BLANK[KIND.get(c, "string")]) if c not in g else g[c] for c in COLUMNS[relation].split(", ")) for i, g in enumerate(given, 1)]


def markdown(text, doc_id=1):
    return rows("md", *({"line": x, "doc_id": doc_id, "line_no": i} for i, x in enumerate(text.split("\n"))))


def run(name, frames):
    """A plan over given rows, on DuckDB."""
    db = duckdb.connect()
    for relation in COLUMNS:
        kinds = ", ".join(f"{c.split()[0]} {DUCK_TYPE[c.split()[1]]}" for c in schema(relation).split(", "))
        db.execute(f"CREATE TABLE in_{relation} ({kinds})")
        if frames.get(relation):
            db.executemany(f"INSERT INTO in_{relation} VALUES ({', '.join('?' * len(COLUMNS[relation].split(', ')))})", frames[relation])
    said = db.execute(BUILDERS[name](DUCK, {r: f"SELECT * FROM in_{r}" for r in COLUMNS}))
    Row = namedtuple("Row", [c[0] for c in said.description])
    return [Row(*r) for r in said.fetchall()]


def on_spark(spark, name, frames):
    made = {k: spark.createDataFrame(v, schema(k)) for k, v in frames.items() if v}
    return run_over(spark, name, made).collect()


#: A document without a fault: two sections, ten lines of body, a table, a parameter, a standard.
SOUND = "\n".join(["# 标准", "## 1 范围", "### 2 要求", *(f"正文第{'一二三四五六七八九十'[i]}行内容" for i in range(10)), "| 参数 | 值 |"])


def sound(**changes):
    frames = {
        "doc": rows("doc", {"title": "法兰", "doc_type": "standard", "line_count": 200, "chars_per_page": 500, "full_summary": "本文件规定了法兰的要求。", "llm_called": True, "llm_backend": "responses", "confidence_pct": 90}),
        "sec": rows("sec", {"no": "1", "title": "范围", "level": 1, "body": "本标准适用于法兰。"}, {"no": "2", "title": "要求", "level": 1, "body": "应检验。"}),
        "par": rows("par", {"name": "宽度", "value": "20", "unit": "mm", "section_ref": "2 要求"}),
        "std": rows("std", {"code": "GB/T 100-1999", "title": "垫片", "kind": "GB", "section_ref": "1 范围"}),
        "tab": rows("tab", {"table_no": "第1页_表1", "title": "尺寸", "n_cols": 2, "n_rows": 3}),
        "pg": rows("pg", {"page_no": 1, "text": "\n".join(f"1.{i} 要求 GB 100-1999 宽度 20 mm 正文内容足够长的一行文字" for i in range(12))}),
        "md": markdown(SOUND),
        "tag": rows("tag", {"list": "参数标签", "tag": "宽度"}, {"list": "标准引用标签", "tag": "GB"}),
        "chap": rows("chap", {"title": "范围", "summary": "本章规定范围。"}),
    }
    return frames | changes


def found(frames):
    return sorted((r.review, r.issue, r.reason) for r in run("d12_merged_issues", frames))


def score(frames):
    r = run("a15_scores", frames)[0]
    return (r.base, r.factual, r.consistency, r.redline, r.score, r.passed)


def test_a_sound_document_has_full_marks(spark):
    assert found(sound()) == [] and score(sound()) == (35, 40, 25, False, 100, True)
    (r,) = on_spark(spark, "a15_scores", sound())
    assert (r.base, r.factual, r.consistency, r.redline, r.score, r.passed) == score(sound())


CASES = {
    "no parameters of a table": ({"par": []}, [("source", "表格未消费", "no_parameters")], (35, 40, 17, True, 74, False)),
    "no section": ({"sec": []}, [("markdown", "正文主链缺失", "no_sections"), ("source", "结构主线缺失", "no_nodes")], (25, 40, 20, True, 74, False)),
    "no standard tag": ({"tag": [{"list": "参数标签", "tag": "宽度"}]}, [("tags", "标准引用标签为空", "no_standard_tag")], (35, 36, 25, False, 96, True)),
    "noisy tag": ({"tag": [{"list": "参数标签", "tag": "1. 2. 3."}, {"list": "标准引用标签", "tag": "GB"}]}, [("tags", "参数标签存在噪音", "noisy")], (35, 33, 25, False, 93, True)),
    "sentence as tag": ({"tag": [{"list": "参数标签", "tag": "宽度"}, {"list": "标准引用标签", "tag": "GB"}, {"list": "检验标签", "tag": "tested at a pressure of 20 bar, dry"}]}, [("tags", "标签存在句子污染", "sentences")], (35, 33, 25, False, 93, True)),
    "template without a model": ({"doc": {"llm_backend": "", "llm_reason": "timeout", "full_summary": "当前识别为标准。"}}, [("summary", "LLM自述无内容", "stub"), ("summary", "摘要疑似模板回退", "unexplained")], (35, 24, 25, False, 84, False)),
    "template that is explained": ({"doc": {"llm_backend": "", "log_reason": "LLM不可用：没有密钥", "full_summary": "OCR 待补", "llm_called": False}}, [("summary", "摘要模板回退（已记录原因）", "explained")], (35, 34, 25, False, 94, True)),
    "scan by its profile": ({"doc": {"needs_ocr": True}}, [("source", "疑似扫描件", "profile")], (35, 40, 19, True, 74, False)),
    "few characters": ({"doc": {"chars_per_page": 19}}, [("source", "疑似扫描件", "few_characters")], (35, 40, 19, True, 74, False)),
    "low chapters": ({"chap": [{"title": "章节主题", "summary": "x"}, {"title": "要求", "summary": "正文仍然较少。"}]}, [("summary", "章节摘要为空", "low_signal_chapters")], (35, 34, 25, False, 94, True)),
    "name and text differ": ({"doc": {"file_name": "CB_T 4196-2011.pdf"}}, [("source", "文件名与正文不一致", "CB/T 4196-2011 / GB/T 100-1999")], (35, 30, 25, False, 90, True)),
    "name and text agree": ({"doc": {"file_name": "GB_T 100-99.pdf"}}, [], (35, 40, 25, False, 100, True)),
}


@pytest.mark.parametrize("name", CASES)
def test_issues_and_scores(name):
    changes, issues, marks = CASES[name]
    base = dict(zip(COLUMNS["doc"].split(", "), sound()["doc"][0]))
    frames = sound(**{k: rows(k, base | v) if k == "doc" else rows(k, *v) for k, v in changes.items()})
    assert found(frames) == issues and score(frames) == marks


def test_six_pseudo_headings_cost_three_marks():
    five, six = (SOUND + "\n" + "\n".join(f"## {x}" for x in "AB CD EF GH IJ KL".split()[:n]) for n in (5, 6))
    assert score(sound(md=markdown(five)))[0] == 35 and score(sound(md=markdown(six)))[0] == 32


def test_file_information_is_no_body():
    """A code in the block of file information is no evidence."""
    text = "# x\n## 文件基础信息\n- 标准编号: CB 5-2001\n## 1 范围\n正文"
    base = dict(zip(COLUMNS["doc"].split(", "), sound()["doc"][0])) | {"file_name": "CB 5-2001.pdf"}
    frames = sound(md=markdown(text), doc=rows("doc", base))
    assert ("source", "文件名与正文不一致", "CB 5-2001 / GB/T 100-1999") in found(frames)


def test_signatures():
    assert duckdb.sql(BUILDERS["c16_rule_signature"](DUCK)).fetchall() == [("2a7a252f",)]


@pytest.mark.parametrize(
    "text, odd",
    [("# 1 范围", False), ("# 12345 XZ", False), ("# 99,5 mm", True), ("# 断裂。", True), ("# 1.2 要求", False), ("# 2019 12 34", True), ("# A12 B34 X9", True), ("# Scope", False), ("#", False), ("# 3 It is used; and", False)],
)
def test_suspicious_headings(text, odd):
    got = [r.line_no for r in run("v14_suspicious_headings", {"md": markdown(text)})]
    assert bool(got) == odd


@pytest.mark.parametrize(
    "text, template, counts",
    [("", True, True), ("当前识别为标准。", True, True), ("已抽取 3 条参数。已识别 2 条标准。", False, True), ("已抽取 3 条参数，应按要求试验", False, True), ("已建立 3 章；规定了要求", False, False), ("OCR 待补", True, False), ("OCR " + "长" * 80, False, False)],
)
def test_summary_tests(text, template, counts):
    r = run("v20_v21_summary_tests", {"doc": rows("doc", {"full_summary": text})})[0]
    assert (r.is_template, r.only_counts) == (template, counts)


@pytest.mark.parametrize("tag, odd", [("压力", False), ("1. 2", True), ("a b", True), ("length for valves and pipes", True), ("Wanddicke mit Schutz aussen", True), ("Nenngröße", False), ("für pipes here", True)])
def test_suspicious_parameter_tags(tag, odd):
    assert run("v23_suspicious_parameter_tags", {"tag": rows("tag", {"list": "参数标签", "tag": tag})})[0].suspicious == odd


def test_chapter_summaries():
    frames = {
        "sec": rows("sec", {"no": "1", "title": "Scope", "body": "For pipes."}, {"no": "2", "title": "要求", "body": " 应检验。\n"}, {"no": "U3", "title": "Legend", "body": ""}, {"no": "4", "title": "Xyz", "body": "Nothing known"}),
        "par": rows("par", {"name": "宽度", "value": "20", "section_ref": "1 Scope"}, {"name": "高度", "value": "", "section_ref": "1 Scope"}),
        "std": rows("std", {"code": "ISO 1", "section_ref": "1 Scope"}),
    }
    got = {r.place: (r.title, r.summary) for r in run("m05_chapter_summaries", frames)}
    assert got[1] == ("适用范围（原文：1 Scope）", "本章节围绕适用范围（原文：1 Scope），已提取2项参数（宽度=20）；引用标准：ISO 1。")
    assert got[2] == ("2 要求", "应检验。")
    assert got[3] == ("Legend", "当前仅稳定识别到Legend，正文仍然较少。")
    assert got[4] == ("4 Xyz", "本章节主要围绕4 Xyz展开，已识别到原文正文，当前细节仍以原文为准。")


def test_numeric_summary_drops_repeats_and_falls_back():
    given = [{"name": "Total width", "value": "", "lower": "5", "upper": "10", "cond": "dry"}, {"name": "Total width", "value": "", "lower": "5", "upper": "10", "cond": "dry"}, {"name": "DN", "value": "", "comparator": "≤", "upper": "3"}, {"name": "压力", "value": "7", "cond": "低温"}]
    got = [(r.name, r.shown_value, r.unit, r.overview) for r in sorted(run("m06_m11_m12_numeric_summary", {"par": rows("par", *given)}), key=lambda r: r.place)]
    assert got == [("宽度（原文：Total width）", "5 ~ 10", "未注明", "宽度（原文：Total width）在dry条件下取值为。"), ("DN", "≤ 3", "未注明", "DN取值为。"), ("压力", "7", "未注明", "压力在低温条件下取值为7。")]


def test_chapter_summaries_on_spark(spark):
    frames = {"sec": rows("sec", {"no": "1", "title": "Scope", "body": "For pipes."}), "std": rows("std", {"code": "ISO 1", "section_ref": "1 Scope"})}
    assert [tuple(r) for r in on_spark(spark, "m05_chapter_summaries", frames)] == [tuple(r) for r in run("m05_chapter_summaries", frames)]


def test_requirements_fall_back_to_section_notes():
    frames = {"sec": rows("sec", {"no": "1", "title": "范围", "body": "说明" * 100}, {"no": "2", "title": "X", "body": "Foreign text"})}
    got = [(r.rule_type, r.content) for r in sorted(run("m08_requirement_summary", frames), key=lambda r: r.place)]
    assert got == [("章节说明", "说明" * 90 + "..."), ("章节说明", "本章节已识别到原文说明，当前细节仍以原文为准。")]


def test_tags():
    frames = sound(sec=rows("sec", {"no": "1", "title": "Materials and design", "body": "Application: pumps\nCE and ul"}, {"no": "2", "title": "Scope", "body": "焊接后检验"}), prd=rows("prd", {"product_id": "p", "name": "a", "model": " AB-1 ", "series": "AB catalog"}), ins=rows("ins", {"method": "visual inspection"}, {"method": "外观检查"}))
    got = {}
    for r in sorted(run("m13_all_tags", frames), key=lambda r: (r.list, r.place)):
        got.setdefault(r.list, []).append(r.tag)
    assert got["文档类型标签"] == ["标准规范", "标准/规范文档"] and got["工艺流程标签"] == ["焊接", "检验"] and got["产品系列标签"] == ["AB"] and got["产品型号标签"] == ["AB-1"]
    assert got["检验标签"] == ["检验规则", "外观检查"] and got["认证标签"] == ["CE", "UL"] and got["标准引用标签"] == ["GB"] and got["参数标签"] == ["宽度"]
    assert got["文档主题标签"] == ["材料", "尺寸"]


def test_normalised_parameters_find_their_product():
    frames = {
        "par": rows("par", {"name": "working pressure", "value": "5", "unit": "UM", "cond": "for AB-1 only"}, {"name": "pressure", "value": "5", "unit": "bar", "cond": "for AB-1 only"}, {"name": "Gewicht", "value": "1", "section_ref": "2 要求"}, {"name": "x", "value": "2"}),
        "prd": rows("prd", {"product_id": "p7", "model": "AB-1"}, {"product_id": "p8", "model": "AB-1"}),
    }
    got = [(r.param_id, r.name, r.unit, r.anchor, r.anchor_kind) for r in sorted(run("d08_n05_normalised_parameters", frames), key=lambda r: r.place)]
    assert got == [("param-1", "压力", "μm", "AB-1", "product"), ("param-2", "重量", "", "2 要求", "section"), ("param-3", "x", "", "文档", "section")]


def test_guards():
    frames = {"doc": rows("doc", *({"doc_id": i, "doc_type": t, "confidence_pct": c} for i, (t, c) in enumerate([("standard", 49), ("unknown", 90), ("standard", 50), ("standard", 90), ("error", 0)]))), "tab": rows("tab", *({"doc_id": 3} for _ in range(51)))}
    assert {r.doc_id: r.refused for r in run("p01_guarded_documents", frames)} == {0: "domain", 1: "domain", 2: "", 3: "tables", 4: ""}
    assert {r.doc_id: r.reason for r in run("p06_rejected_results", frames)}[0] == "文档超出处理领域(类型=standard, 置信度=0.49)"


def test_state_is_canonical_json():
    frames = sound()
    (row,) = run("a16_state_snapshot", frames)
    state = json.loads(row.state)
    assert row.state == json.dumps(state, ensure_ascii=False, sort_keys=True)
    assert state["章节示例"] == ["1 范围", "2 要求"] and state["原文解析长度"] == len(SOUND) and state["标签数量统计"] == {"参数标签": 1, "标准引用标签": 1}
    assert run("a17_state_fingerprint", frames)[0].fingerprint == hashlib.sha1(row.state.encode()).hexdigest()


def test_every_problem_has_its_points():
    by_dim = {}
    for _, _, dim, points, *_ in checks.PROBLEMS:
        by_dim[dim] = by_dim.get(dim, 0) + points
    assert by_dim == {"base": 27, "factual": 80, "consistency": 50, "": 0}


def test_markdown():
    frames = {
        "doc": rows("doc", {"title": "T", "file_name": "f.pdf", "doc_type": "manual", "std_code": "GB 1"}),
        "sec": rows("sec", {"no": "1", "title": "范围", "level": 1, "body": " a \n\nb", "part": "Part 1"}, {"no": "U2", "title": "尺寸", "level": 9, "part": "Part 1"}, {"no": "3", "title": "X", "level": 2, "part": ""}, {"no": "4", "title": "Y", "level": 1, "part": "Part 2"}),
        "tab": rows("tab", {"ord": 1, "title": "尺寸", "section_ref": "U2 尺寸"}, {"ord": 2, "title": "第3页表1", "section_ref": "1 范围"}, {"ord": 3, "title": "Weights", "section_ref": "1 范围"}, {"ord": 4, "title": "weights", "section_ref": "1 范围"}),
        "cel": rows("cel", *({"ord": o, "row_idx": r, "col_idx": c, "cell": f"{o}{r}{c}"} for o, shape in ((1, (2, 1, 3)), (3, (1,))) for r, n in enumerate(shape) for c in range(n))),
        "std": rows("std", {"code": "ISO 1", "title": "One"}, {"code": "ISO 1", "title": "Two"}, {"code": "ISO 2", "title": "ISO 2"}),
    }
    want = "# T\n\n## 文件基础信息\n- 文件名称：f.pdf\n- 文档类型：技术手册\n- 标准编号：GB 1\n- 版本日期：\n- 适用范围：\n\n## Part 1\n\n### 1 范围\n\na\nb\n\n#### Weights\n\n| 300 |\n| --- |\n\n###### 尺寸\n\n| 100 | 101 |\n| --- | --- |\n| 110 |  |\n| 120 | 121 |\n\n#### 3 X\n\n## Part 2\n\n### 4 Y\n\n## 引用标准\n\n- ISO 1：One\n- ISO 2\n"
    assert run("m01_document_markdown", frames)[0].markdown == want


def test_problem_list_actions_and_reasons():
    """Order and choice of problems, worked out by hand: gravest finding first, then the place of a problem's first finding."""
    import duckdb

    from stratafold.functions.dialect import DUCK
    from stratafold.plans import checks
    from stratafold.plans.registry import with_

    found = [
        (1, "ocr", "表格未消费", "s"), (1, "source", "表格未消费", "t"), (1, "markdown", "markdown内容过少", "m"), (1, "tags", "参数标签为空", "p"), (1, "tags", "标准引用标签为空", "q"),
        (1, "ocr", "OCR标题噪音轻度", "o"), (1, "source", "疑似扫描件", "x"), (1, "source", "结构未建立", "y"), (2, "markdown", "正文主链缺失", "n"), (3, "tags", "参数标签为空", "p"),
    ]
    db = duckdb.connect()
    db.execute("CREATE TABLE given_iss (doc_id BIGINT, review VARCHAR, issue VARCHAR, reason VARCHAR)")
    db.executemany("INSERT INTO given_iss VALUES (?, ?, ?, ?)", found)
    db.execute("CREATE TABLE given_total AS SELECT * FROM (VALUES (1, 60, true), (2, 70, false), (3, 80, false), (4, 90, false)) t(doc_id, score, redline)")
    own = {"iss": "SELECT * FROM given_iss", "total": "SELECT * FROM given_total", "seen": "SELECT doc_id FROM given_total"}

    def run(parts, last):
        steps = {k: own.get(k, v) for k, v in parts.items() if k in own or k in ("prob", "ded", "red", "redn", "rk", "pb0", "pb1", "plist", "a", "no_pass", "why0", "why", "n", "k")}
        return db.execute(with_(steps, last)).fetchall()

    listed = run(checks.listed(DUCK), "SELECT problem_id, level, issue FROM plist WHERE doc_id = 1 ORDER BY place")
    # the table problem has two findings, of which the one of the sources is graver
    assert listed == [
        ("markdown_too_short", 0, "markdown内容过少"), ("scan_like", 0, "疑似扫描件"), ("structure_missing", 0, "结构未建立"), ("table_to_param_missing", 0, "表格未消费"),
        ("standard_tag_empty", 2, "标准引用标签为空"), ("param_tag_empty", 2, "参数标签为空"), ("ocr_heading_noise_minor", 2, "OCR标题噪音轻度"),
    ]
    sql = checks.t04_fix_actions(DUCK)
    assert "PARTITION BY doc_id, action, module" in sql
    a = sql[sql.index("a AS (") + 6 :]
    got = run(checks.listed(DUCK) | {"a": a[: a.index(")\nSELECT")]}, a[a.index(")\nSELECT") + 2 :])
    mine = [r[1:6] for r in sorted((r for r in got if r[0] == 1), key=lambda r: r[6])]
    # recognition before parsing before rebuilding among the gravest; each action of a module once, with its first problem
    assert [(r[0], r[1]) for r in mine] == [("标记需OCR", "ocr"), ("重跑parser", "parser"), ("重建markdown", "md_builder"), ("重建tags", "tagger"), ("观察", "parser")]
    assert mine[0][4] is True and [r[2] for r in mine if r[0] == "重跑parser"] == ["结构未建立"]
    why = run(checks.failure_reasons(DUCK), "SELECT doc_id, reason FROM why ORDER BY doc_id, place")
    assert why == [(1, "表格存在但数值型参数为空"), (1, "文本层不足需要OCR"), (2, "正文主链缺失"), (3, "总分未达通过线")]
