"""Pages of small documents on their way to a score, against values worked out by hand."""

from functools import cache

import pytest
from pyspark.sql import functions as F

from stratafold.plans.document import outputs, parse, review

PAGES = "doc_id string, page_index long, lines array<string>, tables array<array<array<string>>>, ocr_used boolean"
SEEN = "doc_id string, page_index long, grade string, inject boolean, single_m long, dup_m long, punct_m long, fragmented boolean"
ENGLISH = [
    ["Steel pipe flanges", "1 Scope", "This part specifies flanges for pipes.", "Application: pumps and valves", "2 Dimensions", "Operating pressure: 5 to 10 bar"],
    ["See DIN EN 10025-2 for the material.", "3 Inspection", "The surface shall be inspected.", "3.1 Visual inspection", "It is recommended that the marking is checked.", "Page 2"],
]
CHINESE = [["法兰连接尺寸", "1 范围", "本标准规定了法兰的连接尺寸和要求。", "2 要求", "应进行水压试验，压力 16 bar。", "GB/T 9112-2010"]]
#: Three pages with a line that repeats, a part, headings in capitals, a table that two pages show, and its cells as lines.
GERMAN = [
    ["ACME WERKNORM", "Teil 1", "SN 544-1:2009-07", "1 Anwendungsbereich", "Diese Norm gilt für Dichtungen und Flansche.", "WERKSTOFF UND PRÜFUNG"],
    ["ACME WERKNORM", "2 Maße", "Tabelle 1: Rohre", "Kenngröße", "unit", "Breite", "Die Maße sind für alle Teile und mit Toleranz angegeben"],
    ["ACME WERKNORM", "Teil 2", "3 Zitierte Normen", "DIN EN 10025-2", "Weitere Hinweise für Nutzer", "4 Prüfung", "超声 test nach Plan"],
]
TUBES = [["Kenngröße", "unit", "AB-100", "AB-200"], ["Breite", "mm", "12", "14"], ["Druck", "bar", "5 - 10", "≤ 16 bar"]]
#: Each model once as a line; the table has it as a column.
CATALOGUE = [["产品型号 XYZ-100", "型号 ABC-200", "系列 A 规格说明", "系列 B 规格说明", "选型参数", "型号 ABC-200", "订货说明"]]
SIZES = [["参数", "XYZ-100", "ABC-200"], ["压力", "10 bar", "16 bar"], ["重量", "5 kg", ""]]
#: A recognised page: letters, pieces that are no headings, and one title of a standard section.
SCANNED = [["要求", "铜管 bar", "2 材料要求说明", "12 螺纹说明", "尺寸为大的", "密封材料应符合有关的规定并且经过检验之后才可以使用"]]


@pytest.fixture(scope="module")
def frames(spark):
    rows = [("a.pdf", i, p, None, i == 0) for i, p in enumerate(ENGLISH)] + [("b.pdf", i, p, [], False) for i, p in enumerate(CHINESE)]
    rows += [("c.pdf", i, p, [TUBES] if i else None, None) for i, p in enumerate(GERMAN)] + [("d.pdf", i, p, [SIZES], False) for i, p in enumerate(CATALOGUE)]
    rows += [(f"e{k}.pdf", i, p, None, k > 0) for k in range(3) for i, p in enumerate(SCANNED)] + [("f.pdf", 0, [" ", ""], [[["", " "]]], False), ("g.pdf", 0, ["it is used", "and so on", "12"], None, False), (None, 0, ["lost"], None, False)]
    seen = [("a.pdf", 0, "通过", True, 0, 0, 0, False), ("e1.pdf", 0, "通过", True, 10, 0, 0, False), ("e2.pdf", 0, "边缘", True, 10, 0, 0, False)]
    files = spark.createDataFrame([(x, f"/in/{x}") for x in ("a.pdf", "f.pdf", "c.pdf")], "doc_id string, file_name string")
    return parse(spark, spark.createDataFrame(rows, PAGES), files, spark.createDataFrame(seen, SEEN))


@pytest.fixture(scope="module")
def table(frames):
    @cache
    def rows(name, doc, *columns):
        order = {"pg": "page_no", "doc": "doc_id"}.get(name, "ord")
        return [tuple(r) if len(columns) > 1 else r[0] for r in frames[name].where(F.col("doc_id") == doc).orderBy(order).select(*columns).collect()]

    return rows


def test_english_document(table):
    assert [h for h in table("sec", "a.pdf", "no", "title") if h[0][0].isdigit()] == [("1", "Scope"), ("2", "Dimensions"), ("3", "Inspection"), ("3.1", "Visual inspection")]
    assert table("par", "a.pdf", "param_id", "name", "value", "unit", "section_ref", "anchor") == [("param-1", "Operating pressure", "5~10", "bar", "2 Dimensions", "2 Dimensions")]
    assert table("std", "a.pdf", "code", "family", "section_ref") == [("DIN EN 10025-2", "DIN EN", "2 Dimensions"), ("DIN EN 10025-2", "DIN EN", "3 Inspection")]
    assert table("rul", "a.pdf", "rule_id", "rule_type", "section_ref") == [("rule-1", "建议", "3.1 Visual inspection")]  # the line with "shall" is a piece of a table
    assert table("pg", "a.pdf", "page_no", "ocr_run", "ocr_injected") == [(0, True, True), (1, False, False)]
    # the footer of the second page is gone; the scope is the body of the section that is called so
    assert "Page 2" not in table("pg", "a.pdf", "text")[1] and table("doc", "a.pdf", "title", "file_name", "scope") == [("Steel pipe flanges", "/in/a.pdf", "This part specifies flanges for pipes.")]


def test_chinese_document(table):
    assert set(table("std", "b.pdf", "code", "family")) == {("GB/T 9112-2010", "GB")} and table("doc", "b.pdf", "std_code") == ["GB/T 9112-2010"]
    assert table("rul", "b.pdf", "rule_type", "content") == [("必须", "应进行水压试验，压力 16 bar。")]


def test_german_document(table):
    assert table("doc", "c.pdf", "doc_type", "version") == [("standard", "2009-07")]
    assert table("sec", "c.pdf", "no", "title", "part") == [("1", "Anwendungsbereich", "Teil 1"), ("U1", "WERKSTOFF UND PRÜFUNG", "Teil 1"), ("2", "Maße", "Teil 1"), ("3", "Zitierte Normen", "Teil 2"), ("4", "Prüfung", "Teil 2")]
    # the line on every page is no block, and lines that equal a cell of the page's table are pieces of it
    assert "ACME WERKNORM" not in table("blk", "c.pdf", "content")
    assert [k for k, c in table("blk", "c.pdf", "kind", "content") if c in ("Kenngröße", "unit", "Breite")] == ["表格碎片"] * 3
    # an unnumbered heading of the reference section is taken in
    assert table("sec", "c.pdf", "no", "body")[3] == ("3", "DIN EN 10025-2\nWeitere Hinweise für Nutzer")
    # the pointer moves to titles that are whole lines: to the heading in capitals, and no further, as "Maße" is no line
    assert table("tab", "c.pdf", "table_no", "title", "section_ref", "n_cols", "n_rows") == [("第2页_表1", "2 Maße", "U1 WERKSTOFF UND PRÜFUNG", 4, 2), ("第3页_表1", "3 Zitierte Normen", "U1 WERKSTOFF UND PRÜFUNG", 4, 2)]
    want = [("宽度", "12", "mm", "", "AB-100"), ("宽度", "14", "mm", "", "AB-200"), ("压力", "5~10", "bar", "范围", "AB-100"), ("压力", "16", "bar", "≤", "AB-200")]
    assert [p[:5] for p in table("par", "c.pdf", "name", "value", "unit", "comparator", "cond", "table_no") if p[5] == "2 Maße" and p[4] in ("AB-100", "AB-200")] == want
    assert table("ins", "c.pdf", "method", "object")[-1] == ("超声波检测", "4 Prüfung")
    assert len(table("cel", "c.pdf", "cell")) == 24


def test_catalogue(table):
    assert table("doc", "d.pdf", "doc_type") == ["product_catalog"]
    assert table("prd", "d.pdf", "product_id", "anchor", "model")[:2] == [("product-1", "XYZ-100", "XYZ-100"), ("product-2", "ABC-200", "ABC-200")]
    assert len({x for x in table("prd", "d.pdf", "anchor")}) == len(table("prd", "d.pdf", "anchor"))
    models = [(n, v, c, a) for n, v, c, a, t in table("par", "d.pdf", "name", "value", "cond", "anchor", "source_item") if t in ("压力", "重量") and c in ("XYZ-100", "ABC-200")]
    assert models == [("压力", "10 bar", "XYZ-100", "XYZ-100"), ("压力", "16 bar", "ABC-200", "ABC-200"), ("重量", "5 kg", "XYZ-100", "XYZ-100")]
    # no other document has products
    assert not table("prd", "a.pdf", "anchor") and not table("prd", "c.pdf", "anchor")


def test_recognised_pages(table):
    """The same lines native, recognised, and recognised in pieces."""
    heads = {k: [c for k_, c in table("blk", f"e{k}.pdf", "kind", "content") if k_ == "标题"] for k in range(3)}
    assert heads[0] == ["2 材料要求说明", "12 螺纹说明", "尺寸为大的"]
    assert heads[1] == ["2 材料要求说明", "12 螺纹说明"]  # a piece with a function word is no heading of a recognised page
    assert heads[2] == ["2 材料要求说明"]  # nor is a short title with a high number, where the page is in pieces


def test_bare_documents(table):
    """A document without a line keeps its row and asks for recognition; one of pieces only has its pages for sections."""
    assert table("doc", "f.pdf", "title", "doc_type", "needs_ocr") == [("f", "unknown", True)] and not table("sec", "f.pdf", "no") and not table("tab", "f.pdf", "ord")
    assert {k for k, _ in table("blk", "g.pdf", "kind", "section_ref")} == {"表格碎片"} and table("sec", "g.pdf", "no") == []


def test_from_pages_to_scores(spark, frames):
    whole = outputs(spark, frames)
    md = [r.line for r in whole["md"].where("doc_id = 'a.pdf'").orderBy("line_no").collect()]
    assert md[0] == "# Steel pipe flanges" and "### 2 Dimensions" in md and "#### 3.1 Visual inspection" in md and "- DIN EN 10025-2：See DIN EN 10025-2 for the material." in md
    tags = {(r.list, r.tag) for r in whole["tag"].where("doc_id = 'a.pdf'").collect()}
    assert ("标准引用标签", "DIN EN") in tags and ("参数标签", "压力") in tags
    scores, problems = review(spark, whole)
    got = {r.doc_id: r for r in scores.collect()}
    assert {"a.pdf", "c.pdf", "d.pdf"} <= set(got)
    assert all(0 <= r.score <= 100 for r in got.values()) and {r.doc_id for r in problems.collect()} <= set(got)


def test_odd_tables(spark):
    """Extra columns with clashing names, numbers as ids, a table of no page, a long line."""
    rows = [(1, 0, ["1 Scope", "x" * 200_000, None], [[["A", None], [None, "5"]]], "clash")]
    pages = spark.createDataFrame(rows, "doc_id long, page_index int, lines array<string>, tables array<array<array<string>>>, line string")
    frames = parse(spark, pages)
    assert frames["sec"].select("no", "title").collect() == [("1", "Scope")] and frames["sec"].schema["doc_id"].dataType.simpleString() == "bigint"
    assert frames["cel"].count() == 4
    assert all(f.count() == 0 for f in parse(spark, pages.limit(0)).values())
