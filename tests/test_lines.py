"""Line predicates on literal cases, in Spark; CJK and full-width cases have no oracle in the other engine."""

import pytest

from stratafold.functions import lines as L
from stratafold.functions.dialect import SPARK as d
from stratafold.functions.patterns import Parser, Profile, Review
from stratafold.plans import checks as C
from stratafold.plans import parameters as P
from stratafold.plans.text_layer import language

CASES = {
    "part_heading": (L.part_heading(d, "x"), ["第 2 部分", "Part 3: Tests", "Teil 1"], ["Partner 3", "2 Part"]),
    "toc_line": (L.toc_line(d, "x"), ["Scope ........ 3", "Contents", "目录", "目录 2 章", "List of Contents"], ["Scope", "The contents of the box"]),
    "metadata_line": (L.metadata_line(d, "x"), ["发布日期", "2007-02-01", "2007/2"], ["Width 20", "2007"]),
    "header_noise": (L.header_noise(d, "x"), ["3/15", "第 3 页", "Page 3", "Page 3 of 15", "Seite 5", "2007-02", "SN 200"], ["Page three", "Width: 3/15 mm"]),
    "standard_line": (L.standard_line(d, "x"), ["See DIN EN 1092-1", "GB/T 1234-2020 适用"], ["1 GB/T 1234-2020 heading", "no code"]),
    "caption": (L.caption(d, "x"), ["Table 3: Sizes", "图 1 结构", "Fig. 2", "Legend for it"], ["A Table 3"]),
    "table_fragment": (L.table_fragment(d, "x"), ["DN", "12 14 16", "and others", "A - C", "pressure", "-12,5 %"], ["Materials", "Scope of supply"]),
    "ocr_fragment": (L.ocr_fragment_heading(d, "x"), ["mm", "a)", "结构。", "ab", "(12"], ["范围", "要求", "Scope"]),
    "value": (P.value_like(d, "x"), ["10 to 20 mm", "≤ 5 bar", "12", "3 x 4", "10~20"], ["2007-02-01", "GB 12-99", "width", "10 to 20 mm wide", ""]),
    "standard_code": (P.canonical(d, "x") + " = 'GB/T 1234-1996'", ["GB/T 1234-96"], ["GB 1234-96"]),
    "symbol_sentence": (d.search("x", Parser.SENTENCE_VERB_RE), ["es ist gut", "it shall be"], ["Liste", "shallow"]),
}


@pytest.mark.parametrize("name", CASES)
def test_predicate(spark, name):
    expression, yes, no = CASES[name]
    rows = [(t, True) for t in yes] + [(t, False) for t in no]
    df = spark.createDataFrame(rows, "x string, want boolean").selectExpr("x", "want", f"({expression}) AS got")
    wrong = [(r.x, r.want) for r in df.collect() if bool(r.got) != r.want]
    assert not wrong


@pytest.mark.parametrize("code,want", [("GB/T 1234-96", "GB/T 1234-1996"), ("GB/T 1234-23", "GB/T 1234-2023"), ("CB 589—95", "CB 589-1995"), ("none", "")])
def test_canonical_code(spark, code, want):
    assert spark.createDataFrame([(code,)], "x string").selectExpr(f"{P.canonical(d, 'x')} AS c").first().c == want


def test_unicode_white_space_and_digits(spark):
    df = spark.createDataFrame([("a　  b\x1cc ",)], "x string").selectExpr(f"{d.norm('x')} AS n")
    assert df.first().n == "a b c"
    df = spark.createDataFrame([("１２",), ("标准GB 1234-2020",)], "x string").selectExpr(f"{d.full('x', Parser.SECTION_NUMBER_ONLY_RE)} AS n")
    assert [r.n for r in df.collect()] == [True, False]


def test_languages(spark):
    texts = {"zh": "标准" * 20, "de": "und für mit Teil", "en": "the and for the", "unknown": "xyz"}
    rows = spark.createDataFrame(list(texts.items()), "want string, t string").selectExpr("want", f"{language(d, 't')} AS got").collect()
    assert all(r.want == r.got for r in rows)


def test_names_and_units(spark):
    df = spark.createDataFrame([("Working pressure", "um"), ("Gewicht", "N/mm²"), ("Colour", "µm")], "n string, u string")
    got = df.selectExpr(P.name_of(d, "n", "''") + " AS n", P.unit_of(d, "u") + " AS u").collect()
    assert [tuple(r) for r in got] == [("压力", "μm"), ("重量", "N/mm2"), ("Colour", "μm")]


def test_deduction_table_matches_published_signature_size():
    deductions = [r for r in C.PROBLEMS if r[2]]
    assert len(deductions) == len({r[1] for r in deductions}) == 25
    assert sum(C.FULL_MARKS.values()) == 100


def test_patterns_compile_in_java(spark):
    found = [v for c in (Parser, Profile, Review) for v in vars(c).values() if hasattr(v, "ignore_case")]
    row = spark.range(1).selectExpr(*[f"'x' RLIKE {d.rx(p)} AS c{i}" for i, p in enumerate(found)]).first()
    assert len(row) == len(found)
