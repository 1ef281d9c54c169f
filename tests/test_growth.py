"""What must not grow with the input: rows that a plan sends through the driver, and rows that a task holds."""

import os

import pytest

from stratafold.functions.dialect import REGISTERED, ascii_classes, guarded
from stratafold.functions.patterns import Parser, Rx
from stratafold.operators.pointers import page_sections
from stratafold.plans import all_queries
from stratafold.plans.batch import UNSAFE
from stratafold.plans.pages import back, front
from stratafold.plans.steps import Steps

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", ["f14_cells_of_page", "f24_f25_rendered_titles", "j09_renamed_sections"])
def test_joined_rows_are_not_broadcast(spark, name):
    """Pages and lines are made of few bytes, so Spark takes them for small tables."""
    assert "Broadcast" not in planned(all_queries()[name](spark, SF))


@needs_tables
def test_tables_are_found_without_joins(spark):
    """The lines of f24_f25_rendered_titles are dealt out by page and by document, and their steps planned for one reader."""
    plan = planned(all_queries()["f24_f25_rendered_titles"](spark, SF))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_pointer_broadcasts_no_titles(spark):
    """Every step of the pointer (j04_page_pointer) but the mark of documents that have a section."""
    pages = spark.createDataFrame([(1, 0, ["a", "b"]), (1, 1, ["c"]), (2, 0, ["x"])], "doc_id long, page_index long, lines array<string>")
    heads = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c")], "doc_id long, sec_ord long, title string")
    plans = []

    def keep(df):
        plans.append(planned(df))
        return df.localCheckpoint()

    last = page_sections(pages, heads, keep)
    assert sorted(map(tuple, last.collect())) == [(1, 0, 2), (1, 1, 3)]
    assert all("BroadcastHashJoin" not in p or "LeftSemi" in p for p in [*plans, planned(last)])
    assert "BroadcastHashJoin" not in planned(last)


@pytest.mark.parametrize("name", ["f03_class_counts", "w03_sections"])
def test_tasks_follow_the_pages(spark, tmp_path, name):
    """Ten times the pages are dealt out to ten times the tasks, whatever the bytes of their lines."""
    made = "id AS p_partkey, 'bolt' AS p_name, 'Brand#1' AS p_brand, 'STEEL' AS p_type, CAST(id % 50 AS INT) AS p_size"
    spark.range(50_000).selectExpr(*made.split(", ", 4)).write.parquet(f"{tmp_path}/part.parquet")
    plan = planned(all_queries()[name](spark, str(tmp_path)))
    assert ", 20), REPARTITION_BY_NUM" in plan


def parse_steps(spark):
    """The steps of s14_parsed_catalogue over pages, sections and products that are there already."""
    s = Steps(spark, front(REGISTERED, "SELECT 1") | back(REGISTERED), lambda df: df)
    s.add("cpg", spark.createDataFrame([(1, 0, ["Scope", "a b"], [[["a b"]]], False, False)], "doc_id long, page_index long, lines array<string>, tables array<array<array<string>>>, ocr_used boolean, in_pieces boolean"))
    s.add("headed", spark.createDataFrame([(1,)], "doc_id long"))
    s.add("sec", spark.createDataFrame([(1, 1, "U1", "", "u"), (1, 2, "U2", "Scope", "v")], "doc_id long, sec_ord long, no string, title string, ref string"))
    return s


def test_page_marks_are_worked_out_once(spark):
    """A row is made of each mark of a page's lines; the optimiser would ask the whole array twice more for its size."""
    s = parse_steps(spark)
    marks, rows = (planned(s.frame(x)).count("regexp_extract") for x in ("pfl", "pex"))
    assert rows == marks > 0
    assert planned(s.frame("bare")).count("filter(") == planned(s.frame("bare0")).count("filter(") == 1


def test_page_text_is_joined_once(spark):
    """The text of a page is not joined anew for each title of the document, and the titles are not broadcast."""
    pages = parse_steps(spark).frame("pgr")
    assert [r.page_ref for r in pages.collect()] == ["v"]
    assert "Contains(array_join" not in planned(pages) and "Broadcast" not in planned(pages)


def test_guards_find_the_same(spark):
    """Patterns that begin with an edge or alternatives look at the first character first, and find what they found."""
    known = [Parser.STANDARD_RE, Parser.MODEL_RE, Parser.FRONT_MATTER_CUE_RE, Parser.SENTENCE_VERB_RE, Rx(r"\b(?:size|kind|ist)\b", True), Rx(r"\b(?:größe|dn)\b", True)]
    assert sum(guarded(p.pattern, p.ignore_case)[0] != "" for p in known) == len(known)
    texts = ["DIN EN 12-3", "xDIN 12", "äDIN 12, GB/T 7", "_EN 1", "AB-100 CD12", "ſize size xſize", "x\u017fize", "\u212aind kind", "\u0130st ist ıst", "GRÖßE 3 DN 4", "must musſt", "电话 12", "", "É ICS 3"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for p in known:
        plain = REGISTERED.lit("(?iu)" * p.ignore_case + ascii_classes(p.pattern))
        rows = df.selectExpr(f"regexp_replace(x, {plain}, '<$0>') AS a", f"regexp_replace(x, {REGISTERED.rx(p)}, '<$0>') AS b").collect()
        assert [r.a for r in rows] == [r.b for r in rows]


def test_patterns_unknown_to_python(spark):
    """Java and RE2 know classes such as \\p{L}, Python's parser does not: such a pattern has no guard."""
    assert guarded(UNSAFE.pattern, UNSAFE.ignore_case) == ("", UNSAFE.pattern)
    df = spark.createDataFrame([("Größe 3/电话.pdf",)], "x string")
    assert df.selectExpr(f"{REGISTERED.replace_all('x', UNSAFE, '_')} AS y").first().y == "Größe_3_电话.pdf"
