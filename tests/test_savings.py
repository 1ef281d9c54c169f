"""What Spark leaves out or works out otherwise than the SQL of registered queries (s14_parsed_texts, s14_parsed_catalogue)
gives the same."""

import duckdb
import pytest

from stratafold.functions import lines as L
from stratafold.functions.dialect import DUCK, REGISTERED, guarded
from stratafold.functions.patterns import Parser, Rx
from stratafold.plans.structure import sections
from stratafold.plans.text_layer import language, watermark

TEXTS = ["", " ", "a b", " a  b ", "a b", "a　 \tb", " a", "x\x0by", "Contents", "contents 1", "the Contents", "Der Inhalt", "目录", "Scope ..... 3", "Scope ……… 3", "Scope …....12+3", "Scope .... 3",
         "ÄNDERUNG 2", "xänderung", "Revision", "修订", "1 2 3", "12 34 56", "DN 40 mm", "xDN 40 mm", "DN", "a²b³1", "1234567890" * 5, "DIN EN 10025-2", "DIN EN 10025-2 " + "x" * 180, "y" * 181, "kurze zeile hier", "und 12 mm"]
TESTS = {
    "norm": lambda d: d.norm("x"),
    "digits": lambda d: d.count("x", Rx("[0-9]")),
    "signs": lambda d: d.count("x", Rx("[0-9²³¹]")),
    "revision": lambda d: d.search("x", Parser.REVISION_RE),
    "toc": lambda d: L.toc_line(d, "x"),
    "table": lambda d: L.table_fragment(d, "x"),
    "standard": lambda d: L.standard_line(d, "x"),
    "language": lambda d: language(d, "x"),
}


@pytest.mark.parametrize("name", sorted(TESTS))
def test_same_as_sql(spark, name):
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    got = [r[0] for r in df.selectExpr(f"{TESTS[name](REGISTERED)} AS y").collect()]
    want = [duckdb.connect().execute(f"SELECT {TESTS[name](DUCK)} FROM (SELECT CAST(? AS VARCHAR) AS x) t", [t]).fetchone()[0] for t in TEXTS]
    assert got == want


def test_watermark_as_sql(spark):
    columns = "CAST(1 AS BIGINT) AS advert_lines, CAST(1 AS BIGINT) AS content_lines, CAST(1 AS BIGINT) AS front_lines, CAST(1 AS BIGINT) AS signals"
    texts = [*TEXTS, "see www.abc.com", "see www.abc.com " + "z" * 290, "文库 " + "z" * 400, "z" * 219, "z" * 220, "GB 12-3"]
    df = spark.createDataFrame([(t,) for t in texts], "full_text string").selectExpr("full_text", *columns.split(", "))
    want = [duckdb.connect().execute(f"SELECT {watermark(DUCK)} FROM (SELECT CAST(? AS VARCHAR) AS full_text, {columns}) t", [t]).fetchone()[0] for t in texts]
    assert [r[0] for r in df.selectExpr(watermark(REGISTERED)).collect()] == want


def test_work_that_nobody_asks_for_is_left_out():
    """Titles are tested where the line before is a number alone, candidates of 100 characters at most, titles of numbers."""
    steps = sections(REGISTERED)
    assert "CASE WHEN alone AND" in steps["merged"] and "CASE WHEN length(candidate) BETWEEN 1 AND 100" in steps["c1"]
    assert "CASE WHEN number <> ''" in steps["c2"] and "CASE WHEN NOT barred AND number <> ''" in steps["c4"]
    assert "regexp_count" not in REGISTERED.count("x", Rx("[0-9]")) and guarded(Parser.REVISION_RE.pattern, True)[0]
    assert "CASE" not in DUCK.only("a", "b")
