"""Rounds of review and repair: documents that pass, are repaired, or are stuck, and a driver that is lost on the way."""

import pytest
from pyspark.sql import functions as F

from stratafold.plans import rounds
from stratafold.plans.rounds import LAST, NOTHING, PASSED, SAME, Rounds

GOOD = [
    "Steel pipe flanges", "1 Scope", "This standard applies to flanges for pipes and valves of all sizes in the range given below.", "2 Dimensions", "The dimensions follow the table of this standard and the requirements of the material.", "Operating pressure: 5 to 10 bar",
    "3 Requirements", "The parts shall be inspected before delivery according to DIN EN 10025-2 and ISO 9001 and the drawings.", "4 Inspection", "See GB/T 1234-2010 and DIN 2501 for the inspection of the surface and the marking of the parts.",
]
FEW = ["1 Scope", "2 Dimensions", "3 Inspection"]
SHORT = ["A short page that says little but is read well enough", "to be taken over into the document by the evaluation", "as it has three whole lines of text"]


class Lost(Exception):
    pass


def test_rounds_and_a_lost_driver(spark, tmp_path, monkeypatch):
    rows = [("good", 0, GOOD), *((name, p, FEW if p == 0 else []) for name, n in (("scan", 4), ("part", 4), ("stuck", 4)) for p in range(n)), (None, 0, GOOD)]
    pages = spark.createDataFrame(rows, "doc_id string, page_index long, lines array<string>")
    asked, parsed = [], []

    def recognise(wanted):
        """scan: good text on all pages; part: a little on its second page only; stuck: pieces, which the evaluation refuses."""
        asked.append({(r.doc_id, r.page_index) for r in wanted.collect()})
        if len(asked) == 1:
            raise Lost
        text = F.when(F.col("doc_id") == "scan", "\n".join(GOOD)).when((F.col("doc_id") == "part") & (F.col("page_index") == 1), "\n".join(SHORT)).otherwise("a\n,\nb")
        return wanted.select("doc_id", "page_index", text.alias("text"))

    real = rounds.parse
    monkeypatch.setattr(rounds, "parse", lambda spark, pages, *more: parsed.append({r.doc_id for r in pages.select("doc_id").distinct().collect()}) or real(spark, pages, *more))
    folder = f"file://{tmp_path}/rounds"
    with pytest.raises(Lost):
        Rounds(spark, folder, recognise).run(pages)
    assert parsed == [{"good", "scan", "part", "stuck"}]
    frames, ends = Rounds(spark, folder, recognise).run(pages)  # a new driver goes on: the first parse is not repeated
    assert parsed == [{"good", "scan", "part", "stuck"}, {"scan", "part"}]
    assert asked[0] == asked[1] and {x for x, _ in asked[1]} == {"scan", "part", "stuck"} and ("scan", 0) not in asked[2:3]
    log = {(r.doc_id, r.round): r for r in Rounds(spark, folder).log().collect()}
    assert log["good", 1].reason == PASSED and ("good", 2) not in log
    assert log["scan", 1].reason == "" and log["scan", 1].changed and log["scan", 2].score > log["scan", 1].score
    assert log["part", 1].changed and log["part", 2].score > log["part", 1].score
    assert log["stuck", 1].reason == SAME and not log["stuck", 1].changed and log["stuck", 1].before == log["stuck", 1].after and ("stuck", 2) not in log
    got = {r.doc_id: r for r in ends.collect()}
    assert got["good"].version == 1 and got["scan"].version >= 2 and got["stuck"].version == 1 and got["part"].version == 2 and got["scan"].reason in (PASSED, LAST, SAME, NOTHING)
    # every document once, from its own version; only accepted pages were replaced
    assert sorted(r.doc_id for r in frames["doc"].collect()) == ["good", "part", "scan", "stuck"]
    assert {(r.page_no, r.ocr_injected) for r in frames["pg"].where("doc_id = 'part'").collect()} == {(p, p == 1) for p in range(4)}
    assert frames["std"].where("doc_id = 'scan'").count() > 0
    # all rounds are done: another run changes nothing and asks for nothing
    n = len(asked)
    again, _ = Rounds(spark, folder, recognise).run(pages)
    assert len(asked) == n and len(parsed) == 2 and again["sec"].count() == frames["sec"].count()


def test_the_budget_cuts_rounds(spark, tmp_path):
    pages = spark.createDataFrame([("scan", p, FEW if p == 0 else []) for p in range(4)], "doc_id string, page_index long, lines array<string>")
    times = iter([0.0, 9999.0, 9999.0, 9999.0])
    _, ends = Rounds(spark, f"file://{tmp_path}/cut", lambda w: pytest.fail("asked"), budget=10.0, clock=lambda: next(times)).run(pages)
    assert [(r.round, r.reason) for r in ends.collect()] == [(1, rounds.CUT)]
