"""Language models, recognition, settings, locks, exports and batches; folds and merges against plain loops."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratafold import job
from stratafold.operators.folds import row_clusters
from stratafold.operators.pointers import page_sections
from stratafold.plans.document import to_shared
from stratafold.operators.merge import merge_sections
from stratafold.operators.refine import local_cleanup, refine, renamed_references
from stratafold.sources import language, locks, recognition
from stratafold.sources.export import write_documents
from stratafold.sources.providers import Settings, open_both, page_texts
from stratafold.streaming.batches import DONE, FAILED, PARTLY, REQUIRED, WAITING, Batches, logical_parent, make_event


def model(*answers, **how):
    """A model whose endpoint gives these answers, or raises those that are errors, one after the other."""
    left = list(answers)
    asked = []

    def send(url, key, body, timeout):
        asked.append((url, body))
        answer = left.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    return language.Model(**({"key": "k", "name": "m", "chat_name": "", "url": ""} | how), send=send), asked


CHAT = {"choices": [{"message": {"content": '{"a": 1}'}}]}


def test_protocols_and_fallbacks(monkeypatch):
    m, asked = model({"output_text": '{"a": 1}'})
    assert m.ask("r", {}, "n", {}) == ({"a": 1}, "responses") and asked[0][0].endswith("/responses")
    m, asked = model(language.Refused(400), CHAT, chat_name="c")
    assert m.ask("r", {}, "n", {}) == ({"a": 1}, "chat_completions:c")
    m, asked = model(language.Refused(400), CHAT, url="http://other/v1")  # no vendor: chat only, then JSON at large
    assert m.ask("r", {}, "n", {"x": 1})[0] == {"a": 1}
    assert [a[1]["response_format"]["type"] for a in asked] == ["json_schema", "json_object"] and '"x": 1' in asked[1][1]["messages"][0]["content"]
    m, _ = model(ValueError("one"), ValueError("two"), ValueError("three"))
    with pytest.raises(RuntimeError, match="one.*three"):
        m.ask("r", {}, "n", {})
    assert not language.Model(key="").available and language.Model(key="k", url="https://API.OpenAI.com/v1").is_vendor
    monkeypatch.setenv("LLM_API_KEY", "x")
    assert language.Model().key == "x"


def test_retries_grow_and_end():
    pauses = []
    left = [language.Refused(429), language.Refused(503), 7]

    def call():
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    assert language.retried(call, pauses.append) == 7
    assert 1 <= pauses[0] <= 1.5 and 1.5 <= pauses[1] <= 2.25
    left = [language.Refused(401), 1]
    with pytest.raises(language.Refused):
        language.retried(call, pauses.append)
    left = [language.Refused(500)] * 7
    with pytest.raises(language.Refused):
        language.retried(call, lambda _: None)
    assert len(left) == 1


def test_proxies_of_the_discard_port(monkeypatch):
    monkeypatch.setenv("HTTP_PROXY", "http://127.0.0.1:9")
    monkeypatch.setenv("HTTPS_PROXY", "http://proxy:8080")
    with language.without_disabled_proxies():
        import os

        assert "HTTP_PROXY" not in os.environ and os.environ["HTTPS_PROXY"] == "http://proxy:8080"
    assert os.environ["HTTP_PROXY"] == "http://127.0.0.1:9"


def test_answers_are_rows(spark):
    requests = spark.createDataFrame([(1, "{}"), (2, "not json")], "doc_id long, payload string")

    def send(url, key, body, timeout):
        return {"output_text": '{"full_summary": "s", "chapters": []}'}

    got = {r.doc_id: r for r in language.answered(requests, language.Model(key="k", url="", name="m", send=send), language.SUMMARY_RULES, "s", language.summary_schema()).collect()}
    assert got[1].backend == "responses" and json.loads(got[1].answer)["full_summary"] == "s" and got[2].answer is None and "JSON" in got[2].error
    none = language.answered(requests, language.Model(key="", name="m"), "", "s", {})
    ruled = spark.createDataFrame([(1, "rule"), (3, "rule")], "doc_id long, summary string")
    got = {r.doc_id: (r.summary, r.reason) for r in language.with_fallback(ruled, none).collect()}
    assert got[1][0] == "rule" and "no model" in got[1][1] and got[3] == ("rule", "not asked")
    assert language.clean_tags({"topic_tags": [" a  b ", "a b", "", None]})["文档主题标签"] == ["a b", "None"] and len(language.tag_schema()["required"]) == 13


def test_decisions_in_order(spark):
    candidates = spark.createDataFrame([("sec-1", "section", 1), ("sec-4", "section", 4), ("blk-2", "block", 2), ("sec-9", "section", 9)], "candidate_id string, kind string, place int")
    decisions = spark.createDataFrame([("blk-2", "delete", None), ("sec-1", "merge_previous", None), ("sec-4", "merge_next", None), ("sec-9", "rename", "New"), ("sec-7", "delete", None), ("sec-9", "delete", None)][:5], "candidate_id string, action string, new_title string")
    assert [r.candidate_id for r in language.decided(candidates, decisions).collect()] == ["sec-9", "sec-4", "sec-1", "blk-2"]


V2 = [[[[0, 0], [10, 0], [10, 5], [0, 5]], ("b ", 0.5)], [[[0, 20], [9, 20], [9, 25], [0, 25]], ("a", 0.9)], [[[0, 9], [1, 9], [1, 9], [0, 9]], (" ", 0.1)]]
V3 = [{"rec_texts": ["b", " ", "a"], "rec_scores": [0.5, None, 0.9], "rec_polys": [[0, 0, 10, 5], [1, 1, 1, 1], [0, 20, 9, 25]]}]


@pytest.mark.parametrize("raw", [V2, V3])
def test_results_of_engines(raw):
    assert recognition.flat_text(raw) == "b\na" and recognition.confidences(raw)[0] == ("a", 0.9)
    assert [(x["text"], x["cy"]) for x in recognition.placed_lines(raw)] == [("b", 2.5), ("a", 22.5)]
    assert recognition.flat_text(None) == "" and recognition.rectangle([3, 4, 1, 2]) == (1, 2, 3, 4) and recognition.rectangle("x") is None and recognition.rectangle([1, 2, 3]) is None


def test_recognition_keeps_finished_batches():
    now = iter([0, 1, 20])

    class Engine:
        def ocr(self, image, **how):
            if image == 1 and not how:
                raise TypeError
            if image == 2:
                raise ValueError
            return [[0, (f"page {image}", 1.0)]]

    texts, run = recognition.recognise([0, 1, 2, 3, 4], lambda p: p, Engine(), 3, 10, lambda: next(now))
    assert texts == {0: "page 0", 1: "page 1"} and (run.executed, run.successful, run.batches, run.timed_out) == (3, 2, 1, True)
    assert recognition.recognise([1], lambda p: p, None)[1].executed == 0 and recognition.chunks([1, 2, 3], 0) == [[1], [2], [3]]
    assert recognition.origin().startswith("paddleocr") and not recognition.meaningful([["a", "b"], ["c", " "]])


def test_recognised_pages_and_tables(spark):
    class Engine:
        def ocr(self, image):
            return [[0, (f"p{image}", 1.0)]]

    files = spark.createDataFrame([("a", b"x", [0, 5, 1]), ("b", b"bad", [0])], "path string, content binary, pages array<int>")

    def opener(content, dpi):
        if content == b"bad":
            raise ValueError("broken")
        return 2, lambda page: page

    got = {(r.doc_id, r.page_index): r for r in recognition.recognised_pages(files, opener, Engine).collect()}
    assert got["a", 0].text == "p0" and got["a", 1].text == "p1" and ("a", 5) not in got and "broken" in got["b", None].error
    cells = [[x, y, x + 9, y + 9] for y in (0, 20) for x in (0, 10)]
    inside = lambda rect, cells: next((i for i, c in enumerate(cells) if c["rect"][0] <= rect[0] <= c["rect"][2] and c["rect"][1] <= rect[1] <= c["rect"][3]), None)
    lines = [{"text": str(i), "rect": (c[0] + 1, c[1] + 1, c[0] + 2, c[1] + 2), "cx": 0.0, "cy": 0.0} for i, c in enumerate(cells)]
    made = recognition.recognised_tables([{"bbox": cells}, {"bbox": cells[:2]}], lines, inside, lambda cells: [int(c["cy"] > 10) for c in cells], lambda t: " ".join(x[2] for x in t))
    assert made == [[["0", "1"], ["2", "3"]]]


def test_settings_of_the_environment():
    s = Settings.from_environment({"OCR_ENABLED": "False", "OCR_DPI": "150", "OCR_SOFT_TIMEOUT_SECONDS": ""}, ocr_language="de")
    assert not s.ocr_enabled and s.ocr_table_enabled and s.ocr_dpi == 150 and s.soft_limit == 180 and s.plan(8)["reduced"] is False
    assert Settings(ocr_soft_seconds=5).soft_limit == 5 and Settings().plan(8) == {"dpi": 220, "batches": 2, "reduced": True}
    for wrong in ({"ocr_language": "xx"}, {"ocr_dpi": 71}, {"ocr_reduced_dpi": 1201}, {"ocr_batch_pages": 0}, {"ocr_seconds": 0}, {"refine_rounds": -1}, {"refine_candidates": 0}, {"pipeline_seconds": -1}):
        with pytest.raises(ValueError):
            Settings(**wrong)


def test_locks(tmp_path):
    folder = str(tmp_path / "out")
    assert locks.acquire(folder) is None and "held" in locks.acquire(folder)
    (Path(folder) / locks.LOCK).write_text("999999999")
    locks.release(folder)  # another's lock stays
    assert (Path(folder) / locks.LOCK).exists() and locks.acquire(folder) is None
    locks.release(folder)
    assert not (Path(folder) / locks.LOCK).exists() and not locks.alive(0)
    (Path(folder) / locks.LOCK).write_text("x")
    assert "cannot" in locks.acquire(folder)


def test_command_line(tmp_path, capsys):
    (tmp_path / "Input" / "a").mkdir(parents=True)
    pdf = tmp_path / "Input" / "a" / "x.PDF"
    pdf.write_bytes(b"%PDF")
    seen = []
    assert job.main(["--input", str(pdf), "--output", str(tmp_path / "out")], lambda p, f: seen.append(f) or ["done"]) == 0
    assert seen == [tmp_path / "out" / "a" / "x"] and "done" in capsys.readouterr().out
    assert job.main(["--input", str(tmp_path / "no.pdf")]) == 1 and job.main(["--input", str(tmp_path)]) == 1
    assert job.folders_under_input(Path("/x/y.pdf")) == ()


def test_decoders_and_page_texts(spark):
    closed = []

    class Doc:
        def close(self):
            closed.append(1)

    def broken(content):
        raise ValueError

    assert open_both(b"", lambda c: Doc(), broken) is None and closed == [1] and open_both(b"", broken, broken) is None
    native = spark.createDataFrame([(1, 0, "a  b\r\n　c", 1.0, 2.0), (1, 1, "", 1.0, 2.0), (1, 2, "n", 1.0, 2.0)], "doc_id long, page_index int, text string, width double, height double")
    other = spark.createDataFrame([(1, 1, "o")], "doc_id long, page_index int, text string")
    ocr = spark.createDataFrame([(1, 2, "r\n \nq")], "doc_id long, page_index int, text string")
    got = {r.page_index: (r.lines, r.ocr_used) for r in page_texts(native, other, ocr).collect()}
    assert got == {0: (["a b", "c"], False), 1: (["o"], False), 2: (["r", "q"], True)}


def test_exported_documents(spark, tmp_path):
    given = [(1, "summary", '{"_inner": 1, "全文摘要": "a"}'), (1, "process_log", '{"_kept": 1}'), (1, "markdown", '"# t"')]
    paths = {r.path for r in write_documents(spark.createDataFrame(given, "doc_id long, kind string, value string"), f"file://{tmp_path}/out").collect()}
    assert len(paths) == 3 and sorted(p.name for p in (tmp_path / "out/1").iterdir()) == sorted({Path(p).name for p in paths})
    assert json.loads((tmp_path / "out/1/summary.json").read_text()) == {"全文摘要": "a"} and '\n  "_kept"' in (tmp_path / "out/1/process_log.json").read_text()


def test_batches(spark, tmp_path):
    b = Batches(spark, f"file://{tmp_path}/batches")
    files = spark.createDataFrame([("a.pdf", 1, "/u/a", ["s"], "x\\y/a.pdf"), ("b.PDF", 2, "/u/b", ["s"], "b.pdf"), ("c.pdf", 3, "/u/c", ["s"], "")], "name string, size long, path string, layers array<string>, relative_path string")
    with pytest.raises(ValueError):
        b.create(files.withColumn("name", F.lit("x.txt")))
    assert [r.p for r in files.select(logical_parent().alias("p")).collect()] == [["s", "x", "y"], ["s"], ["s"]]
    batch = b.create(files)
    assert b.status(batch)["status"] == WAITING and b.files(batch).count() == 3 and b.file(batch, b.files(batch).first().file_id).count() == 1
    with pytest.raises(KeyError):
        b.status("none")

    def work(row):
        if row["name"] == "b.PDF":
            raise ValueError("broken")
        review = {"score": 90 if row["name"] == "a.pdf" else 60, "passed": row["name"] == "a.pdf", "redline": False, "reasons": ["r1", "r2"]}
        return dict.fromkeys(REQUIRED) | {"review": review, "review_rounds": [1, 2]}

    seen = []
    query = b.follow(batch, seen.extend, f"file://{tmp_path}/cp")
    state = b.start(batch, work)
    assert state["status"] == PARTLY and (state["done"], state["failed"]) == (2, 1)
    query.processAllAvailable()
    assert {e["event_type"] for e in seen} >= {"批次开始", "批次完成"}
    b.unfollow(query)
    assert b.prune() == 0 and not b.following
    with pytest.raises(ValueError):
        b.start(batch, work)
    report = b.report(batch)
    assert (report["passed"], report["not_passed"], report["redline_rate"], report["reasons"]) == (1, 1, 0.0, [("r1", 1), ("r2", 1)])
    assert {r.name: r.status for r in b.results(batch).collect()} == {"a.pdf": DONE, "b.PDF": FAILED, "c.pdf": DONE}
    b.publish(*(make_event("stage", batch, n=i) for i in range(5)))
    assert b.history(batch, 3).count() == 3
    out = tmp_path / "out" / "d"
    out.mkdir(parents=True)
    (out / "f.json").write_text("{}")
    assert b.outputs(f"file://{tmp_path}/out") == [("d/f.json", 2)] and b.output(f"file://{tmp_path}/out", "d\\f.json").endswith("/d/f.json") and b.outputs(f"file://{tmp_path}/none") == []
    for name in ("../x", "d/g.json"):
        with pytest.raises(KeyError):
            b.output(f"file://{tmp_path}/out", name)


def test_page_pointer_in_plain_loops(spark):
    rng = random.Random(5)
    pages, titles, want = [], [], {}
    for doc in range(25):
        heads = [rng.choice("ABCDE") + rng.choice("12") for _ in range(rng.randrange(1, 12))]
        titles += [(doc, i + 1, t) for i, t in enumerate(heads)]
        at = 0
        for page in range(8):
            lines = [rng.choice("ABCDE") + rng.choice("12") for _ in range(rng.randrange(0, 9))]
            pages.append((doc, page, lines))
            while at + 1 < len(heads) and heads[at + 1] in lines:
                at += 1
            want[doc, page] = at + 1
    got = page_sections(spark.createDataFrame(pages, "doc_id long, page_index long, lines array<string>"), spark.createDataFrame(titles, "doc_id long, sec_ord long, title string"), to_shared)
    assert {(r.doc_id, r.page_index): r.sec_ord for r in got.collect()} == want


def test_row_clusters_in_plain_loops(spark):
    rng = random.Random(6)
    given = [[(i, float(rng.randrange(0, 120)), float(rng.randrange(0, 99)), float(rng.randrange(4, 40))) for i in range(rng.randrange(1, 25))] for _ in range(30)]
    df = spark.createDataFrame([(k, b) for k, b in enumerate(given)], "k int, b array<struct<id:long,cy:double,cx:double,height:double>>")
    for r in df.select("k", row_clusters(F.col("b")).alias("rows")).collect():
        boxes = given[r.k]
        heights = sorted(h for *_, h in boxes)
        n = len(heights)
        reach = max(12.0, 0.6 * (heights[(n - 1) // 2] + heights[n // 2]) / 2)
        rows, want = [], {}
        for i, cy, cx, _ in sorted(boxes, key=lambda b: (b[1], b[2], b[0])):
            if not rows or abs(cy - sum(rows[-1]) / len(rows[-1])) > reach:
                rows.append([])
            rows[-1].append(cy)
            want[i] = len(rows) - 1
        assert {x.id: x.row for x in r.rows} == want


def test_merges_in_plain_loops(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for doc in range(40):
        n = rng.randrange(1, 9)
        own = [(doc, i + 1, str(i), rng.choice(["T", "U", ""]), "\n".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 6))), rng.choice([None, "previous", "next"]), rng.random() < 0.5) for i in range(n)]
        rows += own
        union = lambda a, b: [*dict.fromkeys(x for x in [*a, *b] if x)]
        left = [[o, [*dict.fromkeys(x for x in o[4].split("\n") if x)], {o[1]}] for o in own]
        for o in reversed(own):
            at = next(i for i, x in enumerate(left) if x[0] is o)
            if not o[5] or len(left) < 2:
                continue
            to = at - 1 if (o[5] == "previous" and at > 0) or at == len(left) - 1 else at + 1
            moved = union([o[3]] if o[6] else [], left[at][1])
            left[to][1] = union(moved, left[to][1]) if to > at else union(left[to][1], moved)
            left[to][2] |= left[at][2]
            del left[at]
        for o, body, members in left:
            for m in members:
                want[doc, m] = (None, o[1]) if m != o[1] else ("\n".join(body), None)
    got = merge_sections(spark.createDataFrame(rows, "doc_id long, sec_ord long, sec_no string, title string, body string, direction string, keep_title boolean"))
    assert {(r.doc_id, r.sec_ord): (r.body, r.merged_into) for r in got.collect()} == want


def test_refinement(spark):
    sections = spark.createDataFrame([(1, 1, "1", "DN", "a", True, False), (1, 2, "2", "Scope", "b", False, True), (1, 3, "3", "mm", "c\nd\ne\nf\ng", True, False), (1, 4, "4", "End", "h", False, True)], "doc_id long, sec_ord long, sec_no string, title string, body string, hard boolean, keep_title boolean")
    blocks = spark.createDataFrame([(1, 1, "表格碎片", "", "mm", True, False), (1, 2, "标题", "it is.", "x", False, True), (1, 3, "正文", "", "y", True, True)], "doc_id long, ord long, kind string, title string, content string, hard boolean, soft boolean")
    kept, cleaned, moved = local_cleanup(sections, blocks)
    assert {r.sec_ord: r.body for r in kept.collect()} == {2: "a\nb", 4: "c\nd\ne\nf\ng\nh"}
    assert {r.ord: (r.kind, r.title, r.content, r.changed) for r in cleaned.collect()} == {2: ("正文", "", "it is.\nx", True), 3: ("正文", "", "y", False)}
    assert {r.sec_ord: r.merged_into for r in moved.collect()} == {1: 2, 3: 4}
    records = spark.createDataFrame([(1, "1 DN"), (2, "1 DN")], "doc_id long, section_ref string")
    names = spark.createDataFrame([(1, "1 DN", "2 Scope")], "doc_id long, old_ref string, new_ref string")
    assert {r.doc_id: r.section_ref for r in renamed_references(records, names).collect()} == {1: "2 Scope", 2: "1 DN"}
    one = lambda df: df
    state, log = refine(kept, one, lambda s: s.where("sec_ord = 4"), lambda c: c, lambda s, d: s.where("sec_ord <> 4"), one, lambda df: df.cache())
    assert [x["stage"] for x in log] == ["local", "model"] and state.count() == 1

    def broken(shown):
        raise ValueError("no answer")

    assert refine(kept, one, one, broken, one, one, one)[1][-1] == {"round": 1, "stage": "model", "candidates": 2, "success": False, "error": "no answer"}
    assert len(refine(kept, one, one, None, one, one, one)[1]) == 1
