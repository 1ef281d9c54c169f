"""Folds, providers, exports and streams."""

import json

import pytest
from pyspark.sql import functions as F

from stratafold.functions.dialect import SPARK
from stratafold.operators.folds import merge_cell_texts, row_clusters
from stratafold.operators.merge import merge_sections, review_loop
from stratafold.operators.pointers import page_sections
from stratafold.plans.document import to_shared
from stratafold.plans import all_queries
from stratafold.plans.folded import FOLDED
from stratafold.plans.registry import run_sql, with_
from stratafold.plans.structure import sections
from stratafold.sources.export import write_records, without_inner_keys
from stratafold.sources.providers import Settings, decode_pages, regular_grid, with_recognised
from stratafold.streaming.progress import EVENT_SCHEMA, event_counts, keep_history, last_events, sse


def test_page_pointer_stops_at_a_skipped_title(spark):
    pages = spark.createDataFrame([(1, 0, ["A", "x"]), (1, 1, ["B", "C"]), (1, 2, ["y"]), (1, 3, ["E"])], "doc_id long, page_index long, lines array<string>")
    sections = spark.createDataFrame([(1, 1, "A"), (1, 2, "B"), (1, 3, "C"), (1, 4, "D"), (1, 5, "E")], "doc_id long, sec_ord long, title string")
    got = {r.page_index: r.sec_ord for r in page_sections(pages, sections, to_shared).collect()}
    assert got == {0: 1, 1: 3, 2: 3, 3: 3}


def test_documents_of_more_than_500_sections_stay_whole(spark, tmp_path):
    part = [(k, f"steel part {c}{k}", f"Brand#{k}", "STANDARD STEEL", k % 50 + 1) for k in range(50) for c in "ab"]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    heads = run_sql(spark, str(tmp_path), with_(sections(SPARK), "SELECT sec_ord FROM heads"))
    n = heads.count()
    assert n > 500
    got = all_queries()["w06_section_merges"](spark, str(tmp_path)).collect()
    assert sorted(r.sec_ord for r in got) == list(range(1, n + 1))
    seen = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr("stratafold.plans.folded.page_sections", lambda pages, titles, keep: seen.append(titles) or titles)
        FOLDED["j04_page_pointer"](spark, str(tmp_path))
    assert sorted(r.sec_ord for r in seen[0].collect()) == list(range(1, n + 1))


def test_row_clusters_follow_the_running_mean(spark):
    boxes = [(1, 10.0, 5.0, 10.0), (2, 12.0, 50.0, 10.0), (3, 22.0, 5.0, 10.0), (4, 60.0, 5.0, 10.0)]
    df = spark.createDataFrame([(boxes,)], "b array<struct<id:long,cy:double,cx:double,height:double>>")
    got = {r.id: r.row for r in df.select(F.inline(row_clusters(F.col("b")))).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1}
    empty = spark.createDataFrame([([],)], "b array<struct<id:long,cy:double,cx:double,height:double>>")
    assert empty.select(row_clusters(F.col("b")).alias("r")).first().r == []


def test_merge_cell_texts(spark):
    df = spark.createDataFrame([([(1.0, 2.0, "b"), (1.0, 1.0, "a"), (1.0, 3.0, "b")],), ([(1.0, 1.0, "a"), (20.0, 1.0, "b")],)], "i array<struct<cy:double,cx:double,text:string>>")
    assert [r.t for r in df.select(merge_cell_texts(F.col("i")).alias("t")).collect()] == ["a b", "a\nb"]


def test_broken_file_is_a_row(spark):
    files = spark.createDataFrame([("a", b"ok"), ("b", b"bad")], "path string, content binary")

    def decode(content):
        if content == b"bad":
            raise ValueError("broken")
        return [{"lines": ["x", "y"], "width": 1.0, "height": 2.0}]

    got = {r.doc_id: r for r in decode_pages(files, decode).collect()}
    assert got["a"].lines == ["x", "y"] and got["a"].error is None
    assert got["b"].lines == [] and "broken" in got["b"].error
    text = spark.createDataFrame([("a", 0, " p \n\nq")], "doc_id string, page_index int, text string")
    row = with_recognised(decode_pages(files, decode).where("error is null"), text).first()
    assert row.lines == ["p", "q"] and row.ocr_used


def test_regular_grid(spark):
    df = spark.createDataFrame([([["a", "b", ""], ["c"]],), ([["x"]],), ([["", ""], ["", ""]],)], "g array<array<string>>")
    assert [r.g for r in df.select(regular_grid("g").alias("g")).collect()] == [[["a", "b"], ["c", ""]], None, [[""], [""]]]


def test_settings():
    assert Settings().plan(20) == {"dpi": 220, "batches": 4, "reduced": True}
    with pytest.raises(ValueError):
        Settings(ocr_dpi=10)


def test_export_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "1.2", "T", "x")], "doc_id long, sec_no string, title string, _inner string")
    path = write_records(df, str(tmp_path), "sections")
    row = spark.read.json(path).first().asDict()
    assert row["章节编号"] == "1.2" and row["章节标题"] == "T" and "_inner" not in row
    m = spark.createDataFrame([({"_a": "1", "b": "2"},)], "m map<string,string>").select(without_inner_keys("m").alias("m")).first().m
    assert m == {"b": "2"}


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lines = [{"event_type": "start", "batch_id": "b", "ts": f"2024-01-01T00:0{i % 9}:00", "payload": str(i)} for i in range(9)]
    (src / "a.json").write_text("\n".join(map(json.dumps, [*lines, lines[0]])))
    events = spark.readStream.schema(EVENT_SCHEMA).json(str(src))
    keep_history(events, str(tmp_path / "out"), str(tmp_path / "cp"), keep=5).awaitTermination(60)
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert last_events(kept, 3).count() == 3 and kept.count() == 5
    assert sse(kept).first().message.startswith("data: {")
    q = event_counts(events).writeStream.format("memory").queryName("counts").outputMode("append").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("counts").schema.names == ["start", "end", "batch_id", "event_type", "count"]


def test_section_merges_chain_from_the_end(spark):
    rows = [(1, 1, "1", "A", "a", "next", True), (1, 2, "2", "B", "b\na", None, True), (1, 3, "3", "C", "c", "previous", False), (1, 4, "4", "D", "d\nc", "previous", True), (2, 1, "1", "only", "x", "previous", True)]
    got = {(r.doc_id, r.sec_ord): (r.body, r.merged_into) for r in merge_sections(spark.createDataFrame(rows, "doc_id long, sec_ord long, sec_no string, title string, body string, direction string, keep_title boolean")).collect()}
    assert got == {(1, 1): (None, 2), (1, 2): ("A\na\nb\nc\nD\nd", None), (1, 3): (None, 2), (1, 4): (None, 2), (2, 1): ("x", None)}


def test_review_loop_keeps_the_best_round(spark):
    state = spark.createDataFrame([(1, 90, 0), (2, 60, 15), (3, 70, 0), (4, 80, -5), (5, 10, 1)], "doc_id long, points long, gain long")
    review = lambda s: s.select("doc_id", F.col("points").alias("score"), F.lit(False).alias("redline"), F.col("points").cast("string").alias("fingerprint"))
    repair = lambda s: s.withColumn("points", F.col("points") + F.col("gain"))
    got = {r.doc_id: (r.round, r.score, r.passed) for r in review_loop(state, review, repair, lambda df: df.cache()).collect()}
    assert got == {1: (1, 90, True), 2: (3, 90, True), 3: (1, 70, False), 4: (1, 80, False), 5: (3, 12, False)}
