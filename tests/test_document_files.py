"""Documents as files: records of the relations, commits, repeated attempts, aborts."""

import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratafold.plans.state import COLUMNS, empty
from stratafold.sources.document_files import DocumentFiles, DocumentWriter, document_records, save_documents


def tree(folder):
    return sorted(os.path.relpath(f"{d}/{f}", folder) for d, _, names in os.walk(folder) for f in names if not f.endswith(".crc"))


def test_records_of_relations(spark, tmp_path):
    frames = {k: empty(spark, k, "string") for k in COLUMNS}
    frames["doc"] = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    frames["sec"] = spark.createDataFrame([("a", 2, "2", "Maße", 1, "", "", ""), ("a", 1, "1", "Scope", 1, "", "text \"q\"", "Part 1")], "doc_id string, ord long, no string, title string, level long, parent_no string, body string, part string")
    frames["tab"] = spark.createDataFrame([("a", 1, "第1页_表1", "T", "1 Scope")], "doc_id string, ord long, table_no string, title string, section_ref string")
    frames["cel"] = spark.createDataFrame([("a", 1, r, c, f"{r}{c}") for r in range(3) for c in range(12)], "doc_id string, ord long, row_idx long, col_idx long, cell string")
    frames["md"] = spark.createDataFrame([("a", i, f"line {i}") for i in range(12)], "doc_id string, line_no long, line string")
    got = {(r.doc_id, r.kind): r.value for r in document_records(frames).collect()}
    assert len(got) == 14 and got["b", "sections"] == "[]" and got["b", "markdown"] == "" and got["a", "markdown"].split("\n")[10] == "line 10"
    assert [(x["章节编号"], x["章节清洗文本"]) for x in json.loads(got["a", "sections"])] == [("1", 'text "q"'), ("2", "")]
    one = json.loads(got["a", "tables"])[0]
    assert one["表头"] == [f"0{c}" for c in range(12)] and [r[0] for r in one["表体"]] == ["10", "20"]
    folder = f"{tmp_path}/out"
    save_documents(spark, frames, folder)
    files = tree(folder)
    assert len(files) == 14 and "a/章节结构.json" in files and "b/原文解析.md" in files
    assert json.load(open(f"{folder}/a/章节结构.json"))[0]["所属部分"] == "Part 1"
    save_documents(spark, frames, folder)  # again: the same set of files
    assert tree(folder) == files


def test_a_repeated_attempt_leaves_one_set(tmp_path):
    writer = DocumentWriter(f"file://{tmp_path}")
    rows = [Row(doc_id="a", kind="sections", value="[1]"), Row(doc_id="../x", kind="tags", value='{"t": [], "_inner": 1}')]

    def broken():
        yield rows[0]
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    first, second = writer.write(iter(rows)), writer.write(iter(rows))  # the same task twice
    assert first.folder != second.folder
    writer.commit([second, None])
    assert tree(tmp_path) == ["_/x/tags.json", "a/章节结构.json"] and json.load(open(f"{tmp_path}/_/x/tags.json")) == {"t": []}
    other = DocumentWriter(f"file://{tmp_path}")
    other.abort([other.write(iter([Row(doc_id="c", kind="rules", value="[]")]))])
    assert tree(tmp_path) == ["_/x/tags.json", "a/章节结构.json"]


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(DocumentFiles)
    rows = spark.range(40, numPartitions=4).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.when(F.col("id") == 33, "nothing of the kind").otherwise("rules").alias("kind"), F.lit("[]").alias("value"))
    with pytest.raises(Exception, match="no file for kind"):
        rows.write.format("document_files").mode("append").save(f"{tmp_path}/out")
    assert tree(tmp_path) == []
    with pytest.raises(Exception, match="mode append"):
        rows.write.format("document_files").mode("overwrite").save(f"{tmp_path}/out")
