"""Parsed documents as files: records of a document from its relations, and a data source that writes them with commits.

`df.write.format("document_files").mode("append").save(folder)` takes doc_id, kind and value (JSON, or Markdown text). A task
writes drafts into a folder of its own; when all tasks are done the drafts are put in place, and when one fails for good they
are deleted. A task that is repeated, or runs twice, leaves nothing but the drafts of the attempt that counted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from stratafold.sources.export import FILES, document_json

#: Public names of the columns of a relation, in order.
SHOWN = {
    "sections": ("sec", {"no": "章节编号", "title": "章节标题", "level": "章节层级", "parent_no": "父章节编号", "body": "章节清洗文本", "part": "所属部分"}),
    "params": ("par", {"param_id": "参数ID", "name": "参数名称", "value": "参数值清洗值", "unit": "参数单位", "lower": "参数范围下限", "upper": "参数范围上限", "comparator": "比较符号", "cond": "适用条件", "section_ref": "所属章节", "table_no": "来源表格", "source_item": "来源子项"}),
    "rules": ("rul", {"rule_id": "规则ID", "rule_type": "规则类型", "content": "规则内容", "section_ref": "所属章节"}),
    "inspections": ("ins", {"object": "检验对象", "method": "检验方法", "requirement": "检验要求", "section_ref": "所属章节"}),
    "standards": ("std", {"code": "标准编号", "title": "标准名称", "kind": "标准类型", "section_ref": "所属章节", "family": "标准族"}),
    "tables": ("tab", {"table_no": "表格编号", "title": "表格标题", "section_ref": "所属章节", "header": "表头", "body": "表体"}),
}


def document_records(frames: dict[str, DataFrame]) -> DataFrame:
    """records(doc_id, kind, value) of the relations of document.outputs: an ordered JSON list for each kind that SHOWN names,
    empty ones too, and the Markdown. Every document of `doc` has all kinds."""
    docs = frames["doc"].select("doc_id")
    rows = frames["cel"].groupBy("doc_id", "ord", "row_idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "cell"))), lambda c: c["cell"]).alias("cells"))
    grids = rows.groupBy("doc_id", "ord").agg(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "cells"))), lambda r: r["cells"]).alias("grid"))
    grids = grids.select("doc_id", "ord", F.get("grid", F.lit(0)).alias("header"), F.expr("slice(grid, 2, greatest(size(grid) - 1, 0))").alias("body"))
    own = frames | {"tab": frames["tab"].join(grids, ["doc_id", "ord"], "left")}
    made = []
    for kind, (relation, names) in SHOWN.items():
        shown = F.struct(*(F.col(c).alias(n) for c, n in names.items()))
        listed = own[relation].groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", F.to_json(shown, {"ignoreNullFields": "false"}).alias("x")))), lambda r: r["x"]).alias("rows"))
        made.append(docs.join(listed, "doc_id", "left").select("doc_id", F.lit(kind).alias("kind"), F.concat(F.lit("["), F.coalesce(F.array_join("rows", ","), F.lit("")), F.lit("]")).alias("value")))
    text = frames["md"].groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda r: r["line"]), "\n").alias("text"))
    made.append(docs.join(text, "doc_id", "left").select("doc_id", F.lit("markdown").alias("kind"), F.coalesce("text", F.lit("")).alias("value")))
    return reduce(DataFrame.unionByName, made)


def safe_folder(doc_id: object) -> str:
    """The folder of a document: its id without what leads out of a folder."""
    return str(doc_id).replace("\\", "/").strip("/").replace("..", "_") or "_"


@dataclass
class Drafts(WriterCommitMessage):
    """The folder of a task's drafts."""

    folder: str


class DocumentWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder.rstrip("/"), f"_drafts-{uuid.uuid4().hex}"

    def _files(self):
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{self.folder.removeprefix('file:')}")
        return files, root

    def write(self, iterator: Iterator[Row]) -> Drafts:
        files, root = self._files()
        own = f"{root}/{self.job}/{uuid.uuid4().hex}"
        files.create_dir(own, recursive=True)
        for row in iterator:
            if row["doc_id"] is None or row["kind"] not in FILES:
                raise ValueError(f"no file for kind {row['kind']} of document {row['doc_id']}")
            text = row["value"] or ""
            if row["kind"] != "markdown":
                found = json.loads(text or "null")
                if row["kind"] in ("summary", "tags") and isinstance(found, dict):
                    found = {k: v for k, v in found.items() if not k.startswith("_")}
                text = document_json(found)
            files.create_dir(f"{own}/{safe_folder(row['doc_id'])}", recursive=True)
            with files.open_output_stream(f"{own}/{safe_folder(row['doc_id'])}/{FILES[row['kind']]}") as out:
                out.write(text.encode())
        return Drafts(own)

    def commit(self, messages: list[Drafts | None]) -> None:
        """Put the drafts of the attempts that count in place; those of others go with the folder of the job."""
        from pyarrow import fs

        files, root = self._files()
        for message in messages:
            if message is not None:
                for x in files.get_file_info(fs.FileSelector(message.folder, recursive=True)):
                    if x.type == fs.FileType.File:
                        to = f"{root}/{x.path.removeprefix(message.folder).lstrip('/')}"
                        files.create_dir(to.rsplit("/", 1)[0], recursive=True)
                        files.move(x.path, to)
        self.abort([])

    def abort(self, messages: list[Drafts | None]) -> None:
        from pyarrow import fs

        files, root = self._files()
        if files.get_file_info(f"{root}/{self.job}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.job}")


class DocumentFiles(DataSource):
    """The data source `document_files`; its path is a folder that driver and workers reach."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def schema(self) -> str:
        return "doc_id string, kind string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        if overwrite:
            raise ValueError("documents are added to a folder: use mode append")
        return DocumentWriter(self.options["path"])


def save_documents(spark: SparkSession, frames: dict[str, DataFrame], folder: str) -> None:
    """Write the relations of documents as files, one folder for each document."""
    spark.dataSource.register(DocumentFiles)
    document_records(frames).withColumn("doc_id", F.col("doc_id").cast("string")).write.format("document_files").mode("append").save(folder)
