"""Sinks: partitioned JSON under the public contract's file names, and the bilingual key map."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: File names of the public contract and public names of columns.
FILES = {"profile": "文档画像.json", "sections": "章节结构.json", "tables": "表格.json", "params": "数值型参数.json", "rules": "规则类内容.json", "inspections": "检验与证书.json", "standards": "引用标准.json", "trace": "trace_map.json", "markdown": "原文解析.md", "summary": "summary.json", "tags": "tags.json", "process_log": "process_log.json", "review": "review.json", "review_rounds": "review_rounds.json", "confidence": "OCR置信度.json"}
PUBLIC = {"sec_no": "章节编号", "title": "章节标题", "level": "章节层级", "parent_no": "父章节编号", "body": "章节清洗文本", "part": "所属部分", "name": "参数名称", "clean_value": "参数值清洗值", "unit": "参数单位", "lower_bound": "参数范围下限", "upper_bound": "参数范围上限", "comparator": "比较符号", "condition": "适用条件", "section_ref": "所属章节", "rule_type": "规则类型", "code": "标准编号", "family": "标准族"}


def public_names(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).alias(PUBLIC.get(c, c)) for c in df.columns if not c.startswith("_")))


def write_records(df: DataFrame, folder: str, kind: str, key: str = "doc_id", mode: str = "errorifexists") -> str:
    """Records of one kind, in a folder of the contract's name, partitioned by document; inner columns (_…) are left out."""
    path = f"{folder}/{FILES[kind]}"
    public_names(df).write.mode(mode).partitionBy(key).json(path)
    return path


def without_inner_keys(column: str):
    """A map without the keys that begin with an underscore."""
    return F.map_filter(column, lambda k, v: ~k.startswith("_"))


def document_json(value: object) -> str:
    """JSON as the contract has it: two spaces of indent, letters of all scripts as they are."""
    return json.dumps(value, ensure_ascii=False, indent=2)


def write_documents(records: DataFrame, folder: str) -> DataFrame:
    """records(doc_id, kind, value as JSON) -> one file for each document and kind, in a folder of the document's own, with
    its public name. Inner keys are taken out of summaries and tags, not out of the process log. Files are written by the
    tasks, on a file system that workers reach; each goes under a name of its own first and is then put in place, so a task
    that is repeated leaves one file. Returns (doc_id, path)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        for part in parts:
            rows = []
            for doc_id, kind, value in zip(part["doc_id"], part["kind"], part["value"]):
                found = json.loads(value)
                if kind in ("summary", "tags") and isinstance(found, dict):
                    found = {k: v for k, v in found.items() if not k.startswith("_")}
                text = found if kind == "markdown" else document_json(found)
                files.create_dir(f"{root}/{doc_id}", recursive=True)
                path = f"{root}/{doc_id}/{FILES[kind]}"
                draft = f"{path}.{uuid.uuid4().hex}"
                with files.open_output_stream(draft) as out:
                    out.write(text.encode())
                files.move(draft, path)
                rows.append((doc_id, path))
            yield pd.DataFrame(rows, columns=["doc_id", "path"])

    kind = records.schema["doc_id"].dataType.simpleString()
    return records.select("doc_id", "kind", "value").mapInPandas(run, f"doc_id {kind}, path string")
