"""A language model as an external structured source.

A request asks for JSON of a given schema. Two protocols are tried: the vendor's own, if that is the endpoint, and chat
completions, first bound to the schema and then to JSON at large with the schema in the prompt. Requests that are refused
for their rate or by a broken server are tried again. The model is reached over HTTP by the standard library; without a key
there is none, and rule-based results stand.
"""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Statuses worth another try, most tries after the first, growth of the pause, its random share; longest answer.
RETRIED, MOST_RETRIES, GROWTH, JITTER, MOST_TOKENS = (429, 500, 502, 503), 5, 1.5, 0.5, 4000
VENDOR, VENDOR_URL = "openai.com", "https://api.openai.com/v1"
PROXIES = ("HTTP_PROXY", "HTTPS_PROXY", "http_proxy", "https_proxy", "ALL_PROXY", "all_proxy")

#: What a summary and tags must and must not do; their short hash signs every run.
SUMMARY_RULES = "Summarise technical documents from the given facts only. Invent nothing. Keep chapters, parameters, rules and standards together as they belong. Write simplified Chinese; give a foreign term as 中文（原文：X） only where it is needed."
TAG_RULES = "Clean and merge the tags of technical documents. Use the given evidence only. Write short nouns in simplified Chinese; return no sentences."
#: Names of the tag lists in an answer and in the result.
TAG_LISTS = {
    "doc_type_tags": "文档类型标签", "topic_tags": "文档主题标签", "process_tags": "工艺流程标签", "parameter_tags": "参数标签", "inspection_tags": "检验标签", "standard_tags": "标准引用标签", "product_series_tags": "产品系列标签",
    "product_model_tags": "产品型号标签", "application_tags": "应用标签", "certification_tags": "认证标签", "defect_tags": "缺陷标签", "weld_type_tags": "焊缝类型标签", "region_tags": "区域标签",
}


class Refused(Exception):
    """An answer with an HTTP status."""

    def __init__(self, status: int, text: str = ""):
        super().__init__(f"HTTP {status}: {text[:300]}")
        self.status = status


def disabled_proxy(value: str) -> bool:
    """A proxy of this machine on the discard port stands for none."""
    u = urlparse(value)
    return (u.hostname or "").lower() in ("127.0.0.1", "localhost") and u.port == 9


@contextmanager
def without_disabled_proxies():
    """The environment without proxies that stand for none; they come back afterwards."""
    taken = {k: os.environ.pop(k) for k in PROXIES if os.environ.get(k) and disabled_proxy(os.environ[k])}
    try:
        yield
    finally:
        os.environ.update(taken)


def retried(call: Callable[[], object], sleep: Callable[[float], None] = time.sleep, most: int = MOST_RETRIES) -> object:
    """call(), again after a growing pause while it is refused for its rate or by a broken server."""
    for attempt in range(most + 1):
        try:
            return call()
        except Refused as refused:
            if attempt == most or refused.status not in RETRIED:
                raise
            pause = GROWTH**attempt
            sleep(pause + random.uniform(0, JITTER * pause))
    raise AssertionError("unreachable")


def post(url: str, key: str, body: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
    try:
        with without_disabled_proxies(), urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)
    except urllib.error.HTTPError as error:
        raise Refused(error.code, error.read().decode("utf-8", "replace")) from error


@dataclass(frozen=True)
class Model:
    """Where a model is and how it is asked; taken from the environment where nothing is given. `send` makes a request and
    can be replaced."""

    name: str = field(default_factory=lambda: os.getenv("LLM_MODEL") or os.getenv("OPENAI_MODEL") or "default")
    chat_name: str = field(default_factory=lambda: os.getenv("OPENAI_CHAT_MODEL") or "")
    key: str = field(default_factory=lambda: os.getenv("LLM_API_KEY") or os.getenv("OPENAI_API_KEY") or "")
    url: str = field(default_factory=lambda: os.getenv("LLM_BASE_URL") or "")
    timeout: float = 60.0
    send: Callable[[str, str, dict, float], dict] = post

    @property
    def available(self) -> bool:
        return bool(self.key)

    @property
    def is_vendor(self) -> bool:
        return not self.url or VENDOR in self.url.lower()

    def _post(self, path: str, body: dict) -> dict:
        return self.send(f"{(self.url or VENDOR_URL).rstrip('/')}/{path}", self.key, body, self.timeout)

    def by_responses(self, messages: list[dict], name: str, schema: dict) -> tuple[dict, str]:
        body = {"model": self.name, "input": messages, "text": {"format": {"type": "json_schema", "name": name, "schema": schema, "strict": True}}}
        said = self._post("responses", body)
        text = said.get("output_text") or "".join(part.get("text", "") for item in said.get("output", []) for part in item.get("content", []))
        return json.loads(text), "responses"

    def by_chat(self, messages: list[dict], name: str, schema: dict) -> tuple[dict, str]:
        model = self.chat_name or self.name
        ask = lambda messages, kind: retried(lambda: self._post("chat/completions", {"model": model, "messages": messages, "response_format": kind, "max_completion_tokens": MOST_TOKENS}))
        try:
            said = ask(messages, {"type": "json_schema", "json_schema": {"name": name, "schema": schema, "strict": True}})
        except Exception:  # an endpoint that knows no schemas still writes JSON
            hint = f"{messages[0]['content']}\n\nAnswer with JSON of this schema only: {json.dumps(schema, ensure_ascii=False)}"
            said = ask([{"role": "system", "content": hint}, *messages[1:]], {"type": "json_object"})
        return json.loads(said["choices"][0]["message"].get("content") or ""), f"chat_completions:{model}"

    def ask(self, rules: str, payload: dict, name: str, schema: dict) -> tuple[dict, str]:
        """(answer, protocol); a RuntimeError that names both failures if neither protocol gives an answer."""
        if not self.available:
            raise RuntimeError("no model is configured")
        messages = [{"role": "system", "content": rules}, {"role": "user", "content": json.dumps(payload, ensure_ascii=False)}]
        first: Exception | None = None
        if self.is_vendor:
            try:
                return self.by_responses(messages, name, schema)
            except Exception as error:
                first = error
        try:
            return self.by_chat(messages, name, schema)
        except Exception as error:
            if first is None:
                raise
            raise RuntimeError(f"{name}: responses failed: {first}; chat failed: {error}") from error


def tag_schema() -> dict:
    lists = {k: {"type": "array", "items": {"type": "string"}} for k in TAG_LISTS}
    return {"type": "object", "properties": lists, "required": [*lists], "additionalProperties": False}


def summary_schema() -> dict:
    text = {"type": "string"}
    chapter = {"type": "object", "properties": {"title": text, "summary": text}, "required": ["title", "summary"], "additionalProperties": False}
    return {"type": "object", "properties": {"full_summary": text, "chapters": {"type": "array", "items": chapter}}, "required": ["full_summary", "chapters"], "additionalProperties": False}


def clean_tags(answer: dict) -> dict[str, list[str]]:
    """An answer's lists under their public names: normalised texts, equal and empty ones once and never."""
    flat = lambda v: " ".join(str(v).replace("　", " ").split())
    return {name: [*dict.fromkeys(t for t in map(flat, answer.get(key) or []) if t)] for key, name in TAG_LISTS.items()}


def answered(requests: DataFrame, model: Model, rules: str, name: str, schema: dict) -> DataFrame:
    """requests(doc_id, payload as JSON) with answer (JSON), backend and error: one request a row, inside the tasks. A
    failure is a row, never a failed job; without a model every row has the error that says so."""
    kind = requests.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc_id, payload in zip(part["doc_id"], part["payload"]):
                try:
                    answer, backend = model.ask(rules, json.loads(payload), name, schema)
                    rows.append((doc_id, json.dumps(answer, ensure_ascii=False), backend, None))
                except Exception as error:
                    rows.append((doc_id, None, None, f"{type(error).__name__}: {error}"[:500]))
            yield pd.DataFrame(rows, columns=["doc_id", "answer", "backend", "error"])

    return requests.select("doc_id", "payload").mapInPandas(run, f"doc_id {kind}, answer string, backend string, error string")


def with_fallback(ruled: DataFrame, answers: DataFrame, column: str = "summary") -> DataFrame:
    """Rule-based rows (doc_id, column) with the model's answer in their place where there is one, and the reason where not."""
    met = ruled.join(answers, "doc_id", "left")
    return met.select("doc_id", F.coalesce("answer", column).alias(column), F.coalesce("backend", F.lit("")).alias("backend"), F.when(F.col("answer").isNull(), F.coalesce("error", F.lit("not asked"))).otherwise("").alias("reason"))


def decided(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """A model's decisions on candidates(candidate_id, kind, place): those whose candidate exists and whose action fits its
    kind, in the order in which they can be carried out: renames, then merges from the last place back, then blocks."""
    fits = ((F.col("kind") == "section") & F.col("action").isin("rename", "merge_previous", "merge_next", "keep")) | ((F.col("kind") == "block") & F.col("action").isin("delete", "to_body", "keep"))
    rank = F.when(F.col("action") == "rename", 0).when(F.col("action").startswith("merge"), 1).otherwise(2)
    met = candidates.join(decisions.dropDuplicates(["candidate_id"]), "candidate_id").where(fits & (F.col("action") != "keep") & ~((F.col("action") == "rename") & (F.coalesce("new_title", F.lit("")) == "")))
    return met.withColumn("rank", rank).withColumn("step", F.when(F.col("rank") == 1, -F.col("place")).otherwise(F.col("place"))).orderBy("rank", "step", "candidate_id").drop("step")
