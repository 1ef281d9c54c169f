"""Batches of files as tables in a shared folder: files, results and events, each appended to and read as Parquet or JSON.

State lives in the folder and survives its driver. Files of a batch are worked on in parallel; one that fails is a row with
its error. Events are a stream: whoever follows a batch gets its history first and then what comes.
"""

from __future__ import annotations

import json
import traceback
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Events kept per batch, states, event types, keys that a result must have.
HISTORY = 500
WAITING, RUNNING, DONE, PARTLY, FAILED = "待开始", "处理中", "已完成", "部分完成", "失败"
EVENTS = {"batch_start": "批次开始", "file_start": "文件开始", "stage": "阶段进度", "round": "评审轮次", "file_done": "文件完成", "file_failed": "文件失败", "batch_done": "批次完成", "batch_failed": "批次失败", "heartbeat": "心跳"}
REQUIRED = ("document", "markdown", "summary", "tags", "process_log", "review", "review_rounds")
FILE = "batch_id string, file_id string, name string, size long, path string, layers array<string>, relative_path string"
EVENT = "batch_id string, event_type string, ts timestamp, payload string"
RESULT = "batch_id string, file_id string, name string, status string, score double, passed boolean, redline boolean, reasons array<string>, rounds int, error string, trace string"


def new_batch_id(now: datetime | None = None) -> str:
    return f"b_{(now or datetime.now()).strftime('%Y%m%d%H%M%S')}_{uuid.uuid4().hex[:6]}"


def new_file_id() -> Column:
    return F.concat(F.lit("f_"), F.substring(F.regexp_replace(F.expr("uuid()"), "-", ""), 1, 10))


def logical_parent(layers: str = "layers", path: str = "relative_path") -> Column:
    """Source layers and folders of a file, without the file itself."""
    parts = F.filter(F.split(F.regexp_replace(F.coalesce(F.col(path), F.lit("")), r"\\", "/"), "/"), lambda p: p != "")
    return F.when(F.size(parts) > 1, F.concat(F.col(layers), F.slice(parts, 1, F.greatest(F.lit(0), F.size(parts) - 1)))).otherwise(F.col(layers))


def make_event(event_type: str, batch_id: str, now: datetime | None = None, **payload) -> dict:
    return {"batch_id": batch_id, "event_type": EVENTS.get(event_type, event_type), "ts": now or datetime.now(), "payload": json.dumps(payload, ensure_ascii=False, default=str)}


class Batches:
    """All batches under a shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.following: dict[str, StreamingQuery] = {}

    def _read(self, kind: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{kind}"
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.schema(schema).parquet(path) if there else self.spark.createDataFrame([], schema)

    def create(self, files: DataFrame, batch_id: str | None = None) -> str:
        """A new batch of files(name, size, path, layers, relative_path); names that do not end in .pdf are refused."""
        if not files.where(~F.lower("name").endswith(".pdf")).isEmpty():
            raise ValueError("only PDF files can be processed")
        batch_id = batch_id or new_batch_id()
        rows = files.select(F.lit(batch_id).alias("batch_id"), new_file_id().alias("file_id"), "name", F.col("size").cast("long").alias("size"), "path", "layers", "relative_path")
        rows.write.mode("append").parquet(f"{self.folder}/files")
        return batch_id

    def files(self, batch_id: str) -> DataFrame:
        return self._read("files", FILE).where(F.col("batch_id") == batch_id)

    def file(self, batch_id: str, file_id: str) -> DataFrame:
        return self.files(batch_id).where(F.col("file_id") == file_id)

    def results(self, batch_id: str) -> DataFrame:
        return self._read("results", RESULT).where(F.col("batch_id") == batch_id)

    def publish(self, *events: dict) -> None:
        """Append events; whoever follows gets them with the next trigger."""
        self.spark.createDataFrame([tuple(e[k] for k in ("batch_id", "event_type", "ts", "payload")) for e in events], EVENT).coalesce(1).write.mode("append").parquet(f"{self.folder}/events")

    def history(self, batch_id: str, keep: int = HISTORY) -> DataFrame:
        """The newest `keep` events of a batch, oldest first."""
        own = self._read("events", EVENT).where(F.col("batch_id") == batch_id)
        return own.orderBy(F.desc("ts"), F.desc("payload")).limit(keep).orderBy("ts", "payload")

    def follow(self, batch_id: str, push: Callable[[list[dict]], None], checkpoint: str, **trigger) -> StreamingQuery:
        """Hand every event of a batch to push, those that came before first."""
        self.publish(make_event("heartbeat", batch_id))
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.folder}/events").where(F.col("batch_id") == batch_id)

        def hand_on(rows: DataFrame, _: int) -> None:
            push([r.asDict() for r in rows.orderBy("ts", "payload").toLocalIterator()])

        query = stream.writeStream.foreachBatch(hand_on).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "2 seconds"})).start()
        self.following[query.id] = query
        return query

    def unfollow(self, query: StreamingQuery) -> None:
        query.stop()
        self.following.pop(query.id, None)

    def prune(self) -> int:
        """Forget followers that have ended; returns how many."""
        ended = [k for k, q in self.following.items() if not q.isActive]
        for k in ended:
            del self.following[k]
        return len(ended)

    def status(self, batch_id: str) -> dict:
        """State and counts of a batch."""
        n = self.files(batch_id).count()
        if not n:
            raise KeyError(batch_id)
        ended = {r["status"]: r["count"] for r in self.results(batch_id).groupBy("status").count().collect()}
        done, lost = ended.get(DONE, 0), ended.get(FAILED, 0)
        began = not self._read("events", EVENT).where((F.col("batch_id") == batch_id) & (F.col("event_type") == EVENTS["batch_start"])).isEmpty()
        state = (RUNNING if began else WAITING) if done + lost < n else DONE if not lost else FAILED if not done else PARTLY
        return {"batch_id": batch_id, "status": state, "files": n, "done": done, "failed": lost}

    def start(self, batch_id: str, work: Callable[[dict], dict]) -> dict:
        """Work on all files of a waiting batch, in parallel. work gets a file's row and returns a result with all REQUIRED
        keys; its review has score, passed, redline and reasons. A file whose work fails, or whose result lacks a key, is a
        failed file; the others go on."""
        if self.status(batch_id)["status"] != WAITING:
            raise ValueError("the batch has been started before")
        self.publish(make_event("batch_start", batch_id))

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                rows = []
                for row in part.to_dict("records"):
                    try:
                        result = work(row)
                        missing = [k for k in REQUIRED if k not in result]
                        if missing:
                            raise RuntimeError(f"the result lacks {missing}")
                        review = result["review"]
                        passed = bool(review.get("passed"))
                        rows.append((row["batch_id"], row["file_id"], row["name"], DONE, float(review.get("score") or 0), passed, bool(review.get("redline")), [] if passed else [*review.get("reasons", [])], len(result["review_rounds"]), None, None))
                    except Exception as error:
                        rows.append((row["batch_id"], row["file_id"], row["name"], FAILED, None, None, None, [], 0, str(error), traceback.format_exc()))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

        tasks = self.files(batch_id)
        n = min(tasks.count(), 4 * self.spark.sparkContext.defaultParallelism)
        tasks.repartition(max(1, n)).mapInPandas(run, RESULT).write.mode("append").parquet(f"{self.folder}/results")
        state = self.status(batch_id)
        self.publish(make_event("batch_failed" if state["status"] == FAILED else "batch_done", batch_id, **{k: v for k, v in state.items() if k != "batch_id"}))
        return state

    def report(self, batch_id: str, top: int = 3) -> dict:
        """Counts, rates and the most frequent reasons of a batch."""
        r = self.results(batch_id)
        share = lambda n, m: round(100 * n / m, 1) if m else 0.0
        state = self.status(batch_id)
        count = lambda c: F.sum(F.coalesce(c.cast("int"), F.lit(0)))
        passed, failed, red = r.agg(count(F.col("passed")), count(~F.col("passed")), count(F.col("redline"))).first()
        reasons = r.select(F.explode("reasons").alias("reason")).where("reason <> ''").groupBy("reason").count().orderBy(F.desc("count"), "reason").limit(top).collect()
        return state | {"passed": passed or 0, "not_passed": failed or 0, "redline": red or 0, "redline_rate": share(red or 0, state["files"]), "reasons": [(x["reason"], x["count"]) for x in reasons]}

    def outputs(self, folder: str) -> list[tuple[str, int]]:
        """(path under the folder, size) of all files below a folder, by path."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(folder)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        base = fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
        found, each = [], fs.listFiles(root, True)
        while each.hasNext():
            f = each.next()
            found.append((f.getPath().toUri().getPath().removeprefix(base), f.getLen()))
        return sorted(found)

    def output(self, folder: str, name: str) -> str:
        """Path of one of a folder's files; a name that is none of them, or leads out of the folder, is refused."""
        name = name.replace("\\", "/")
        if ".." in name.split("/") or name not in {n for n, _ in self.outputs(folder)}:
            raise KeyError(name)
        return f"{folder.rstrip('/')}/{name}"
