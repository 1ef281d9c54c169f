"""Rounds of review and repair over many documents, resumable: what a round has found and made lies in a shared folder, and a
round counts once its mark is written. A driver that starts again goes on with the first round without a mark.

The state of a document is a version: version 1 is its first parse, and a round writes version r + 1 for those documents only
whose pages it has changed. Of these, only the changed pages are replaced (by document and page), and only these documents are
parsed again; all others keep the version they have. The end result takes each document from its own version.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.functions.dialect import SPARK as d
from stratafold.plans.document import Keep, outputs, parse, to_shared
from stratafold.plans.registry import run_over
from stratafold.plans.state import COLUMNS
from stratafold.plans.steps import view
from stratafold.plans.text_layer import ocr_evaluated

#: Rounds, seconds, the drop of a score that ends a document, and why a document ends.
ROUNDS, BUDGET, DROP = 3, 1200.0, 0.01
PASSED, LAST, NOTHING, SAME, WORSE, CUT = "评审通过", "达到最大评审轮次", "无可用自动修正动作", "状态指纹未变化", "得分不升反降", "运行被截断"
SEEN = {"grade": "string", "inject": "boolean", "single_m": "long", "dup_m": "long", "punct_m": "long", "fragmented": "boolean"}
LOG = ("doc_id", "round", "score", "redline", "passed", "step", "before", "after", "changed", "reason")


def evaluated(spark: SparkSession, recognised: DataFrame) -> DataFrame:
    """recognised(doc_id, page_index, text) with its lines and evaluation: grade, inject and the shares behind it."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = recognised.select("doc_id", F.col("page_index").cast("long").alias("page_index"), lines.alias("lines"))
    flat = rows.select(F.struct("doc_id", "page_index").alias("doc_id"), F.posexplode("lines").alias("line_no", "line"))
    marks = spark.sql(ocr_evaluated(d, view(flat)))
    seen = marks.select("doc_id.doc_id", "doc_id.page_index", "grade", (F.col("grade") != "拒绝").alias("inject"), "single_m", "dup_m", "punct_m", "fragmented")
    return rows.join(seen, ["doc_id", "page_index"], "left").withColumn("grade", F.coalesce("grade", F.lit("拒绝"))).withColumn("inject", F.coalesce("inject", F.lit(False)))


class Rounds:
    """Review rounds in `folder`. recognise(pages(doc_id, page_index)) gives texts(doc_id, page_index, text) of pages that the
    review wants recognised; without it such pages stay as they are. `budget` are the seconds of one run over all rounds."""

    def __init__(self, spark: SparkSession, folder: str, recognise: Callable[[DataFrame], DataFrame] | None = None, rounds: int = ROUNDS, budget: float = BUDGET, keep: Keep = to_shared, clock: Callable[[], float] = time.monotonic):
        self.spark, self.folder, self.recognise, self.rounds, self.budget, self.keep, self.clock = spark, folder.rstrip("/"), recognise, rounds, budget, keep, clock

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def finished(self, turn: int) -> bool:
        path, fs = self._path(f"round-{turn}/_DONE")
        return fs.exists(path)

    def _finish(self, turn: int) -> None:
        path, fs = self._path(f"round-{turn}/_DONE")
        fs.create(path, True).close()

    def _put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self._get(name)

    def _get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def frames(self, version: int) -> dict[str, DataFrame]:
        return {k: self._get(f"version-{version}/{k}") for k in self._get(f"version-{version}/names").first()["names"]}

    def log(self) -> DataFrame:
        """What every finished round has found, a row per document and round."""
        turns = [t for t in range(1, self.rounds + 1) if self.finished(t)]
        return reduce(DataFrame.unionByName, [self._get(f"round-{t}/log") for t in turns])

    def _parse(self, pages: DataFrame, files: DataFrame | None, version: int) -> dict[str, DataFrame]:
        """Parse pages and write their frames, and the pages, as a version."""
        seen = pages.where("grade is not null").select("doc_id", "page_index", *SEEN)
        frames = outputs(self.spark, parse(self.spark, pages.drop(*SEEN), files, seen, self.keep), self.keep)
        for k, f in frames.items():
            self._put(f, f"version-{version}/{k}")
        self._put(pages, f"version-{version}/pages")
        self._put(self.spark.createDataFrame([(sorted(frames),)], "names array<string>"), f"version-{version}/names")
        return self.frames(version)

    def _repaired(self, pages: DataFrame, wanted: DataFrame) -> DataFrame:
        """Pages of the documents of wanted(doc_id, page_index) whose text has changed, with their new lines and evaluation."""
        if self.recognise is None:
            return pages.limit(0)
        got = self.keep(evaluated(self.spark, self.recognise(wanted)))
        own = pages.drop(*SEEN).join(got.withColumnRenamed("lines", "_lines"), ["doc_id", "page_index"])
        lines = F.when(F.col("inject"), F.col("_lines")).otherwise(F.col("lines"))
        changed = own.where(F.col("inject") & (F.col("_lines") != F.col("lines")))
        return changed.withColumn("lines", lines).withColumn("ocr_used", F.lit(True)).select(*pages.columns)

    def run(self, pages: DataFrame, files: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
        """(frames, ends): the relations of every document in its final version, and per document its last round: doc_id,
        round, score, redline, passed, reason, version. pages and files are those of document.parse; files may be None."""
        began = self.clock()
        if not self.finished(0):
            tables = F.col("tables") if "tables" in pages.columns else F.expr(d.no_tables)
            used = F.coalesce(F.col("ocr_used"), F.lit(False)) if "ocr_used" in pages.columns else F.lit(False)
            rows = pages.select("doc_id", F.col("page_index").cast("long").alias("page_index"), F.coalesce("lines", F.array().cast("array<string>")).alias("lines"), tables.alias("tables"), used.alias("ocr_used"), *(F.lit(None).cast(t).alias(c) for c, t in SEEN.items()))
            self._parse(rows.where("doc_id is not null and page_index is not null"), files, 1)
            self._finish(0)
        for turn in range(1, self.rounds + 1):
            if self.finished(turn):
                continue
            if turn > 1 and self._get(f"round-{turn - 1}/log").where("reason = ''").isEmpty():
                break
            self._round(turn, files, self.clock() - began > self.budget)
            self._finish(turn)
        return self.result()

    def _round(self, turn: int, files: DataFrame | None, late: bool) -> None:
        frames = self.frames(turn)
        guard = run_over(self.spark, "p01_guarded_documents", frames).select("doc_id", "refused")
        scores = run_over(self.spark, "a15_scores", frames).select("doc_id", "score", "redline", "passed")
        step = run_over(self.spark, "x20_repair_plan", frames).select("doc_id", "step")
        before = run_over(self.spark, "a17_state_fingerprint", frames).withColumnRenamed("fingerprint", "before")
        refused = F.coalesce(F.col("refused"), F.lit("")) != ""
        whole = frames["doc"].select("doc_id").join(guard, "doc_id", "left").join(scores, "doc_id", "left").join(step, "doc_id", "left").join(before, "doc_id", "left")
        whole = whole.withColumn("score", F.when(refused, 0).otherwise(F.coalesce("score", F.lit(0)))).withColumn("redline", refused | F.coalesce("redline", F.lit(False)))
        whole = whole.withColumn("passed", ~refused & F.coalesce("passed", F.lit(False))).withColumn("step", F.coalesce("step", F.lit("stop: nothing to repair")))
        halts = F.when(F.col("step") == "stop: nothing to repair", NOTHING).when(F.col("step").startswith("stop: "), F.expr("substring(step, 7)"))
        ends = F.when(refused, F.col("refused")).when(F.lit(late), CUT).when(F.col("passed"), PASSED).when(F.lit(turn == self.rounds), LAST).otherwise(F.coalesce(halts, F.lit("")))
        judged = self._put(whole.withColumn("ends", ends), f"round-{turn}/judged")
        going = judged.where("ends = ''").select("doc_id", "step")
        after = judged.select("doc_id", F.col("before").alias("after")).limit(0)
        if not going.isEmpty():
            pages = self._get(f"version-{turn}/pages")
            wanted = run_over(self.spark, "x20_ocr_targets", frames).select("doc_id", F.col("page_no").alias("page_index"))
            wanted = wanted.join(going.where("step = 'recognise, parse'").select("doc_id"), "doc_id", "left_semi")
            changed = self._put(self._repaired(pages, wanted), f"round-{turn}/pages")
            if not changed.isEmpty():
                docs = changed.select("doc_id").distinct()
                same = pages.join(docs, "doc_id", "left_semi").join(changed, ["doc_id", "page_index"], "left_anti")
                new = self._parse(same.unionByName(changed), files, turn + 1)
                after = run_over(self.spark, "a17_state_fingerprint", new).withColumnRenamed("fingerprint", "after")
        best = self.log().groupBy("doc_id").agg(F.max("score").alias("best")) if turn > 1 else judged.select("doc_id", F.lit(0).alias("best")).limit(0)
        met = judged.join(after, "doc_id", "left").join(best, "doc_id", "left").withColumn("after", F.coalesce("after", "before"))
        moved = ~F.col("after").eqNullSafe(F.col("before"))
        reason = F.when(F.col("ends") != "", F.col("ends")).when(~moved, SAME).when(F.col("score") < F.coalesce("best", F.lit(0)) - DROP, WORSE).otherwise("")
        self._put(met.withColumn("round", F.lit(turn)).withColumn("changed", moved).withColumn("reason", reason).select(*LOG), f"round-{turn}/log")
        if turn < self.rounds and self._path(f"version-{turn + 1}/names")[1].exists(self._path(f"version-{turn + 1}/names")[0]):
            self._narrow(turn)

    def _narrow(self, turn: int) -> None:
        """The next version keeps only documents that go on."""
        go = self._get(f"round-{turn}/log").where("reason = ''").select("doc_id")
        for k in [*self.frames(turn + 1), "pages"]:
            rows = self.keep(self._get(f"version-{turn + 1}/{k}").join(go, "doc_id", "left_semi"))
            self._put(rows, f"version-{turn + 1}/{k}")

    def result(self) -> tuple[dict[str, DataFrame], DataFrame]:
        """(frames, ends) of the rounds that are finished."""
        log = self.log()
        last = log.groupBy("doc_id").agg(F.max_by(F.struct("round", "score", "redline", "passed", "reason"), "round").alias("e"), F.max_by("round", F.struct(F.col("score"), -F.col("round"))).alias("best"))
        ends = last.select("doc_id", "e.*", F.when(F.col("e.reason") == WORSE, F.col("best")).otherwise(F.col("e.round")).alias("version"))
        ends = self.keep(ends)
        versions = sorted(r["version"] for r in ends.select("version").distinct().collect())
        kept = [{k: f.join(ends.where(F.col("version") == v).select("doc_id"), "doc_id", "left_semi") for k, f in self.frames(v).items()} for v in versions]
        return {k: reduce(DataFrame.unionByName, [x[k] for x in kept]) for k in kept[0]} if kept else {k: None for k in COLUMNS}, ends
