"""Chains of section merges, and the review loop over documents that are not finished."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.functions.dialect import SPARK
from stratafold.plans.merges import contracted
from stratafold.plans.registry import with_
from stratafold.plans.steps import view


def merge_sections(sections: DataFrame) -> DataFrame:
    """Merge sections(doc_id, sec_ord, sec_no, title, body, direction, keep_title): rows with a direction ('previous' or
    'next') go into that neighbour, from the last to the first; lines go before the neighbour's if it is the next one, and
    none stands twice. keep_title makes the title a line of its own. Every input row comes back: survivors with their
    body, merged ones with the section they ended up in (see plans.merges)."""
    return sections.sparkSession.sql(with_(contracted(SPARK, f"SELECT * FROM {view(sections)}"), "SELECT * FROM zm"))


def review_loop(state: DataFrame, review: Callable[[DataFrame], DataFrame], repair: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame], rounds: int = 3, pass_mark: int = 85) -> DataFrame:
    """Rounds of review and repair. state has doc_id; review(state) gives doc_id, score, redline, fingerprint; repair(state)
    gives the next state. A document leaves the loop when it passes, when a repair leaves its fingerprint as it was, when
    its score falls, or after the last round. keep writes a frame where its lineage ends. Returns doc_id, round, score,
    redline, passed of the round with the best score, first one on ties."""
    history: list[DataFrame] = []
    active = state
    before: DataFrame | None = None
    for turn in range(1, rounds + 1):
        judged = review(active).withColumn("round", F.lit(turn)).withColumn("passed", (F.col("score") >= pass_mark) & ~F.col("redline"))
        judged = keep(judged)
        history.append(judged)
        going = judged.where(~F.col("passed")).select("doc_id", "fingerprint", "score")
        if before is not None:
            last = before.select("doc_id", F.col("fingerprint").alias("_f"), F.col("score").alias("_s"))
            going = going.join(last, "doc_id", "left").where("_f is null or (fingerprint <> _f and score >= _s)").drop("_f", "_s")
        before = judged
        if turn == rounds or going.limit(1).count() == 0:
            break
        active = keep(repair(active.join(going.select("doc_id"), "doc_id", "left_semi")))
    every = history[0]
    for h in history[1:]:
        every = every.unionByName(h)
    best = every.groupBy("doc_id").agg(F.max_by(F.struct("round", "score", "redline", "passed"), F.struct(F.col("score"), -F.col("round"))).alias("b"))
    return best.select("doc_id", "b.round", "b.score", "b.redline", "b.passed")
