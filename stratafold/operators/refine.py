"""Refinement of a document's structure: local rules once, then rounds of a model's decisions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.operators.merge import merge_sections

#: Kinds of blocks; body lines from which a section is merged forward.
FRAGMENT, TITLE, BODY, LONG = "表格碎片", "标题", "正文", 4


def merge_directions(sections: DataFrame) -> DataFrame:
    """sections(doc_id, sec_ord, title, body, hard, keep_title) with the way a section goes: the first into the next one, long
    ones that have a next one too, all others into the one before; only those with a hard reason go."""
    last = sections.groupBy("doc_id").agg(F.max("sec_ord").alias("_last"), F.min("sec_ord").alias("_first"))
    lines = F.size(F.filter(F.split(F.coalesce("body", F.lit("")), "\n"), lambda x: F.trim(x) != ""))
    way = F.when(~F.col("hard"), F.lit(None)).when(F.col("sec_ord") == F.col("_first"), "next").when((lines > LONG) & (F.col("sec_ord") < F.col("_last")), "next").otherwise("previous")
    return sections.join(last, "doc_id").withColumn("direction", way).drop("_last", "_first")


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """blocks(doc_id, ord, kind, title, content, hard, soft): table fragments with a hard reason go, titles with a soft one
    become body text; changed tells which rows were rewritten."""
    kept = blocks.where(~((F.col("kind") == FRAGMENT) & F.col("hard")))
    down = (F.col("kind") == TITLE) & F.col("soft")
    joined = F.array_join(F.filter(F.array(F.trim("title"), F.trim("content")), lambda x: x != ""), "\n")
    return kept.select("doc_id", "ord", F.when(down, BODY).otherwise(F.col("kind")).alias("kind"), F.when(down, "").otherwise(F.col("title")).alias("title"), F.when(down, joined).otherwise(F.col("content")).alias("content"), down.alias("changed"))


def local_cleanup(sections: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sections after merging, blocks after cleaning, old and new section of every section that was merged away)."""
    merged = merge_sections(merge_directions(sections).select("doc_id", "sec_ord", "sec_no", "title", "body", "direction", "keep_title"))
    return merged.where("merged_into is null").drop("merged_into"), clean_blocks(blocks), merged.where("merged_into is not null").select("doc_id", "sec_ord", "merged_into")


def renamed_references(records: DataFrame, old_to_new: DataFrame, column: str = "section_ref") -> DataFrame:
    """Records whose section was renamed or merged away point to the new one. old_to_new(doc_id, old_ref, new_ref)."""
    met = records.join(old_to_new, (records["doc_id"] == old_to_new["doc_id"]) & (records[column] == old_to_new["old_ref"]), "left").drop(old_to_new["doc_id"])
    return met.withColumn(column, F.coalesce("new_ref", column)).drop("old_ref", "new_ref")


def refine(state: DataFrame, local: Callable[[DataFrame], DataFrame], candidates: Callable[[DataFrame], DataFrame], decide: Callable[[DataFrame], DataFrame] | None, apply: Callable[[DataFrame, DataFrame], DataFrame], normalise: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame], rounds: int = 2) -> tuple[DataFrame, list[dict]]:
    """(state, what each round did). Local rules work in round 0. Without a model (decide is None) that is all. With one, each
    round shows it the candidates and applies what it decides; a round without candidates, without a decision, or whose
    request fails is the last. keep writes a frame where its lineage ends. States are normalised after every change."""
    state = keep(normalise(local(state)))
    log: list[dict] = [{"round": 0, "stage": "local", "success": True}]
    if decide is None:
        return state, log
    for turn in range(1, max(1, rounds) + 1):
        shown = keep(candidates(state))
        n = shown.count()
        if not n:
            break
        try:
            decisions = keep(decide(shown))
            taken = decisions.count()
        except Exception as error:
            log.append({"round": turn, "stage": "model", "candidates": n, "success": False, "error": str(error)})
            break
        log.append({"round": turn, "stage": "model", "candidates": n, "success": True, "actions": taken})
        if not taken:
            break
        state = keep(normalise(apply(state, decisions)))
    return state, log
