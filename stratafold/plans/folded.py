"""Queries whose operator is a fold or a chain, which SQL does not express; tests hold them against plain loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.functions.dialect import DUCK, REGISTERED, Dialect
from stratafold.operators.folds import row_clusters
from stratafold.operators.pointers import page_sections
from stratafold.plans.document import to_shared
from stratafold.plans.merges import contracted
from stratafold.plans.pages import pointer, pointer_lines
from stratafold.plans.registry import query, run_sql, with_
from stratafold.plans.structure import sections


def _catalogue_pages(d: Dialect) -> dict[str, str]:
    return sections(d) | {"cpg": f"SELECT doc_id, page_index, {d.list_in_order('line', 'line_no')} AS lines FROM spec GROUP BY doc_id, page_index", "plp": pointer_lines(d)}


def j04_page_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section of every page of the catalogue by the greedy pointer over section titles, followed by doubling."""
    steps = _catalogue_pages(REGISTERED)
    heads = run_sql(spark, sf_dir, with_(steps, "SELECT doc_id, sec_ord, title FROM heads"))
    return page_sections(run_sql(spark, sf_dir, with_(steps, "SELECT * FROM plp")), heads, to_shared)


def w08_row_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of text boxes that are laid out from the parts: forty boxes a page."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    box = F.struct(F.col("p_partkey").alias("id"), (F.col("p_size") * 7.0).alias("cy"), (F.col("p_partkey") % 40 * 15.0).alias("cx"), (8.0 + F.col("p_partkey") % 5).alias("height"))
    pages = part.groupBy(F.expr("p_partkey div 40").alias("page")).agg(F.collect_list(box).alias("boxes"))
    return pages.select("page", F.inline(row_clusters(F.col("boxes"))))


def _merges(d: Dialect) -> dict[str, str]:
    """Sections of the catalogue with every short title to be merged into its neighbour; bodies are in order."""
    kept = f"SELECT doc_id, sec_ord, line, min({d.struct(p='page_index', l='line_no')}) AS place FROM s6 WHERE sec_ord > 0 AND (block_type IN ('正文', '标准引用') OR (is_head AND NOT opens)) GROUP BY doc_id, sec_ord, line"
    way = "CASE WHEN h.sec_ord = 1 THEN 'next' WHEN length(h.title) <= 6 THEN 'previous' END AS direction, true AS keep_title"
    steps = sections(d) | {"bod0": kept, "bod": f"SELECT doc_id, sec_ord, {d.join_in_order('line', 'place')} AS body FROM bod0 GROUP BY doc_id, sec_ord"}
    return steps | contracted(d, f"SELECT {d.apart('b')}h.doc_id, h.sec_ord, h.sec_no, h.title, coalesce(b.body, '') AS body, {way} FROM heads h LEFT JOIN bod b ON h.doc_id = b.doc_id AND h.sec_ord = b.sec_ord")


@query
def w06_section_merges(d):
    """Sections after all merges, with a digest of their bodies, and merged ones with the section they ended up in."""
    return with_(_merges(d), f"SELECT doc_id, sec_ord, sec_no, title, coalesce({d.sha256('body')}, '') AS body_sha, coalesce(merged_into, 0) AS merged_into FROM zm")


FOLDED = {f.__name__: f for f in (j04_page_pointer, w08_row_clusters)}


def folded_sql() -> dict[str, str]:
    """Oracles of those that DuckDB can follow step by step."""
    steps = _catalogue_pages(DUCK)
    walk = with_(steps | pointer(DUCK, sct="heads"), "SELECT doc_id, page_index, sec_ord FROM ptr").replace("WITH", "WITH RECURSIVE", 1)
    return {"j04_page_pointer": walk}
