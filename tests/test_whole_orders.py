"""Reviews of the derived documents read every order: none is left out by its key."""

import duckdb
import pytest

from stratafold.plans import all_queries, all_sql

NAMES = (
    "p04_quarantined_summary", "p05_quarantined_tags", "p02_round_states", "v03_summary_facts", "v04_tag_review", "v05_ocr_quality", "v08_metadata_mismatch",
    "v10_source_review", "v11_redlines", "v17_weak_backbone", "v18_suspicious_parameters", "d12_merged_issues", "a14_deduction_rollup", "a15_scores",
)


@pytest.mark.parametrize("name", NAMES)
def test_no_order_is_left_out(name):
    assert "FROM orders" in all_sql()[name] and "FROM orders WHERE" not in all_sql()[name]


def test_orders_of_any_key_are_parameters(spark, tmp_path):
    """Keys that leave a remainder of 4 on division by 7 were no parameters."""
    spark.range(200).selectExpr("id * 7 + 4 AS o_orderkey", "id % 3 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    got = all_queries()["v18_suspicious_parameters"](spark, str(tmp_path)).select("doc_id", "merged", "first_ord").collect()
    assert got and sorted(map(tuple, got)) == sorted(duck.execute(all_sql()["v18_suspicious_parameters"]).fetchall())
